"""Run the operators from the parameter dicts a config file holds.

Key mapping only: each function validates like the operator it calls and
raises ``ValueError`` for missing or empty required keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from silverline.operators.dedup import drop_duplicates
from silverline.operators.merge import MergeSpec
from silverline.sources.ingest import ingest, require
from silverline.sources.tables import dedup_table, merge_table

INGEST_REQUIRED = ("input_path", "input_format", "output_table_name", "schema_location",
                   "checkpoint_location")


# The key configs in the wild use for the ingest's output table, next to the plain one.
OUTPUT_TABLE_KEYS = ("output_table_name", "output_delta_table_name")


def ingest_from_params(spark: SparkSession, params: Mapping[str, Any]) -> StreamingQuery:
    """Start :func:`ingest` from an ingest parameter dict (output table key included)."""
    table = next((params[k] for k in OUTPUT_TABLE_KEYS if params.get(k)), None)
    require("ingest", {**params, "output_table_name": table}, INGEST_REQUIRED)
    opts = params.get("file_format_options")
    props = params.get("table_properties")
    return ingest(
        spark,
        params["input_path"],
        params["input_format"],
        table,
        params["schema_location"],
        params["checkpoint_location"],
        options=opts if isinstance(opts, Mapping) else None,
        trigger_type=params.get("trigger_type", "availableNow"),
        trigger_interval=params.get("trigger_interval"),
        output_mode=params.get("output_mode", "append"),
        table_properties=props if isinstance(props, Mapping) else None,
    )


def dedup_from_params(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """:func:`drop_duplicates` from a ``strategy='drop_duplicates'`` parameter dict."""
    strategy = params.get("strategy")
    if not strategy:
        raise ValueError("missing 'strategy'; must be 'drop_duplicates' or 'merge_into'")
    if strategy != "drop_duplicates":
        raise ValueError(f"dedup_from_params handles 'drop_duplicates', got {strategy!r}; "
                         "use merge_from_params for merges")
    require("dedup", params, ["deduplication_keys"])
    return drop_duplicates(df, params["deduplication_keys"], params.get("watermark_column"),
                           params.get("watermark_delay_threshold"), params.get("mode", "exact"))


def dedup_job_from_params(spark: SparkSession, params: Mapping[str, Any]) -> DataFrame:
    """:func:`dedup_table` from a dict with ``source_table_name``, ``target_table_name`` and the dedup keys."""
    require("dedup job", params, ["source_table_name", "target_table_name", "deduplication_keys"])
    return dedup_table(spark, params["source_table_name"], params["target_table_name"], params["deduplication_keys"],
                       params.get("watermark_column"), params.get("watermark_delay_threshold"), params.get("order_by"))


def merge_spec_from_params(params: Mapping[str, Any]) -> MergeSpec:
    """A :class:`MergeSpec` from a ``strategy='merge_into'`` dict with structured clauses.

    ``update`` and ``update_by_source`` map columns to expressions, ``insert`` does too or is ``"*"``;
    absent or ``"NONE"`` means no such clause. ``delete_by_source`` is true, false or a condition.
    """
    require("merge", params, ["deduplication_keys"])
    if params.get("strategy", "merge_into") != "merge_into":
        raise ValueError(f"merge_from_params handles 'merge_into', got {params['strategy']!r}")
    given = {k: v for k, v in params.items() if not (isinstance(v, str) and v.upper() == "NONE")}
    clauses = {k: given[k] for k in ("update", "insert", "update_by_source", "delete_by_source", "update_condition", "dedupe_source", "plan") if given.get(k)}
    spec = MergeSpec(keys=params["deduplication_keys"], extras=given.get("merge_condition_extras"), **clauses)
    spec.validate()
    return spec


def merge_from_params(spark: SparkSession, params: Mapping[str, Any]) -> DataFrame:
    """:func:`merge_table` from a dict: ``source_table_name``, ``target_table_name`` and the spec's keys."""
    require("merge", params, ["source_table_name", "target_table_name"])
    return merge_table(spark, params["target_table_name"], params["source_table_name"], merge_spec_from_params(params))
