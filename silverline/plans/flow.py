"""The whole raw-to-clean flow as one driver function over Spark jobs.

decrypt -> explode -> stage as files -> incremental ingest (bronze) ->
optional transform chain -> dedup or merge into the clean (silver) table.

Settings (a plain dict; only ``payloads``, ``key``, ``bronze_table`` and
``silver_table`` are required)::

    payloads        DataFrame with encrypted Fernet tokens
    payload_column  column of ``payloads`` holding the tokens (default "payload")
    key             Fernet key
    payload_schema  optional schema of one payload object ("id bigint, name string").
                    Without it the decrypted JSON text is staged as is (one payload
                    per line; a top-level array yields one row per element) and the
                    ingest schema store infers and evolves the columns.
    root            shared folder for staging, schemas, checkpoints
                    (default: the session's spark.checkpoint.dir)
    name, run_id    staging path is <root>/staging/<name>/run_<run_id>/<suffix>
    input_suffix    default "decrypted_data"
    bronze_table, silver_table
    transformations transform chain applied between bronze and silver
    merge_source    "bronze" (default): merge the whole bronze table, as a table job
                    would; "run": merge only the rows this run staged, so a run costs
                    O(new data). With "run" and an order_by, a matched row is updated
                    only by a strictly newer version, so late old versions are ignored.
    dedup           {"strategy": "merge_into", "keys": [...], "order_by": [...],
                     "update": {...} | None, "insert": "*" | {...} | None, ...}
                    or {"strategy": "drop_duplicates", "keys": [...]}
    rejects_table   optional table for payloads that cannot be used (run_id, reason, detail, payload as it came)
    on_reject       "keep" (default) goes on without them, "fail" raises after they are recorded

Every payload is decrypted and judged once and is then either staged or rejected, with a reason: "undecryptable",
"unparseable", "wrong shape" or "bad field" (:func:`silverline.functions.payload.payload_outcome`). A run
whose files are staged already (a retry with its ``run_id``) is not staged again, and its rejects are recorded once,
as a batch of their own. Without a ``rejects_table`` their number is logged. The merge
source is the bronze table (the latest row per key wins, so a rerun is idempotent). Schema and checkpoint
locations are ``<root>/{schemas,checkpoints}/<bronze table with . -> _>``.
"""

from __future__ import annotations

import logging
import uuid
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.functions.fernet import decrypt
from silverline.functions.payload import explode_payload, payload_outcome
from silverline.operators.dedup import drop_duplicates
from silverline.operators.merge import MergeSpec
from silverline.operators.transforms import apply_transformations
from silverline.session import scratch_root
from silverline.sources.ingest import run_ingest
from silverline.sources.tables import adopt_table, append_batch, create_table, merge_table, stage_files, write_snapshot

log = logging.getLogger(__name__)


def _has_files(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.format("binaryFile").load(path).select("path").isEmpty()
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            return False
        raise


def _judged(spark: SparkSession, s: dict[str, Any], col: str, where: str) -> DataFrame:
    """Every payload with its decrypted text and what is wrong with it, in one pass; a retry reads what was written."""
    if not _has_files(spark, f"{where}/_SUCCESS"):
        opened = s["payloads"].select(F.col(f"`{col}`").cast("string").alias("payload"), decrypt(F.col(f"`{col}`"), s["key"]).alias("json"))
        outcome = payload_outcome("json", s.get("payload_schema"))
        reason = F.when(F.col("json").isNull(), "undecryptable").otherwise(F.col("outcome.reason"))
        # the decrypted text is staged as rows; a payload that is not staged stays as it came
        (opened.withColumn("outcome", outcome).withColumn("reason", reason)
         .select("payload", F.when(F.col("reason").isNull(), F.col("json")).alias("json"), "reason",
                 F.when(F.col("json").isNotNull(), F.col("outcome.detail")).alias("detail"))
         .write.mode("overwrite").parquet(where))
    return spark.read.schema("payload string, json string, reason string, detail string").parquet(where)


def _record_rejects(spark: SparkSession, s: dict[str, Any], judged: DataFrame, run_id: str) -> None:
    """Put the run's rejects into ``rejects_table`` (where one is set) once, however often the run is tried."""
    rejected = judged.where("reason IS NOT NULL").select(F.lit(run_id).alias("run_id"), "reason", "detail", "payload")
    table = s.get("rejects_table")
    if table:
        if spark.catalog.tableExists(table):
            adopt_table(spark, table)
            if "detail" not in spark.table(table).columns:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`detail` string)")
        else:
            create_table(spark, table, rejected.schema)
        append_batch(spark, table, rejected, 0, f"flow-{run_id}")
    if s.get("on_reject", "keep") == "fail" or not table:
        counts = {r["reason"]: r["count"] for r in rejected.groupBy("reason").count().collect()}
        if counts and s.get("on_reject", "keep") == "fail":
            raise ValueError(f"run_flow: payloads of run {run_id} cannot be used: {counts}")
        if counts:
            log.warning("flow run %s: payloads left out, no rejects_table is set: %s", run_id, counts)


def run_flow(spark: SparkSession, settings: dict[str, Any]) -> DataFrame:
    s = dict(settings)
    for k in ("payloads", "key", "bronze_table", "silver_table"):
        if s.get(k) is None or (isinstance(s.get(k), str) and not s[k]):
            raise ValueError(f"run_flow: missing setting {k!r}")
    if s.get("on_reject", "keep") not in ("keep", "fail"):
        raise ValueError("run_flow: on_reject must be 'keep' or 'fail'")
    root = (s.get("root") or f"{scratch_root(spark)}/silverline/flow").rstrip("/")
    name = s.get("name", "flow")
    run_id = s.get("run_id") or uuid.uuid4().hex
    col = s.get("payload_column", "payload")

    suffix = s.get("input_suffix", "decrypted_data")
    run_dir = f"{root}/staging/{name}/run_{run_id}/{suffix}"
    # executors write, nothing passes through the driver
    judged = _judged(spark, s, col, f"{root}/staging/{name}/run_{run_id}/outcome")
    _record_rejects(spark, s, judged, run_id)
    plain = judged.where("reason IS NULL")
    if _has_files(spark, run_dir):
        log.info("flow %s: run %s is staged already", name, run_id)  # a retry of a run that got this far
    elif s.get("payload_schema"):
        stage_files(explode_payload(plain, "json", s["payload_schema"]), run_dir, "json")
    else:
        # raw line breaks in valid JSON are only whitespace between tokens
        one_line = F.replace(F.replace(F.col("json"), F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
        stage_files(plain.select(one_line.alias("value")), run_dir, "text")
    # one stable stream path over all runs: the checkpoint knows which files were ingested
    staged = f"{root}/staging/{name}/run_*/{suffix}"

    bronze = s["bronze_table"]
    safe = bronze.replace(".", "_")
    run_ingest(
        spark,
        staged,
        "json",
        bronze,
        f"{root}/schemas/{safe}",
        f"{root}/checkpoints/{safe}",
        options=s.get("ingest_options"),
    )
    merge_source = s.get("merge_source", "bronze")
    if merge_source == "bronze":
        source = spark.table(bronze)
    elif merge_source == "run":
        fmt_opts = {"multiLine": "false"}
        source = spark.read.schema(spark.table(bronze).schema).options(**fmt_opts).json(run_dir)
    else:
        raise ValueError(f"run_flow: merge_source must be 'bronze' or 'run', got {merge_source!r}")
    if s.get("transformations"):
        source = apply_transformations(source, s["transformations"])

    d = dict(s.get("dedup") or {"strategy": "drop_duplicates", "keys": None})
    strategy = d.get("strategy")
    silver = s["silver_table"]
    if strategy == "drop_duplicates":
        if merge_source == "run" and spark.catalog.tableExists(silver):  # earlier runs' rows stay
            source = spark.table(silver).unionByName(source, allowMissingColumns=True)
        write_snapshot(spark, silver, drop_duplicates(source, d["keys"]))
    elif strategy == "merge_into":
        order = d.get("order_by")
        order = [order] if isinstance(order, str) else order
        newer = None
        if merge_source == "run" and order:
            newer = F.struct(*[F.col(f"source.`{c}`") for c in order]) > \
                F.struct(*[F.col(f"target.`{c}`") for c in order])
        spec = MergeSpec(
            keys=d["keys"],
            extras=d.get("extras"),
            update=d.get("update", {c: f"source.`{c}`" for c in source.columns if c not in d["keys"]}),
            update_condition=d.get("update_condition", newer),
            insert=d.get("insert", "*"),
            delete_by_source=d.get("delete_by_source", False),
            update_by_source=d.get("update_by_source"),
            dedupe_source=d.get("order_by"),
        )
        merge_table(spark, silver, source, spec, create_schema=source.schema)
    else:
        raise ValueError(f"run_flow: unknown dedup strategy {strategy!r}")
    return spark.table(silver)
