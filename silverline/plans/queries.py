"""Registered queries: one per operator, over the given tables, with DuckDB oracle SQL.

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame computed from the
parquet tables under ``sf_dir`` (whole tables, no row caps). Builders for
streaming and table operators run their job when called (files are staged under
the session's shared scratch folder, a stream or table job runs to completion)
and return a DataFrame over the resulting table.

``ORACLE`` holds the equivalent SQL for DuckDB, over the same tables as views.
Output column names and types are kept equal on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.functions.fernet import decrypt, encrypt_column, generate_key_from
from silverline.functions.payload import explode_payload, explode_with_rejects, json_validity
from silverline.operators.dedup import drop_duplicates, flag_latest, keep_rows
from silverline.operators.merge import MergeSpec, merge, scd2_apply, scd2_expire
from silverline.operators.transforms import Transformer, apply_transformations
from silverline.plans.flow import run_flow
from silverline.session import scratch_path
from silverline.sources.ingest import ingest, run_ingest
from silverline.sources.tables import (
    JSON_WRITE_OPTIONS, create_table, dedup_table, merge_table, stage_files, write_snapshot,
)
from silverline.streaming.dedup import dedup_stream
from silverline.streaming.merge import merge_stream

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}

# A fixed key for fixtures only (32 bytes 0..31, url-safe base64).
FIXTURE_KEY = generate_key_from(bytes(range(32)))
# Files that a staged table is dealt over: streams read a fixed number of micro-batches at any size.
STAGED_FILES = 4


def register(name: str, sql: str | None = None):
    def _add(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return _add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _name(prefix: str) -> str:
    return f"silverline_{prefix}_{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------------------
# Transforms
# ---------------------------------------------------------------------------

@register("rename_columns", """
SELECT event_id, ts, user_id, event_type AS kind, value AS amount, props FROM events
""")
def q_rename_columns(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    return apply_transformations(ev, [
        {"name": "rename_columns", "params": {"mapper": {"event_type": "kind", "value": "amount", "nope": "x"}}},
    ])


@register("rename_swap", """
SELECT c_custkey, c_mktsegment AS c_name, c_nationkey, c_acctbal, c_name AS c_mktsegment FROM customer
""")
def q_rename_swap(spark, sf_dir):
    cu = _read(spark, sf_dir, "customer")
    return apply_transformations(cu, [
        {"name": "rename_columns", "params": {"mapper": {"c_name": "c_mktsegment", "c_mktsegment": "c_name"}}},
    ])


@register("add_column_literal", """
SELECT *, 'nightly' AS feed FROM lineitem
""")
def q_add_column_literal(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    return apply_transformations(li, [
        {"name": "add_column", "params": {"column_name": "feed", "value": "nightly"}},
    ])


@register("add_column_expr", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 10 AS l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
       l_extendedprice * (1 - l_discount) AS net_price
FROM lineitem
""")
def q_add_column_expr(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    return apply_transformations(li, [
        {"name": "add_column", "params": {"column_name": "net_price",
                                          "expression": "l_extendedprice * (1 - l_discount)"}},
        # overwrite in place, expression wins over value
        {"name": "add_column", "params": {"column_name": "l_quantity", "expression": "l_quantity + 10",
                                          "value": 0}},
    ])


@register("drop_columns", """
SELECT * EXCLUDE (l_tax, l_linestatus) FROM lineitem
""")
def q_drop_columns(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    return apply_transformations(li, [
        {"name": "drop_columns", "params": {"columns_to_drop": ["l_tax", "l_linestatus", "l_absent"]}},
    ])


@register("filter_rows", """
SELECT * FROM events WHERE value > 15 AND event_type <> 'view'
""")
def q_filter_rows(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    return apply_transformations(ev, [
        {"name": "filter_rows", "params": {"query_string": "value > 15 and event_type != 'view'"}},
    ])


@register("filter_null_keeping", """
SELECT * FROM (SELECT *, NULLIF(event_type, 'click') AS kind FROM events) q
WHERE kind IS DISTINCT FROM 'view' AND (kind IS NULL OR kind NOT IN ('error'))
""")
def q_filter_null_keeping(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    return apply_transformations(ev, [
        {"name": "add_column", "params": {"column_name": "kind", "expression": "nullif(event_type, 'click')"}},
        {"name": "filter_rows", "params": {"conditions": [("kind", "!=", "view"), ("kind", "not in", ["error"])]}},
    ])


CHAIN = [
    {"name": "rename_columns", "params": {"mapper": {"event_type": "kind", "value": "score"}}},
    {"name": "add_column", "params": {"column_name": "score_up", "expression": "score + 10"}},
    {"name": "add_column", "params": {"column_name": "origin", "value": "web"}},
    {"name": "filter_rows", "params": {"query_string": "score > 15 and kind != 'error'"}},
    {"name": "drop_columns", "params": {"columns_to_drop": ["props", "no_such"]}},
    {"name": "not_a_transform", "params": {}},
    {"bad": "entry"},
]


@register("transform_chain", """
SELECT event_id, ts, user_id, event_type AS kind, value AS score,
       value + 10 AS score_up, 'web' AS origin
FROM events WHERE value > 15 AND event_type <> 'error'
""")
def q_transform_chain(spark, sf_dir):
    return apply_transformations(_read(spark, sf_dir, "events"), CHAIN)


@register("transform_custom", """
SELECT event_id, ts, user_id, event_type, value, props,
       CAST(hour(ts) AS INTEGER) AS event_hour, upper(event_type) AS kind
FROM events
""")
def q_transform_custom(spark, sf_dir):
    tr = Transformer()

    @tr.register("with_event_hour")
    def _hour(df, params):
        return df.withColumn(params.get("out", "event_hour"), F.hour(params.get("ts", "ts")))

    tr.register("upper_copy", lambda df, p: df.withColumn(p["out"], F.upper(p["col"])))
    return tr.apply_transformations(_read(spark, sf_dir, "events"), [
        {"name": "with_event_hour", "params": {}},
        {"name": "upper_copy", "params": {"col": "event_type", "out": "kind"}},
    ])


# ---------------------------------------------------------------------------
# Dedup
# ---------------------------------------------------------------------------

@register("dedup_batch", """
SELECT DISTINCT user_id, event_type FROM events
""")
def q_dedup_batch(spark, sf_dir):
    return drop_duplicates(_read(spark, sf_dir, "events"), ["user_id", "event_type"]).select("user_id", "event_type")


@register("dedup_batch_rows", """
SELECT user_id, event_type, CAST(1 AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS n_whole_rows FROM events GROUP BY user_id, event_type
""")
def q_dedup_batch_rows(spark, sf_dir):
    """Whole surviving rows: one for each key, and each one is a row of the input in all its columns."""
    events = _read(spark, sf_dir, "events")
    out = drop_duplicates(events, ["user_id", "event_type"])
    values = ["ts", "value", "props"]
    given = events.select("event_id", F.struct("user_id", "event_type", *values).alias("given"))
    checked = out.join(given, "event_id").withColumn("whole", F.struct("user_id", "event_type", *values).eqNullSafe(F.col("given")))
    return checked.groupBy("user_id", "event_type").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("whole").cast("long")).alias("n_whole_rows"))


def _rn_sql(order: str) -> str:
    return f"""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY {order}) AS rn FROM events
) q WHERE rn = 1
"""


@register("dedup_keep_first", _rn_sql("ts ASC, event_id ASC"))
def q_dedup_keep_first(spark, sf_dir):
    return keep_rows(_read(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"], "first")


@register("dedup_keep_last", _rn_sql("ts DESC, event_id DESC"))
def q_dedup_keep_last(spark, sf_dir):
    return keep_rows(_read(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"], "last")


@register("dedup_keep_none", """
SELECT doc_id, text, lang, source, n_chars FROM (
  SELECT *, count(*) OVER (PARTITION BY text) AS n FROM documents
) q WHERE n = 1
""")
def q_dedup_keep_none(spark, sf_dir):
    return keep_rows(_read(spark, sf_dir, "documents"), ["text"], keep=False)


@register("dedup_latest_flag", """
SELECT event_id, ts, user_id, event_type, value, props,
       row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
         AS is_latest_record
FROM events
""")
def q_dedup_latest_flag(spark, sf_dir):
    return flag_latest(_read(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@register("dedup_table_job", """
SELECT DISTINCT text FROM documents
""")
def q_dedup_table_job(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    src, dst = _name("docs_raw"), _name("docs_dedup")
    write_snapshot(spark, src, docs)
    # dedup in place first (source == target), then into a second table
    dedup_table(spark, src, src, ["text"])
    return dedup_table(spark, src, dst, ["text"]).select("text")


# ---------------------------------------------------------------------------
# Merge
# ---------------------------------------------------------------------------

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
T_SQL = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'"
S_SQL = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, "
         "o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'")
WITH_TS = f"WITH t AS ({T_SQL}), s AS ({S_SQL})"


def _merge_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    o = _read(spark, sf_dir, "orders")
    t = o.filter(F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'"))
    s = o.filter(F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1999-01-01 00:00:00'")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    return t, s


UPDATE = {"o_totalprice": "source.o_totalprice", "o_orderstatus": "source.o_orderstatus"}


def _upd_select(matched: str, by_source_status: str = "t.o_orderstatus") -> str:
    return (
        f"t.o_orderkey, t.o_custkey, "
        f"CASE WHEN {matched} THEN s.o_orderstatus ELSE {by_source_status} END AS o_orderstatus, "
        f"CASE WHEN {matched} THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice, "
        f"t.o_orderdate, t.o_orderpriority"
    )


INSERTS = "SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)"


@register("merge_upsert", f"""
{WITH_TS}
SELECT {_upd_select('s.o_orderkey IS NOT NULL')} FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
UNION ALL {INSERTS}
""")
def q_merge_upsert(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    return merge(t, s, MergeSpec(keys=["o_orderkey"], update=UPDATE, insert="*"))


@register("merge_full_outer", ORACLE["merge_upsert"])
def q_merge_full_outer(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    return merge(t, s, MergeSpec(keys=["o_orderkey"], update=UPDATE, insert="*", plan="full_outer"))


@register("merge_insert_only", f"""
{WITH_TS}
SELECT * FROM t
UNION ALL
SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)
""")
def q_merge_insert_only(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    ins = {c: f"source.{c}" for c in ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]}
    return merge(t, s, MergeSpec(keys=["o_orderkey"], update="NONE", insert=ins))


@register("merge_insert_star", f"""
{WITH_TS}
SELECT * FROM t UNION ALL {INSERTS}
""")
def q_merge_insert_star(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    return merge(t, s, MergeSpec(keys=["o_orderkey"], insert="*"))


@register("merge_update_only", f"""
{WITH_TS}
SELECT {_upd_select('s.o_orderkey IS NOT NULL')} FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
""")
def q_merge_update_only(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    return merge(t, s, MergeSpec(keys=["o_orderkey"], update=UPDATE))


@register("merge_delete_by_source", f"""
{WITH_TS}
SELECT {_upd_select('TRUE')} FROM t JOIN s ON t.o_orderkey = s.o_orderkey
UNION ALL {INSERTS}
""")
def q_merge_delete_by_source(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    return merge(t, s, MergeSpec(keys=["o_orderkey"], update=UPDATE, insert="*", delete_by_source=True))


@register("merge_update_by_source", f"""
{WITH_TS}
SELECT * FROM t WHERE EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL
SELECT o_orderkey, o_custkey, 'C' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL {INSERTS}
""")
def q_merge_update_by_source(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    return merge(t, s, MergeSpec(keys=["o_orderkey"], insert="*", update_by_source={"o_orderstatus": "'C'"}))


@register("merge_by_source_delete_then_update", f"""
{WITH_TS}
SELECT {_upd_select('s.o_orderkey IS NOT NULL', "'C'")}
FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
WHERE s.o_orderkey IS NOT NULL OR NOT (t.o_totalprice < 250000)
UNION ALL {INSERTS}
""")
def q_merge_by_source_delete_then_update(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    return merge(t, s, MergeSpec(
        keys=["o_orderkey"], update=UPDATE, insert="*",
        delete_by_source="target.o_totalprice < 250000",
        update_by_source={"o_orderstatus": "'C'"},
    ))


@register("merge_condition_extras", f"""
{WITH_TS}
SELECT {_upd_select('s.o_orderkey IS NOT NULL')}
FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey AND s.o_orderstatus = 'O'
UNION ALL
SELECT s.* FROM s WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey AND s.o_orderstatus = 'O')
""")
def q_merge_condition_extras(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    return merge(t, s, MergeSpec(keys=["o_orderkey"], extras="AND source.o_orderstatus = 'O'",
                                 update=UPDATE, insert="*"))


@register("merge_dedupe_source", f"""
WITH t AS ({T_SQL}), s0 AS ({S_SQL}),
s2 AS (
  SELECT *, 1 AS v FROM s0
  UNION ALL
  SELECT o_orderkey, o_custkey, 'P' AS o_orderstatus, o_totalprice + 100 AS o_totalprice, o_orderdate,
         o_orderpriority, 2 AS v
  FROM s0 WHERE o_orderpriority = '1-URGENT'
),
s AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY v DESC) AS rn FROM s2) q
  WHERE rn = 1
)
SELECT {_upd_select('s.o_orderkey IS NOT NULL')} FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
UNION ALL {INSERTS}
""")
def q_merge_dedupe_source(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    v2 = (s.filter(F.col("o_orderpriority") == "1-URGENT")
          .withColumn("o_orderstatus", F.lit("P"))
          .withColumn("o_totalprice", F.col("o_totalprice") + 100)
          .withColumn("v", F.lit(2)))
    s2 = s.withColumn("v", F.lit(1)).unionByName(v2)
    return merge(t, s2, MergeSpec(keys=["o_orderkey"], update=UPDATE, insert="*", dedupe_source="v"))


@register("merge_table_job", ORACLE["merge_upsert"])
def q_merge_table_job(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    tgt, src = _name("orders_silver"), _name("orders_bronze")
    write_snapshot(spark, tgt, t)
    write_snapshot(spark, src, s)
    return merge_table(spark, tgt, src, MergeSpec(keys=["o_orderkey"], update=UPDATE, insert="*"))


@register("merge_partitioned_table_job", f"""
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM (
{WITH_TS}
SELECT {_upd_select('s.o_orderkey IS NOT NULL')} FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
UNION ALL {INSERTS}
) q
""")
def q_merge_partitioned_table_job(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    year = F.year("o_orderdate").alias("o_year")
    t, s = t.select("*", year), s.select("*", year)
    tgt = _name("orders_by_year")
    create_table(spark, tgt, t.schema, partition_by=["o_year"])
    write_snapshot(spark, tgt, t)
    # the source touches 1999 onwards: earlier year partitions are neither read nor rewritten
    spec = MergeSpec(keys=["o_orderkey", "o_year"], update=UPDATE, insert="*")
    return merge_table(spark, tgt, s, spec)


@register("merge_foreachbatch", ORACLE["merge_upsert"])
def q_merge_foreachbatch(spark, sf_dir):
    t, s = _merge_inputs(spark, sf_dir)
    tgt = _name("orders_stream_silver")
    write_snapshot(spark, tgt, t)
    inp = scratch_path(spark, "merge_foreachbatch_input")
    cp = scratch_path(spark, "merge_foreachbatch_cp")
    cut = F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    spec = MergeSpec(keys=["o_orderkey"], update=UPDATE, insert="*")
    # two arrivals, each picked up by its own run of the stream: two micro-batches
    for part in (s.filter(F.col("o_orderdate") < cut), s.filter(F.col("o_orderdate") >= cut)):
        stage_files(part, inp, "parquet")
        q = merge_stream(spark.readStream.schema(s.schema).parquet(inp), tgt, spec, cp)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return spark.table(tgt)


@register("merge_two_streams", ORACLE["merge_upsert"])
def q_merge_two_streams(spark, sf_dir):
    """Two streams into one table: each counts its batches on its own, so neither hides the other's."""
    t, s = _merge_inputs(spark, sf_dir)
    tgt = _name("orders_two_streams")
    write_snapshot(spark, tgt, t)
    spec = MergeSpec(keys=["o_orderkey"], update=UPDATE, insert="*")
    cut = F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    for part in (s.filter(F.col("o_orderdate") < cut), s.filter(F.col("o_orderdate") >= cut)):
        inp, cp = scratch_path(spark, "two_streams_input"), scratch_path(spark, "two_streams_cp")
        stage_files(part, inp, "parquet")
        q = merge_stream(spark.readStream.schema(s.schema).parquet(inp), tgt, spec, cp)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return spark.table(tgt)


DIM_SQL = """
dim AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, TRUE AS is_current,
         TIMESTAMP '2020-01-01 00:00:00' AS valid_from_ts, CAST(NULL AS TIMESTAMP) AS valid_to_ts,
         'active' AS status
  FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal - 100 AS c_acctbal, c_mktsegment, FALSE AS is_current,
         TIMESTAMP '2010-01-01 00:00:00' AS valid_from_ts, TIMESTAMP '2020-01-01 00:00:00' AS valid_to_ts,
         'closed' AS status
  FROM customer WHERE c_acctbal < 0
),
chg AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment,
         TIMESTAMP '2024-01-01 00:00:00' AS update_ts
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
)"""

SCD2_EXPIRE_SQL = f"""
WITH {DIM_SQL}
SELECT d.c_custkey, d.c_name, d.c_nationkey, d.c_acctbal, d.c_mktsegment,
       FALSE AS is_current,
       d.valid_from_ts,
       CASE WHEN c.c_custkey IS NOT NULL THEN c.update_ts ELSE d.valid_to_ts END AS valid_to_ts,
       CASE WHEN c.c_custkey IS NOT NULL THEN d.status ELSE 'archived' END AS status
FROM dim d LEFT JOIN chg c ON d.c_custkey = c.c_custkey AND d.is_current = TRUE
"""


def _dim_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    cu = _read(spark, sf_dir, "customer")
    ts = lambda s: F.expr(f"TIMESTAMP_NTZ '{s}'")
    cur = cu.select("*", F.lit(True).alias("is_current"), ts("2020-01-01 00:00:00").alias("valid_from_ts"),
                    F.lit(None).cast("timestamp_ntz").alias("valid_to_ts"), F.lit("active").alias("status"))
    hist = cu.filter("c_acctbal < 0").select(
        "c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") - 100).alias("c_acctbal"), "c_mktsegment",
        F.lit(False).alias("is_current"), ts("2010-01-01 00:00:00").alias("valid_from_ts"),
        ts("2020-01-01 00:00:00").alias("valid_to_ts"), F.lit("closed").alias("status"))
    chg = cu.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        "c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") + 100).alias("c_acctbal"), "c_mktsegment",
        ts("2024-01-01 00:00:00").alias("update_ts"))
    return cur.unionByName(hist), chg


@register("scd2_expire", SCD2_EXPIRE_SQL)
def q_scd2_expire(spark, sf_dir):
    dim, chg = _dim_inputs(spark, sf_dir)
    return scd2_expire(dim, chg, ["c_custkey"], "update_ts")


# closed versions, archived versions, history as it was, and the new versions
SCD2_APPLY_SQL = f"""
WITH {DIM_SQL}
SELECT d.c_custkey, d.c_name, d.c_nationkey, d.c_acctbal, d.c_mktsegment, FALSE AS is_current, d.valid_from_ts,
       CASE WHEN d.is_current AND c.c_custkey IS NOT NULL THEN c.update_ts ELSE d.valid_to_ts END AS valid_to_ts,
       CASE WHEN d.is_current AND c.c_custkey IS NULL THEN 'archived' ELSE d.status END AS status
FROM dim d LEFT JOIN chg c ON d.c_custkey = c.c_custkey
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, TRUE AS is_current,
       update_ts AS valid_from_ts, CAST(NULL AS TIMESTAMP) AS valid_to_ts, 'active' AS status
FROM chg
"""


@register("scd2_apply", SCD2_APPLY_SQL)
def q_scd2_apply(spark, sf_dir):
    dim, chg = _dim_inputs(spark, sf_dir)
    return scd2_apply(dim, chg, ["c_custkey"], "update_ts")


@register("scd2_rerun", SCD2_APPLY_SQL)
def q_scd2_rerun(spark, sf_dir):
    """The same changes applied twice: the second time changes nothing."""
    dim, chg = _dim_inputs(spark, sf_dir)
    once = scd2_apply(dim, chg, ["c_custkey"], "update_ts")
    return scd2_apply(once, chg, ["c_custkey"], "update_ts")


NULL_KEY_CHANGES = "CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_custkey END"


@register("scd2_null_keys", f"""
WITH {DIM_SQL},
keyed AS (SELECT {NULL_KEY_CHANGES} AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, update_ts FROM chg)
SELECT d.c_custkey, d.c_name, d.c_nationkey, d.c_acctbal, d.c_mktsegment, FALSE AS is_current, d.valid_from_ts,
       CASE WHEN d.is_current AND c.c_custkey IS NOT NULL THEN c.update_ts ELSE d.valid_to_ts END AS valid_to_ts,
       CASE WHEN d.is_current AND c.c_custkey IS NULL THEN 'archived' ELSE d.status END AS status
FROM dim d LEFT JOIN keyed c ON d.c_custkey = c.c_custkey
UNION ALL
SELECT coalesce(c_custkey, -1), c_name, c_nationkey, c_acctbal, c_mktsegment, TRUE AS is_current,
       update_ts AS valid_from_ts, CAST(NULL AS TIMESTAMP) AS valid_to_ts, 'active' AS status
FROM keyed
""")
def q_scd2_null_keys(spark, sf_dir):
    """Changes of which some have no key, applied three times."""
    dim, chg = _dim_inputs(spark, sf_dir)
    chg = chg.withColumn("c_custkey", F.expr(NULL_KEY_CHANGES))
    for _ in range(3):
        dim = scd2_apply(dim, chg, ["c_custkey"], "update_ts")
    return dim.withColumn("c_custkey", F.coalesce("c_custkey", F.lit(-1).cast("bigint")))


@register("merge_sized_table_job", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_totalprice END AS o_totalprice
FROM orders
""")
def q_merge_sized_table_job(spark, sf_dir):
    """A table job whose source is over the broadcast limit: rows without a match pass by, the others meet in one join."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    table = _name("orders_sized")
    # the target holds every order but a seventh; the source every second one
    write_snapshot(spark, table, o.where("o_orderkey % 14 <> 0"))
    source = o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        merge_table(spark, table, source, MergeSpec(
            keys=["o_orderkey"], update={"o_orderstatus": "source.o_orderstatus", "o_totalprice": "source.o_totalprice"}, insert="*",
            update_by_source={"o_totalprice": "CASE WHEN target.o_orderkey % 3 = 0 THEN -1 ELSE target.o_totalprice END"}))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return spark.table(table)


# ---------------------------------------------------------------------------
# Payloads
# ---------------------------------------------------------------------------

@register("decrypt_column", """
SELECT doc_id, text FROM documents
""")
def q_decrypt_column(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    enc = encrypt_column(docs, "text", FIXTURE_KEY, out="token").select("doc_id", "token")
    return enc.select("doc_id", decrypt("token", FIXTURE_KEY).alias("text"))


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
# Events per payload: each payload is a bounded JSON array, whatever the key skew.
PAYLOAD_ROWS = 64


def event_payloads(ev: DataFrame) -> DataFrame:
    """Events packed into JSON arrays of at most ``PAYLOAD_ROWS`` consecutive event ids."""
    return ev.groupBy(F.floor(F.col("event_id") / PAYLOAD_ROWS).alias("batch")).agg(
        F.to_json(F.collect_list(F.struct(*EVENT_COLS)), JSON_WRITE_OPTIONS).alias("payload")
    )


@register("explode_payload", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def q_explode_payload(spark, sf_dir):
    return explode_payload(event_payloads(_read(spark, sf_dir, "events")), "payload", EVENT_SCHEMA)


DAMAGE_SQL = """
CASE WHEN event_type = 'error' AND value < 50 THEN substr(props, 1, length(props) - 1)
     WHEN event_type = 'signup' AND value < 10 THEN 'null'
     WHEN event_type = 'view' AND value < 10 THEN ''
     ELSE props END
"""


@register("split_valid_json", f"""
SELECT event_id, payload, COALESCE(json_valid(payload), FALSE) AND payload <> 'null' AS is_valid
FROM (SELECT event_id, {DAMAGE_SQL} AS payload FROM events) q
""")
def q_split_valid_json(spark, sf_dir):
    ev = _read(spark, sf_dir, "events").select("event_id", F.expr(DAMAGE_SQL).alias("payload"))
    return ev.select("event_id", "payload", json_validity("payload").alias("is_valid"))


ODD_PAYLOAD_SQL = """
CASE event_id % 8 WHEN 0 THEN concat('[{"id":', event_id, ',"kind":"', event_type, '"},{"id":null}]')
     WHEN 1 THEN concat('{"id":', event_id, ',"other":[1]}') WHEN 2 THEN '[]' WHEN 3 THEN concat('[', event_id, ']')
     WHEN 4 THEN concat('{"other":', event_id, '}') WHEN 5 THEN concat('[{"id":"', event_type, '"}]')
     WHEN 6 THEN substr(props, 1, length(props) - 1) ELSE 'null' END
"""


@register("explode_payload_rejects", """
SELECT event_id, event_id AS id, CASE WHEN event_id % 8 = 0 THEN event_type END AS kind, CAST(NULL AS VARCHAR) AS reason
FROM events WHERE event_id % 8 IN (0, 1)
UNION ALL
SELECT event_id, -1, NULL, NULL FROM events WHERE event_id % 8 = 0
UNION ALL
SELECT event_id, -1, NULL, CASE event_id % 8 WHEN 5 THEN 'bad field' WHEN 6 THEN 'unparseable' ELSE 'wrong shape' END
FROM events WHERE event_id % 8 > 2
""")
def q_explode_payload_rejects(spark, sf_dir):
    """Rows of usable payloads and the reasons of all others."""
    ev = _read(spark, sf_dir, "events").select("event_id", F.expr(ODD_PAYLOAD_SQL).alias("payload"))
    rows, rejects = explode_with_rejects(ev, "payload", "id bigint, kind string", keep=["event_id"])
    none = F.lit(-1).cast("bigint")
    return rows.select("event_id", F.coalesce("id", none).alias("id"), "kind", F.lit(None).cast("string").alias("reason")).unionByName(
        rejects.select("event_id", none.alias("id"), F.lit(None).cast("string").alias("kind"), "reason"))


# ---------------------------------------------------------------------------
# Streaming dedup and ingest
# ---------------------------------------------------------------------------

def _stage(df: DataFrame, path: str, fmt: str = "parquet", **options) -> str:
    return stage_files(df.repartition(STAGED_FILES), path, fmt, options)


@register("dedup_stream", """
SELECT DISTINCT user_id, event_type FROM events
""")
def q_dedup_stream(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    inp = _stage(ev, scratch_path(spark, "dedup_stream_in"))
    table = _name("events_dedup_stream")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(inp)
    q = dedup_stream(stream, ["user_id", "event_type"], table, scratch_path(spark, "dedup_stream_cp"),
                     select=["user_id", "event_type"])
    q.awaitTermination()
    return spark.table(table)


@register("dedup_stream_watermark", """
SELECT DISTINCT user_id, event_type, date_trunc('day', ts) AS day FROM events
""")
def q_dedup_stream_watermark(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    inp = _stage(ev, scratch_path(spark, "dedup_wm_in"))
    table = _name("events_dedup_wm")
    stream = (spark.readStream.schema(ev.schema).parquet(inp)
              .withColumn("day", F.date_trunc("day", "ts"))
              .withColumn("day_ts", F.col("day").cast("timestamp")))
    q = dedup_stream(stream, ["user_id", "event_type", "day_ts"], table, scratch_path(spark, "dedup_wm_cp"),
                     watermark_column="day_ts", watermark_delay="1 day",
                     select=["user_id", "event_type", "day"])
    q.awaitTermination()
    return spark.table(table)


@register("dedup_stream_within_watermark", """
SELECT DISTINCT user_id, event_type FROM events
""")
def q_dedup_stream_within_watermark(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    inp = _stage(ev, scratch_path(spark, "dedup_wwm_in"))
    table = _name("events_dedup_wwm")
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(inp)
              .withColumn("event_ts", F.col("ts").cast("timestamp")))
    # a delay longer than the data's time span: every repeat of a key is within it
    q = dedup_stream(stream, ["user_id", "event_type"], table, scratch_path(spark, "dedup_wwm_cp"),
                     watermark_column="event_ts", watermark_delay="400 days", mode="within_watermark",
                     select=["user_id", "event_type"])
    q.awaitTermination()
    return spark.table(table)


LATE_CUT = "2024-01-15 00:00:00"


@register("dedup_stream_late", f"""
SELECT DISTINCT user_id, event_type, date_trunc('day', ts) AS day FROM events WHERE ts >= TIMESTAMP '{LATE_CUT}'
""")
def q_dedup_stream_late(spark, sf_dir):
    """Events of the first days come in a second run, behind the watermark of the first: they are late and stay out."""
    ev = _read(spark, sf_dir, "events")
    inp, cp, table = scratch_path(spark, "dedup_late_in"), scratch_path(spark, "dedup_late_cp"), _name("events_dedup_late")
    late = F.col("ts") < F.expr(f"TIMESTAMP_NTZ '{LATE_CUT}'")
    for part in (ev.where(~late), ev.where(late)):
        _stage(part, inp)
        stream = (spark.readStream.schema(ev.schema).parquet(inp)
                  .withColumn("day", F.date_trunc("day", "ts")).withColumn("day_ts", F.col("day").cast("timestamp")))
        q = dedup_stream(stream, ["user_id", "event_type", "day_ts"], table, cp, watermark_column="day_ts", watermark_delay="1 day",
                         select=["user_id", "event_type", "day"])
        q.awaitTermination()
    return spark.table(table)


def _ingest_paths(spark: SparkSession, tag: str) -> dict[str, str]:
    return {
        "input_path": scratch_path(spark, f"{tag}_in"),
        "schema_location": scratch_path(spark, f"{tag}_schema"),
        "checkpoint_location": scratch_path(spark, f"{tag}_cp"),
    }


def _events_typed(exclude: tuple[str, ...] = ()) -> list:
    """Event columns cast back to the source types (JSON infers ts as a string)."""
    types = dict(event_id="bigint", ts="timestamp_ntz", user_id="bigint", event_type="string",
                 value="double", props="string")
    return [F.col(c).cast(t).alias(c) for c, t in types.items() if c not in exclude]


@register("ingest_json", "SELECT * FROM events")
def q_ingest_json(spark, sf_dir):
    p = _ingest_paths(spark, "ingest_json")
    _stage(_read(spark, sf_dir, "events"), p["input_path"], "json")
    table = _name("bronze_events_json")
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"],
               options={"_comment": "config comments are dropped", "multiLine": False})
    return spark.table(table).select(_events_typed())


@register("ingest_json_rescue", """
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN NULL
            ELSE CAST(json_object('props', props) AS VARCHAR) END AS _rescued_data
FROM events
""")
def q_ingest_json_rescue(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    p = _ingest_paths(spark, "ingest_rescue")
    table = _name("bronze_events_rescue")
    early = F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    _stage(ev.filter(early).drop("props"), p["input_path"], "json")
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"],
               rescue_column="_rescued_data")
    # later files carry a column the fixed schema lacks: kept in the rescue column
    _stage(ev.filter(~early), p["input_path"], "json")
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"],
               evolve=False, rescue_column="_rescued_data")
    return spark.table(table).select(*_events_typed(exclude=("props",)), "_rescued_data")


@register("ingest_drift_running", """
SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 3 = 2 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS props,
       CASE WHEN event_id % 3 = 2 THEN CAST(json_object('value', event_type) AS VARCHAR) END AS _rescued_data
FROM events
""")
def q_ingest_drift_running(spark, sf_dir):
    """One running stream meets a new column, then a column with another type."""
    ev = _read(spark, sf_dir, "events")
    p = _ingest_paths(spark, "ingest_drift")
    table = _name("bronze_events_drift")
    part = lambda k: ev.where(F.col("event_id") % 3 == k)
    _stage(part(0).drop("props"), p["input_path"], "json")
    q = ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"],
               trigger_type="processingTime", trigger_interval="1 second")
    try:
        q.processAllAvailable()
        _stage(part(1), p["input_path"], "json")
        q.processAllAvailable()
        _stage(part(2).withColumn("value", F.col("event_type")), p["input_path"], "json")
        q.processAllAvailable()
    finally:
        q.stop()
    t = spark.table(table)
    # a table too small for every kind of drift lacks the columns that it would have brought
    missing = [F.lit(None).cast("string").alias(c) for c in ("props", "_rescued_data") if c not in t.columns]
    return t.select("*", *missing).select(*_events_typed(), "_rescued_data")


@register("ingest_then_dedup_in_place", f"""
SELECT * FROM events
UNION ALL
SELECT * FROM events WHERE ts < TIMESTAMP '{LATE_CUT}' AND event_id % 5 = 0
""")
def q_ingest_then_dedup_in_place(spark, sf_dir):
    """Stream into a table, deduplicate it where it is, stream into it again."""
    ev = _read(spark, sf_dir, "events")
    p = _ingest_paths(spark, "ingest_swap")
    table = _name("bronze_events_swap")
    early = F.col("ts") < F.expr(f"TIMESTAMP_NTZ '{LATE_CUT}'")
    run = lambda: run_ingest(spark, p["input_path"], "parquet", table, p["schema_location"], p["checkpoint_location"])
    _stage(ev.where(early), p["input_path"])
    _stage(ev.where(early), p["input_path"])
    run()
    dedup_table(spark, table, table, ["event_id"])
    _stage(ev.where(~early | (F.col("event_id") % 5 == 0)), p["input_path"])
    run()
    return spark.table(table)


@register("ingest_csv", "SELECT * FROM orders")
def q_ingest_csv(spark, sf_dir):
    p = _ingest_paths(spark, "ingest_csv")
    _stage(_read(spark, sf_dir, "orders"), p["input_path"], "csv", header="true")
    table = _name("bronze_orders_csv")
    run_ingest(spark, p["input_path"], "csv", table, p["schema_location"], p["checkpoint_location"],
               options={"header": True, "delimiter": ",", "inferSchema": True})
    t = spark.table(table)
    return t.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"),
        F.col("o_orderstatus").cast("string").alias("o_orderstatus"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        F.col("o_orderpriority").cast("string").alias("o_orderpriority"),
    )


@register("ingest_parquet", "SELECT * FROM events")
def q_ingest_parquet(spark, sf_dir):
    p = _ingest_paths(spark, "ingest_parquet")
    _stage(_read(spark, sf_dir, "events"), p["input_path"], "parquet")
    table = _name("bronze_events_parquet")
    run_ingest(spark, p["input_path"], "parquet", table, p["schema_location"], p["checkpoint_location"])
    return spark.table(table)


@register("ingest_text", """
SELECT unnest(string_split(text, chr(10))) AS value FROM documents
""")
def q_ingest_text(spark, sf_dir):
    p = _ingest_paths(spark, "ingest_text")
    _read(spark, sf_dir, "documents").select("text").write.mode("append").text(p["input_path"])
    table = _name("bronze_docs_text")
    run_ingest(spark, p["input_path"], "text", table, p["schema_location"], p["checkpoint_location"])
    return spark.table(table)


@register("ingest_binary", """
SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS total_bytes FROM documents
""")
def q_ingest_binary(spark, sf_dir):
    p = _ingest_paths(spark, "ingest_binary")
    _read(spark, sf_dir, "documents").select("text").write.mode("append").text(p["input_path"])
    table = _name("bronze_docs_binary")
    run_ingest(spark, p["input_path"], "binaryFile", table, p["schema_location"], p["checkpoint_location"],
               options={"pathGlobFilter": "*.txt"})
    return spark.table(table).agg(F.sum("length").cast("bigint").alias("total_bytes"))


@register("ingest_binary_content", """
SELECT line, CAST(count(*) AS BIGINT) AS n
FROM (SELECT md5(unnest(string_split(text, chr(10)))) AS line FROM documents) q GROUP BY line
""")
def q_ingest_binary_content(spark, sf_dir):
    """The bytes of the files, line by line."""
    p = _ingest_paths(spark, "ingest_binary_content")
    _read(spark, sf_dir, "documents").select("text").write.mode("append").text(p["input_path"])
    table = _name("bronze_docs_content")
    run_ingest(spark, p["input_path"], "binaryFile", table, p["schema_location"], p["checkpoint_location"], options={"pathGlobFilter": "*.txt"})
    whole = F.col("content").cast("string")
    lines = F.split(F.substring(whole, F.lit(1), F.length(whole) - 1), "\n")  # every line ends with a line break
    found = spark.table(table).where("length > 0").select(F.explode(lines).alias("text"))
    return found.groupBy(F.md5("text").alias("line")).agg(F.count("*").alias("n"))


CUSTOMER_EVOLVED = """
SELECT *, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN NULL
               ELSE substring(c_mktsegment, 1, 3) END AS c_segment_code
FROM customer
"""


@register("ingest_evolve", CUSTOMER_EVOLVED)
def q_ingest_evolve(spark, sf_dir):
    cu = _read(spark, sf_dir, "customer")
    p = _ingest_paths(spark, "ingest_evolve")
    table = _name("bronze_customer")
    first = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    _stage(cu.filter(first), p["input_path"], "json")
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"])
    # second drop brings a new column; the stored schema and the table are widened
    _stage(cu.filter(~first).withColumn("c_segment_code", F.substring("c_mktsegment", 1, 3)),
           p["input_path"], "json")
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"])
    return spark.table(table).select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), F.col("c_name").alias("c_name"),
        F.col("c_nationkey").cast("int").alias("c_nationkey"), F.col("c_acctbal").cast("double").alias("c_acctbal"),
        F.col("c_mktsegment").alias("c_mktsegment"), F.col("c_segment_code").alias("c_segment_code"),
    )


@register("ingest_restart", "SELECT * FROM events")
def q_ingest_restart(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    p = _ingest_paths(spark, "ingest_restart")
    table = _name("bronze_events_restart")
    cut = F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    _stage(ev.filter(cut), p["input_path"], "json")
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"])
    _stage(ev.filter(~cut), p["input_path"], "json")
    # same checkpoint: only the new files are read
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"])
    return spark.table(table).select(_events_typed())


@register("ingest_trigger_once", "SELECT * FROM orders")
def q_ingest_trigger_once(spark, sf_dir):
    p = _ingest_paths(spark, "ingest_once")
    _stage(_read(spark, sf_dir, "orders"), p["input_path"], "parquet")
    table = _name("bronze_orders_once")
    run_ingest(spark, p["input_path"], "parquet", table, p["schema_location"], p["checkpoint_location"],
               trigger_type="once", table_properties={"quality": "bronze", "team": "ingest"})
    return spark.table(table)


# ---------------------------------------------------------------------------
# End to end
# ---------------------------------------------------------------------------

@register("flow_end_to_end", _rn_sql("ts DESC, event_id DESC"))
def q_flow_end_to_end(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    payloads = encrypt_column(event_payloads(ev), "payload", FIXTURE_KEY)
    silver = run_flow(spark, {
        "payloads": payloads,
        "key": FIXTURE_KEY,
        "root": scratch_path(spark, "flow"),
        "name": "events_flow",
        "bronze_table": _name("bronze_events"),
        "silver_table": _name("silver_events"),
        "transformations": [
            {"name": "add_column", "params": {"column_name": "ts", "expression": "CAST(ts AS TIMESTAMP_NTZ)"}},
        ],
        "merge_source": "run",
        "dedup": {"strategy": "merge_into", "keys": ["user_id", "event_type"], "order_by": ["ts", "event_id"]},
    })
    return silver.select(_events_typed())
