"""The plan that merge_by_size picks, and that it changes no result."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverline.operators import sized_merge
from silverline.operators.merge import MergeSpec, merge
from silverline.operators.sized_merge import flag_possible, hot_hashes, key_bitmap, merge_by_size


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def limit(spark):
    yield lambda v: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(v))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def tables(spark, tmp_path):
    spark.range(60_000).selectExpr("id", "id AS v").write.parquet(f"{tmp_path}/t")
    return spark.read.parquet(f"{tmp_path}/t")


SPECS = [
    dict(update={"v": "source.v"}, insert="*"),
    dict(insert="*"),
    dict(update={"v": "source.v"}),
    dict(update={"v": "source.v + target.v"}, insert="*", delete_by_source="target.v % 2 = 0", update_by_source={"v": "-1"}),
    dict(delete_by_source=True, insert="*"),
    dict(update={"v": "source.v"}, insert="*", extras="source.v > 100"),
    dict(update={"v": "source.v"}, insert="*", extras="target.v % 3 = 0", update_condition="source.v > target.v"),
    dict(update={"v": "source.v"}, insert="*", dedupe_source="v"),
]


@pytest.mark.parametrize("spec", SPECS, ids=range(len(SPECS)))
def test_any_plan_gives_the_same_rows(spark, limit, spec):
    """Hot keys (a third of the target each on a matched, an unmatched and a null key) and a source with new keys."""
    n = 9000
    key = F.when(F.col("id") % 4 == 0, 5).when(F.col("id") % 4 == 1, 6).when(F.col("id") % 4 == 2, F.lit(None)).otherwise(F.col("id"))
    t = spark.range(n).select(key.cast("long").alias("k"), (F.col("id") % 1000).alias("v")).repartition(4)
    s = spark.range(400).select(F.when(F.col("id") == 0, F.lit(None)).otherwise(F.col("id") * 37 % 12_000 + 5).cast("long").alias("k"), (F.col("id") * 3).alias("v"))
    spec = MergeSpec(keys=["k"], **spec)
    limit(-1)
    want = rows(merge(t, s, MergeSpec(**{**spec.__dict__, "plan": "narrow"})))
    got = merge_by_size(t, s, spec, hot_rows=100)
    assert rows(got) == want
    limit(10 << 20)
    assert rows(merge_by_size(t, s, spec)) == want


def test_three_sizes_three_plans(spark, limit, tables):
    spec = MergeSpec(keys=["id"], update={"v": "source.v"}, insert="*")
    small = spark.range(0, 100_000, 1000).selectExpr("id", "id * 2 AS v")
    limit(32 * 1024)
    out = merge_by_size(tables, small, spec)
    assert "BroadcastHashJoin" in plan(out) and "FullOuter" not in plan(out)
    large = spark.range(30_000, 90_000).selectExpr("id", "id * 2 AS v")
    limit(1024)
    out = merge_by_size(tables, large, spec)
    p = plan(out)
    assert "FullOuter" in p and p.count("Exchange hashpartitioning") == 2, p
    assert rows(out) == rows(merge(tables, large, spec))
    # half of all bits would be set: no bitmap, still one exchange a side
    least = sized_merge.BITS_PER_ROW, sized_merge.LEAST_BITS, sized_merge.MAX_BITS
    sized_merge.BITS_PER_ROW, sized_merge.LEAST_BITS, sized_merge.MAX_BITS = 1, 1 << 15, 1 << 16
    try:
        out = merge_by_size(tables, large, spec)
        assert plan(out).count("Exchange hashpartitioning") == 2 and "__bitmap" not in plan(out)
    finally:
        sized_merge.BITS_PER_ROW, sized_merge.LEAST_BITS, sized_merge.MAX_BITS = least
    # no hand-set option is needed in the lazy operator either
    assert plan(merge(tables, spark.read.parquet(*[f for f in tables.inputFiles()]), spec)).count("Exchange hashpartitioning") == 2


def test_rows_without_a_match_are_not_shuffled(spark, limit, tables):
    """The share of the target that reaches the join is the matching share and a few by chance."""
    source = spark.range(0, 6000).select((F.col("id") * 10 + 5).alias("id"), F.col("id").alias("v"))
    bits = 1 << 20
    flagged = flag_possible(tables, key_bitmap(source, ["id"], bits), ["id"], bits, "possible")
    possible = flagged.where("possible")
    assert possible.join(source, "id").count() == 6000  # none is missed
    assert 6000 <= possible.count() < 6000 + 0.02 * 60_000
    limit(-1)
    out = merge_by_size(tables, source, MergeSpec(keys=["id"], update={"v": "source.v"}, insert="*"))
    assert rows(out) == rows(merge(tables, source, MergeSpec(keys=["id"], update={"v": "source.v"}, insert="*")))


def test_a_hot_key_stays_in_its_tasks(spark, limit):
    n = 30_000
    t = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("v")).repartition(6)
    assert hot_hashes(t, ["k"], 1000) == [spark.sql("SELECT xxhash64(7L) AS h").first()["h"]]
    s = spark.range(20_000).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"))
    limit(64 * 1024)  # the whole source is above, the hot key's row below
    out = merge_by_size(t, s, MergeSpec(keys=["k"], update={"v": "source.v"}, insert="*"), hot_rows=1000)
    assert out.where("k = 7 AND v = -1").count() == t.where("k = 7").count()
    # tasks of the result: none holds a third of the rows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        most = max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out.count() == t.count() + s.join(t, "k", "left_anti").count() and most < n / 4


def test_duplicate_matches_raise_in_each_part(spark, limit):
    t = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("v"))
    limit(-1)
    for k in (7, 2500):
        s = spark.createDataFrame([(k, 1), (k, 2), (99_999, 1), (99_999, 2)], "k long, v long")
        with pytest.raises(PySparkException, match="more than one source row"):
            merge_by_size(t, s, MergeSpec(keys=["k"], update={"v": "source.v"}, insert="*"), hot_rows=100).collect()


def test_keys_whose_hashes_may_differ(spark, limit):
    limit(-1)
    t = spark.sql("SELECT k COLLATE UTF8_LCASE AS k, v FROM VALUES ('a', 1), ('B', 2) AS t(k, v)")
    s = spark.sql("SELECT k COLLATE UTF8_LCASE AS k, v FROM VALUES ('A', 10), ('c', 30) AS t(k, v)")
    out = merge_by_size(t, s, MergeSpec(keys=["k"], update={"v": "source.v"}, insert="*"))
    assert sorted(r["v"] for r in out.collect()) == [2, 10, 30]
    t = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    s = spark.createDataFrame([(1, 10), (3, 30)], "k long, v int")
    assert rows(merge_by_size(t, s, MergeSpec(keys=["k"], update={"v": "source.v"}, insert="*"))) == [(1, 10), (2, 2), (3, 30)]
