"""One key holds a third of all rows: results stay exact and hot keys are reduced map-side."""

import pytest
from pyspark.sql import functions as F

from silverline.operators.dedup import drop_duplicates, flag_latest, keep_rows
from silverline.operators.merge import PLANS, MergeSpec, merge

N = 6000


@pytest.fixture(scope="module")
def skewed(spark):
    # rows 0..1999 all share user 0; the rest spread over 400 users
    df = spark.range(N).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") < N // 3, F.lit(0)).otherwise(F.col("id") % 400 + 1).alias("user_id"),
        (F.col("id") % 5).cast("string").alias("kind"),
        ((F.col("id") * 7919) % 1000).alias("ts"),
    ).repartition(8)
    return df, df.toPandas()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_drop_duplicates_partial_aggregate(skewed):
    df, pdf = skewed
    out = drop_duplicates(df, ["user_id", "kind"])
    assert out.count() == len(pdf.drop_duplicates(["user_id", "kind"]))
    plan = _plan(out)
    assert "partial_first" in plan  # map-side combine before the exchange


def test_keep_last_matches_pandas(skewed):
    df, pdf = skewed
    got = keep_rows(df, ["user_id"], ["ts", "event_id"], "last").toPandas()
    exp = pdf.sort_values(["ts", "event_id"]).groupby("user_id").tail(1)
    assert sorted(got.event_id) == sorted(exp.event_id)
    assert "Partial" in _plan(keep_rows(df, ["user_id"], ["ts", "event_id"], "last"))


def test_keep_none_and_flag(skewed):
    df, pdf = skewed
    got = keep_rows(df, ["user_id", "ts"], keep=False).toPandas()
    counts = pdf.groupby(["user_id", "ts"]).event_id.transform("count")
    assert sorted(got.event_id) == sorted(pdf[counts == 1].event_id)
    flagged = flag_latest(df, ["user_id"], ["ts", "event_id"]).filter("is_latest_record").toPandas()
    exp = pdf.sort_values(["ts", "event_id"]).groupby("user_id").tail(1)
    assert sorted(flagged.event_id) == sorted(exp.event_id)


def test_merge_with_hot_source_key_without_update(skewed, spark):
    df, pdf = skewed
    target = df.filter("event_id % 2 = 0").select("event_id", "user_id", "ts")
    # the source's hot user appears thousands of times; insert-only is legal and exact
    source = df.select(F.col("user_id").alias("event_id"), "user_id", "ts")
    out = merge(target, source, MergeSpec(keys=["event_id"], insert="*"))
    t_ids = set(pdf[pdf.event_id % 2 == 0].event_id)
    expected = len(t_ids) + int((~pdf.user_id.isin(t_ids)).sum())
    assert out.count() == expected


@pytest.mark.parametrize("plan", PLANS)
def test_merge_sort_merge_path_with_hot_and_null_target_keys(spark, plan):
    """Broadcasts off: a third of the target on one key, a third on null keys; compared with counts by hand."""
    n = 30_000
    kind = F.col("id") % 3
    target = spark.range(n).select(
        F.when(kind == 0, F.lit(7)).when(kind == 1, F.lit(None)).otherwise(F.col("id") + 100).cast("long").alias("k"),
        F.col("id").alias("v"), F.map_from_arrays(F.array(F.lit("a")), F.array("id")).alias("m"))
    source = spark.range(50).select(  # key 7, 39 target keys of the third kind or new ones, ten null keys
        F.when(F.col("id") == 0, F.lit(7)).when(F.col("id") <= 10, F.lit(None)).otherwise(F.col("id") * 3 + 102).cast("long").alias("k"),
        F.lit(-1).cast("long").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = merge(target, source, MergeSpec(keys=["k"], update={"v": "source.v"}, insert="*", plan=plan))
        assert "SortMergeJoin" in _plan(out)
        got = {(r["kind"], r["hit"]): r["count"] for r in out.groupBy(
            F.when(F.col("k").isNull(), "null").when(F.col("k") == 7, "hot").otherwise("own").alias("kind"),
            (F.col("v") == -1).alias("hit")).count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # target keys of the third kind are 102, 105, ...: all 39 of the source's lie among them
    assert got == {("hot", True): n // 3, ("null", False): n // 3, ("null", True): 10,
                   ("own", False): n // 3 - 39, ("own", True): 39}
