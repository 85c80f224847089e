import pytest

from silverline.operators.dedup import drop_duplicates, flag_latest, keep_rows

# The sample payload rows of the original flow demo.
PAYLOAD = [(1, "Alice", 120, "AX123"), (1, "Alice", 120, "AX123"), (2, "Bob", 150, "BY456"),
           (3, "Charlie", 90, "CZ789"), (4, "Alicia", 200, "AX123")]


def test_sample_payload_dedup_by_id(spark):
    df = spark.createDataFrame(PAYLOAD, "id bigint, name string, value bigint, secret_code string")
    assert drop_duplicates(df, ["id"]).count() == 4


def test_nulls_compare_equal(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k bigint, v string")
    assert drop_duplicates(df, ["k"]).count() == 2


def test_keys_validation(spark):
    df = spark.createDataFrame([(1,)], "k bigint")
    for bad in ([], "k", ["nope"]):
        with pytest.raises(ValueError):
            drop_duplicates(df, bad)
    with pytest.raises(ValueError):
        drop_duplicates(df, ["k"], mode="later")
    with pytest.raises(ValueError):
        drop_duplicates(df, ["k"], mode="within_watermark")


def test_batch_watermark_is_noop(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-02 00:00:00")], "k bigint, t string") \
        .selectExpr("k", "cast(t as timestamp) as t")
    assert drop_duplicates(df, ["k"], "t", "10 minutes").count() == 1


def test_keep_first_last_none(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "d"), (3, 5, "e"), (3, 5, "f")],
        "k bigint, o bigint, v string")
    first = {r.k: r.v for r in keep_rows(df, ["k"], ["o", "v"], "first").collect()}
    last = {r.k: r.v for r in keep_rows(df, ["k"], ["o", "v"], "last").collect()}
    assert first == {1: "a", 2: "d", 3: "e"}
    assert last == {1: "c", 2: "d", 3: "f"}
    assert [r.v for r in keep_rows(df, ["k"], keep=False).collect()] == ["d"]
    with pytest.raises(ValueError):
        keep_rows(df, ["k"], None, "first")
    with pytest.raises(ValueError):
        keep_rows(df, ["k"], ["o"], "middle")


def test_keep_first_plans_partial_limit_before_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as o")
    plan = keep_rows(df, ["k"], ["o"], "last")._jdf.queryExecution().executedPlan().toString()
    # the map side keeps one row per key before the exchange
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_flag_latest(spark):
    df = spark.createDataFrame([(1, 1), (1, 3), (2, 2), (None, 1), (None, 4)], "k bigint, o bigint")
    got = sorted((r.k, r.o, r.is_latest_record) for r in flag_latest(df, ["k"], ["o"]).collect()
                 if r.k is not None)
    assert got == [(1, 1, False), (1, 3, True), (2, 2, True)]
    nulls = sorted((r.o, r.is_latest_record) for r in flag_latest(df, ["k"], ["o"]).collect() if r.k is None)
    assert nulls == [(1, False), (4, True)]


def test_dedup_idempotent(spark):
    df = spark.range(500).selectExpr("id % 7 as a", "id % 5 as b", "id as c")
    once = drop_duplicates(df, ["a", "b"])
    twice = drop_duplicates(once, ["a", "b"])
    assert sorted(once.select("a", "b").collect()) == sorted(twice.select("a", "b").collect())


def test_watermark_needs_column_and_delay(spark, tmp_path):
    p = str(tmp_path / "in")
    spark.range(3).selectExpr("id % 2 as k", "current_timestamp() as t").write.parquet(p)
    stream = spark.readStream.schema("k bigint, t timestamp").parquet(p)
    # column without delay: no watermark applied, plain dedup
    plan_only_col = drop_duplicates(stream, ["k"], "t", None)
    assert "EventTimeWatermark" not in plan_only_col._jdf.queryExecution().analyzed().toString()
    with_wm = drop_duplicates(stream, ["k", "t"], "t", "10 minutes")
    assert "EventTimeWatermark" in with_wm._jdf.queryExecution().analyzed().toString()


def test_tiebreak_is_deterministic(spark):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, 5, "c"), (2, 1, "z")]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "k bigint, o bigint, v string").repartition(parts)
        got = {r.k: r.v for r in keep_rows(df, ["k"], "o", "last", tiebreak=True).collect()}
        assert got == {1: "c", 2: "z"}


def test_string_keys_group_by_hash_first_and_keep_partial_limit(spark):
    df = spark.createDataFrame([("a" * 500, 1), ("a" * 500, 2), ("b", 3)], "t string, o bigint")
    out = keep_rows(df, ["t"], ["o"], "last")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan and "Partial" in plan
    assert sorted(r.o for r in out.collect()) == [2, 3]
    assert sorted(r.o for r in keep_rows(df, ["t"], keep=False).collect()) == [3]
    assert drop_duplicates(df, ["t"]).count() == 2


def test_drop_duplicates_keys_only_frame(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "t string, k bigint")
    assert sorted(tuple(r) for r in drop_duplicates(df, ["t", "k"]).collect()) == [("a", 1), ("b", 2)]


def test_batch_only_operators_refuse_streams(spark, tmp_path):
    from silverline.operators.merge import MergeSpec, merge

    p = str(tmp_path / "in")
    spark.range(3).selectExpr("id", "id as o").write.parquet(p)
    stream = spark.readStream.schema("id bigint, o bigint").parquet(p)
    with pytest.raises(ValueError):
        keep_rows(stream, ["id"], ["o"])
    with pytest.raises(ValueError):
        flag_latest(stream, ["id"], ["o"])
    with pytest.raises(ValueError):
        merge(spark.read.parquet(p), stream, MergeSpec(keys=["id"], insert="*"))
