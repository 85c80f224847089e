import datetime
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverline.operators.merge import MergeSpec, merge, scd2_apply, scd2_expire

T = [(1, "a", 10), (2, "b", 20), (3, "c", 30), (None, "n", 0)]
S = [(2, "B", 21), (4, "D", 41), (None, "N", 1)]
SCHEMA = "id bigint, name string, v bigint"


@pytest.fixture
def ts(spark):
    return spark.createDataFrame(T, SCHEMA), spark.createDataFrame(S, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_no_clause_and_bad_specs(ts):
    t, s = ts
    with pytest.raises(ValueError):
        merge(t, s, MergeSpec(keys=["id"]))
    with pytest.raises(ValueError):
        merge(t, s, MergeSpec(keys=["id"], update="NONE", insert="none"))
    with pytest.raises(ValueError):
        merge(t, s, MergeSpec(keys=[], insert="*"))
    with pytest.raises(ValueError):
        merge(t, s, MergeSpec(keys=["id"], delete_by_source=True, update_by_source={"v": "0"}))
    with pytest.raises(ValueError):
        merge(t, s, MergeSpec(keys=["id"], update={"nope": "1"}))


def test_upsert_with_null_keys(ts):
    t, s = ts
    out = merge(t, s, MergeSpec(keys=["id"], update={"name": "source.name", "v": "source.v"}, insert="*"))
    assert rows(out) == sorted([(1, "a", 10), (2, "B", 21), (3, "c", 30), (None, "n", 0), (4, "D", 41),
                                (None, "N", 1)], key=str)


def test_delete_and_update_by_source(ts):
    t, s = ts
    out = merge(t, s, MergeSpec(keys=["id"], update={"v": "source.v"}, delete_by_source=True))
    assert rows(out) == [(2, "b", 21)]
    out = merge(t, s, MergeSpec(keys=["id"], update_by_source={"v": "target.v * -1"}))
    assert rows(out) == sorted([(1, "a", -10), (2, "b", 20), (3, "c", -30), (None, "n", 0)], key=str)
    out = merge(t, s, MergeSpec(keys=["id"], delete_by_source="target.v > 15",
                                update_by_source={"name": "'gone'"}))
    assert rows(out) == sorted([(1, "gone", 10), (2, "b", 20), (None, "gone", 0)], key=str)


def test_extras_are_part_of_on(ts, spark):
    t, s = ts
    out = merge(t, s, MergeSpec(keys=["id"], extras="AND source.v > 100",
                                update={"v": "source.v"}, insert="*"))
    # the (2, B, 21) row fails the extras: not matched -> inserted; target row 2 stays
    assert (2, "B", 21) in rows(out) and (2, "b", 20) in rows(out)


def test_duplicate_source_with_update_raises(spark):
    t = spark.createDataFrame([(1, 0)], "id bigint, v bigint")
    s = spark.createDataFrame([(1, 1), (1, 2)], "id bigint, v bigint")
    with pytest.raises(PySparkException):
        merge(t, s, MergeSpec(keys=["id"], update={"v": "source.v"})).collect()
    out = merge(t, s, MergeSpec(keys=["id"], update={"v": "source.v"}, dedupe_source="v"))
    assert rows(out) == [(1, 2)]


def test_duplicate_source_without_update_never_multiplies(spark):
    t = spark.createDataFrame([(1, 0), (2, 0)], "id bigint, v bigint")
    s = spark.createDataFrame([(1, 1), (1, 2), (3, 3), (3, 4)], "id bigint, v bigint")
    out = merge(t, s, MergeSpec(keys=["id"], insert="*", update_by_source={"v": "-1"}))
    assert rows(out) == [(1, 0), (2, -1), (3, 3), (3, 4)]


def test_insert_explicit_and_casts(spark):
    t = spark.createDataFrame([(1, "x", 1.5)], "id bigint, name string, p double")
    s = spark.createDataFrame([(2, 7)], "id int, q int")
    out = merge(t, s, MergeSpec(keys=["id"], insert={"id": "source.id", "p": "source.q"}))
    assert out.schema == t.schema
    assert rows(out) == [(1, "x", 1.5), (2, None, 7.0)]


def test_merge_properties(spark):
    t = spark.range(200).selectExpr("id", "id * 2 as v")
    s = spark.range(150, 300).selectExpr("id", "id * 3 as v")
    spec = MergeSpec(keys=["id"], update={"v": "source.v"}, insert="*")
    once = merge(t, s, spec)
    twice = merge(once, s, spec)
    assert rows(once) == rows(twice)
    # rows = target + inserted - deleted
    spec_d = MergeSpec(keys=["id"], update={"v": "source.v"}, insert="*", delete_by_source="target.id < 50")
    assert merge(t, s, spec_d).count() == 200 + 100 - 50


def test_full_plan_reuses_join_partitioning(spark, tmp_path):
    p1, p2 = str(tmp_path / "t"), str(tmp_path / "s")
    spark.range(1000).selectExpr("id", "id as v").write.parquet(p1)
    spark.range(500, 1500).selectExpr("id", "id as v").write.parquet(p2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = merge(spark.read.parquet(p1), spark.read.parquet(p2),
                    MergeSpec(keys=["id"], update={"v": "source.v"}, insert="*"))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # with broadcasts disabled: target and source once each for the update join, the
    # (key, count) aggregate of the duplicate-match guard, the key-only sides of the
    # semi join that narrows the target for the insert step, and the source rows of
    # the insert anti join (the narrowed target is already partitioned by key)
    assert plan.count("Exchange hashpartitioning") <= 6


def test_full_outer_plan_shuffles_each_side_once(spark, tmp_path):
    p1, p2 = str(tmp_path / "t"), str(tmp_path / "s")
    spark.range(1000).selectExpr("id", "id as v").write.parquet(p1)
    spark.range(500, 1500).selectExpr("id", "id * 2 as v").write.parquet(p2)
    t, s = spark.read.parquet(p1), spark.read.parquet(p2)
    spec = dict(keys=["id"], update={"v": "source.v"}, insert="*")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = merge(t, s, MergeSpec(**spec, plan="full_outer"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2, plan
        assert plan.count("FileScan") == 2, plan
        assert rows(out) == rows(merge(t, s, MergeSpec(**spec)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        merge(t, s, MergeSpec(**spec, plan="other"))


def test_small_source_merge_never_shuffles_the_target(spark, tmp_path):
    p1, p2 = str(tmp_path / "big"), str(tmp_path / "small")
    spark.range(200000).selectExpr("id", "id as v").write.parquet(p1)
    spark.range(0, 300000, 1000).selectExpr("id", "id * 2 as v").write.parquet(p2)
    t = spark.read.parquet(p1)
    # the target (1.6 MB of keys) is over this threshold, the source is under it
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(512 * 1024))
    try:
        out = merge(t, spark.read.parquet(p2), MergeSpec(keys=["id"], update={"v": "source.v"}, insert="*"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        old_shape = spark.read.parquet(p2).join(t, "id", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in old_shape  # a plain anti join against the target would shuffle it
    # the 200k-row target reaches a shuffle only after the semi join has narrowed it to
    # the rows whose keys occur in the source (broadcast exchanges are fine)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = line.index("Exchange")
            subtree = []
            for nxt in lines[i + 1:]:
                stripped = nxt.lstrip(" :|+-")
                if len(nxt) - len(stripped) <= depth:
                    break
                subtree.append(nxt)
            if any("/big" in x for x in subtree):
                assert any("LeftSemi" in x for x in subtree), "\n".join([line] + subtree)
    assert out.count() == 200000 + 100


def test_scd2(spark):
    ts = F.to_timestamp
    dim = spark.createDataFrame(
        [(1, "a", True, None, "active"), (1, "a0", False, "2020-01-01", "closed"), (2, "b", True, None, "active")],
        "k bigint, name string, is_current boolean, valid_to_ts string, status string",
    ).withColumn("valid_to_ts", ts("valid_to_ts")).withColumn("valid_from_ts", F.lit(None).cast("timestamp"))
    chg = spark.createDataFrame([(1, "a1", "2024-01-01")], "k bigint, name string, update_ts string") \
        .withColumn("update_ts", ts("update_ts"))
    exp = {(r.k, r.name): (r.is_current, r.status) for r in scd2_expire(dim, chg, ["k"], "update_ts").collect()}
    # archiving ends a version; history row (1, a0) is not matched (ON requires is_current) -> archived, as documented
    assert exp == {(1, "a"): (False, "active"), (1, "a0"): (False, "archived"), (2, "b"): (False, "archived")}
    full = scd2_apply(dim, chg, ["k"], "update_ts")
    got = {(r.k, r.name, r.is_current, r.status) for r in full.collect()}
    assert got == {(1, "a", False, "active"), (1, "a0", False, "closed"), (2, "b", False, "archived"), (1, "a1", True, "active")}
    again = scd2_apply(full, chg, ["k"], "update_ts")
    assert sorted(map(str, again.collect())) == sorted(map(str, full.collect()))


def test_scd2_skips_what_is_not_newer_or_not_different(spark):
    schema = "k bigint, name string, is_current boolean, valid_from_ts timestamp, valid_to_ts timestamp, status string"
    at = lambda y: datetime.datetime(y, 1, 1)
    dim = spark.createDataFrame([(1, "a", True, at(2020), None, "active"), (2, None, True, at(2020), None, "active"), (3, "c", True, at(2020), None, "active")], schema)
    chg = spark.createDataFrame([(1, "a", at(2024)), (2, None, at(2024)), (3, "older", at(2019)), (4, "new", at(2024)), (None, "n1", at(2024)), (None, "n2", at(2024))],
                                "k bigint, name string, update_ts timestamp")
    got = sorted(((r.k, r.name, r.is_current) for r in scd2_apply(dim, chg, ["k"], "update_ts").collect()), key=str)
    assert got == sorted([(1, "a", True), (2, None, True), (3, "c", True), (4, "new", True), (None, "n1", True), (None, "n2", True)], key=str)
    twice = chg.union(chg.where("k = 4"))
    with pytest.raises(Exception, match="more than one source row"):
        scd2_apply(dim, twice, ["k"], "update_ts").collect()

def test_scd2_null_keys_are_values_and_reruns_change_nothing(spark):
    dim = spark.createDataFrame([(1, "a", True, "2020-01-01", None, "active")],
                                "k long, v string, is_current boolean, valid_from_ts string, valid_to_ts string, status string")
    src = spark.createDataFrame([(None, "n", "2024-01-01"), (1, "b", "2024-01-01"), (2, "c", "2024-01-01")], "k long, v string, ts string")
    for threshold in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            once = rows(scd2_apply(dim, src, ["k"], "ts"))
            again = dim
            for _ in range(3):
                again = spark.createDataFrame(scd2_apply(again, src, ["k"], "ts").collect(), dim.schema)
            assert rows(again) == once and len(once) == 4
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # rows without a key are told apart by their values; of equal ones the latest counts
    more = spark.createDataFrame([(None, "n", "2024-01-01"), (None, "m", "2024-01-01"), (None, "m", "2024-02-01")], "k long, v string, ts string")
    twice = scd2_apply(spark.createDataFrame(scd2_apply(dim, more, ["k"], "ts").collect(), dim.schema), more, ["k"], "ts")
    assert sorted((r["v"], r["is_current"], r["valid_from_ts"]) for r in twice.collect()) == [
        ("a", False, "2020-01-01"), ("m", True, "2024-02-01"), ("n", True, "2024-01-01")]


@pytest.mark.parametrize("key", [1, 9, None])
def test_scd2_without_a_change_time_is_an_error(spark, key):
    dim = spark.createDataFrame([(1, "a", True, "2020-01-01", None, "active")],
                                "k long, v string, is_current boolean, valid_from_ts string, valid_to_ts string, status string")
    src = spark.createDataFrame([(key, "changed", None)], "k long, v string, ts string")
    with pytest.raises(PySparkException, match="no ts for key"):
        scd2_apply(dim, src, ["k"], "ts").collect()


def test_current_timestamp_in_merge_clauses(spark):
    t = spark.createDataFrame([(1, None), (2, None)], "id long, at timestamp")
    s = spark.createDataFrame([(1,), (3,)], "id long")
    before = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    out = merge(t, s, MergeSpec(keys=["id"], update={"at": "current_timestamp()"}, insert={"id": "source.id", "at": F.current_timestamp()},
                                update_by_source={"at": "current_timestamp()"})).collect()
    after = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    assert sorted(r["id"] for r in out) == [1, 2, 3] and len({r["at"] for r in out}) == 1
    assert all(before <= r["at"] <= after for r in out)
