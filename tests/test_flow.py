import uuid

import pytest

from silverline.functions.fernet import encrypt_column, generate_key_from
from silverline.plans.flow import run_flow
from silverline.session import scratch_path

KEY = generate_key_from(bytes(range(32)))
# The sample payload rows of the original flow demo.
ROWS = '[{"id": 1, "name": "Alice", "value": 120, "secret_code": "AX123"},' \
       ' {"id": 1, "name": "Alice", "value": 120, "secret_code": "AX123"},' \
       ' {"id": 2, "name": "Bob", "value": 150, "secret_code": "BY456"},' \
       ' {"id": 3, "name": "Charlie", "value": 90, "secret_code": "CZ789"},' \
       ' {"id": 4, "name": "Alicia", "value": 200, "secret_code": "AX123"}]'


def _payloads(spark):
    df = spark.createDataFrame([(ROWS,), ("not a token",)], "payload string")
    enc = encrypt_column(df.limit(1), "payload", KEY)
    return enc.unionByName(df.filter("payload = 'not a token'"))


def test_sample_flow_drop_duplicates(spark):
    out = run_flow(spark, {
        "payloads": _payloads(spark),
        "key": KEY,
        "payload_schema": "id bigint, name string, value bigint, secret_code string",
        "root": scratch_path(spark, "flow_test"),
        "bronze_table": "flow_test_bronze",
        "silver_table": "flow_test_silver",
        "dedup": {"strategy": "drop_duplicates", "keys": ["id"]},
    })
    assert sorted(r.id for r in out.collect()) == [1, 2, 3, 4]


def test_flow_merge_is_idempotent(spark):
    settings = {
        "payloads": _payloads(spark),
        "key": KEY,
        "payload_schema": "id bigint, name string, value bigint, secret_code string",
        "root": scratch_path(spark, "flow_test2"),
        "bronze_table": "flow_test_bronze2",
        "silver_table": "flow_test_silver2",
        "dedup": {"strategy": "merge_into", "keys": ["id"], "order_by": ["value"]},
    }
    first = sorted(tuple(r) for r in run_flow(spark, settings).collect())
    again = sorted(tuple(r) for r in run_flow(spark, settings).collect())
    assert first == again and len(first) == 4


def test_flow_validation(spark):
    with pytest.raises(ValueError):
        run_flow(spark, {"key": KEY})


def test_incremental_runs_keep_newest(spark):
    def payload(rows):
        import json as _json
        df = spark.createDataFrame([(_json.dumps(rows),)], "payload string")
        return encrypt_column(df, "payload", KEY)

    settings = {
        "key": KEY,
        "root": scratch_path(spark, "flow_test3"),
        "bronze_table": "flow_test_bronze3",
        "silver_table": "flow_test_silver3",
        "merge_source": "run",
        "dedup": {"strategy": "merge_into", "keys": ["id"], "order_by": ["ord"]},
    }
    run_flow(spark, {**settings, "payloads": payload(
        [{"id": 1, "v": 5, "ord": 2}, {"id": 2, "v": 1, "ord": 1}, {"id": 2, "v": 2, "ord": 3}])})
    out = run_flow(spark, {**settings, "payloads": payload(
        [{"id": 1, "v": 9, "ord": 1}, {"id": 3, "v": 7, "ord": 1}])})
    got = sorted((r.id, r.v, r.ord) for r in out.collect())
    # id 1's late version (ord 1) does not overwrite ord 2
    assert got == [(1, 5, 2), (2, 2, 3), (3, 7, 1)]


def test_runs_keep_earlier_rows_retries_add_none_and_rejects_are_kept(spark):
    root, t = scratch_path(spark, "flow_runs"), uuid.uuid4().hex[:8]

    def go(run_id, *texts):
        good = encrypt_column(spark.createDataFrame([(x,) for x in texts], "payload string"), "payload", KEY)
        return run_flow(spark, {
            "payloads": good.unionByName(spark.createDataFrame([("not a token",)], "payload string")), "key": KEY,
            "payload_schema": "id bigint, name string", "root": root, "run_id": run_id, "merge_source": "run",
            "bronze_table": f"bronze_{t}", "silver_table": f"silver_{t}", "rejects_table": f"rejects_{t}",
            "dedup": {"strategy": "drop_duplicates", "keys": ["id"]}})

    go("one", '[{"id": 1, "name": "a"}]', "not json")
    for _ in range(2):
        out = go("two", '[{"id": 2, "name": "b"}]')
    assert sorted(r.id for r in out.collect()) == [1, 2]
    assert spark.table(f"bronze_{t}").count() == 2
    got = sorted((r.run_id, r.reason) for r in spark.table(f"rejects_{t}").collect())
    assert got == [("one", "undecryptable"), ("one", "unparseable"), ("two", "undecryptable")]


def test_rows_and_rejects_are_all_payloads_and_come_once(spark):
    """The texts that used to vanish: valid JSON of another shape, and values that do not fit."""
    root, t = scratch_path(spark, "flow_shapes"), uuid.uuid4().hex[:8]
    texts = ["42", '"text"', "[1,2]", "null", '{"other":5}', '{"id": "x7"}', "nope", '[{"id": 1}]', '{"id": 2}']
    payloads = encrypt_column(spark.createDataFrame([(x,) for x in texts], "payload string"), "payload", KEY).cache()
    settings = {"payloads": payloads, "key": KEY, "payload_schema": "id bigint, name string", "root": root, "run_id": "one", "merge_source": "run",
                "bronze_table": f"bronze_{t}", "silver_table": f"silver_{t}", "rejects_table": f"rejects_{t}",
                "dedup": {"strategy": "drop_duplicates", "keys": ["id"]}}
    for _ in range(2):  # a retry adds nothing
        assert sorted(r.id for r in run_flow(spark, settings).collect()) == [1, 2]
        got = sorted(r.reason for r in spark.table(f"rejects_{t}").collect())
        assert got == ["bad field", "unparseable"] + ["wrong shape"] * 5
    kept = {r.payload for r in spark.table(f"rejects_{t}").collect()}
    assert kept < {r.payload for r in payloads.collect()}  # as they came, still encrypted
    with pytest.raises(ValueError, match="cannot be used"):
        run_flow(spark, {**settings, "run_id": "two", "on_reject": "fail"})
    assert spark.table(f"rejects_{t}").where("run_id = 'two'").count() == 7


def test_a_run_cut_off_before_staging_records_its_rejects_once(spark, monkeypatch):
    from silverline.plans import flow

    root, t = scratch_path(spark, "flow_cut"), uuid.uuid4().hex[:8]
    settings = {"payloads": _payloads(spark), "key": KEY, "payload_schema": "id bigint, name string", "root": root, "run_id": "r",
                "bronze_table": f"bronze_{t}", "silver_table": f"silver_{t}", "rejects_table": f"rejects_{t}",
                "dedup": {"strategy": "drop_duplicates", "keys": ["id"]}}
    real = flow.stage_files

    def crash(*a, **k):
        raise RuntimeError("cut off")

    monkeypatch.setattr(flow, "stage_files", crash)
    with pytest.raises(RuntimeError):
        run_flow(spark, settings)
    monkeypatch.setattr(flow, "stage_files", real)
    run_flow(spark, settings)
    assert spark.table(f"rejects_{t}").count() == 1 and spark.table(f"silver_{t}").count() == 4
