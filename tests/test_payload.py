import json

from silverline.functions.payload import explode_payload, json_validity, split_valid_json

# The sample payload rows of the original flow demo.
ROWS = [{"id": 1, "name": "Alice", "value": 120, "secret_code": "AX123"},
        {"id": 1, "name": "Alice", "value": 120, "secret_code": "AX123"},
        {"id": 2, "name": "Bob", "value": 150, "secret_code": "BY456"},
        {"id": 3, "name": "Charlie", "value": 90, "secret_code": "CZ789"},
        {"id": 4, "name": "Alicia", "value": 200, "secret_code": "AX123"}]


def test_explode(spark):
    df = spark.createDataFrame([(json.dumps(ROWS),), ("[]",), ("garbage",), (None,)], "p string")
    out = explode_payload(df, "p", "id bigint, name string, value bigint, secret_code string")
    assert out.columns == ["id", "name", "value", "secret_code"]
    assert out.count() == 5 and out.dropDuplicates(["id"]).count() == 4


def test_json_validity(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("null",), ("",), ("{bad",), (None,), ("[1,2]",), ("3",)], "b string")
    got = [r.ok for r in df.select(json_validity("b").alias("ok")).collect()]
    assert got == [True, False, False, False, False, True, True]
    good, bad = split_valid_json(df, "b")
    assert good.count() == 3 and bad.count() == 4


def test_explode_with_inferred_schema(spark):
    df = spark.createDataFrame([(json.dumps(ROWS, indent=2),), ('[{"id": 9, "extra": true}]',)], "p string")
    out = explode_payload(df, "p")
    assert set(out.columns) == {"id", "name", "value", "secret_code", "extra"}
    assert out.count() == 6


def test_dedup_table_keeps_latest(spark):
    from silverline.sources.tables import dedup_table, write_snapshot

    write_snapshot(spark, "payload_test_versions", spark.createDataFrame(
        [(1, 1, "old"), (1, 2, "new"), (2, 1, "only")], "id bigint, version bigint, v string"))
    out = dedup_table(spark, "payload_test_versions", "payload_test_latest", ["id"], order_by="version")
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, "new"), (2, "only")]


SHAPES = {
    '[{"id": 1, "name": "a"}, {"id": 2}]': None, '{"id": 3, "name": null}': None, "[]": None, '[{"id": 4, "other": [1]}]': None,
    '[{"name": "only"}]': None, "nope": "unparseable", "": "unparseable", '{"id": 1, "id": 2}': "unparseable",
    "42": "wrong shape", '"text"': "wrong shape", "[1,2]": "wrong shape", "null": "wrong shape", "[null]": "wrong shape",
    '{"other": 5}': "wrong shape", '[{"id": 1}, {}]': "wrong shape", "[[{\"id\": 1}]]": "wrong shape",
    '{"id": "x7"}': "bad field", '[{"id": 1}, {"id": 1.5}]': "bad field", '{"id": 1, "n": {"a": "x"}}': None,
}


def test_every_payload_is_rows_or_a_reject(spark):
    from silverline.functions.payload import explode_with_rejects

    df = spark.createDataFrame([(i, p) for i, p in enumerate([*SHAPES, None])], "no int, p string")
    rows, rejects = explode_with_rejects(df, "p", "id bigint, name string", keep=["no"])
    reasons = {r["no"]: (r["reason"], r["detail"]) for r in rejects.collect()}
    assert {k: v[0] for k, v in reasons.items()} == {i: r for i, r in enumerate([*SHAPES.values(), "unparseable"]) if r}
    at = {p: i for i, p in enumerate(SHAPES)}
    assert reasons[at['[{"id": 1}, {"id": 1.5}]']][1] == "element 1 field id" and "element 1" in reasons[at['[{"id": 1}, {}]']][1]
    got = sorted((r["no"], r["id"], r["name"]) for r in rows.collect() if r["id"] is not None)
    assert [(g[1], g[2]) for g in got] == [(1, "a"), (2, None), (3, None), (4, None), (1, None)]
    # accepted and rejected payloads are all payloads
    accepted = {r["no"] for r in rows.collect()} | {at["[]"]}
    assert accepted | set(reasons) == set(range(len(SHAPES) + 1)) and not accepted & set(reasons)


def test_outcome_without_a_schema(spark):
    from silverline.functions.payload import payload_outcome

    df = spark.createDataFrame([(p,) for p in ('{"a": 1}', "[]", "[3]", "x")], "p string")
    assert [r[0] for r in df.select(payload_outcome("p")["reason"]).collect()] == [None, None, "wrong shape", "unparseable"]
