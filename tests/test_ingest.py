import time
import uuid
import json
import os

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

import silverline.sources.ingest as ingest_module
from silverline.sources.ingest import clean_options, ingest, merge_schemas, run_ingest


def _paths(root):
    return dict(input_path=f"{root}/in", schema_location=f"{root}/schema", checkpoint_location=f"{root}/cp")


def _write_json(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_required_and_invalid(spark, tmp_root):
    p = _paths(tmp_root)
    with pytest.raises(ValueError):
        ingest(spark, p["input_path"], "", "t", p["schema_location"], p["checkpoint_location"])
    with pytest.raises(ValueError):
        ingest(spark, p["input_path"], "json", "t", None, p["checkpoint_location"])
    with pytest.raises(ValueError):
        ingest(spark, p["input_path"], "xml", "t", p["schema_location"], p["checkpoint_location"])
    for mode in ("overwrite", "complete", "update"):
        with pytest.raises(ValueError):
            ingest(spark, p["input_path"], "json", "t", p["schema_location"], p["checkpoint_location"],
                   output_mode=mode)


def test_clean_options_and_schema_merge():
    assert clean_options({"header": True, "_comment": "x", "sep": ","}) == {"header": "True", "sep": ","}
    a = StructType([StructField("id", LongType()), StructField("name", StringType())])
    b = StructType([StructField("ID", StringType()), StructField("extra", StringType())])
    with pytest.raises(ValueError, match="would be lost"):
        merge_schemas(a, b)
    m = merge_schemas(a, b, strict=False)
    assert [f.name for f in m.fields] == ["id", "name", "extra"]
    assert m.fields[0].dataType == LongType()


def test_restart_reads_only_new_files_and_evolves(spark, tmp_root):
    p = _paths(tmp_root)
    table = "ingest_test_evolve"
    _write_json(p["input_path"], "a.json", [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}, {"id": 3, "name": "c"}])
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"],
               table_properties={"quality": "bronze"})
    assert spark.table(table).count() == 3
    assert spark.sql(f"SHOW TBLPROPERTIES {table} ('quality')").first()["value"] == "bronze"
    _write_json(p["input_path"], "b.json", [{"id": 4, "name": "d", "score": 9}])
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"])
    got = sorted((r.id, r.name, r.score) for r in spark.table(table).collect())
    assert got == [(1, "a", None), (2, "b", None), (3, "c", None), (4, "d", 9)]
    # nothing new: a third run adds nothing
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"])
    assert spark.table(table).count() == 4


def test_csv_options_trigger_once(spark, tmp_root):
    p = _paths(tmp_root)
    os.makedirs(p["input_path"])
    with open(f"{p['input_path']}/x.csv", "w") as f:
        f.write("id;name\n1;a\n2;b\n")
    run_ingest(spark, p["input_path"], "csv", "ingest_test_csv", p["schema_location"], p["checkpoint_location"],
               options={"header": True, "delimiter": ";", "_note": "dropped"}, trigger_type="once")
    assert sorted(tuple(r) for r in spark.table("ingest_test_csv").collect()) == [(1, "a"), (2, "b")]


def test_text_and_binary(spark, tmp_root):
    p = _paths(tmp_root)
    os.makedirs(p["input_path"])
    with open(f"{p['input_path']}/x.txt", "w") as f:
        f.write("one\ntwo\n")
    run_ingest(spark, p["input_path"], "text", "ingest_test_text", p["schema_location"], p["checkpoint_location"])
    assert sorted(r.value for r in spark.table("ingest_test_text").collect()) == ["one", "two"]
    run_ingest(spark, p["input_path"], "binaryFile", "ingest_test_bin", f"{tmp_root}/s2", f"{tmp_root}/c2")
    r = spark.table("ingest_test_bin").first()
    assert r.length == 8 and bytes(r.content) == b"one\ntwo\n"


def test_processing_time_trigger(spark, tmp_root):
    p = _paths(tmp_root)
    _write_json(p["input_path"], "a.json", [{"id": 1}, {"id": 2}])
    q = ingest(spark, p["input_path"], "json", "ingest_test_pt", p["schema_location"], p["checkpoint_location"],
               trigger_type="processingTime", trigger_interval="1 second")
    try:
        q.processAllAvailable()
        _write_json(p["input_path"], "b.json", [{"id": 3}])
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.id for r in spark.table("ingest_test_pt").collect()) == [1, 2, 3]


def test_unknown_trigger_falls_back(spark, tmp_root):
    p = _paths(tmp_root)
    _write_json(p["input_path"], "a.json", [{"id": 1}])
    run_ingest(spark, p["input_path"], "json", "ingest_test_fallback", p["schema_location"],
               p["checkpoint_location"], trigger_type="continuous-ish")
    assert spark.table("ingest_test_fallback").count() == 1


def test_multiline_json_array_file(spark, tmp_root):
    p = _paths(tmp_root)
    os.makedirs(p["input_path"])
    rows = [{"id": 1, "name": "Alice", "value": 120, "secret_code": "AX123"},
            {"id": 1, "name": "Alice", "value": 120, "secret_code": "AX123"},
            {"id": 2, "name": "Bob", "value": 150, "secret_code": "BY456"},
            {"id": 3, "name": "Charlie", "value": 90, "secret_code": "CZ789"},
            {"id": 4, "name": "Alicia", "value": 200, "secret_code": "AX123"}]
    with open(f"{p['input_path']}/decrypted_data_001.json", "w") as f:
        json.dump(rows, f, indent=2)
    run_ingest(spark, p["input_path"], "json", "ingest_test_multiline", p["schema_location"],
               p["checkpoint_location"], options={"multiline": "true", "_comment_schema": "x"})
    t = spark.table("ingest_test_multiline")
    assert t.count() == 5 and t.dropDuplicates(["id"]).count() == 4


def test_parquet_evolution(spark, tmp_root):
    p = _paths(tmp_root)
    spark.createDataFrame([(1, "a")], "id bigint, name string").write.mode("append").parquet(p["input_path"])
    run_ingest(spark, p["input_path"], "parquet", "ingest_test_pq_evolve", p["schema_location"],
               p["checkpoint_location"])
    spark.createDataFrame([(2, "b", 3.5)], "id bigint, name string, score double") \
        .write.mode("append").parquet(p["input_path"])
    run_ingest(spark, p["input_path"], "parquet", "ingest_test_pq_evolve", p["schema_location"],
               p["checkpoint_location"])
    got = sorted(tuple(r) for r in spark.table("ingest_test_pq_evolve").select("id", "name", "score").collect())
    assert got == [(1, "a", None), (2, "b", 3.5)]


def test_typed_from_variant_rescues_unknown_and_bad_fields(spark):
    from pyspark.sql import functions as F
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from silverline.sources.ingest import typed_from_variant

    lines = ['{"id": 1, "name": "a"}', '{"id": 2, "name": "b", "score": 9}', '{"id": "x", "name": "c"}',
             '[{"id": 4, "name": "d"}, {"id": 5, "name": "e", "tags": [1]}]', '7']
    df = spark.createDataFrame([(x,) for x in lines], "t string").select(F.parse_json("t").alias("r"))
    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    got = sorted((tuple(r) for r in typed_from_variant(df, "r", schema, "_rescued").collect()), key=str)
    assert got == sorted([(1, "a", None), (2, "b", '{"score":9}'), (None, "c", '{"id":"x"}'),
                          (4, "d", None), (5, "e", '{"tags":[1]}'), (None, None, "7")], key=str)


def test_ingest_rescue_keeps_fields_unknown_to_a_fixed_schema(spark, tmp_root):
    p = _paths(tmp_root)
    table = "ingest_test_rescue"
    _write_json(p["input_path"], "a.json", [{"id": 1, "name": "a"}])
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"],
               rescue_column="_rescued_data")
    # files arriving after the schema was fixed: a new field and a type mismatch
    _write_json(p["input_path"], "b.json", [{"id": 2, "name": "b", "score": 9}, {"id": "x", "name": "c"}])
    run_ingest(spark, p["input_path"], "json", table, p["schema_location"], p["checkpoint_location"],
               evolve=False, rescue_column="_rescued_data")
    got = sorted((tuple(r) for r in spark.table(table).select("id", "name", "_rescued_data").collect()), key=str)
    assert got == sorted([(1, "a", None), (2, "b", '{"score":9}'), (None, "c", '{"id":"x"}')], key=str)


def _put(path, text, age=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    if age:
        then = time.time() - age
        os.utime(path, (then, then))


def _runner(spark, root, fmt, **options):
    table = "t_" + uuid.uuid4().hex
    run = lambda **more: run_ingest(spark, f"{root}/in", fmt, table, f"{root}/schema", f"{root}/cp", options=options, **more)
    return table, run


def test_a_late_file_with_an_old_time_brings_its_columns(spark, tmp_path):
    table, run = _runner(spark, tmp_path, "json")
    _put(f"{tmp_path}/in/a.json", '{"id": 1}\n')
    run()
    _put(f"{tmp_path}/in/b c+d%.json", '{"id": 2, "late": "x"}\n', age=3600)
    run()
    assert sorted((r["id"], r["late"]) for r in spark.table(table).collect()) == [(1, None), (2, "x")]


def test_inference_reads_only_files_the_stream_has_not(spark, tmp_path, monkeypatch):
    table, run = _runner(spark, tmp_path, "json")
    seen = []
    real = ingest_module.infer_schema
    monkeypatch.setattr(ingest_module, "infer_schema", lambda s, f, path, *a: seen.append(path) or real(s, f, path, *a))
    for i in range(3):
        _put(f"{tmp_path}/in/{i}.json", f'{{"id": {i}}}\n')
        run()
    run()
    assert [len(p) for p in seen] == [1, 1, 1]
    assert spark.table(table).count() == 3


@pytest.mark.parametrize("later", ['{"id": 1.5}', '{"id": "x"}', '{"id": 2, "n": {"a": 1, "b": 2}}'])
def test_what_the_schema_cannot_hold_stops_the_ingest_or_is_rescued(spark, tmp_path, later):
    for rescue in (None, "rescued"):
        root = f"{tmp_path}/{rescue}"
        table, run = _runner(spark, root, "json")
        _put(f"{root}/in/a.json", '{"id": 1, "n": {"a": 1}}\n')
        run(rescue_column=rescue)
        _put(f"{root}/in/b.json", later + "\n")
        if rescue is None or "n" in json.loads(later):
            with pytest.raises(ValueError, match="would be lost"):
                run()
            assert spark.table(table).count() == 1
        else:
            run(rescue_column=rescue)
            assert spark.table(table).count() == 2
            assert [json.loads(r["rescued"]) for r in spark.table(table).where("id IS NULL").collect()] == [json.loads(later)]


@pytest.mark.parametrize("evolve", [True, False])
def test_csv_columns_are_found_by_name(spark, tmp_path, evolve):
    table, run = _runner(spark, tmp_path, "csv", header="true")
    _put(f"{tmp_path}/in/a.csv", "id,name\n1,A\n")
    run()
    # another order, a new column in the middle, a column missing: all in one batch
    _put(f"{tmp_path}/in/b.csv", "name,id\nB,2\n")
    _put(f"{tmp_path}/in/c.csv", "id,extra,name\n3,E,C\n")
    _put(f"{tmp_path}/in/d [x].csv", "id\n4\n")
    run(evolve=evolve)
    got = spark.table(table).select("id", "name", *(["extra"] if evolve else []))
    want = {(1, "A", None), (2, "B", None), (3, "C", "E"), (4, None, None)}
    assert {tuple(r) for r in got.collect()} == {w[:len(got.columns)] for w in want}


def test_malformed_records_are_rescued_as_text(spark, tmp_path):
    table, run = _runner(spark, tmp_path, "json")
    _put(f"{tmp_path}/in/a.json", '{"id": 1}\nnot json {\n')
    run(rescue_column="rescued")
    assert sorted(((r["id"], r["rescued"]) for r in spark.table(table).select("id", "rescued").collect()), key=str) == [(1, None), (None, "not json {")]


def _records(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: str(r["id"]))


def test_a_running_stream_meets_new_columns_fields_and_types(spark, tmp_path):
    """No value is lost and nothing is restarted by hand."""
    table = "t_" + uuid.uuid4().hex
    _put(f"{tmp_path}/in/a.json", '{"id": 1, "v": 10, "n": {"a": 1}, "l": [{"x": 1}]}\n')
    q = ingest(spark, f"{tmp_path}/in", "json", table, f"{tmp_path}/schema", f"{tmp_path}/cp", trigger_type="processingTime", trigger_interval="1 second")
    later = [
        {"id": 2, "v": 11, "n": {"a": 2}, "l": [{"x": 2}], "new": "c"},  # a new column
        {"id": 3, "v": 12, "n": {"a": 3, "b": "deep"}, "l": [{"x": 3}]},  # a new nested field
        {"id": 4, "v": "many", "n": {"a": 4}, "l": [{"x": 4, "y": 5}]},  # another type, a new field in a list
        {"id": 5, "v": 1.5, "n": {"a": "five"}, "l": None},
        {"id": 6, "v": {"now": "an object"}, "n": 7, "l": "text"},
        {"id": 7, "v": 13, "n": {"a": 8}, "l": [{"x": 9}], "new": "d"},
    ]
    try:
        q.processAllAvailable()
        for r in later:
            _put(f"{tmp_path}/in/{r['id']}.json", json.dumps(r) + "\n")
            q.processAllAvailable()
        _put(f"{tmp_path}/in/bad.json", '{"id": 8, "v": 14}\n{"id": 9, "v"\n')
        q.processAllAvailable()
    finally:
        q.stop()
    rows = _records(spark.table(table))
    assert [r["id"] for r in rows] == [1, 2, 3, 4, 5, 6, 7, 8, None]
    for got, put in zip(rows[1:7], later, strict=True):
        kept = json.loads(got["_rescued_data"] or "{}")
        for k, v in put.items():
            typed = got[k]
            if isinstance(typed, list):
                typed = [dict(e) for e in typed]
            assert typed == v or kept.get(k) == v, (k, v, got)
    assert rows[2]["n"] == {"a": 3} and rows[3]["v"] is None and rows[7]["v"] == 14
    assert rows[8]["_rescued_data"] == '{"id": 9, "v"'
    assert spark.table(table).schema["v"].dataType == LongType()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_drift_in_a_running_stream_of_other_formats(spark, tmp_path, fmt):
    table = "t_" + uuid.uuid4().hex

    def put(rows, schema):
        df = spark.createDataFrame(rows, schema).coalesce(1)
        df.write.mode("append").options(**({"header": "true"} if fmt == "csv" else {})).format(fmt).save(f"{tmp_path}/in")

    put([(1, 5), (2, 6)], "id int, v int")
    q = ingest(spark, f"{tmp_path}/in", fmt, table, f"{tmp_path}/schema", f"{tmp_path}/cp", options={"header": "true"} if fmt == "csv" else {},
               trigger_type="processingTime", trigger_interval="1 second")
    try:
        q.processAllAvailable()
        put([(3, 7.5, "x"), (4, 8.0, "y")], "id int, v double, w string")
        q.processAllAvailable()
        put([(5, "none")], "id int, v string")
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["id"]: (r["v"], r["w"], r["_rescued_data"]) for r in spark.table(table).collect()}
    assert got[1] == (5, None, None) and got[3][1] == "x" and got[4][:2] == (8, "y")
    assert json.loads(got[3][2]) == {"v": 7.5} and got[3][0] is None and json.loads(got[5][2]) == {"v": "none"}


def test_drift_fails_before_its_batch_and_comes_again(spark, tmp_path):
    table, run = _runner(spark, tmp_path, "json")
    _put(f"{tmp_path}/in/a.json", '{"id": 1}\n')
    run()
    _put(f"{tmp_path}/in/b.json", '{"id": "x", "w": 1}\n')
    for _ in range(2):
        with pytest.raises(ValueError, match="would be lost"):
            run()
    assert spark.table(table).count() == 1
    run(on_drift="rescue")
    assert sorted(((r["id"], r["w"], r["_rescued_data"]) for r in spark.table(table).collect()), key=str) == [(1, None, None), (None, 1, '{"id":"x"}')]
    with pytest.raises(ValueError, match="on_drift"):
        run(on_drift="ignore")


def test_malformed_json_is_kept_by_default(spark, tmp_path):
    table, run = _runner(spark, tmp_path, "json")
    _put(f"{tmp_path}/in/a.json", 'not json\n\n')
    run()
    assert [r["_rescued_data"] for r in spark.table(table).collect()] == ["not json"]
    _put(f"{tmp_path}/in/b.json", '{"id": 1}\n{"id": \n')
    run()
    assert sorted(((r["id"], r["_rescued_data"]) for r in spark.table(table).collect()), key=str) == [(1, None), (None, "not json"), (None, '{"id": ')]


def test_nothing_to_read_is_an_error(spark, tmp_path):
    table, run = _runner(spark, tmp_path, "json")
    os.makedirs(f"{tmp_path}/in")
    with pytest.raises(ValueError, match="infer a schema"):
        run()


def test_partition_directories_are_columns(spark, tmp_path):
    table, run = _runner(spark, tmp_path, "parquet")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string").write.partitionBy("day").parquet(f"{tmp_path}/in")
    run()
    assert sorted((r["id"], r["day"]) for r in spark.table(table).collect()) == [(1, "a"), (2, "b")]


def test_several_batches_and_a_transform(spark, tmp_path):
    table, run = _runner(spark, tmp_path, "json", maxFilesPerTrigger=1)
    for i in range(3):
        _put(f"{tmp_path}/in/{i}.json", f'{{"id": {i}, "c{i}": 1}}\n')
    run(transform=lambda df: df.selectExpr("*", "id * 2 AS twice"))
    assert sorted((r["id"], r["twice"]) for r in spark.table(table).collect()) == [(0, 0), (1, 2), (2, 4)]
    assert {"c0", "c1", "c2"} <= set(spark.table(table).columns)
