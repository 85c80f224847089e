import pytest
from pyspark.sql import functions as F

from silverline.operators.transforms import Transformer, apply_transformations

# The sample frame and chain of the original transform demo.
SAMPLE = [
    (1, "Alice", "X", 10, 100, None),
    (2, "Bob", "Y", 20, 200, None),
    (3, "Charlie", "X", 30, 150, None),
    (4, "David", "Z", 40, 250, None),
    (5, "Eve", "Y", 50, 180, None),
]
SCHEMA = "id bigint, old_name_A string, category string, value1 bigint, value2 bigint, to_drop string"
CHAIN = [
    {"name": "rename_columns", "params": {"mapper": {"old_name_A": "name", "value1": "metric1"}}},
    {"name": "add_column", "params": {"column_name": "metric1_plus_10", "expression": "metric1 + 10"}},
    {"name": "add_column", "params": {"column_name": "source_system", "value": "SystemA"}},
    {"name": "filter_rows", "params": {"query_string": "metric1 > 15 and category != 'Z'"}},
    {"name": "drop_columns", "params": {"columns_to_drop": ["value2", "to_drop", "non_existent_col"]}},
]


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(SAMPLE, SCHEMA)


def test_sample_chain(sample):
    out = apply_transformations(sample, CHAIN)
    assert out.columns == ["id", "name", "category", "metric1", "metric1_plus_10", "source_system"]
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [
        (2, "Bob", "Y", 20, 30, "SystemA"),
        (3, "Charlie", "X", 30, 40, "SystemA"),
        (5, "Eve", "Y", 50, 60, "SystemA"),
    ]


def test_unknown_and_malformed_steps_skipped(sample):
    out = apply_transformations(sample, [{"name": "nope", "params": {}}, {"name": "x"}, "junk"])
    assert out.columns == sample.columns and out.count() == 5


def test_wrong_params_raise(sample):
    with pytest.raises(ValueError):
        apply_transformations(sample, [{"name": "rename_columns", "params": {"mapper": "bad"}}])
    with pytest.raises(ValueError):
        apply_transformations(sample, [{"name": "drop_columns", "params": {"columns_to_drop": "id"}}])
    with pytest.raises(ValueError):
        apply_transformations(sample, [{"name": "filter_rows", "params": {"query_string": 3}}])
    with pytest.raises(ValueError):
        apply_transformations(sample, [{"name": "add_column", "params": {"column_name": "x"}}])
    with pytest.raises(ValueError):
        apply_transformations(sample, [{"name": "add_column", "params": {"column_name": "x", "expression": 5}}])
    with pytest.raises(ValueError):
        apply_transformations(sample, [{"name": "add_column", "params": {"column_name": "x", "expression": "no_such + 1"}}])
    with pytest.raises(ValueError):
        apply_transformations(sample, [{"name": "filter_rows", "params": {"query_string": "no_such > 1"}}])


def test_type_errors(sample):
    with pytest.raises(TypeError):
        apply_transformations([1, 2], CHAIN)
    with pytest.raises(TypeError):
        apply_transformations(sample, {"name": "x"})


def test_add_column_overwrites_in_place_and_falsy_values(sample):
    out = apply_transformations(sample, [
        {"name": "add_column", "params": {"column_name": "category", "value": "Q"}},
        {"name": "add_column", "params": {"column_name": "zero", "value": 0}},
        {"name": "add_column", "params": {"column_name": "empty", "value": ""}},
        {"name": "add_column", "params": {"column_name": "no", "value": False}},
    ])
    assert out.columns[:3] == ["id", "old_name_A", "category"]
    r = out.first()
    assert (r.category, r.zero, r.empty, r.no) == ("Q", 0, "", False)


def test_add_column_case_clash_refused(sample):
    with pytest.raises(ValueError):
        apply_transformations(sample, [{"name": "add_column", "params": {"column_name": "CATEGORY", "value": 1}}])


def test_expression_wins_over_value(sample):
    out = apply_transformations(sample, [
        {"name": "add_column", "params": {"column_name": "d", "expression": "value1 * 2", "value": 7}}])
    assert [r.d for r in out.orderBy("id").collect()] == [20, 40, 60, 80, 100]


def test_rename_swap_and_collision(sample):
    out = apply_transformations(sample, [
        {"name": "rename_columns", "params": {"mapper": {"value1": "value2", "value2": "value1"}}}])
    r = out.orderBy("id").first()
    assert (r.value1, r.value2) == (100, 10)
    with pytest.raises(ValueError):
        apply_transformations(sample, [{"name": "rename_columns", "params": {"mapper": {"value1": "id"}}}])


def test_null_keeping_filter(spark):
    df = spark.createDataFrame([("X",), (None,), ("Z",)], "c string")
    kept = apply_transformations(df, [{"name": "filter_rows", "params": {"conditions": [("c", "!=", "Z")]}}])
    assert sorted(kept.collect(), key=str) == sorted([("X",), (None,)], key=str)
    sql = apply_transformations(df, [{"name": "filter_rows", "params": {"query_string": "c != 'Z'"}}])
    assert sql.count() == 1
    notin = apply_transformations(df, [{"name": "filter_rows", "params": {"conditions": [("c", "not in", ["X"])]}}])
    assert notin.count() == 2


def test_custom_registered(sample):
    tr = Transformer()
    tr.register("double", lambda df, p: df.withColumn(p["col"], F.col(p["col"]) * 2))
    out = tr.apply_transformations(sample, [{"name": "double", "params": {"col": "value1"}}])
    assert out.agg(F.sum("value1")).first()[0] == 300


def test_chain_is_one_plan_with_pushdown(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(100).withColumn("v", F.col("id") * 2).write.parquet(p)
    out = apply_transformations(spark.read.parquet(p), [
        {"name": "rename_columns", "params": {"mapper": {"v": "w"}}},
        {"name": "filter_rows", "params": {"query_string": "w > 10"}},
        {"name": "drop_columns", "params": {"columns_to_drop": ["id"]}},
    ])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(v), GreaterThan(v,10)]" in plan
    assert "ReadSchema: struct<v:bigint>" in plan


def test_chain_on_a_stream(spark, tmp_path):
    import uuid

    p = str(tmp_path / "in")
    spark.createDataFrame(SAMPLE, SCHEMA).write.parquet(p)
    stream = spark.readStream.schema(spark.read.parquet(p).schema).parquet(p)
    out = apply_transformations(stream, CHAIN)
    assert out.isStreaming
    name = f"chain_{uuid.uuid4().hex[:8]}"
    q = out.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.id for r in spark.table(name).collect()) == [2, 3, 5]


def test_pandas_column_accessor_in_expressions(sample):
    out = apply_transformations(sample, [
        {"name": "add_column", "params": {"column_name": "col_a2", "expression": "df['value1'] * 2"}},
        {"name": "add_column", "params": {"column_name": "m", "expression": 'df["value2"] + 10'}},
        {"name": "filter_rows", "params": {"query_string": "df['value1'] > 15"}},
    ])
    assert sorted((r.col_a2, r.m) for r in out.collect()) == [(40, 210), (60, 160), (80, 260), (100, 190)]
