"""Plan-level rules over every registered query: JVM-side only, no pairwise joins."""

import pytest

from silverline.plans.queries import QUERIES

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("EvalPython", "PythonUDF", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udfs_or_pairwise_joins(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan], plan


def test_decrypt_runs_in_whole_stage_codegen(spark):
    from silverline.functions.fernet import decrypt, generate_key_from

    key = generate_key_from(bytes(range(32)))
    df = spark.read.parquet(f"{SF}/documents.parquet").select(decrypt("text", key).alias("p"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the key comes from subqueries, so the plan is an adaptive one; the projection is inside a codegen stage
    assert "aesDecrypt" in plan and "   +- *(1) Project [CASE WHEN" in plan, plan
