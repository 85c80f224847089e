"""Structured filters against pandas DataFrame.query, the reference's filter engine."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from silverline.operators.transforms import apply_transformations

ROWS = st.lists(st.tuples(st.sampled_from(["X", "Y", "Z", None]),
                          st.one_of(st.none(), st.integers(0, 20))), max_size=12)
COND = st.one_of(
    st.tuples(st.just("c"), st.sampled_from(["==", "!="]), st.sampled_from(["X", "Z"])),
    st.tuples(st.just("c"), st.sampled_from(["in", "not in"]), st.sampled_from([["X"], ["X", "Y"]])),
    st.tuples(st.just("n"), st.sampled_from([">", ">=", "<", "<=", "==", "!="]), st.integers(0, 20)),
)


def pandas_query(pdf, conds):
    parts, env = [], {}
    for i, (col, op, val) in enumerate(conds):
        env[f"v{i}"] = val
        parts.append(f"{col} {op} @v{i}")
    return pdf.query(" and ".join(parts), local_dict=env)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, conds=st.lists(COND, min_size=1, max_size=3))
def test_structured_filter_matches_pandas(spark, rows, conds):
    data = [(i, c, n) for i, (c, n) in enumerate(rows)]
    pdf = pd.DataFrame(data, columns=["id", "c", "n"]).astype({"n": "float64"})
    expected = sorted(pandas_query(pdf, conds)["id"].tolist())
    df = spark.createDataFrame(data, "id bigint, c string, n bigint")
    out = apply_transformations(df, [{"name": "filter_rows", "params": {"conditions": [tuple(c) for c in conds]}}])
    assert sorted(r.id for r in out.collect()) == expected
