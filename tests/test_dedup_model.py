"""keep_rows against pandas drop_duplicates(keep=...) on frames sorted by the order columns."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from silverline.operators.dedup import keep_rows

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5)), max_size=15)


@settings(max_examples=50, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, keep=st.sampled_from(["first", "last", False]))
def test_keep_rows_matches_pandas(spark, rows, keep):
    data = [(i, k, o) for i, (k, o) in enumerate(rows)]
    pdf = pd.DataFrame(data, columns=["id", "k", "o"]).astype({"k": "float64"})
    expected = sorted(pdf.sort_values(["o", "id"]).drop_duplicates(["k"], keep=keep)["id"].tolist())
    df = spark.createDataFrame(data, "id bigint, k bigint, o bigint")
    got = sorted(r.id for r in keep_rows(df, ["k"], ["o", "id"], keep).collect())
    assert got == expected
