"""typed_from_variant against a plain-Python model of typed columns plus a rescue object."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from silverline.sources.ingest import typed_from_variant

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType())])
VALUES = st.one_of(st.none(), st.integers(-5, 5), st.sampled_from(["a", "b"]), st.booleans(),
                   st.lists(st.integers(0, 3), max_size=2))
RECORD = st.dictionaries(st.sampled_from(["id", "name", "x", "y"]), VALUES, max_size=4)


def model(rec):
    """(id, name, rescued) for one JSON object."""
    rescued, out = {}, {}
    for k, v in rec.items():
        if k not in ("id", "name"):
            rescued[k] = v
    idv = rec.get("id")
    if idv is None:
        out["id"] = None
    elif isinstance(idv, int) and not isinstance(idv, bool):
        out["id"] = idv
    else:
        out["id"] = None
        rescued["id"] = idv
    nv = rec.get("name")
    # a string column takes any JSON value; non-strings as their JSON text
    out["name"] = None if nv is None else (nv if isinstance(nv, str) else json.dumps(nv, separators=(",", ":")))
    return out["id"], out["name"], rescued or None


@settings(max_examples=80, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records=st.lists(RECORD, min_size=1, max_size=6))
def test_rescue_matches_model(spark, records):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "t string").select(F.parse_json("t").alias("r"))
    def norm(row):  # rescued objects compared as sorted-key JSON
        i, n, rescued = row
        return i, n, None if rescued is None else json.dumps(rescued, sort_keys=True)

    got = [norm((r.id, r.name, json.loads(r.rescued) if r.rescued else None))
           for r in typed_from_variant(df, "r", SCHEMA, "rescued").collect()]
    assert sorted(got, key=repr) == sorted((norm(model(r)) for r in records), key=repr)
