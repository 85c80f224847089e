import json
import os

import pytest

from silverline.plans.config import dedup_from_params, ingest_from_params


def test_ingest_params_required_and_modes(spark, tmp_root):
    base = {"input_path": f"{tmp_root}/in", "input_format": "csv", "output_table_name": "cfg_t",
            "schema_location": f"{tmp_root}/s", "checkpoint_location": f"{tmp_root}/c"}
    for k in base:
        with pytest.raises(ValueError):
            ingest_from_params(spark, {kk: v for kk, v in base.items() if kk != k})
    with pytest.raises(ValueError):
        ingest_from_params(spark, {**base, "file_format_options": {"header": "true", "delimiter": ","},
                                   "trigger_type": "processingTime", "trigger_interval": "5 minutes",
                                   "output_mode": "overwrite"})


def test_ingest_params_run(spark, tmp_root):
    os.makedirs(f"{tmp_root}/in")
    with open(f"{tmp_root}/in/a.json", "w") as f:
        f.write(json.dumps({"id": 1}) + "\n")
    q = ingest_from_params(spark, {"input_path": f"{tmp_root}/in", "input_format": "json",
                                   "output_table_name": "cfg_json", "schema_location": f"{tmp_root}/s",
                                   "checkpoint_location": f"{tmp_root}/c", "trigger_type": "once"})
    q.awaitTermination()
    assert spark.table("cfg_json").count() == 1


def test_dedup_params(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "user_id bigint, event_type string")
    assert dedup_from_params(df, {"strategy": "drop_duplicates",
                                  "deduplication_keys": ["user_id", "event_type"]}).count() == 2
    for bad in ({}, {"strategy": "drop_duplicates"}, {"strategy": "drop_duplicates", "deduplication_keys": []},
                {"strategy": "merge_into", "deduplication_keys": ["id"]}, {"strategy": "other"}):
        with pytest.raises(ValueError):
            dedup_from_params(df, bad)
