"""silverline: Spark-native ingest, decrypt, transform, dedup and merge for raw-to-clean tables."""

from silverline.functions.fernet import FernetKey, decrypt, encrypt, encrypt_column, random_iv
from silverline.functions.payload import explode_payload, infer_payload_schema, json_validity, split_valid_json
from silverline.operators.dedup import drop_duplicates, flag_latest, keep_rows
from silverline.operators.merge import MergeSpec, merge, merge_into_sql, scd2_apply, scd2_expire
from silverline.operators.transforms import Transformer, apply_transformations
from silverline.plans.config import dedup_from_params, dedup_job_from_params, ingest_from_params, merge_from_params
from silverline.plans.flow import run_flow
from silverline.session import local_session, scratch_path, scratch_root
from silverline.sources.ingest import SchemaStore, ingest, run_ingest, typed_from_variant
from silverline.sources.tables import create_table, dedup_table, merge_table, stage_files, write_snapshot
from silverline.streaming.dedup import dedup_stream
from silverline.streaming.merge import merge_stream

__all__ = [
    "FernetKey", "decrypt", "encrypt", "encrypt_column", "random_iv",
    "explode_payload", "infer_payload_schema", "json_validity", "split_valid_json",
    "drop_duplicates", "flag_latest", "keep_rows",
    "MergeSpec", "merge", "merge_into_sql", "scd2_apply", "scd2_expire",
    "Transformer", "apply_transformations",
    "dedup_from_params", "dedup_job_from_params", "ingest_from_params", "merge_from_params",
    "run_flow",
    "local_session", "scratch_path", "scratch_root",
    "SchemaStore", "ingest", "run_ingest", "typed_from_variant",
    "create_table", "dedup_table", "merge_table", "stage_files", "write_snapshot",
    "dedup_stream", "merge_stream",
]
