"""Catalog tables of files, appended to by streams, replaced by snapshot swap, and table-level jobs.

Parquet has no transactions and a table cannot be overwritten while it is being
read. A replace therefore writes the new content to a fresh directory
``<base>/v=<id>`` and then points the table at it (``ALTER TABLE ... SET
LOCATION``). Readers see the old or the new snapshot; a failed write leaves the
old one in place. No directory is ever written twice: each attempt takes a new one.

A swap is logged on the table before its pointers move (a property naming the new
directory), and the log entry is cleared together with the record of the batch. Whoever
touches the table next finishes a swap that was cut off, so a replayed batch is
applied once. Batches are recorded for each stream on its own. Single writer per table.

Streams append to the same tables (:func:`append_batch`): each batch is a directory of its own below the
current snapshot, named by stream and batch and written with overwrite, so a replayed batch replaces
itself. No file sink and no sink log is involved, so a table may be appended to, swapped, and appended to
again. An append is logged before it is written; one that was cut off is emptied before the
next swap reads the table, and comes again with its stream. Tables whose directory does hold a
file sink's log (made by ``toTable``) are taken over once with :func:`adopt_table`.

All data is written by executors; only catalog metadata (a location, a property)
is read on the driver.
"""

from __future__ import annotations

import functools
import json
import logging
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, StructField, StructType

from silverline.operators.dedup import drop_duplicates, keep_rows
from silverline.operators.merge import MergeSpec, merge_into_sql
from silverline.operators.sized_merge import merge_by_size
from silverline.session import scratch_path

log = logging.getLogger(__name__)

# JSON writers default to millisecond timestamps; staged data must keep microseconds.
JSON_WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Providers without row-level operations: merged by rewriting a snapshot.
FILE_PROVIDERS = {"parquet", "orc", "json", "csv", "text", "avro"}

PROP_BASE = "silverline.base"
PROP_BATCH = "silverline.last_batch"
PROP_PENDING = "silverline.pending_swap"
PROP_APPEND = "silverline.pending_append"


# Reader option with which a table reads the directories below its location.
NESTED = "recursiveFileLookup"


def _q(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows}


def _describe(spark: SparkSession, name: str, key: str) -> str | None:
    """A detail of the table; data columns that share the key's name come before and do not count."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    start = max((i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed Table")), default=-1)
    return next((r["data_type"] for r in rows[start + 1:] if r["col_name"] == key), None)


def table_location(spark: SparkSession, name: str) -> str | None:
    return _describe(spark, name, "Location")


def table_provider(spark: SparkSession, name: str) -> str:
    return (_describe(spark, name, "Provider") or "").lower()


def storable(df: DataFrame) -> DataFrame:
    """``df`` with all-null (``void``) columns cast to string: parquet cannot store ``void``."""
    if not any(isinstance(f.dataType, NullType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, NullType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def _storable_schema(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType(), True) if isinstance(f.dataType, NullType) else f
                       for f in schema.fields])


def schema_ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    base: str | None = None,
    properties: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
    provider: str = "parquet",
) -> str:
    """Create a table ``name`` (if missing) of files whose snapshots live under ``base``.

    Returns the base directory. Table properties are applied at creation;
    ``partition_by`` makes a partitioned table (partitions tracked in the catalog). Others read
    the directories of appended batches below their location too.
    """
    if spark.catalog.tableExists(name):
        props = table_properties(spark, name)
        return props.get(PROP_BASE) or (table_location(spark, name) or "").rsplit("/", 1)[0]
    schema = _storable_schema(schema)
    base = (base or scratch_path(spark, "tables", name.replace(".", "_"))).rstrip("/")
    first = f"{base}/v=init-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.format(provider).save(first)
    props = {PROP_BASE: base, **{str(k): str(v) for k, v in (properties or {}).items()}}
    props_sql = ", ".join(f"'{_q(k)}' = '{_q(v)}'" for k, v in props.items())
    ddl = schema_ddl(schema)
    parts = f"PARTITIONED BY ({', '.join('`' + c + '`' for c in partition_by)}) " if partition_by else ""
    nested = "" if partition_by else f"OPTIONS ({NESTED} 'true') "
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {provider} {nested}{parts}"
        f"LOCATION '{_q(first)}' TBLPROPERTIES ({props_sql})"
    )
    return base


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _partition_dirs(path: str, base_dir: str) -> tuple[str, ...] | None:
    """The ``col=value`` directory names, as on storage, of a file URI under ``base_dir``.

    File listings are URIs, so names come back percent-encoded once more than on
    storage; one decoding restores them (Spark's own escaping stays in place).
    """
    rel = unquote(path).split(base_dir.rstrip("/") + "/", 1)
    if len(rel) != 2:
        return None
    return tuple(seg for seg in rel[1].split("/")[:-1] if "=" in seg)


def _swap_partitions(spark: SparkSession, name: str, pcols: list[str], new_dir: str) -> set:
    """Point each partition found under ``new_dir`` there.

    The written partitions are read back from the file listing (metadata only);
    directory names are used as Spark wrote them. Partitions not found there keep
    their current location. Running it again changes nothing.
    """
    try:
        files = spark.read.parquet(new_dir).inputFiles()
    except AnalysisException:  # nothing written: no partition to swap
        files = []
    dirs = {d for d in (_partition_dirs(f, new_dir) for f in files) if d and len(d) == len(pcols)}
    written = set()
    for d in dirs:
        spec = dict(unquote(seg).split("=", 1) for seg in d)
        if set(spec) != set(pcols):
            continue
        part = ", ".join(f"`{c}` = '{_q(spec[c])}'" for c in pcols)
        loc = new_dir + "/" + "/".join(d)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({part}) LOCATION '{_q(loc)}'")
        spark.sql(f"ALTER TABLE {name} PARTITION ({part}) SET LOCATION '{_q(loc)}'")
        written.add(tuple(spec[c] for c in pcols))
    return written


def _drop_partitions_except(spark: SparkSession, name: str, pcols: list[str], keep: set) -> None:
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        spec = dict(unquote(seg).split("=", 1) for seg in row[0].split("/"))
        if tuple(spec[c] for c in pcols) not in keep:
            part = ", ".join(f"`{c}` = '{_q(spec[c])}'" for c in pcols)
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({part})")


def _batch_property(stream_id: str | None) -> str:
    return f"{PROP_BATCH}.{stream_id}" if stream_id else PROP_BATCH


def last_batch(spark: SparkSession, name: str, stream_id: str | None = None) -> int | None:
    """The last batch of a stream (or of callers that name none) that the table holds."""
    v = table_properties(spark, name).get(_batch_property(stream_id))
    return int(v) if v not in (None, "") else None


def is_applied(spark: SparkSession, name: str, batch_id: int | None, stream_id: str | None = None) -> bool:
    done = None if batch_id is None else last_batch(spark, name, stream_id)
    return done is not None and int(batch_id) <= done


def _set_properties(spark: SparkSession, name: str, props: dict[str, str]) -> None:
    pairs = ", ".join(f"'{_q(k)}' = '{_q(v)}'" for k, v in props.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def finish_swap(spark: SparkSession, name: str) -> None:
    """Carry out the swap that is logged on the table, if there is one; safe to repeat."""
    entry = table_properties(spark, name).get(PROP_PENDING)
    if not entry:
        return
    swap = json.loads(entry)
    pcols = partition_columns(spark, name)
    if pcols:
        written = _swap_partitions(spark, name, pcols, swap["dir"])
        if swap["replace_all"]:
            _drop_partitions_except(spark, name, pcols, written)
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_q(swap['dir'])}'")
    mark = {swap["mark"]: str(swap["batch"])} if swap["mark"] else {}
    _set_properties(spark, name, {PROP_PENDING: "", **mark})
    spark.catalog.refreshTable(name)


def write_snapshot(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    batch_id: int | None = None,
    replace_all: bool = True,
    stream_id: str | None = None,
) -> bool:
    """Replace the content of table ``name`` with ``df`` by a snapshot swap.

    For a partitioned table each partition present in ``df`` is swapped on its
    own; partitions absent from ``df`` are dropped, or kept when
    ``replace_all=False`` (``df`` then holds only the partitions it rewrites).
    Each swap is atomic, the set of them is not, but a cut-off set is finished by
    the next writer. With ``batch_id``, a batch at or below the last one applied for
    ``stream_id`` is skipped (returns False).
    """
    df = storable(df)
    if not spark.catalog.tableExists(name):
        create_table(spark, name, df.schema)
    settle(spark, name)
    props = table_properties(spark, name)
    if has_sink_log(spark, name):
        raise ValueError(f"table {name} is appended to by a file sink; take it over with adopt_table, or write the result to another table")
    if is_applied(spark, name, batch_id, stream_id):
        log.info("table %s: batch %s already applied, skipped", name, batch_id)
        return False
    _swap_in(spark, name, df, props, replace_all, _batch_property(stream_id) if batch_id is not None else None, batch_id)
    return True


def _swap_in(spark: SparkSession, name: str, df: DataFrame, props: dict[str, str], replace_all: bool = True,
             mark: str | None = None, batch_id: int | None = None) -> None:
    base = props.get(PROP_BASE) or (table_location(spark, name) or "").rsplit("/", 1)[0]
    new_dir = f"{base}/v={uuid.uuid4().hex}"
    pcols = partition_columns(spark, name)
    writer = df.select(*[F.col(f"`{c}`") for c in spark.table(name).columns]).write if pcols else df.write
    (writer.partitionBy(*pcols) if pcols else writer).format(table_provider(spark, name)).save(new_dir)
    _set_properties(spark, name, {PROP_PENDING: json.dumps(
        {"dir": new_dir, "replace_all": replace_all, "mark": mark, "batch": None if batch_id is None else int(batch_id)})})
    finish_swap(spark, name)


# -- appends ------------------------------------------------------------------------


def has_sink_log(spark: SparkSession, name: str) -> bool:
    """Whether the table's directory holds the log of a file sink, which decides what readers see."""
    location = table_location(spark, name)
    if not location or table_provider(spark, name) not in FILE_PROVIDERS:
        return False
    try:
        spark.read.text(f"{location}/_spark_metadata")
        return True
    except AnalysisException as e:
        if not (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise
        return False


def adopt_table(spark: SparkSession, name: str) -> None:
    """Make an existing table of files one that batches can be appended to; others are left as they are.

    A table that a file sink wrote is copied once into a snapshot without the sink's log; the stream
    that wrote it must not go on with ``toTable``.
    """
    if table_provider(spark, name) not in FILE_PROVIDERS or partition_columns(spark, name):
        return
    settle(spark, name)
    if has_sink_log(spark, name):
        _swap_in(spark, name, spark.table(name), table_properties(spark, name))
    if NESTED.lower() not in (_describe(spark, name, "Storage Properties") or "").lower():
        spark.sql(f"ALTER TABLE {name} SET SERDEPROPERTIES ('{NESTED}' = 'true')")
    spark.catalog.refreshTable(name)


def settle(spark: SparkSession, name: str) -> None:
    """Finish a swap and empty the appends that were cut off; their streams bring them again."""
    finish_swap(spark, name)
    for key, where in table_properties(spark, name).items():
        if key.startswith(PROP_APPEND + ".") and where:
            spark.createDataFrame([], spark.table(name).schema).write.mode("overwrite").format(table_provider(spark, name)).save(where)
            _set_properties(spark, name, {key: ""})
            spark.catalog.refreshTable(name)


def aligned(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in their order; missing ones are null, unknown ones an error."""
    have = {c.lower(): c for c in df.columns}
    unknown = sorted(set(have) - {f.name.lower() for f in schema.fields})
    if unknown:
        raise ValueError(f"the table has no column {', '.join(have[c] for c in unknown)}")
    types = dict(df.dtypes)

    def col(f):
        own = have.get(f.name.lower())
        if own is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f"`{own}`")
        return (c if types[own] == f.dataType.simpleString() else c.cast(f.dataType)).alias(f.name)

    return df.select(*map(col, schema.fields))


def append_batch(spark: SparkSession, name: str, df: DataFrame, batch_id: int, stream_id: str) -> bool:
    """Append one batch of a stream to table ``name`` exactly once; returns False where it was applied before.

    Unpartitioned tables of files get a directory for the batch; of partitioned ones the partitions that the
    batch touches are rewritten. Tables of other providers are appended to through ``writeTo`` in their
    own format; where the provider knows ``txnAppId`` / ``txnVersion`` a batch repeated after a
    crash between its commit and its record is dropped there, elsewhere it would come twice.
    """
    mark = _batch_property(stream_id)
    provider = table_provider(spark, name)
    if provider not in FILE_PROVIDERS:
        if is_applied(spark, name, batch_id, stream_id):
            return False
        aligned(df, spark.table(name).schema).writeTo(name).option("txnAppId", stream_id).option("txnVersion", str(batch_id)).append()
        _set_properties(spark, name, {mark: str(int(batch_id))})
        return True
    finish_swap(spark, name)
    if is_applied(spark, name, batch_id, stream_id):
        return False
    rows = aligned(df, spark.table(name).schema)
    pcols = partition_columns(spark, name)
    if pcols:
        kept = _touched_partitions(spark.table(name), rows, pcols)
        return write_snapshot(spark, name, kept.unionByName(rows), batch_id, replace_all=False, stream_id=stream_id)
    where = f"{table_location(spark, name)}/append/{stream_id}/{int(batch_id)}"
    pending = f"{PROP_APPEND}.{stream_id}"
    _set_properties(spark, name, {pending: where})
    rows.write.mode("overwrite").format(provider).save(where)
    _set_properties(spark, name, {pending: "", mark: str(int(batch_id))})
    spark.catalog.refreshTable(name)
    return True


def stage_files(df: DataFrame, path: str, fmt: str = "json", options: dict | None = None) -> str:
    """Append ``df`` as files under ``path`` (executors write; nothing is collected)."""
    opts = dict(JSON_WRITE_OPTIONS) if fmt == "json" else {}
    opts.update({k: str(v) for k, v in (options or {}).items()})
    df.write.mode("append").format(fmt).options(**opts).save(path)
    return path


def dedup_table(
    spark: SparkSession,
    source_table: str,
    target_table: str,
    keys: list[str],
    watermark_column: str | None = None,
    watermark_delay: str | None = None,
    order_by: list[str] | str | None = None,
) -> DataFrame:
    """Read ``source_table``, drop duplicates by ``keys``, replace ``target_table`` (may be the same).

    With ``order_by`` the latest row per key is kept instead of an arbitrary one.
    """
    for table in {source_table, target_table}:
        if spark.catalog.tableExists(table) and table_provider(spark, table) in FILE_PROVIDERS:
            settle(spark, table)
    src = spark.table(source_table)
    if order_by:
        out = keep_rows(src, keys, order_by, keep="last")
    else:
        out = drop_duplicates(src, keys, watermark_column, watermark_delay)
    write_snapshot(spark, target_table, out)
    return spark.table(target_table)


def _touched_partitions(target: DataFrame, source: DataFrame, pcols: list[str]) -> DataFrame:
    """The rows of ``target`` in partitions that ``source`` has rows for, null partitions included.

    The plain semi join prunes partitions at run time; only partitions with a null value
    need the null-safe one.
    """
    touched = source.select(*pcols).distinct()
    some_null = functools.reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in pcols])
    whole = target.join(touched.where(~some_null), pcols, "left_semi")
    renamed = touched.where(some_null).select(*[F.col(f"`{c}`").alias(f"__touched_{i}") for i, c in enumerate(pcols)])
    same = functools.reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"__touched_{i}")) for i, c in enumerate(pcols)])
    return whole.unionByName(target.where(some_null).join(renamed, same, "left_semi"))


def merge_table(
    spark: SparkSession,
    target_table: str,
    source: str | DataFrame,
    spec: MergeSpec,
    batch_id: int | None = None,
    create_schema: StructType | None = None,
    engine: str = "auto",
    stream_id: str | None = None,
) -> DataFrame:
    """MERGE ``source`` (table name or DataFrame) into ``target_table``.

    ``engine="rewrite"`` computes the merged table with :func:`merge_by_size` and swaps in a
    new snapshot (plain file tables). ``engine="sql"`` runs ``MERGE INTO`` for
    catalogs whose tables support row-level operations, so only touched files are
    rewritten. ``"auto"`` picks by the table's provider. With ``batch_id`` a batch
    already applied for ``stream_id`` is skipped; on the SQL path the batch is recorded after
    the MERGE commits, so use idempotent update expressions there.
    """
    for what, v in (("target table", target_table), ("source", source)):
        if v is None or (isinstance(v, str) and not v):
            raise ValueError(f"merge_table: missing {what}")
    if engine not in ("auto", "rewrite", "sql"):
        raise ValueError("merge_table: engine must be 'auto', 'rewrite' or 'sql'")
    src = spark.table(source) if isinstance(source, str) else source
    if not spark.catalog.tableExists(target_table):
        create_table(spark, target_table, create_schema or src.schema)
    if engine == "auto":
        engine = "rewrite" if table_provider(spark, target_table) in FILE_PROVIDERS else "sql"
    if engine == "rewrite":
        settle(spark, target_table)
        spec.validate()
        if is_applied(spark, target_table, batch_id, stream_id):
            return spark.table(target_table)
        target = spark.table(target_table)
        pcols = partition_columns(spark, target_table)
        by_source = spec.delete_by_source is not False or spec.update_by_source is not None
        scoped = bool(pcols) and set(pcols) <= set(spec.keys) and not by_source
        if scoped:
            # a source row can only match target rows of its own partition: read and
            # rewrite just the partitions that the source touches
            target = _touched_partitions(target, src, pcols)
        write_snapshot(spark, target_table, merge_by_size(target, src, spec), batch_id, replace_all=not scoped, stream_id=stream_id)
        return spark.table(target_table)

    spec.validate()
    if is_applied(spark, target_table, batch_id, stream_id):
        return spark.table(target_table)
    if spec.dedupe_source:
        src = keep_rows(src, spec.keys, spec.dedupe_source, keep="last", tiebreak=True)
    view = f"silverline_merge_source_{uuid.uuid4().hex}"
    src.createOrReplaceTempView(view)
    try:
        sql = merge_into_sql(target_table, view, spec, spark.table(target_table).columns, src.columns)
        spark.sql(sql)
    finally:
        spark.catalog.dropTempView(view)
    if batch_id is not None:
        _set_properties(spark, target_table, {_batch_property(stream_id): str(int(batch_id))})
    return spark.table(target_table)
