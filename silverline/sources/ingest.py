"""Incremental file ingest: a stream of files with a persisted, evolving schema.

``ingest`` starts a Structured Streaming query that finds new files under ``input_path`` (json, csv,
parquet, text, binaryFile). The stream itself carries file names only; each micro-batch reads its
files as a batch job and appends them to a table (:func:`silverline.sources.tables.append_batch`),
with exactly-once progress kept in the checkpoint and on the table. A restart with the same checkpoint
reads only files it has not seen.

For json/csv/parquet every micro-batch looks at the schema of its own files before it reads them: new columns are
added to the stored schema at ``schema_location`` (columns are never dropped or narrowed), the new
version is appended to the store and the table is widened with ``ALTER TABLE ADD COLUMNS``, while
the stream runs on. text and binaryFile have fixed schemas. csv files with a header are read by
column name, whatever the order.

Nothing is lost without a word. A value that its column's type cannot hold and a new field inside a
struct either stop the stream before the batch is appended (``on_drift="fail"``) or are kept as JSON in a rescue
column, which the table gets when it is first needed (``on_drift="rescue"``). Malformed json records are
kept there as text.
"""

from __future__ import annotations

import datetime as _dt
import functools
import json
import logging
import re
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, NullType, ShortType,
    StringType, StructField, StructType, TimestampNTZType, TimestampType, VariantType,
)

from silverline.sources.tables import _q, adopt_table, append_batch, create_table, is_applied, schema_ddl

log = logging.getLogger(__name__)

FORMATS = ("json", "csv", "parquet", "text", "binaryfile")
FIXED_SCHEMAS = {
    "text": "value string",
    "binaryfile": "path string, modificationTime timestamp, length bigint, content binary",
}
REQUIRED = ("input_path", "input_format", "table", "schema_location", "checkpoint_location")
# Analysis errors that mean "there is nothing to read"; every other one is raised.
_NOTHING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
RESCUE_COLUMN = "_rescued_data"
_CORRUPT = "_corrupt_record"
# Files of one micro-batch where the options set no limit; their names pass through the driver.
FILES_PER_BATCH = 10_000
# Options of the stream that finds files; the reader of their content gets the others.
_STREAM_OPTIONS = {
    "maxfilespertrigger", "maxbytespertrigger", "latestfirst", "filenameonly", "maxfileage", "cleansource", "sourcearchivedir", "maxcachedfiles",
    "discardcachedinputratio",
}
_LISTING_OPTIONS = _STREAM_OPTIONS | {"pathglobfilter", "recursivefilelookup"}
_RANK = {ByteType: 0, ShortType: 1, IntegerType: 2, LongType: 3, FloatType: 4, DoubleType: 5}


def clean_options(options: Mapping[str, Any] | None) -> dict[str, str]:
    """Reader options as strings; keys starting with ``_`` (config comments) are dropped."""
    return {str(k): str(v) for k, v in (options or {}).items() if not str(k).startswith("_")}


def _nothing_there(e: AnalysisException) -> bool:
    return (e.getCondition() or "").split(".")[0] in _NOTHING


def holds(stored: DataType, new: DataType) -> bool:
    """Whether a reader with the stored type keeps every value of the new one."""
    if stored == new or isinstance(new, NullType) or isinstance(stored, VariantType):
        return True
    if isinstance(stored, StructType) and isinstance(new, StructType):
        fields = {f.name: f.dataType for f in stored.fields}
        return all(f.name in fields and holds(fields[f.name], f.dataType) for f in new.fields)
    if isinstance(stored, ArrayType) and isinstance(new, ArrayType):
        return holds(stored.elementType, new.elementType)
    if isinstance(stored, MapType) and isinstance(new, MapType):
        return holds(stored.keyType, new.keyType) and holds(stored.valueType, new.valueType)
    if isinstance(stored, StringType):
        return not isinstance(new, (BinaryType, VariantType))
    if type(stored) in _RANK and type(new) in _RANK:
        return _RANK[type(stored)] >= _RANK[type(new)]
    return isinstance(stored, (TimestampType, TimestampNTZType)) and isinstance(new, DateType)


def merge_schemas(stored: StructType | None, new: StructType | None, strict: bool = True, nested_strict: bool = True) -> StructType:
    """Stored columns first with their stored types, then columns only ``new`` has.

    With ``strict`` a stored type that cannot hold the new one is an error; else it is kept and logged.
    With ``nested_strict`` it is an error inside structs, arrays and maps in any case.
    """
    if stored is None or new is None:
        return new or stored or StructType([])
    have = {f.name.lower(): f for f in stored.fields}
    drift = [f"{f.name}: {have[f.name.lower()].dataType.simpleString()} cannot hold {f.dataType.simpleString()}"
             for f in new.fields if f.name.lower() in have and not holds(have[f.name.lower()].dataType, f.dataType)]
    nested = any(isinstance(have[f.name.lower()].dataType, (StructType, ArrayType, MapType)) and not holds(have[f.name.lower()].dataType, f.dataType)
                 for f in new.fields if f.name.lower() in have)
    if drift and (strict or nested and nested_strict):
        raise ValueError(f"ingest: values would be lost to the stored schema ({'; '.join(drift)}); "
                         "use a rescue column (json) or another table")
    if drift:
        log.warning("schema evolution: %s; such values go to the rescue column", "; ".join(drift))
    return StructType([*stored.fields, *[StructField(f.name, f.dataType, True) for f in new.fields if f.name.lower() not in have]])


class SchemaStore:
    """Versioned schemas at ``location``: one JSON row per version, append-only."""

    _ROW = StructType([
        StructField("version", LongType()),
        StructField("schema_json", StringType()),
        StructField("inferred_at", StringType()),
    ])

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")

    def latest(self) -> tuple[int, StructType, str] | None:
        try:
            df = self.spark.read.schema(self._ROW).json(self.location)
            rows = df.orderBy(F.col("version").desc()).limit(1).collect()
        except AnalysisException as e:
            if not _nothing_there(e):
                raise
            return None
        if not rows:
            return None
        r = rows[0]
        return r["version"], StructType.fromJson(json.loads(r["schema_json"])), r["inferred_at"]

    def save(self, version: int, schema: StructType, inferred_at: str) -> None:
        row = [(version, schema.json(), inferred_at)]
        self.spark.createDataFrame(row, self._ROW).coalesce(1).write.mode("append").json(self.location)


def _plain_path(path: str) -> str:
    """A file name as a path that is not taken for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _flag(options: Mapping[str, str], name: str) -> str:
    return {k.lower(): v for k, v in options.items()}.get(name, "").lower()


def _header_groups(spark: SparkSession, paths: list[str], options: Mapping[str, str]) -> list[list[str]]:
    """The files of one micro-batch (or a folder), together where their header lines agree."""
    keep = {k: v for k, v in options.items() if k.lower() in ("encoding", "charset", "pathglobfilter", "recursivefilelookup")}
    lines = spark.read.options(**keep).text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    # file names in metadata are encoded as in a URL, where a plus sign is itself
    name = F.url_decode(F.regexp_replace("file", "[+]", "%2B"))
    first = lines.where("start = 0").groupBy(name.alias("file")).agg(F.min_by("value", "at").alias("header"))
    groups = [r["files"] for r in first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()]
    return sorted(groups)


def infer_schema(
    spark: SparkSession,
    fmt: str,
    path: str | list[str],
    options: Mapping[str, str],
    sampling_ratio: float | None = None,
    keep_corrupt: bool = False,
) -> StructType | None:
    """Schema of the files under ``path`` (a folder or a list of files); None where there are none.

    Csv files with headers are put together by column name. ``keep_corrupt`` leaves in the column that
    json inference adds where it met a malformed record.
    """
    opts = dict(options)
    if fmt == "parquet":
        opts.setdefault("mergeSchema", "true")
    if fmt == "csv":
        opts.setdefault("inferSchema", "true")
    if sampling_ratio is not None and fmt in ("json", "csv"):
        opts["samplingRatio"] = str(sampling_ratio)
    try:
        if fmt == "csv" and _flag(opts, "header") == "true":
            schema = None
            for files in _header_groups(spark, path if isinstance(path, list) else [path], opts):
                own = spark.read.format(fmt).options(**opts).load([_plain_path(f) for f in files]).schema
                schema = own if schema is None else _put_together(schema, own)
        else:
            schema = spark.read.format(fmt).options(**opts).load(path).schema
    except AnalysisException as e:
        # a folder may be empty, but files that the stream has found must be there
        if not _nothing_there(e) or isinstance(path, list) and e.getCondition() == "PATH_NOT_FOUND":
            raise
        log.info("schema inference found nothing under %s", path)
        return None
    fields = [f for f in schema.fields if keep_corrupt or f.name != _CORRUPT] if schema is not None else []
    return StructType(fields) if fields else None


def _put_together(one: StructType, other: StructType) -> StructType:
    """Columns of both schemas by name, each with a type that holds what both have for it (string where neither does)."""
    mine = {f.name.lower(): f for f in other.fields}

    def wider(f: StructField) -> StructField:
        new = mine.get(f.name.lower(), f).dataType
        return f if holds(f.dataType, new) else StructField(f.name, new if holds(new, f.dataType) else StringType(), True)

    have = {f.name.lower() for f in one.fields}
    return StructType([*map(wider, one.fields), *[f for f in other.fields if f.name.lower() not in have]])


def resolve_schema(
    spark: SparkSession,
    fmt: str,
    path: str | list[str],
    options: Mapping[str, str],
    schema_location: str,
    sampling_ratio: float | None = None,
    strict: bool = True,
    nested_strict: bool = True,
) -> tuple[StructType, StructType | None]:
    """(stored schema widened by what the files add, the files' own schema); stores a new version if it changed.

    The files' own schema has a ``_corrupt_record`` column where json inference met a malformed record.
    """
    store = SchemaStore(spark, schema_location)
    latest = store.latest()
    stored = latest[1] if latest else None
    own = infer_schema(spark, fmt, path, options, sampling_ratio, True)
    new = None if own is None else StructType([f for f in own.fields if f.name != _CORRUPT])
    merged = merge_schemas(stored, new, strict, nested_strict)
    if not merged.fields and (own is None or not own.fields):
        raise ValueError(f"ingest: cannot infer a schema for {fmt} files under {path}")
    if merged.fields and (stored is None or merged != stored):
        now = _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        store.save((latest[0] + 1) if latest else 0, merged, now)
    return merged, own


def _shaped(value: Column, own: DataType, stored: DataType) -> Column:
    """``value`` of type ``own`` as ``stored``: fields by name, scalars where they can be cast, else null."""
    if own == stored:
        return value
    if isinstance(own, StructType) and isinstance(stored, StructType):
        have = {f.name: f.dataType for f in own.fields}
        fields = [(_shaped(value[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in stored.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(own, ArrayType) and isinstance(stored, ArrayType):
        return F.transform(value, lambda e: _shaped(e, own.elementType, stored.elementType))
    if isinstance(own, (StructType, ArrayType, MapType, VariantType, NullType)) or isinstance(stored, (StructType, ArrayType, MapType, VariantType)):
        return F.lit(None).cast(stored)
    return value.try_cast(stored)


def _can_cast(spark: SparkSession, own: DataType, to: DataType) -> bool:
    try:
        return bool(spark.createDataFrame([], StructType([StructField("v", own)])).select(_shaped(F.col("v"), own, to)).schema)
    except AnalysisException:
        return False


def fitted(df: DataFrame, schema: StructType, drifted: Mapping[str, DataType], rescue_column: str, malformed: str | None = None) -> DataFrame:
    """``df`` with the columns of ``schema``; ``drifted`` columns come with types that theirs cannot hold.

    A drifted scalar is kept where its cast and back gives the same value, and else goes to ``rescue_column``, a JSON
    object of column names and values; a drifted struct, array or map keeps what fits and goes there whole. ``malformed``
    names a column with the text of records that could not be read, which goes there as it is.
    """
    columns, lost = [], []
    for f in schema.fields:
        value = F.col(f"`{f.name}`")
        own = drifted.get(f.name)
        if own is None:
            columns.append(value)
            continue
        nested = isinstance(own, (StructType, ArrayType, MapType))
        there = _can_cast(df.sparkSession, own, f.dataType)
        fits = _shaped(value, own, f.dataType) if there else F.lit(None).cast(f.dataType)
        gone = value.isNotNull()
        if not nested and there and _can_cast(df.sparkSession, f.dataType, own):
            gone &= ~_shaped(fits, f.dataType, own).eqNullSafe(value)
        columns.append((fits if nested else F.when(~gone, fits)).alias(f.name))
        lost.append(F.when(gone, value).alias(f.name))
    if not lost and malformed is None:
        return df.select(*columns)
    kept = F.lit(None).cast("string")
    if lost:
        kept = F.when(functools.reduce(lambda a, b: a | b, [x.isNotNull() for x in lost]), F.to_json(F.struct(*lost)))
    if malformed is not None:
        kept = F.coalesce(kept, F.col(f"`{malformed}`"))
    return df.select(*columns, kept.alias(rescue_column))


def read_files(
    spark: SparkSession,
    fmt: str,
    paths: list[str],
    options: Mapping[str, str],
    schema: StructType,
    own: StructType | None = None,
    rescue_column: str = RESCUE_COLUMN,
) -> DataFrame:
    """The rows of files with the columns of ``schema``.

    ``own`` is the files' own schema where it is known: columns it has with a type that ``schema`` cannot hold are read
    with it and :func:`fitted`. Csv columns are found by header name.
    """
    reader = lambda s: spark.read.format(fmt).schema(s).options(**options)
    wanted = {f.name.lower(): f for f in schema.fields}
    drifted = {wanted[f.name.lower()].name: f.dataType for f in (own.fields if own is not None else [])
               if f.name.lower() in wanted and not holds(wanted[f.name.lower()].dataType, f.dataType)}
    types = StructType([StructField(f.name, drifted.get(f.name, f.dataType), True) for f in schema.fields])
    malformed = None
    if fmt == "csv" and _flag(options, "header") == "true":
        df = None
        for files in _header_groups(spark, paths, options):
            files = [_plain_path(f) for f in files]
            names = spark.read.format(fmt).options(**{**options, "inferSchema": "false"}).load(files).columns
            at = {f.name.lower(): f for f in types.fields}
            part = reader(StructType([at.get(n.lower(), StructField(n, StringType(), True)) for n in names])).load(files)
            part = part.select(*[F.col(f"`{f.name}`") if f.name.lower() in {n.lower() for n in names}
                                 else F.lit(None).cast(f.dataType).alias(f.name) for f in types.fields])
            df = part if df is None else df.unionByName(part)
        df = spark.createDataFrame([], types) if df is None else df
    else:
        if fmt == "json" and own is not None and _CORRUPT in own.names and _flag(options, "mode") in ("", "permissive"):
            malformed = _CORRUPT
            types = StructType([*types.fields, StructField(_CORRUPT, StringType(), True)])
        if not schema.fields:  # nothing but malformed records
            return spark.read.options(**options).text(paths).select(F.col("value").alias(rescue_column)).where("trim(value) <> ''")
        df = reader(types).load(paths)
    return fitted(df, schema, drifted, rescue_column, malformed) if drifted or malformed else df


_RAW = "__record"
_MALFORMED = "__malformed"


_INTEGRAL = ("TINYINT", "SMALLINT", "INT", "BIGINT")
_NUMERIC = (*_INTEGRAL, "FLOAT", "DOUBLE", "DECIMAL")


def _typed_value(v: Column, dtype) -> Column:
    """``v`` (a variant) as ``dtype``, accepting only what the JSON reader accepts.

    Variant casts are more lenient (``true`` would become 1, ``"5"`` would parse
    as a number); values the JSON reader would not take stay null here, and so
    end up in the rescue column.
    """
    kind = F.upper(F.schema_of_variant(v))
    target = dtype.simpleString()
    present = ~F.is_variant_null(v)  # a JSON null is null in every column
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        ok = kind.isin(*_INTEGRAL) | kind.startswith("DECIMAL(") & kind.endswith(",0)")
    elif isinstance(dtype, (FloatType, DoubleType, DecimalType)):
        ok = F.coalesce(kind.isin(*_NUMERIC[:-1]), F.lit(False)) | kind.startswith("DECIMAL")
    elif isinstance(dtype, BooleanType):
        ok = kind == "BOOLEAN"
    elif isinstance(dtype, StringType):
        return F.when(present, F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))
                      .otherwise(F.to_json(v)))
    elif isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        ok = kind == "STRING"
    else:
        return F.when(present, F.try_variant_get(v, "$", target))
    return F.when(present & ok, F.try_variant_get(v, "$", target))


def typed_from_variant(df: DataFrame, raw: str, schema: StructType, rescue_column: str, malformed: str | None = None) -> DataFrame:
    """Typed columns of ``schema`` from a variant column of JSON records, plus a rescue column.

    A record holding a top-level array yields one row per element, as the JSON
    reader does. ``rescue_column`` keeps, as a JSON object, every field the schema
    does not know and every known field whose value does not cast to its type;
    it is null when nothing was rescued. ``malformed`` names a column with the text of records that are
    not JSON; such a record has only that text, in the rescue column.
    """
    row = F.col("__row")
    elems = F.coalesce(F.try_variant_get(F.col(raw), "$", "array<variant>"), F.array(F.col(raw)))
    text = F.lit(None).cast("string") if malformed is None else F.col(malformed)
    rows = df.select(F.explode(elems).alias("__row"), text.alias("__text"))
    names = [f.name for f in schema.fields if f.name != rescue_column]
    types = {f.name: f.dataType for f in schema.fields}

    def path(n: str) -> str:
        return "$['" + n.replace("\\", "\\\\").replace("'", "\\'") + "']"

    raw_of = {n: F.try_variant_get(row, path(n), "variant") for n in names}
    typed = {n: _typed_value(raw_of[n], types[n]) for n in names}
    obj = F.try_variant_get(row, "$", "map<string,variant>")
    known = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    unknown = F.map_filter(obj, lambda k, v: ~F.array_contains(known, k))
    bad = F.filter(
        F.array(*[
            F.when(raw_of[n].isNotNull() & ~F.is_variant_null(raw_of[n]) & typed[n].isNull(),
                   F.struct(F.lit(n).alias("key"), raw_of[n].alias("value")))
            for n in names
        ]),
        lambda e: e.isNotNull(),
    ) if names else None
    rescued = unknown if bad is None else F.map_concat(unknown, F.map_from_entries(bad))
    rescue = F.when(obj.isNull(), F.to_json(row)).when(F.size(rescued) > 0, F.to_json(rescued))
    return rows.select(*[typed[n].alias(n) for n in names], F.coalesce(rescue, F.col("__text")).alias(rescue_column))


def require(job: str, params: Mapping[str, Any], keys) -> None:
    """Refuse parameters that lack one of ``keys`` or leave it empty."""
    absent = sorted(k for k in keys if not params.get(k))
    if absent:
        raise ValueError(f"{job} needs a value for {', '.join(absent)}")


def _trigger(trigger_type: str | None, interval: str | None) -> dict[str, Any]:
    """Keyword for ``DataStreamWriter.trigger``; whatever is not known runs like ``availableNow``."""
    kinds = {"availableNow": {"availableNow": True}, "once": {"once": True}, "processingTime": {"processingTime": interval or "1 minute"}}
    if trigger_type and trigger_type not in kinds:
        log.warning("trigger %r is none of %s: available data is read once", trigger_type, sorted(kinds))
    return kinds.get(trigger_type or "", kinds["availableNow"])


def ingest(
    spark: SparkSession,
    input_path: str,
    input_format: str,
    table: str,
    schema_location: str,
    checkpoint_location: str,
    options: Mapping[str, Any] | None = None,
    trigger_type: str = "availableNow",
    trigger_interval: str | None = None,
    output_mode: str = "append",
    table_properties: Mapping[str, Any] | None = None,
    table_location: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    sampling_ratio: float | None = None,
    evolve: bool = True,
    rescue_column: str | None = None,
    on_drift: str | None = None,
) -> StreamingQuery:
    """Start the incremental ingest of ``input_path`` into ``table``; returns the running query.

    ``on_drift`` says what happens to values that the schema cannot hold: ``"fail"`` stops the query before their batch is
    appended (a restart tries it again), ``"rescue"`` keeps them in the rescue column and runs on. By
    default a query that runs until it is stopped (``processingTime``) rescues and the others fail.
    ``evolve=False`` keeps the stored schema as a fixed contract (inference runs only when nothing is stored
    yet). ``rescue_column`` (json only) reads each record as a variant and keeps whatever the schema cannot
    hold in that column (:func:`typed_from_variant`), fields that a fixed schema lacks included.
    ``transform`` is applied to the rows of each micro-batch.
    """
    return _start(spark, input_path, input_format, table, schema_location, checkpoint_location, options, trigger_type, trigger_interval,
                  output_mode, table_properties, table_location, transform, sampling_ratio, evolve, rescue_column, on_drift)[0]


def _start(spark, input_path, input_format, table, schema_location, checkpoint_location, options=None, trigger_type="availableNow",
           trigger_interval=None, output_mode="append", table_properties=None, table_location=None, transform=None, sampling_ratio=None,
           evolve=True, rescue_column=None, on_drift=None) -> tuple[StreamingQuery, list[Exception]]:
    """The query of :func:`ingest`, and a list that gets the error that ends it."""
    require("ingest", dict(input_path=input_path, input_format=input_format, table=table,
                   schema_location=schema_location, checkpoint_location=checkpoint_location), REQUIRED)
    fmt = input_format.lower()
    if fmt not in FORMATS:
        raise ValueError(f"ingest: unsupported input_format {input_format!r}; use one of {FORMATS}")
    if output_mode != "append":
        raise ValueError(
            f"ingest: output mode {output_mode!r} is not possible here; an ingest adds the rows of new files to a "
            "table and supports only 'append' ('complete'/'update' need an aggregation, 'overwrite' is not a stream mode)"
        )
    if on_drift not in (None, "fail", "rescue"):
        raise ValueError("ingest: on_drift must be 'fail' or 'rescue'")
    if rescue_column and fmt != "json":
        raise ValueError("ingest: rescue_column is supported for json input only")
    rescues = (on_drift or ("rescue" if trigger_type == "processingTime" else "fail")) == "rescue"
    opts = clean_options(options)
    spark_fmt = "binaryFile" if fmt == "binaryfile" else fmt
    reading = {k: v for k, v in opts.items() if k.lower() not in _STREAM_OPTIONS}
    if fmt not in FIXED_SCHEMAS and not re.search(r"[*?{\[]", input_path):
        reading.setdefault("basePath", input_path)  # partition values in directory names are columns
    properties = {str(k): str(v) for k, v in (table_properties or {}).items()}

    def rows_of(paths: list[str]) -> DataFrame:
        if fmt in FIXED_SCHEMAS:
            return spark.read.format(spark_fmt).options(**reading).load(paths)
        stored = None if evolve else SchemaStore(spark, schema_location).latest()
        if stored is not None:
            schema, own = stored[1], None
        else:
            schema, own = resolve_schema(spark, spark_fmt, paths, reading, schema_location, sampling_ratio,
                                         strict=not (rescues or rescue_column), nested_strict=not rescues)
        if rescue_column and not (rescues and own is not None and _nested_drift(schema, own)):
            raw = (spark.read.format("json").options(**reading).option("columnNameOfCorruptRecord", _MALFORMED)
                   .option("singleVariantColumn", _RAW).schema(f"{_RAW} variant, {_MALFORMED} string").load(paths))
            return typed_from_variant(raw, _RAW, schema, rescue_column, _MALFORMED)
        return read_files(spark, spark_fmt, paths, reading, schema, own, rescue_column or RESCUE_COLUMN)

    def widened(schema: StructType) -> None:
        if not spark.catalog.tableExists(table):
            create_table(spark, table, schema, base=table_location, properties=properties)
            return
        have = {c.lower() for c in spark.table(table).columns}
        extra = [f for f in schema.fields if f.name.lower() not in have]
        if extra:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({schema_ddl(StructType(extra))})")
            spark.catalog.refreshTable(table)

    if spark.catalog.tableExists(table):
        adopt_table(spark, table)
        if properties:
            props = ", ".join(f"'{_q(k)}' = '{_q(v)}'" for k, v in properties.items())
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({props})")
    elif fmt in FIXED_SCHEMAS and transform is None:
        widened(spark.createDataFrame([], FIXED_SCHEMAS[fmt]).schema)

    errors: list[Exception] = []
    stream_id = StreamId(checkpoint_location)

    def apply(batch: DataFrame, batch_id: int) -> None:
        try:
            paths = [_plain_path(r["path"]) for r in batch.collect()]  # of one micro-batch, bounded by the stream's options
            if not paths or spark.catalog.tableExists(table) and is_applied(spark, table, batch_id, stream_id(spark)):
                return
            rows = rows_of(paths)
            rows = rows if transform is None else transform(rows)
            widened(rows.schema)
            append_batch(spark, table, rows, batch_id, stream_id(spark))
        except Exception as e:
            errors.append(e)
            raise

    listing = {k: v for k, v in opts.items() if k.lower() in _LISTING_OPTIONS}
    if not {"maxfilespertrigger", "maxbytespertrigger"} & {k.lower() for k in listing}:
        listing["maxFilesPerTrigger"] = str(FILES_PER_BATCH)
    # only names are asked for, so the files are listed and not read
    found = spark.readStream.format("binaryFile").schema(FIXED_SCHEMAS["binaryfile"]).options(**listing).load(input_path).select("path")
    query = (found.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
             .trigger(**_trigger(trigger_type, trigger_interval)).start())
    return query, errors


def _nested_drift(schema: StructType, own: StructType) -> bool:
    have = {f.name.lower(): f.dataType for f in schema.fields}
    return any(isinstance(have.get(f.name.lower()), (StructType, ArrayType, MapType)) and not holds(have[f.name.lower()], f.dataType) for f in own.fields)


class StreamId:
    """The id that Spark gives a query and keeps in its checkpoint, read when the first batch runs."""

    def __init__(self, checkpoint_location: str):
        self.location, self.id = checkpoint_location.rstrip("/"), None

    def __call__(self, spark: SparkSession) -> str:
        if self.id is None:
            self.id = json.loads(spark.read.text(f"{self.location}/metadata").first()[0])["id"]
        return self.id


def run_ingest(*args, **kwargs) -> StreamingQuery:
    """:func:`ingest` and wait for it to finish (for ``availableNow`` / ``once`` triggers)."""
    q, errors = _start(*args, **kwargs)
    try:
        q.awaitTermination()
    except StreamingQueryException:
        if errors:
            raise errors[0] from None  # the batch's own error rather than the stream's report of it
        raise
    given = dict(zip(("spark", "input_path", "input_format", "table"), args, strict=False)) | kwargs
    if not given["spark"].catalog.tableExists(given["table"]):
        raise ValueError(f"ingest: cannot infer a schema: no {given['input_format']} files under {given['input_path']}")
    return q
