"""Payload helpers: explode JSON-array payloads, and split valid from invalid JSON.

:func:`payload_outcome` tells for each payload why it cannot be used, so that what is left out can be kept.

All are built-in expressions (``from_json`` + ``inline``,
``try_parse_json`` + ``is_variant_null``), evaluated row by row inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from silverline.session import scratch_path


def _array_schema(schema: str | StructType | ArrayType) -> DataType:
    if isinstance(schema, ArrayType):
        return schema
    if isinstance(schema, StructType):
        return ArrayType(schema)
    text = schema.strip()
    if text.lower().startswith("array<"):
        return text
    if text.lower().startswith("struct<"):
        return f"array<{text}>"
    return f"array<struct<{text}>>"


def explode_payload(
    df: DataFrame,
    column: str,
    schema: str | StructType | ArrayType | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """One output row per object of the JSON array in ``column``, typed by ``schema``.

    ``schema`` describes one element (``"id bigint, name string"`` or a
    ``StructType``) or the whole array. Columns in ``keep`` are carried along.
    Unparseable payloads and empty arrays produce no rows, payloads of another shape none or nulls
    (:func:`explode_with_rejects` keeps them apart). Without ``schema`` it
    is inferred first with :func:`infer_payload_schema` (one extra pass).
    """
    if schema is None:
        schema = infer_payload_schema(df, column)
    parsed = F.from_json(F.col(f"`{column}`"), _array_schema(schema))
    keep_cols = [F.col(f"`{c}`") for c in (keep or [])]
    return df.select(*keep_cols, F.inline(parsed))


UNPARSEABLE, WRONG_SHAPE, BAD_FIELD = "unparseable", "wrong shape", "bad field"


def payload_outcome(column: str | Column, schema: str | StructType | None = None) -> Column:
    """``struct<reason, detail>`` of a JSON payload; ``reason`` is null for one whose rows :func:`explode_payload` gives whole.

    ``"unparseable"``: not JSON (repeated names in an object included). ``"wrong shape"``: neither an object nor an array
    of objects, or, with a ``schema``, an object with none of its fields. ``"bad field"``: a value that its field's type
    cannot hold. A payload is judged as one: one bad element rejects it. ``detail`` names the element and field. An empty
    array is fine and has no rows; null payloads are unparseable; fields beyond the schema are allowed.
    """
    c = F.col(f"`{column}`") if isinstance(column, str) else column
    v = F.try_parse_json(c)
    kind = F.schema_of_variant(v)
    elements = F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(kind.startswith("OBJECT"), F.array(v))
    place = lambda i: F.concat(F.lit("element "), i.cast("string"))
    no_object = F.filter(F.transform(elements, lambda e, i: F.when(~F.coalesce(F.schema_of_variant(e), F.lit("")).startswith("OBJECT"), F.concat(
        place(i), F.lit(" is no object")))), lambda x: x.isNotNull())
    shape = F.when(elements.isNull(), F.lit("neither an object nor an array")).otherwise(F.get(no_object, F.lit(0)))
    field = F.lit(None).cast("string")
    if schema is not None:
        fields = _element_fields(schema)
        rows = F.from_json(c, ArrayType(fields))
        path = lambda n: "$['" + n.replace("\\", "\\\\").replace("'", "\\'") + "']"
        there = lambda e, n: F.try_variant_get(e, path(n), "variant")

        def bad(e, i):
            known = F.lit(False)
            found = F.lit(None).cast("string")
            for f in reversed(fields.fields):
                raw = there(e, f.name)
                known = known | raw.isNotNull()
                lost = raw.isNotNull() & ~F.is_variant_null(raw) & F.get(rows, i)[f.name].isNull()
                found = F.when(lost, F.concat(place(i), F.lit(f" field {f.name}"))).otherwise(found)
            return F.struct((~known).alias("foreign"), found.alias("field"), i.alias("at"))

        faults = F.transform(elements, bad)
        foreign = F.get(F.filter(faults, lambda x: x["foreign"]), F.lit(0))["at"]
        shape = F.coalesce(shape, F.when(foreign.isNotNull(), F.concat(place(foreign), F.lit(" has no field of the schema"))))
        field = F.get(F.filter(faults, lambda x: x["field"].isNotNull()), F.lit(0))["field"]
    reason = F.when(v.isNull(), UNPARSEABLE).when(shape.isNotNull(), WRONG_SHAPE).when(field.isNotNull(), BAD_FIELD)
    detail = F.when(v.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(shape, field))
    return F.struct(reason.alias("reason"), detail.alias("detail"))


def _element_fields(schema: str | StructType | ArrayType) -> StructType:
    """The fields of one element, from any form of schema that :func:`explode_payload` takes."""
    whole = _array_schema(schema)
    if isinstance(whole, str):
        whole = DataType.fromDDL(whole)
    return whole.elementType


def explode_with_rejects(
    df: DataFrame,
    column: str,
    schema: str | StructType | ArrayType,
    keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: what :func:`explode_payload` gives for usable payloads, and the others with ``reason, detail``.

    The outcome of every payload is found in one pass and written to the shared scratch folder, so both
    results see the same. ``rejects`` has the ``keep`` columns and the payload.
    """
    kept = [F.col(f"`{c}`") for c in (keep or []) if c != column]
    path = scratch_path(df.sparkSession, "payload_outcome")
    df.select(*kept, F.col(f"`{column}`"), payload_outcome(column, _element_fields(schema)).alias("__outcome")).write.parquet(path)
    judged = df.sparkSession.read.parquet(path)
    rejects = judged.where("__outcome.reason IS NOT NULL").select(*kept, F.col(f"`{column}`"), "__outcome.reason", "__outcome.detail")
    return explode_payload(judged.where("__outcome.reason IS NULL"), column, schema, keep), rejects


def infer_payload_schema(df: DataFrame, column: str, fraction: float | None = None, seed: int = 7) -> StructType:
    """Element schema of the JSON payloads in ``column``, inferred by Spark's JSON reader.

    The payload texts (optionally a ``fraction`` sample) are written as text files
    under the shared scratch folder and read back with schema inference, which
    turns a top-level array into one record per element. The work is distributed;
    nothing is collected.
    """
    texts = df.select(F.col(f"`{column}`").alias("value")).where(F.col("value").isNotNull())
    if fraction is not None:
        texts = texts.sample(fraction=fraction, seed=seed)
    one_line = F.replace(F.replace(F.col("value"), F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    path = scratch_path(df.sparkSession, "payload_schema")
    texts.select(one_line.alias("value")).write.text(path)
    schema = df.sparkSession.read.json(path).schema
    return StructType([f for f in schema.fields if f.name != "_corrupt_record"])


def json_validity(column: str | Column) -> Column:
    """True when the text is a JSON value other than ``null``; false for malformed, empty or null."""
    c = F.col(column) if isinstance(column, str) else column
    v = F.try_parse_json(c)
    return F.coalesce(v.isNotNull() & ~F.is_variant_null(v), F.lit(False))


def split_valid_json(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` rows by :func:`json_validity` of ``column``.

    Both halves come from one lazy plan; cache or checkpoint ``df`` first if both
    are written and the source is expensive.
    """
    flag = json_validity(column)
    return df.filter(flag), df.filter(~flag)
