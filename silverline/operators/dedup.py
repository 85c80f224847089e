"""Duplicate removal for batch and streaming DataFrames.

Skew notes (a single key may hold a third of all rows):

* ``drop_duplicates`` plans as an aggregate with a partial (map-side) step, so a
  hot key is reduced to one row per input partition before the shuffle.
* ``keep_rows(keep="first"|"last")`` is ``row_number() = 1``; Spark inserts a
  partial ``WindowGroupLimit`` before the exchange, again one row per key and
  input partition leaves the map side.
* ``keep_rows(keep=False)`` counts per key with a partial aggregate instead of a
  window, so no task ever holds a whole key group.
* ``flag_latest`` keeps every row, so it cannot pre-reduce; it aggregates the
  per-key maximum (map-side combined) and joins it back. The join's streamed
  side is the full table, which AQE's skew handling may split.

When a key column is a string or binary (long texts, say), grouping and window
partitioning use ``(xxhash64(keys), keys)``: sorts then compare an 8-byte hash
first and the text only on hash ties. The result is unchanged, since the keys
themselves stay in the grouping.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType,
)

log = logging.getLogger(__name__)

_MODES = ("exact", "within_watermark")


def _check_keys(df: DataFrame, keys: Sequence[str], what: str = "keys") -> list[str]:
    if isinstance(keys, str) or not keys or not all(isinstance(k, str) and k for k in keys):
        raise ValueError(f"{what} must be a non-empty list of column names")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"{what} not in frame: {missing}")
    return list(keys)


def _group_cols(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Grouping columns for ``keys``, led by their hash when a key is a string or binary.

    The hash sees bytes, so it leads only where equal keys have equal bytes: a collated string
    (``UTF8_LCASE`` and the like) is grouped by its own rules. Its name is one that ``df`` does not have.
    """
    cols = [F.col(f"`{k}`") for k in keys]
    types = [df.schema[k].dataType for k in keys]
    if not any(isinstance(t, (StringType, BinaryType)) for t in types) or any(_collated(t) for t in types):
        return cols
    return [F.xxhash64(*cols).alias(_fresh(df, "__kh")), *cols]


def _fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _collated(kind) -> bool:
    """Whether the type holds a string with a collation other than binary."""
    return "COLLATE" in kind.simpleString().upper()


def _order_cols(order_by: str | Column | Sequence[str | Column]) -> list[Column]:
    if order_by is None:
        raise ValueError("order_by is required: rows have no order of their own")
    items = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    if not items:
        raise ValueError("order_by is required: rows have no order of their own")
    return [F.col(o) if isinstance(o, str) else o for o in items]


def drop_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    watermark_column: str | None = None,
    watermark_delay: str | None = None,
    mode: str = "exact",
) -> DataFrame:
    """One arbitrary survivor per key; nulls compare equal.

    On a stream, a watermark is applied only when both ``watermark_column`` and
    ``watermark_delay`` are given. ``mode="exact"`` is plain ``dropDuplicates``:
    its state is evicted only if the event-time column is one of the keys.
    ``mode="within_watermark"`` uses ``dropDuplicatesWithinWatermark``, whose
    state is always evicted but which only dedups within the delay.
    """
    keys = _check_keys(df, keys, "deduplication keys")
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {_MODES}")
    has_wm = bool(watermark_column) and bool(watermark_delay)
    if has_wm:
        if watermark_column not in df.columns:
            raise ValueError(f"watermark column {watermark_column!r} not in frame")
        df = df.withWatermark(watermark_column, watermark_delay)
    if mode == "within_watermark":
        if not has_wm:
            raise ValueError("mode='within_watermark' needs a watermark column and delay")
        return df.dropDuplicatesWithinWatermark(keys)
    if df.isStreaming:
        if not has_wm:
            log.warning("streaming dropDuplicates without a watermark keeps all keys in state forever")
        elif watermark_column not in keys:
            log.warning(
                "watermark column %r is not a key: dedup state is never evicted; "
                "consider mode='within_watermark'", watermark_column
            )
    if df.isStreaming:
        return df.dropDuplicates(keys)
    group = _group_cols(df, keys)
    if len(group) == len(keys):
        return df.dropDuplicates(keys)
    others = [c for c in df.columns if c not in keys]
    values = [F.first(F.col(f"`{c}`")).alias(c) for c in others] or [F.count(F.lit(1)).alias(_fresh(df, "__n"))]
    agg = df.groupBy(*group).agg(*values)
    return agg.select([F.col(f"`{c}`") for c in df.columns])


def keep_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Column | Sequence[str | Column] | None = None,
    keep: str | bool = "first",
    tiebreak: bool = False,
) -> DataFrame:
    """Per key keep the first row, the last row (by ``order_by``), or none of a duplicated key.

    ``order_by`` should make rows unique within a key, otherwise the survivor among
    ties is arbitrary; ``tiebreak=True`` appends the remaining columns of atomic
    type to the order so the choice is deterministic. ``keep=False`` drops every
    row of a key that occurs twice or more and needs no order.
    """
    keys = _check_keys(df, keys)
    if df.isStreaming:
        raise ValueError("keep_rows needs a batch DataFrame; on a stream use drop_duplicates with a "
                         "watermark, or merge_stream with dedupe_source per micro-batch")
    cols = df.columns
    if keep is False:
        others = [c for c in cols if c not in keys]
        n = _fresh(df, "__n")
        agg = df.groupBy(*_group_cols(df, keys)).agg(
            F.count(F.lit(1)).alias(n),
            *[F.first(F.col(f"`{c}`")).alias(c) for c in others],
        )
        return agg.filter(F.col(n) == 1).select([F.col(f"`{c}`") for c in cols])
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first', 'last' or False")
    order = _order_cols(order_by)
    if tiebreak:
        named = {o for o in ([order_by] if isinstance(order_by, str) else list(order_by)) if isinstance(o, str)}
        atomic = (NumericType, StringType, BooleanType, DateType, TimestampType, TimestampNTZType, BinaryType)
        order += [F.col(f"`{f.name}`") for f in df.schema.fields
                  if f.name not in keys and f.name not in named and isinstance(f.dataType, atomic)]
    if keep == "last":
        order = [o.desc_nulls_last() for o in order]
    else:
        order = [o.asc_nulls_first() for o in order]
    w = Window.partitionBy(*_group_cols(df, keys)).orderBy(*order)
    rn = _fresh(df, "__rn")
    return (
        df.withColumn(rn, F.row_number().over(w))
        .filter(F.col(rn) == 1)
        .select([F.col(f"`{c}`") for c in cols])
    )


def flag_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    flag_column: str = "is_latest_record",
) -> DataFrame:
    """Add a boolean ``flag_column``: true on the row with the greatest ``order_by`` per key.

    Rows tied on the greatest ``order_by`` are all flagged; include a unique
    column in ``order_by`` to flag exactly one. Null keys form one group each
    (nulls compare equal), like ``row_number() OVER (PARTITION BY keys)``.
    """
    keys = _check_keys(df, keys)
    if df.isStreaming:
        raise ValueError("flag_latest needs a batch DataFrame")
    if isinstance(order_by, str):
        order_by = [order_by]
    order_by = _check_keys(df, order_by, "order_by")
    if flag_column in df.columns:
        raise ValueError(f"flag column {flag_column!r} already exists")
    okey = F.struct(*[F.col(f"`{c}`") for c in order_by])
    group = _group_cols(df, keys)
    hashed = len(group) > len(keys)
    latest = df.groupBy(*([group[0]] if hashed else []),
                        *[F.col(f"`{k}`").alias(_fresh(df, f"__k{i}")) for i, k in enumerate(keys)]).agg(
        F.max(okey).alias(_fresh(df, "__max"))
    )
    cond = [df[f"`{k}`"].eqNullSafe(latest[_fresh(df, f"__k{i}")]) for i, k in enumerate(keys)]
    if hashed:  # hash first, so the join sorts compare it before the texts
        cond = [F.xxhash64(*[df[f"`{k}`"] for k in keys]) == latest[_fresh(df, "__kh")], *cond]
    joined = df.join(latest, cond, "left_outer")
    flag = F.coalesce(okey == F.col(_fresh(df, "__max")), F.lit(False))
    return joined.select(*[df[f"`{c}`"] for c in df.columns], flag.alias(flag_column))
