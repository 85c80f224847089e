"""MERGE with a plan chosen by the measured size of the source and the keys of the target.

:func:`merge_by_size` is for jobs that write the result (table jobs, micro-batches). It materialises the
source once, so its size is known, and then

* merges by the narrow plan when the source fits the broadcast limit: the target is never shuffled;
* else splits the target by its keys. Rows that a bitmap of the source's key hashes rules out match
  nothing and go straight to the result, without a shuffle. Keys that a sketch of the target finds to be hot
  are merged by the narrow plan with their own few source rows, so their target rows stay where they
  are. Only what is left meets the source in one full outer join.

A key is in exactly one of these parts on both sides, so the union of the merged parts is the merge.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.operators.dedup import keep_rows
from silverline.operators.merge import MergeSpec, fits_broadcast, merge
from silverline.session import scratch_path

# The key bitmap: 16 bits a source row, 32 MB at most, and none where over half of all target rows would pass it by chance.
BITS_PER_ROW = 16
MAX_BITS = 1 << 28
LEAST_BITS = 1 << 20
# A key is hot when it has this many times the rows of an average shuffle partition; a sketch reports HOT_KEYS at most.
HOT_FACTOR = 2
HOT_KEYS = 200
SKETCH_ITEMS = 10_000
HOT_ROWS = 10_000


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "merge", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def hashes_agree(target: DataFrame, source: DataFrame, keys: list[str]) -> bool:
    """Whether equal keys have equal hashes: same type on both sides, and equality that is equality of values."""
    t, s = dict(target.dtypes), dict(source.dtypes)
    return all(t[k] == s[k] and not any(x in t[k] for x in ("collate", "variant", "map<")) for k in keys)


def key_bitmap(source: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """``bucket, bitmap``: one bit for each hash of the source's keys modulo ``bits``; at most bits / 32768 rows of 4 KB."""
    place = F.pmod(_hash(keys), F.lit(bits))
    return source.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))


def flag_possible(target: DataFrame, bitmap: DataFrame, keys: list[str], bits: int, flag: str) -> DataFrame:
    """``target`` with a boolean ``flag``: false where no source row can have its key. The bitmap is broadcast (see its bound)."""
    place = F.pmod(_hash(keys), F.lit(bits))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("__bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("getbit", byte, (at % 8).cast("int")) == 1
    named = bitmap.select(F.col("bucket").alias("__bucket"), F.col("bitmap").alias("__bitmap"))
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(f"`{k}`").isNull()
    joined = target.join(F.broadcast(named), F.bitmap_bucket_number(place) == F.col("__bucket"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in target.columns], (~some_null & F.coalesce(bit, F.lit(False))).alias(flag))


def hot_hashes(target: DataFrame, keys: list[str], least: int = HOT_ROWS) -> list[int]:
    """Hashes of the keys that would make one shuffle partition far larger than the others (``HOT_KEYS`` at most).

    One pass over the key columns with a mergeable sketch; only its few counters reach the driver.
    """
    known = target.dropna(subset=keys, how="any").select(_hash(keys).alias("h"))
    row = known.agg(F.call_function("approx_top_k", F.col("h"), F.lit(HOT_KEYS), F.lit(SKETCH_ITEMS)).alias("top"), F.count("*").alias("n")).first()
    parts = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [x["item"] for x in row["top"] or [] if x["count"] >= max(least, HOT_FACTOR * row["n"] / parts)]


def merge_by_size(target: DataFrame, source: DataFrame, spec: MergeSpec, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The result of :func:`silverline.operators.merge.merge`, planned by measured sizes (module text).

    Runs jobs: it writes the source (after ``dedupe_source``) to the shared scratch folder, and for a source over the
    broadcast limit its key bitmap, and sketches the target's keys. A plan that the spec names is kept.
    """
    spec.validate()
    if target.isStreaming or source.isStreaming:
        raise ValueError("merge needs batch DataFrames; for a stream use merge_stream (one merge per micro-batch)")
    if spec.dedupe_source:
        source = keep_rows(source, spec.keys, spec.dedupe_source, keep="last", tiebreak=True)
        # the rows are unique by key now, so the guard has nothing to find
        spec = dataclasses.replace(spec, dedupe_source=None, check_cardinality=False)
    source = _written(source, "source")
    if spec.plan != "auto":
        return merge(target, source, spec)
    if fits_broadcast(source):
        return merge(target, source, dataclasses.replace(spec, plan="narrow"))
    wide = dataclasses.replace(spec, plan="full_outer")
    if not hashes_agree(target, source, spec.keys):
        return merge(target, source, wide)

    parts = []
    hot = hot_hashes(target, spec.keys, hot_rows)
    if hot:
        is_hot = F.coalesce(_hash(spec.keys).isin(hot), F.lit(False))
        mine = _written(source.where(is_hot), "hot-source")
        parts.append(merge(target.where(is_hot), mine, dataclasses.replace(spec, plan="narrow")))
        target, source = target.where(~is_hot), source.where(~is_hot)
    rows = source.count()
    bits = min(MAX_BITS, max(LEAST_BITS, 1 << (rows * BITS_PER_ROW - 1).bit_length()))
    if 1 - math.exp(-rows / bits) < 0.5:
        bitmap = _written(key_bitmap(source.dropna(subset=spec.keys, how="any"), spec.keys, bits), "key-bitmap")
        flagged = flag_possible(target, bitmap, spec.keys, bits, "__possible")
        # nothing matches these rows: only the clauses for rows that the source lacks apply
        parts.append(merge(flagged.where("NOT __possible").drop("__possible"), source.limit(0), dataclasses.replace(spec, plan="narrow")))
        target = flagged.where("__possible").drop("__possible")
    parts.append(merge(target, source, wide))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
