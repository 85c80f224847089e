"""SimHash near-duplicate groups with pigeonring filtering.

Fingerprints within ``DISTANCE`` bits link, and a group is a connected component. The 64 bits lie
as five segments on a ring. Any linked pair has a segment from which every chain of l consecutive
segments differs in at most l * 4 / 5 bits: 0, 1, 2, 3, 4. Candidates share the whole start
segment and one half of the next (a chain of two with at most one difference must), longer chains
are tested on candidates, and only what passes them all gets the full Hamming check. The filter
loses no link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from silverline.llm.common import ROW, checkpointed, materialise

SHINGLE = 4
DISTANCE = 4
SEED = 42
# Ring segments as (first bit, width) and each segment's two halves.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
HALVES = tuple(((at, width // 2), (at + width // 2, width - width // 2)) for at, width in SEGMENTS)
BLOCK = 2000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's shingles (no words: zero)."""
    return _fingerprint((text or "").encode("utf-8", "surrogatepass"))


def _fingerprint(data: bytes) -> int:
    found = data.translate(_LOWER).split()
    n = len(found)
    if not n:
        return 0
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if n < SHINGLE:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    votes, total = np.zeros(64, np.int64), n - SHINGLE + 1
    for at in range(0, total, 65536):  # bounded memory for very long texts
        last = min(total, at + 65536)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(
            starts[at:last].tolist(), ends[at + SHINGLE - 1:last + SHINGLE - 1].tolist(), strict=True)], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > total, bitorder="little").tobytes(), "little")


def _fingerprints(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        values = np.array([_fingerprint(t.as_py() or b"") for t in texts], dtype=np.uint64)
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(values.view(np.int64))], names=[*rest, "fp"])


def with_fingerprint(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``fp`` (the fingerprint as a signed long)."""
    schema = docs.select(*keep).schema.add("fp", "long")
    return docs.select(*keep, "text").mapInArrow(_fingerprints, schema)


def _bits(fp: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1))


def bucket_keys(fp: Column) -> Column:
    """Ten keys: start segment and half of the next one."""
    keys = []
    for i, (at, width) in enumerate(SEGMENTS):
        for h, (half_at, half_width) in enumerate(HALVES[(i + 1) % len(SEGMENTS)]):
            value = F.shiftleft(_bits(fp, at, width), 8).bitwiseOR(_bits(fp, half_at, half_width))
            keys.append(value.bitwiseOR(F.lit((2 * i + h) << 32)))
    return F.array(*keys)


def _chain_masks(start: int) -> list[int]:
    masks, whole = [], 0
    for k in range(len(SEGMENTS)):
        at, width = SEGMENTS[(start + k) % len(SEGMENTS)]
        whole |= ((1 << width) - 1) << at
        masks.append(whole)
    return masks


BUDGETS = [(k + 1) * DISTANCE // len(SEGMENTS) for k in range(len(SEGMENTS))]
CHAINS = [_chain_masks(i) for i in range(len(SEGMENTS))]


def links(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Edges (member, a group's first member) that span the links viable from segment ``start``."""
    masks = [np.uint64(m) for m in CHAINS[start]]
    left, out = fps, []
    while len(left) > 1:
        root, frontier, left = left[0], [left[0]], left[1:]
        while frontier and len(left):
            differ = left ^ frontier.pop()
            near = np.ones(len(left), bool)
            for mask, budget in zip(masks, BUDGETS, strict=True):  # the last chain is the full Hamming check
                near[near] = np.bitwise_count(differ[near] & mask) <= budget
                if not near.any():
                    break
            if near.any():
                found = left[near]
                out += [(int(x), int(root)) for x in found.view(np.int64)]
                frontier += list(found)
                left = left[~near]
    return [(a, int(np.uint64(b).view(np.int64))) for a, b in out]


def _bucket_links(schema):
    """Edges of buckets; a member is a fingerprint with its label, and edges carry both."""
    kind = schema.field("members").type.value_type

    def run(batches):
        for batch in batches:
            a, b = [], []
            members = batch.column("members")
            flat, ends = members.flatten(), np.cumsum(np.r_[0, members.value_lengths().to_numpy(zero_copy_only=False)])
            fps = flat.field("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i, start in enumerate(batch.column("start").to_pylist()):
                own = fps[ends[i]:ends[i + 1]]
                place = {int(x): int(ends[i]) + k for k, x in enumerate(own.view(np.int64))}
                for x, y in links(own, start):
                    a.append(place[x])
                    b.append(place[y])
            yield pa.RecordBatch.from_arrays([flat.take(pa.array(x, pa.int64())).cast(kind) for x in (a, b)], names=["a", "b"])

    return run


def labelled_links(labelled: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges ``a, b`` between rows ``label, fp`` of distinct fingerprints, each as a struct of both.

    Their components are those of all links. A bucket of more than ``block`` members is dealt into blocks that meet
    pairwise, so no task holds more than ``2 * block`` of them and no pair of members is missed; a bucket
    gives fewer edges than members.
    """
    node = F.struct("label", "fp")
    keyed = labelled.select("fp", node.alias("node"), F.explode(bucket_keys(F.col("fp"))).alias("key"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = (keyed.join(counts, "key").withColumn("blocks", blocks).withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("key", "node", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")))
    grouped = met.groupBy("key", "x", "y").agg(F.collect_list("node").alias("members")).where("size(members) > 1")
    rows = grouped.select(F.shiftright("key", 33).cast("int").alias("start"), "members")
    kind = rows.schema["members"].dataType.elementType
    out = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return rows.mapInArrow(_bucket_links(to_arrow_schema(rows.schema)), out)


def fingerprint_links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints ``fp`` whose components are those of all links."""
    found = labelled_links(fps.select(F.lit(0).alias("label"), "fp"), block)
    return found.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``: root is the component's least node.

    Large-star and small-star rounds on distributed edges, each written to the checkpoint folder;
    only a count and a checksum of the edges reach the driver.
    """
    now = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    seen = mark(now)
    while seen[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        now = checkpointed(small.distinct())
        if (found := mark(now)) == seen:
            break
        seen = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def grouped_fingerprints(marked: DataFrame, ids: str) -> DataFrame:
    """``fp, root, first`` per distinct fingerprint: its component's least ``ids`` (nulls only if there is no other).

    Nodes are ordered by their least id, so a component's least node carries its least id and no
    group is gathered to find it, however large.
    """
    fps = checkpointed(marked.groupBy("fp").agg(F.min(ids).alias("first")))
    labelled = fps.select(F.struct(F.col("first").isNull().alias("none"), F.col("first").alias("first")).alias("label"), "fp")
    linked = checkpointed(components(labelled_links(labelled)))
    rooted = fps.join(linked.select(F.col("node.fp").alias("fp"), F.col("root.fp").alias("r"), F.col("root.label.first").alias("least")), "fp", "left")
    return checkpointed(rooted.select("fp", F.coalesce("r", "fp").alias("root"), F.when(F.col("r").isNull(), F.col("first")).otherwise(F.col("least")).alias("first")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Null and empty texts have fingerprint zero and link like any other. Equal rows fall in one
    group. ``component_id`` is the least non-null ``doc_id`` of the group (null if it has none). An
    empty table gives no rows; further columns take no part.
    """
    marked = materialise(with_fingerprint(docs.select("doc_id", "text"), ["doc_id"]), "simhash")
    groups = grouped_fingerprints(marked, "doc_id").select(F.col("fp").alias("f"), F.col("first").alias("component_id"))
    return marked.join(groups, F.col("fp") == F.col("f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group: the least ``doc_id`` (nulls last), of equal ids one row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), "text", "doc_id")
    marked = with_fingerprint(rows, [ROW, "doc_id"])
    marked = materialise(marked.withColumn("at", F.monotonically_increasing_id()), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("at").alias("at"))
    keys = marked.select("fp", order.alias("pick"))
    groups = grouped_fingerprints(keys, "pick")
    chosen = groups.groupBy("root").agg(F.min("first").alias("pick")).select("pick.at")
    return marked.join(chosen, "at", "left_semi").select(f"{ROW}.*")
