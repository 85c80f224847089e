"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

Two words that differ by one inserted, deleted or replaced character have letter counts at a squared
distance of 1 or 2, and lie in the same or adjacent length blocks. The squared distances of a block of
words come from one NumPy product of its letter counts (a Gram matrix); pairs at most two apart are
then verified by their common beginning and end.

A length block is cut further, without losing a pair: the shorter word is seen as ``PARTS`` parts, and one
edit leaves all but one of them, so both words meet in the sub-block named by the parts that are left.
A sub-block with more members than fit one task is dealt into tiles that meet pairwise.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import checkpointed, materialise

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
EVERY = 31
PARTS = 3
TILE = 4096
ROWS = 256
FLUSH = 400_000
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]

_LETTER = np.full(256, len(LETTERS), dtype=np.int64)
_LETTER[LETTERS] = np.arange(len(LETTERS))
# letters of a Latin-1 text, A-Z lower-cased; all else becomes a space
_RUNS = bytes(b + 32 if 65 <= b <= 90 else b if _LETTER[b] < len(LETTERS) else 32 for b in range(256))
_OTHER = re.compile(r"[^\x00-\xff]")


# -- words -------------------------------------------------------------------------


def document_words(doc_id: str, text: str, least: int = LEAST_LENGTH, every: int = EVERY) -> Counter:
    """The words of one text as Latin-1 bytes with their counts (a run may lose one character by its hash)."""
    plain = text if text.isascii() else _OTHER.sub(" ", text)
    runs = Counter(r for r in plain.encode("latin-1").translate(_RUNS).split() if len(r) >= least)
    seed = zlib.crc32(f"{doc_id}:".encode())
    found: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        found[run] += n
    return found


def word_counts(docs: DataFrame, least: int = LEAST_LENGTH, every: int = EVERY) -> DataFrame:
    """``word, n`` over all documents. A null id is spelled ``null``, a null text has no words.

    Tasks add up their own words before the shuffle and pass them on whenever ``FLUSH`` are held.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("doc_id"), F.col("text").cast("string").alias("text"))

    def out(found: Counter):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in found], pa.string()),
                                           pa.array(found.values(), pa.int64())], ["word", "n"])

    def run(batches):
        found: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in document_words(doc_id, text or "", least, every).items():
                    found[word] += n
                if len(found) >= FLUSH:
                    yield out(found)
                    found = Counter()
        yield out(found)

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# -- pairs -------------------------------------------------------------------------


def _cuts(length, parts: int):
    """Where the parts of a word of this length end."""
    return [length * (k + 1) // parts for k in range(parts)]


def sub_blocks(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``length, part, key, word, n``: each word under its own length and as the longer word of the length below.

    The key hashes the word without part ``part`` of the shorter word: its beginning, and its end counted
    from the end. Equal keys of different words only add candidates.
    """
    size = F.length("word")
    places = []
    for longer in (0, 1):
        length = size - longer
        for part in range(parts):
            start, stop = F.floor(length * part / parts), F.floor(length * (part + 1) / parts)
            keep = length - stop
            end = F.when(keep > 0, F.substring("word", size - keep + 1, keep)).otherwise(F.lit(""))
            key = F.xxhash64(F.substring("word", F.lit(1), start), F.lit("\n"), end)
            places.append(F.struct(length.cast("int").alias("length"), F.lit(part).alias("part"), key.alias("key")))
    return (words.select("word", "n", F.explode(F.array(*places)).alias("place"))
            .select("place.length", "place.part", "place.key", "word", "n"))


def tiled(blocks: DataFrame, tile: int = TILE) -> DataFrame:
    """Rows of sub-blocks with a ``tile`` each: (0, 0) for those that fit one, else every pair of their dealt tiles.

    Sub-blocks of one word hold no pair and go. A word of a large sub-block comes once for each tile
    pair it is in, so every two of its words meet in at least one task; ``own`` is its own tile.
    """
    sizes = blocks.groupBy("length", "part", "key").agg(F.count("*").alias("members")).where("members > 1")
    joined = blocks.join(sizes, ["length", "part", "key"])
    tiles = F.ceil(F.col("members") / tile).cast("int")
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    return (joined.withColumn("tiles", tiles).withColumn("own", own).withColumn("other", other)
            .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("members", "other"))


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of words, of the words reversed (both padded by zeros), and lengths."""
    coded = [w.encode("latin-1") for w in words]
    lengths = np.array(list(map(len, coded)), dtype=np.int64)
    width = int(lengths.max()) + 1
    ahead = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in coded), np.uint8).reshape(-1, width)
    back = np.frombuffer(b"".join(c[::-1].ljust(width, b"\0") for c in coded), np.uint8).reshape(-1, width)
    return ahead, back, lengths


def letter_counts(ahead: np.ndarray) -> np.ndarray:
    """Letter counts of padded words; whole numbers that a product of this type holds exactly."""
    n, width = ahead.shape
    at = np.arange(n)[:, None] * (len(LETTERS) + 1) + _LETTER[ahead]
    counts = np.bincount(at.ravel(), minlength=n * (len(LETTERS) + 1)).reshape(n, -1)[:, :-1]
    return counts.astype(np.float32 if width < 2000 else np.float64)


def gram_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and ``b`` from their product."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading characters rows have in common (the zero after the shorter word differs or ends them)."""
    differ = (a != b) | (a == 0)
    return differ.argmax(1)


class _Block:
    def __init__(self, rows: list[tuple]):
        self.rows = rows
        words = [r[-2] for r in rows]
        self.ahead, self.back, self.lengths = _matrix(words)
        self.counts = letter_counts(self.ahead)
        self.group = [r[:-3] for r in rows]
        self.base = np.array([r[0] for r in rows])
        self.part = np.array([r[1] for r in rows])


def _widened(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def near_rows(a: _Block, b: _Block, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (of ``a``, of ``b``; within one block the first before the second) that are one edit apart.

    A pair meets in the sub-block of each part its edit may lie in, and is reported in the first only.
    """
    gid = {g: k for k, g in enumerate(dict.fromkeys(a.group + b.group))}
    ga, gb = np.array([gid[g] for g in a.group]), np.array([gid[g] for g in b.group])
    close = (gram_distances(a.counts, b.counts) < 2.5) & (ga[:, None] == gb[None, :])
    if a is b:
        close &= np.tri(len(ga), k=-1, dtype=bool).T
    i, j = np.nonzero(close)
    la, lb = a.lengths[i], b.lengths[j]
    short = np.minimum(la, lb)
    width = max(a.ahead.shape[1], b.ahead.shape[1])
    begin = np.empty(len(i), dtype=np.int64)
    end = np.empty(len(i), dtype=np.int64)
    xa, xb, ya, yb = (_widened(x, width) for x in (a.ahead, b.ahead, a.back, b.back))
    step = max(1, (1 << 22) // width)
    for at in range(0, len(i), step):
        p, q = i[at:at + step], j[at:at + step]
        begin[at:at + step], end[at:at + step] = _common(xa[p], xb[q]), _common(ya[p], yb[q])
    same = la == lb
    near = np.where(same, begin + end == la - 1, (np.abs(la - lb) == 1) & (begin + end >= short))
    # the part of the shorter word that the edit lies in; both must be here under the shorter word's length
    base, part = a.base[i], a.part[i]
    place = np.minimum(begin, short)
    first = np.zeros(len(i), dtype=np.int64)
    for k in range(parts - 1):
        cut = short * (k + 1) // parts
        first += np.where(same, place >= cut, place > cut)
    keep = near & (base == short) & (first == part)
    return i[keep], j[keep]


def near_words(words: DataFrame, parts: int = PARTS, tile: int = TILE, rows: int = ROWS) -> DataFrame:
    """``word, near, near_n`` for every ordered pair of words (``word, n``, distinct) one edit apart.

    Rows are sorted by sub-block and taken in blocks of ``rows``; a block is compared with itself and with
    the blocks before it that share its first sub-block, never with more. No pair is left out.
    """
    names = ["length", "part", "key", "low", "high", "own", "word", "n"]
    dealt = (tiled(sub_blocks(words, parts), tile).select(*names)
             .repartition("length", "part", "key", "low", "high").sortWithinPartitions(*names[:5], "own", "word"))

    def meet(blocks: list[_Block], new: _Block):
        for old in [*blocks, new]:
            i, j = near_rows(old, new, parts)
            for p, q in zip(i.tolist(), j.tolist(), strict=True):
                x, y = old.rows[p], new.rows[q]
                # two words of one tile meet in each of its tile pairs: they count in the pair with itself
                if x[5] != y[5] or x[3] == x[4]:
                    yield x[6], y[6], y[7]
                    yield y[6], x[6], x[7]

    def out(pairs):
        a, b, n = zip(*pairs, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], ["word", "near", "near_n"])

    def run(batches):
        held: list[_Block] = []
        waiting: list[tuple] = []
        pairs: list[tuple] = []

        def take(n: int):
            nonlocal held, waiting
            new, waiting = _Block(waiting[:n]), waiting[n:]
            held = [b for b in held if b.rows[-1][:5] == new.rows[0][:5]]
            pairs.extend(meet(held, new))
            held = [b for b in [*held, new] if b.rows[-1][:5] == new.rows[-1][:5]]

        for batch in batches:
            waiting += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(waiting) >= rows:
                # blocks of long words are smaller, so that their padded characters stay bounded
                take(max(1, min(rows, (1 << 22) // (len(waiting[rows - 1][6]) + 1))))
                if len(pairs) >= 50_000:
                    yield out(pairs)
                    pairs.clear()
        while waiting:
            take(max(1, min(rows, len(waiting), (1 << 22) // (len(waiting[-1][6]) + 1))))
        if pairs:
            yield out(pairs)

    return dealt.mapInArrow(run, "word string, near string, near_n long")


# -- forms -------------------------------------------------------------------------


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n``: a word's form is its commonest near word (ties: the least), if common enough."""
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    fits = -F.col("best.n") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.n")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """``word, root`` for the words with a form: the last word that forms lead to.

    Each form is at least ``ratio`` times as common, so chains are short (no more steps than digits in the
    largest count) and end; every round doubles the steps taken, and only words whose target
    still has a form go on.
    """
    step = checkpointed(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = checkpointed(step.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        step = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return step


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO,
             every: int = EVERY) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word found at least ``least_count`` times in ``docs``.

    Words are maximal runs of ``A-Za-z`` and U+00C0 to U+00FF with A-Z lower-cased, of at least
    ``least_length`` characters; in a document whose hash with the run is a multiple of ``every`` a run loses one
    character. Null and empty texts have no words, repeated rows count again, further columns take no
    part, and an empty table gives no rows. Words of any length take part.
    """
    words = materialise(word_counts(docs, least_length, every).where(F.col("n") >= least_count), "words")
    formed = materialise(forms(words, near_words(words), ratio), "forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
