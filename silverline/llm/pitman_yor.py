"""A hierarchical Pitman-Yor language model over word pairs, learned and applied in packed blocks.

Restaurants: one for each context, which is the word before or the start of a text, all sharing one parent, the
word restaurant, whose base is uniform over the training words and one unknown. There are as many
contexts as the training texts have words. The seating is sampled by Gibbs: a sweep draws the number of tables
that serve a word in a restaurant given all other seats, by generalised Stirling numbers up to ``EXACT[-1]`` customers
of a word in one restaurant, and for the customers beyond by seating them in runs of an eighth of those
seated. A word's probability is the mean of its predictive probability over the sampled seatings.

Cells (context, word, customers) are added up in every block of documents and dealt to buckets by their
context, so a restaurant is sampled in one task. Words with more than ``1 / HOT`` of the tokens (``HOT`` at most) are
contexts that are dealt over several buckets by the next word; what the other buckets hold of them
comes from the first seating. The documents are packed twice. First the buckets seat their customers, and every word's
tables over all buckets meet in the word restaurant, which is dealt by word. Then its probabilities go
back to the buckets, which sample their restaurants against them, score all tokens of their contexts and return
sums by document. No task holds all tokens of a word.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import checkpointed, materialise

HOT = 4096
BUCKETS = 32
BUCKET_TOKENS = 1 << 21
FOLDS, HELD_OUT = 7, 2
BLOCK_DOCS, BLOCK_TOKENS = 1 << 16, 1 << 20
CACHED_WORDS = 400_000
DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.7, 1.0
FIRST_SWEEPS, BURN_IN, SAMPLES = 3, 3, 4
EXACT = (20, 200, 2000)
# Weights drawn from at a time.
MATRIX = 1 << 19
HASH_BITS = 56
END, START = b"", b" "
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words and the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(), END]


def is_held_out(doc_id) -> bool:
    """By the fold of the id's text (a null id counts as an empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


# -- frequent words ----------------------------------------------------------------


def _frequent(batches):
    counts, total = Counter(), 0
    for batch in batches:
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            if not is_held_out(i):
                found = tokens(text.as_py())
                counts.update(found)
                total += len(found)
    often = [(w, n) for w, n in counts.items() if n * 4 * HOT >= total]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in often] + [None], pa.binary()), pa.array([n for _, n in often] + [total], pa.int64())], names=["word", "n"])


def frequent_words(docs: DataFrame) -> tuple[list[tuple[bytes, int]], int]:
    """The words with at least ``1 / HOT`` of the training tokens (``HOT`` at most) with their counts, and the number of these tokens.

    A task reports the words that reach a quarter of that share within it, at most ``4 * HOT``.
    """
    counted = checkpointed(docs.select("doc_id", "text").mapInArrow(_frequent, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    row = counted.where("word IS NULL").first()
    total = row["n"] if row else 0
    often = counted.where(F.col("word").isNotNull() & (F.col("n") * HOT >= total)).collect()
    return [(bytes(r["word"]), r["n"]) for r in sorted(often, key=lambda r: (-r["n"], bytes(r["word"])))], total


# -- packing -----------------------------------------------------------------------


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> (64 - HASH_BITS)


class _Words(dict):
    """Word -> index, and the words' hashes."""

    def __init__(self):
        super().__init__()
        self.hashes = array("Q")

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self.hashes)
        self.hashes.append(word_hash(word))
        return k


_KNOWN = _Words()


def _indexed(text: str | None) -> np.ndarray:
    """A text's tokens by their index among the words this worker knows."""
    found = tokens(text)
    return np.fromiter(map(_KNOWN.__getitem__, found), dtype=np.int32, count=len(found))


def _forget(most: int) -> None:
    """Between blocks: begin anew where more than ``most`` words are known."""
    global _KNOWN
    if len(_KNOWN) > most:
        _KNOWN = _Words()


def _press(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], dtype="<i8").tobytes()
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b"" for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def _unpress(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at, out = 8 * (len(kinds) + 1), []
    for size, kind in zip(np.frombuffer(raw, "<i8", len(kinds), 8).tolist(), kinds, strict=True):
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(np.dtype(kind).itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += size
    return out


def _steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0)).astype("<u8")


def _unsteps(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])) if len(sorted_values) else np.empty(0, np.int64)


def _share(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of hashes each lies in (ascending with the hash)."""
    return ((hashes >> np.uint64(HASH_BITS - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _dealt(context: np.ndarray, word: np.ndarray, buckets: int, hot: dict[int, int]) -> np.ndarray:
    """The bucket of each cell: by its context, and for frequent contexts by its word as well."""
    out = _share(context, buckets)
    if hot:
        known = np.array(sorted(hot), dtype=np.uint64)
        at = np.minimum(np.searchsorted(known, context), len(known) - 1)
        ways = np.where(known[at] == context, np.array([hot[int(k)] for k in known])[at], 1)
        out = (out + (word >> np.uint64(16)).astype(np.int64) % ways) % buckets
    return out


COLUMNS = ("bucket", "block", "data", "doc_ids", "held", "n_tokens")


def _pack_block(block: int, ids: list, parts: list[np.ndarray], hot: dict[int, int], buckets: int, with_docs: bool, kind) -> pa.RecordBatch:
    sizes = np.array([len(t) for t in parts], dtype=np.int64)
    index = np.concatenate(parts).astype(np.int64)
    before = np.concatenate(([0], index[:-1]))
    before[np.concatenate(([0], np.cumsum(sizes)[:-1]))] = _KNOWN[START]
    held = np.array([is_held_out(i) for i in ids], dtype=bool)
    doc = np.repeat(np.arange(len(ids)), sizes)
    hashes = np.frombuffer(_KNOWN.hashes, dtype=np.uint64).copy()
    present = np.unique(np.append(index, _KNOWN[START]))
    present = present[np.argsort(hashes[present], kind="stable")]
    place = np.zeros(len(hashes), dtype=np.int64)
    place[present] = np.arange(len(present))
    hashes = hashes[present]
    # (context, word, document) in the order of hashes, in one number: a block of 2^16 documents may have 2^23 words
    bits, doc_bits = len(present).bit_length(), len(ids).bit_length()
    if 2 * bits + doc_bits > 63:
        raise ValueError("a block has too many distinct words")
    keys = np.sort(place[before] << bits + doc_bits | place[index] << doc_bits | doc)
    cell = keys >> doc_bits
    first = _runs(cell)
    n = np.diff(np.append(first, len(cell)))
    cell = cell[first]
    context, word = cell >> bits, cell & (1 << bits) - 1
    docs = keys & (1 << doc_bits) - 1
    learned = np.add.reduceat((~held[docs]).astype(np.int64), first) if len(first) else n
    bucket = _dealt(hashes[context], hashes[word], buckets, hot)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows: dict[str, list] = {k: [] for k in COLUMNS}
    for b in range(buckets):
        own = order[cuts[b]:cuts[b + 1]]
        if len(own):
            contexts = _runs(context[own])
            words, at = np.unique(word[own], return_inverse=True)
            arrays = [_steps(hashes[context[own][contexts]]), np.diff(np.append(contexts, len(own))).astype("<u4"), _steps(hashes[words]),
                      at.astype("<u4"), learned[own].astype("<u4")]
            if with_docs:
                ends = np.cumsum(n[own])
                places = np.arange(int(ends[-1])) + np.repeat(first[own] - (ends - n[own]), n[own])
                arrays += [n[own].astype("<u4"), docs[places].astype("<u2")]
            rows["bucket"].append(b)
            rows["data"].append(_press(*arrays))
    m = len(rows["bucket"])
    rows["block"] = [block] * m
    for k in ("doc_ids", "held", "n_tokens"):
        rows[k] = [None] * m
    if with_docs:
        for k, v in zip(COLUMNS, (block % buckets, block, None, ids, held.tolist(), sizes.tolist()), strict=True):
            rows[k].append(v)
    return pa.RecordBatch.from_pydict(rows, schema=pa.schema([
        ("bucket", pa.int32()), ("block", pa.int64()), ("data", pa.binary()), ("doc_ids", pa.list_(kind)), ("held", pa.list_(pa.bool_())),
        ("n_tokens", pa.list_(pa.int64()))]))


def pack(docs: DataFrame, hot: dict[int, int], buckets: int, with_docs: bool) -> DataFrame:
    """The cells of blocks of documents as a row for each bucket that has some; with documents also which have them, and a row about the block."""
    name = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        seq, ids, parts, n = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids.append(i)
                parts.append(_indexed(text.as_py()))
                n += len(parts[-1])
                if len(ids) >= BLOCK_DOCS or n >= BLOCK_TOKENS:
                    yield _pack_block(seq, ids, parts, hot, buckets, with_docs, kind)
                    seq, ids, parts, n = seq + 1, [], [], 0
                    _forget(CACHED_WORDS)
        if ids:
            yield _pack_block(seq, ids, parts, hot, buckets, with_docs, kind)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"bucket int, block long, data binary, doc_ids array<{name}>, held array<boolean>, n_tokens array<long>")


# -- seating -----------------------------------------------------------------------


@functools.lru_cache(maxsize=8)
def stirling(discount: float, most: int = EXACT[0]) -> np.ndarray:
    """log S[c, t]: generalised Stirling numbers, the weight of seating c customers at t tables."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, c + 1)
        s[c + 1, 1:c + 1] = np.logaddexp(s[c, :c], np.log(c - discount * t) + s[c, 1:c + 1])
        s[c + 1, c + 1] = s[c, c]
    return s


def draw_tables(c: np.ndarray, weight: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables for ``c`` customers of one dish when a new table weighs ``weight`` and table k ``n_k - discount``."""
    t = np.minimum(c, 1).astype(np.int64)
    least = 2
    for most in EXACT:
        # the last table also gives the tables of the first customers of larger cells
        many = np.flatnonzero((c >= least) & ((c <= most) | (most == EXACT[-1])))
        least = most + 1
        if not len(many):
            continue
        log_s, numbers = stirling(discount, most)[:, 1:], np.arange(1, most + 1)
        step = max(1, MATRIX // most)
        for at in range(0, len(many), step):
            cells = many[at:at + step]
            logits = log_s[np.minimum(c[cells], most)] + np.log(weight[cells])[:, None] * numbers
            mass = np.cumsum(np.exp(logits - logits.max(axis=1, keepdims=True)), axis=1)
            t[cells] = 1 + (mass < (rng.random(len(cells)) * mass[:, -1])[:, None]).sum(axis=1)
    big = np.flatnonzero(c > EXACT[-1])
    seated = np.full(len(big), EXACT[-1], dtype=np.int64)
    while len(big):
        run = np.minimum(c[big] - seated, np.maximum(1, seated // 8))
        p = weight[big] / (seated - discount * t[big] + weight[big])
        t[big] += rng.binomial(run, np.clip(p, 0, 1))
        seated += run
        more = seated < c[big]
        big, seated = big[more], seated[more]
    return t


def seat(context: np.ndarray, c: np.ndarray, p: np.ndarray, customers: np.ndarray, tables: np.ndarray, scale: np.ndarray, rng,
         burn_in: int = BURN_IN, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """Gibbs sweeps over cells of restaurants ``context`` with ``c`` customers whose dish has probability ``p`` in the parent.

    ``customers`` and ``tables`` are those of the restaurants in other buckets; own tables count ``scale`` times while
    these are not known. Returns each cell's mean predictive probability and its last tables.
    """
    n = len(customers)
    all_customers = customers + np.bincount(context, c, n)
    t = np.minimum(c, 1).astype(np.int64)
    mean = np.zeros(len(c))
    some = np.flatnonzero(c > 1)  # one customer sits at one table
    total = tables + scale * np.bincount(context, t, n)
    for sweep in range(burn_in + samples):
        u = context[some]
        t[some] = draw_tables(c[some], (STRENGTH + DISCOUNT * np.maximum(total[u] - t[some], 0)) * p[some], DISCOUNT, rng)
        total = tables + scale * np.bincount(context, t, n)
        if sweep >= burn_in:
            mean += (c - DISCOUNT * t + (STRENGTH + DISCOUNT * total[context]) * p) / (STRENGTH + all_customers[context])
    return mean / max(1, samples), t


def root_tables(customers: np.ndarray, base: float, scale: float, rng, sweeps: int = FIRST_SWEEPS) -> np.ndarray:
    """Tables of the word restaurant for words with so many ``customers``; the words seen here are one of ``scale`` such parts."""
    tables = np.minimum(customers, 1).astype(np.int64)
    for _ in range(sweeps):
        spare = (ROOT_STRENGTH + ROOT_DISCOUNT * scale * tables.sum()) * base
        tables = draw_tables(customers, np.full(len(customers), spare), ROOT_DISCOUNT, rng)
    return tables


# -- buckets -----------------------------------------------------------------------


class Bucket:
    """All cells of one bucket, by context and word.

    Where documents are packed, ``tokens`` has for every block its tokens' cells and documents, as runs.
    """

    def __init__(self, table: pa.Table, with_docs: bool):
        _forget(0)  # words are met while packing only
        table = table.sort_by("block")
        self.blocks = table.column("block").to_pylist()
        contexts, runs, words, places, learned, counts, docs = [], [], [], [], [], [], []
        for data in table.column("data"):
            u, n, w, at, c, *more = _unpress(data.as_py(), "<u8", "<u4", "<u8", "<u4", "<u4", *(("<u4", "<u2") if with_docs else ()))
            contexts.append(_unsteps(u))
            runs.append(n)
            words.append(_unsteps(w))
            places.append(at)
            learned.append(c)
            if with_docs:
                counts.append(more[0])
                docs.append(more[1])
        self.contexts, u = np.unique(np.concatenate(contexts), return_inverse=True)
        self.words, w = np.unique(np.concatenate(words), return_inverse=True)
        u = np.repeat(u, np.concatenate(runs))
        # places count from the block's first word
        before = np.cumsum([0, *map(len, words[:-1])])
        w = w[np.concatenate([at.astype(np.int64) + k for at, k in zip(places, before.tolist(), strict=True)])]
        cells, at = np.unique(u.astype(np.int64) << 32 | w, return_inverse=True)
        self.context, self.word = cells >> 32, cells & 0xFFFFFFFF
        self.c = np.bincount(at, np.concatenate(learned), len(cells)).astype(np.int64)
        if with_docs:
            self.tokens = list(zip(np.split(at, np.cumsum(list(map(len, counts)))[:-1]), counts, docs, strict=True))

    def by_document(self, *values: np.ndarray):
        """For every block: the documents with tokens here, and for each of ``values`` (of the cells) its sums over their tokens.

        Sums are held for one block at a time, and only for as many documents as it has.
        """
        for cells, counts, docs in self.tokens:
            at = np.flatnonzero(np.bincount(docs))
            yield at, [np.bincount(docs, np.repeat(v[cells], counts))[at] for v in values]

    def frequent(self, hot: dict[int, int]) -> np.ndarray:
        """For every context in how many ways it is dealt."""
        return np.array([hot.get(int(h), 1) for h in self.contexts], dtype=float) if hot else np.ones(len(self.contexts))


def _number(table: pa.Table) -> int:
    return table.column("bucket")[0].as_py()


def _first_seating(hot: dict[int, int], buckets: int, slices: int, seed: int):
    def run(table: pa.Table) -> pa.Table:
        """Every word's customers (tables of the contexts) and count in this bucket, by slices of words; and its part of frequent contexts."""
        b, number = Bucket(table, False), _number(table)
        rng = np.random.default_rng([seed, 2, number])
        # a first guess of the word restaurant: one table for each context of a word, here and in the other buckets
        seen = np.bincount(b.word, np.minimum(b.c, 1), len(b.words))
        spare = (ROOT_STRENGTH + ROOT_DISCOUNT * buckets * (seen > 0).sum()) / (1 + buckets * max(1, (seen > 0).sum()))
        p = (np.maximum(seen - ROOT_DISCOUNT, 0) + spare) / (ROOT_STRENGTH + buckets * seen.sum())
        none = np.zeros(len(b.contexts))
        ways = b.frequent(hot)
        _, t = seat(b.context, b.c, p[b.word], none, none, ways, rng, FIRST_SWEEPS, 0)
        customers, counts = (np.bincount(b.word, x, len(b.words)).astype("<u8") for x in (t, b.c))
        cuts = np.searchsorted(_share(b.words, slices), np.arange(slices + 1))
        parts = [(s, _press(_steps(b.words[i:j]), customers[i:j], counts[i:j])) for s, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)) if j > i]
        dealt = np.flatnonzero(ways > 1)
        own_c, own_t = (np.bincount(b.context, x, len(b.contexts))[dealt].astype(np.int64) for x in (b.c, t))
        m, k = len(parts), len(dealt)
        return pa.table({"slice": pa.array([s for s, _ in parts] + [-1] * k, pa.int32()), "bucket": pa.array([number] * (m + k), pa.int32()),
                         "data": pa.array([d for _, d in parts] + [None] * k, pa.binary()),
                         "context": pa.array([None] * m + b.contexts[dealt].astype(np.int64).tolist(), pa.int64()),
                         "customers": pa.array([None] * m + own_c.tolist(), pa.int64()), "tables": pa.array([None] * m + own_t.tolist(), pa.int64())})

    return run


def _word_restaurant(slices: int, seed: int):
    def run(table: pa.Table) -> pa.Table:
        """The word restaurant's part of a slice of words, for each bucket in the order of its words, and its sums."""
        table = table.sort_by("bucket")
        number = table.column("slice")[0].as_py()
        found = [_unpress(d, "<u8", "<u8", "<u8") for d in table.column("data").to_pylist()]
        words, at = np.unique(np.concatenate([_unsteps(w) for w, _, _ in found]), return_inverse=True)
        customers, counts = (np.bincount(at, np.concatenate([f[k] for f in found]), len(words)).astype(np.int64) for k in (1, 2))
        known = int((counts > 0).sum())
        tables = root_tables(customers, 1 / (1 + slices * max(1, known)), slices, np.random.default_rng([seed, 3, number]))
        rest = (customers - ROOT_DISCOUNT * tables).astype("<f4")
        ends = np.cumsum([len(w) for w, _, _ in found])
        data = [_press(rest[x], counts[x].astype("<u8")) for x in np.split(at, ends[:-1])]
        m = len(data)
        return pa.table({"bucket": pa.array([*table.column("bucket").to_pylist(), -1], pa.int32()), "block": pa.array([-1 - number] * (m + 1), pa.int64()),
                         "data": pa.array([*data, None], pa.binary()), "customers": pa.array([0] * m + [int(customers.sum())], pa.int64()),
                         "tables": pa.array([0] * m + [int(tables.sum())], pa.int64()), "known": pa.array([0] * m + [known], pa.int64())})

    return run


def score(docs: DataFrame, seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` for every row of ``docs``.

    ``base_score`` is the add-one unigram score, ``score`` the model's log10 probability, both learned
    from the rows that are not held out, and ``perplexity`` the model's for a token of the text. Null text counts as empty (its
    only token is the end); repeated rows each count and each get a row; ids of any type are kept as they are; further
    columns take no part; an empty table gives no rows. ``buckets`` is a floor: there are as many more as keep
    a bucket near ``BUCKET_TOKENS`` tokens.
    """
    words, n_train = frequent_words(docs)
    buckets = max(buckets, -(-n_train // BUCKET_TOKENS))
    # in how many ways a frequent context is dealt: its part of a bucket stays under a quarter
    hot = {word_hash(w): min(buckets, -(-4 * n * buckets // max(1, n_train))) for w, n in words if 4 * n * buckets > n_train}
    first = materialise(pack(docs, hot, buckets, False).groupBy("bucket").applyInArrow(
        _first_seating(hot, buckets, buckets, seed), "slice int, bucket int, data binary, context long, customers long, tables long"), "first-seating")
    # frequent contexts are HOT at most
    shared = {r["context"]: (r["c"], r["t"]) for r in first.where("slice < 0").groupBy("context").agg(F.sum("customers").alias("c"), F.sum("tables").alias("t")).collect()}
    roots = materialise(first.where("slice >= 0").select("slice", "bucket", "data").groupBy("slice").applyInArrow(
        _word_restaurant(buckets, seed), "bucket int, block long, data binary, customers long, tables long, known long"), "word-restaurant")
    sums = roots.agg(F.sum("customers").alias("r"), F.sum("tables").alias("s"), F.sum("known").alias("v")).first()
    at_root, root, vocabulary = (sums[k] or 0 for k in ("r", "s", "v"))
    spare = (ROOT_STRENGTH + ROOT_DISCOUNT * root) / (vocabulary + 1)
    below = np.log10(float(n_train + vocabulary + 1))

    def apply(table: pa.Table) -> pa.Table:
        number, block = _number(table), table.column("block")
        about = table.filter(pa.compute.is_valid(table.column("doc_ids")))
        about = about.append_column("from", pa.array([-1] * about.num_rows, pa.int32())).select(["block", "from", "data", "doc_ids", "held", "n_tokens"])
        dealt = table.filter(pa.compute.and_(pa.compute.is_valid(table.column("data")), pa.compute.greater_equal(block, 0)))
        if not dealt.num_rows:
            return about
        b = Bucket(dealt, True)
        parts = table.filter(pa.compute.less(block, 0)).sort_by([("block", "descending")])
        cuts = np.bincount(_share(b.words, buckets), minlength=buckets)
        rest, counts = np.zeros(0, "<f4"), np.zeros(0, "<u8")
        if parts.num_rows:
            found = [_unpress(d, "<f4", "<u8") for d in parts.column("data").to_pylist()]
            rest, counts = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            if [len(f[0]) for f in found] != [n for n in cuts.tolist() if n]:
                raise ValueError("a bucket's words are not those of the first pass")
        p = (rest.astype(float) + spare) / (ROOT_STRENGTH + at_root)
        ways = b.frequent(hot)
        own_c = np.bincount(b.context, b.c, len(b.contexts))
        other_c, other_t = np.zeros(len(b.contexts)), np.zeros(len(b.contexts))
        for k in np.flatnonzero(ways > 1):
            c, t = shared.get(int(b.contexts[k]), (0, 0))
            other_c[k] = c - own_c[k]
            other_t[k] = t * (other_c[k] / c if c else 0.0)
        mean, _ = seat(b.context, b.c, p[b.word], other_c, other_t, np.ones(len(b.contexts)), np.random.default_rng([seed, 4, number]))
        known = counts[b.word].astype(float)
        out = [_press(at.astype("<u2"), scores, bases, knowns.astype("<u4")) for at, (scores, bases, knowns) in b.by_document(
            np.log10(np.minimum(mean, 1.0)), np.log10(known + 1.0) - below, (known > 0).astype(float))]
        m = len(out)
        own_rows = pa.table({"block": pa.array(b.blocks, pa.int64()), "from": pa.array([number] * m, pa.int32()), "data": pa.array(out, pa.binary()), **{
            k: pa.nulls(m, about.schema.field(k).type) for k in ("doc_ids", "held", "n_tokens")}})
        return pa.concat_tables([about, own_rows])

    def finish(table: pa.Table) -> pa.Table:
        about = table.filter(pa.compute.is_valid(table.column("doc_ids")))
        ids = pa.concat_arrays(about.column("doc_ids").chunks).flatten()
        held, sizes = (about.column(k)[0].as_py() for k in ("held", "n_tokens"))
        n = len(sizes)
        scores, bases, knowns = np.zeros(n), np.zeros(n), np.zeros(n)
        for data in table.filter(pa.compute.is_null(table.column("doc_ids"))).sort_by("from").column("data").to_pylist():
            at, s, d, k = _unpress(data, "<u2", "<f8", "<f8", "<u4")
            scores[at] += s
            bases[at] += d
            knowns[at] += k
        with np.errstate(over="ignore"):
            perplexity = 10.0 ** (-scores / np.array(sizes))
        return pa.table({"doc_id": ids, "held_out": pa.array(held, pa.bool_()),
                         "n_tokens": pa.array(sizes, pa.int64()), "n_known": pa.array(knowns.astype(np.int64)),
                         "train_tokens": pa.array([n_train] * n, pa.int64()), "base_score": pa.array(bases), "score": pa.array(scores), "perplexity": pa.array(perplexity)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = pack(docs, hot, buckets, True)
    none = [F.lit(None).cast(packed.schema[k].dataType).alias(k) for k in ("doc_ids", "held", "n_tokens")]
    together = packed.unionByName(roots.where("bucket >= 0").select("bucket", "block", "data", *none))
    partial = together.groupBy("bucket").applyInArrow(
        apply, f"block long, from int, data binary, doc_ids array<{kind}>, held array<boolean>, n_tokens array<long>")
    return partial.groupBy("block").applyInArrow(
        finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
