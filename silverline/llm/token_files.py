"""Token ids as bit-plane shuffled, compressed chunks.

Texts are encoded in ascending document order. A chunk holds whole documents and is cut into blocks of
``block`` ids; each block is transposed into byte planes (or bit planes) and every plane is compressed
with zstandard on its own. A chunk begins with its own index of plane lengths. Chunks are stored by
Spark, one to a row, so they can lie in any store Spark writes to; a second small table, the chunk
index, gives every chunk's place in the id stream.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import string
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.session import scratch_path

MAGIC = b"SLP1"
BLOCK = 16_384
CHUNK_IDS = 1 << 18
LEVEL = 1
END_ID = 0
CACHED_UNITS = 1_500_000
HEADER = struct.Struct("<4sBIII")


# -- the chunk format --------------------------------------------------------------


def pack(ids: np.ndarray, block: int = BLOCK, bits: bool = False, level: int = LEVEL) -> bytes:
    """Header, the length of every plane, then the planes."""
    press = zstandard.ZstdCompressor(level=level)
    planes = []
    for at in range(0, len(ids), block):
        part = np.ascontiguousarray(ids[at:at + block], dtype="<u4").view(np.uint8).reshape(-1, 4)
        if bits:
            part = np.unpackbits(part, axis=1, bitorder="little")
            planes += [press.compress(np.packbits(part[:, k]).tobytes()) for k in range(32)]
        else:
            planes += [press.compress(part[:, k].tobytes()) for k in range(4)]
    head = HEADER.pack(MAGIC, bits, len(ids), block, len(planes))
    return head + np.array(list(map(len, planes)), dtype="<u4").tobytes() + b"".join(planes)


def unpack(data: bytes) -> np.ndarray:
    magic, bits, n, block, n_planes = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a chunk of token ids")
    lengths = np.frombuffer(data, "<u4", n_planes, HEADER.size)
    at = HEADER.size + 4 * n_planes
    expand, out, per = zstandard.ZstdDecompressor(), np.empty(n, dtype="<u4"), 32 if bits else 4
    for k in range(0, n_planes, per):
        first = k // per * block
        size = min(block, n - first)
        part = np.zeros((size, per), dtype=np.uint8)
        for p in range(per):
            raw = np.frombuffer(expand.decompress(data[at:at + lengths[k + p]]), np.uint8)
            part[:, p] = np.unpackbits(raw, count=size) if bits else raw
            at += int(lengths[k + p])
        if bits:
            part = np.packbits(part, axis=1, bitorder="little")
        out[first:first + size] = np.ascontiguousarray(part).view("<u4").ravel()
    return out


# -- encoding ----------------------------------------------------------------------

# White space other than single spaces and line ends between words, or U+0000, which marks first words; such texts are encoded whole.
_UNEVEN_ASCII = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\0")
_UNEVEN_OTHER = tuple(c for c in map(chr, range(128, 0x3001)) if c.isspace())
# Units that are not plain words are learned so many to a text.
_LEARN_AT_ONCE = 20
# Words of these letters are one piece to the pre-tokeniser, in any version of Unicode.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def _byte_signs() -> str:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs, more = dict(zip(printable, map(chr, printable), strict=True)), 0x100
    for b in range(256):
        if b not in signs:
            signs[b], more = chr(more), more + 1
    return "".join(signs[b] for b in range(256))


_SIGNS = _byte_signs()
_SPACE_SIGN = _SIGNS[32]
_MARKS = frozenset(string.punctuation)


def _plain_byte_level(spec: dict) -> bool:
    """Whether words with their space can be encoded apart: the GPT-2 pre-tokeniser, no normaliser, byte-pair merges."""
    before = spec.get("pre_tokenizer") or {}
    return (before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True) and not spec.get("normalizer")
            and (spec.get("model") or {}).get("type") == "BPE" and not (spec["model"].get("dropout") or spec["model"].get("ignore_merges")))


class Encoder:
    """Texts to the bytes of their ids.

    The byte-level pre-tokeniser never joins a character to white space after it and gives a
    single space to the word that follows, so words with their space (or line end) can be encoded
    apart; each is encoded once by the library and remembered. A tokenizer with other rules before its merges
    encodes all texts whole. With ``special`` the tokenizer's added
    tokens (such as an end of text) are found in the text as the library does by itself; texts that
    have one are encoded whole. Without, they are plain characters.
    """

    def __init__(self, tokenizer_json: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = not special
        self.added = [t["content"] for t in spec.get("added_tokens") or ()]
        # a unit's number; the ids of all units are on end, in the order of their numbers
        self.known: dict[str, int] = {}
        self.starts, self.sizes, self.ids = array("Q"), array("I"), array("I")
        self._remember("\0", ())
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.apart = _plain_byte_level(spec) and len(line_end) == 1
        self.line_end = line_end[0] if self.apart else -1

    def _remember(self, unit: str, ids) -> None:
        self.known[unit] = len(self.sizes)
        self.starts.append(len(self.ids))
        self.sizes.append(len(ids))
        self.ids.extend(ids)

    def _ids(self, number: int) -> array:
        at = self.starts[number]
        return self.ids[at:at + self.sizes[number]]

    def _forget(self, most: int) -> None:
        """Keep the first ``most`` units: what came first is met most."""
        self.known = dict(itertools.islice(self.known.items(), most))
        del self.ids[self.starts[most]:], self.starts[most:], self.sizes[most:]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _uneven(self, text: str) -> bool:
        return (not self.apart or any(x in text for x in _UNEVEN_ASCII) or not text.isascii() and any(x in text for x in _UNEVEN_OTHER)
                or any(x in text for x in self.added))

    def _learn(self, wanted: list[str]) -> None:
        """Encode units: plain words by the library's merges, others as the lines of texts, where a line end is a token of its own.

        One punctuation mark after a letter or digit is a piece of its own, so such a unit is made of two; one that
        begins with a line end is that token and a first word.
        """
        known = self.known
        if not wanted:
            return
        alone: dict[str, None] = {}
        made: list[tuple[str, str, str]] = []  # of a word and a mark, or a line end and a first word
        for u in wanted:
            first = "\0" + u[1:] if u[:1] == "\n" else u
            if first[-1:] in _MARKS and first[-2:-1].isalnum():
                alone[first[:-1]] = alone["\0" + first[-1]] = None
                made.append((first, first[:-1], "\0" + first[-1]))
            else:
                alone[first] = None
            if first is not u:
                made.append((u, "\n", first))
        plain, found, sizes, missing, lines = [], [], [], [], []
        tokenize, is_plain = self.tokenizer.model.tokenize, _LETTERS.fullmatch
        for u in alone:
            if u in known:
                continue
            first = u[:1] == "\0"
            word = u[1:] if first else u
            if is_plain(word):  # one piece: the library's merges alone
                signs = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(_SIGNS)
                ids = [t.id for t in tokenize(signs if first else _SPACE_SIGN + signs)]
                plain.append(u)
                found += ids
                sizes.append(len(ids))
            else:
                missing.append(u)
                lines.append("\n" + word if first else "\n " + word)
        known.update(zip(plain, itertools.count(len(self.sizes))))
        self.starts.extend((len(self.ids) + np.cumsum([0, *sizes])[:-1]).tolist())
        self.sizes.extend(sizes)
        self.ids.extend(found)
        texts = ["".join(lines[at:at + _LEARN_AT_ONCE]) for at in range(0, len(lines), _LEARN_AT_ONCE)]
        found = array("I", b"".join(self._whole(texts)))
        starts = np.flatnonzero(np.frombuffer(found, "<u4") == self.line_end).tolist()
        if len(starts) != len(missing):
            raise ValueError("a line end is not one token between words")
        for u, i, j in zip(missing, starts, [*starts[1:], len(found)], strict=False):
            self._remember(u, found[i + 1:j])
        end = array("I", [self.line_end])
        for u, a, b in made:
            if u not in known:
                self._remember(u, (end if a == "\n" else self._ids(known[a])) + self._ids(known[b]))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHED_UNITS:
            self._forget(CACHED_UNITS // 2)
        out, units, even, counts, uneven = [b""] * len(texts), [], [], [], []
        for k, text in enumerate(texts):
            if self._uneven(text):
                uneven.append(k)
                continue
            # a unit's key is its text: with its space, or beginning with its line end
            own = ("\0" + text.replace("\n", " \n")).split(" ")
            units += own
            even.append(k)
            counts.append(len(own))
        number = np.fromiter(map(self.known.get, units, itertools.repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(number < 0).tolist()
        if new:
            wanted = [units[k] for k in new]
            self._learn(list(dict.fromkeys(wanted)))
            number[new] = list(map(self.known.__getitem__, wanted))
        sizes = np.frombuffer(self.sizes, np.uint32)[number].astype(np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) + np.repeat(np.frombuffer(self.starts, np.uint64)[number].astype(np.int64) - (ends - sizes), sizes)
        data = (np.frombuffer(self.ids, np.uint32) if self.ids else np.empty(0, np.uint32))[place].tobytes()
        cuts = [0, *(4 * ends[np.cumsum(counts) - 1]).tolist()] if counts else [0]
        for k, i, j in zip(even, cuts, cuts[1:], strict=False):
            out[k] = data[i:j]
        for k, ids in zip(uneven, self._whole([texts[k] for k in uneven]), strict=True):
            out[k] = ids
        return out


_ENCODERS: dict[int, Encoder] = {}


def _encoder(tokenizer_json: str) -> Encoder:
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer_json, special=True)
    return _ENCODERS[key]


def write_token_files(docs: DataFrame, tokenizer_json: str, path: str, end_id: int = END_ID, block: int = BLOCK,
                      chunk_ids: int = CHUNK_IDS, bits: bool = False) -> None:
    """Encode ``docs`` into chunks below ``path`` (``chunks`` and ``index``).

    Documents are dealt by ranges of ``doc_id``; rows that share an id are ordered by a hash of the
    text, then by place, so a hot id is split. Null ids come first; null text is empty and gives
    the end id alone. The tokenizer (a file of fixed size) travels with the tasks.
    """
    spark = docs.sparkSession
    order = ["doc_id", "__hash", "__place"]
    spread = (docs.select("doc_id", "text").withColumn("__hash", F.xxhash64("text")).withColumn("__place", F.monotonically_increasing_id())
              .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))
    shared = spark.sparkContext.broadcast(tokenizer_json)
    end = struct.pack("<I", end_id)

    def run(batches):
        encoder, shard, chunk = _encoder(shared.value), TaskContext.get().partitionId(), 0
        ids, sizes, held, n = [], [], [], 0

        def flush():
            flat = np.frombuffer(b"".join(held), dtype="<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([len(flat)], pa.int64()),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([pack(flat, block, bits)], pa.binary())], names=["shard", "chunk", "n_ids", "doc_ids", "sizes", "data"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for i, data in zip(part.column("doc_id").to_pylist(), encoder.encode([t or "" for t in part.column("text").to_pylist()]), strict=True):
                    ids.append(i)
                    sizes.append(len(data) // 4 + 1)
                    held += [data, end]
                    n += sizes[-1]
                    if n >= chunk_ids:
                        yield flush()
                        ids, sizes, held, n, chunk = [], [], [], 0, chunk + 1
        if ids:
            yield flush()

    schema = "shard int, chunk int, n_ids long, doc_ids array<long>, sizes array<long>, data binary"
    spread.mapInArrow(run, schema).write.parquet(f"{path}/chunks")
    stored = spark.read.parquet(f"{path}/chunks").select("shard", "chunk", "n_ids", F.size("doc_ids").alias("n_docs"))
    shards = stored.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    # one row per partition of the writer
    before = shards.selectExpr("shard", "sum(ids) OVER (ORDER BY shard) - ids AS before")
    placed = stored.selectExpr("*", "sum(n_ids) OVER (PARTITION BY shard ORDER BY chunk) - n_ids AS inside")
    placed.join(F.broadcast(before), "shard").select("shard", "chunk", "n_ids", "n_docs", (F.col("before") + F.col("inside")).alias("first_id")).write.parquet(f"{path}/index")


def _documents(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            flat = unpack(batch.column("data")[row].as_py())
            sizes = np.array(batch.column("sizes")[row].as_py(), dtype=np.int64)
            ends = np.cumsum(sizes)
            raw = memoryview(flat.tobytes())
            sums = [zlib.crc32(raw[4 * (b - n):4 * b]) for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids")[row].values, pa.array([batch.column("shard")[row].as_py()] * n, pa.int32()),
                 pa.array([batch.column("chunk")[row].as_py()] * n, pa.int32()), pa.array(ends - sizes), pa.array(sizes), pa.array(sums, pa.int64())],
                names=["doc_id", "shard", "chunk", "inside", "n_tokens", "ids_crc32"])


def read_token_files(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the chunks' decoded ids."""
    found = spark.read.parquet(f"{path}/chunks").select("shard", "chunk", "doc_ids", "sizes", "data").mapInArrow(
        _documents, "doc_id long, shard int, chunk int, inside long, n_tokens long, ids_crc32 long")
    index = spark.read.parquet(f"{path}/index").select("shard", "chunk", "first_id")
    return found.join(index, ["shard", "chunk"]).select("doc_id", (F.col("first_id") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_json: str, **options) -> DataFrame:
    """Write ``docs`` to fresh files in the shared scratch folder and read them back.

    Rows that repeat come as often as they stand. Empty tables give no rows; further columns take no part.
    """
    path = scratch_path(docs.sparkSession, "llm", "token-files")
    write_token_files(docs, tokenizer_json, path, **options)
    return read_token_files(docs.sparkSession, path)
