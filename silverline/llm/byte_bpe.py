"""Byte-level BPE by prefix dynamic programming.

Of all tokens that end at a position of a piece exactly one can be the last token of the encoding of
the bytes before that position: the one that may follow the last token of the shorter prefix it leaves.
``PrefixTable`` stores this token for every byte prefix, so the ids of any prefix are read off
backwards, appended bytes only extend the table, and after an edit only the entries near it are made
anew. ``Encoder`` splits texts by a pattern and encodes each piece with such a table, as the
tiktoken library does with its merges.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_PIECES = 400_000
CACHED_LENGTH = 64


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """The ranks of a tiktoken file: base64 of a token, a space and its id to a line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, lines.splitlines()))}


class Vocabulary:
    """Tokens, how each is merged, and which may follow which.

    A token that merging never makes from its own bytes is left out of encodings, except that a whole
    piece which is a token is that token.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes = ranks, {i: t for t, i in ranks.items()}
        lacking = [b for b in range(256) if bytes([b]) not in ranks]
        if lacking:
            raise ValueError(f"the ranks lack the single bytes {lacking[:5]}")
        self.longest = max(map(len, ranks))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.follows: dict[tuple[int, int], bool] = {}
        self.ends = ahocorasick.Automaton()
        for token, i in ranks.items():
            if self.made(i):
                self.ends.add_word(token.decode("latin-1"), (i, len(token)))
        self.ends.make_automaton()

    def merge(self, data: bytes, below: int | None = None, parts: int = 1) -> list[int]:
        """Merge the best-ranked neighbours, leftmost first, while over ``parts`` are left and ranks are under ``below``."""
        got = [data[k:k + 1] for k in range(len(data))]
        while len(got) > parts:
            best = min((r, k) for k in range(len(got) - 1) if (r := self.ranks.get(got[k] + got[k + 1], 1 << 62)) is not None)
            if best[0] >= (1 << 62 if below is None else below):
                break
            got[best[1]:best[1] + 2] = [got[best[1]] + got[best[1] + 1]]
        return [self.ranks[t] for t in got]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a byte, or where merging goes otherwise."""
        if token not in self.parts:
            data = self.bytes[token]
            made = self.merge(data, token, 2) if len(data) > 1 else []
            self.parts[token] = (made[0], made[1]) if len(made) == 2 else None
        return self.parts[token]

    def made(self, token: int) -> bool:
        return len(self.bytes[token]) == 1 or self.split(token) is not None

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens together are encoded as these two tokens.

        The merges of both are undone from the latest to the earliest. At each time the two tokens at
        the border must not have had a merge that came before the one undone last: one of lower rank,
        or of the same rank and further left.
        """
        known = self.follows.get((left, right))
        if known is None:
            known = self.follows[left, right] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        ranks, text = self.ranks, self.bytes
        # the earliest merge undone so far: (rank, 0 on the left side or 1 on the right side)
        until = (1 << 62, 0)
        while True:
            rank = ranks.get(text[left] + text[right])
            # the border lies right of the left side's merges and left of the right side's
            if rank is not None and (rank < until[0] or rank == until[0] and until[1] == 1):
                return False
            a, b = self.split(left), self.split(right)
            if a is None and b is None:
                return True
            # of equal ranks the left side's merge is the earlier one, so the right one is undone first
            if b is None or a is not None and left > right:
                until, left = (left, 0), a[1]
            else:
                until, right = (right, 1), b[0]


class PrefixTable:
    """The last token of every byte prefix of one piece (``last[n]`` for the first n bytes)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, start: int, stop: int, done=None) -> int:
        """Set ``last`` for the positions in (start, stop]; ``done(position)`` may end it early. Returns the last position set."""
        last, known, may_follow = self.last, self.vocabulary.follows, self.vocabulary.may_follow
        back = max(0, start - self.vocabulary.longest)
        for end, (token, size) in self.vocabulary.ends.iter(self.data[back:stop].decode("latin-1")):
            at = end + back + 1
            rest = at - size
            if at <= start or last[at] >= 0:
                continue
            if rest:
                left = last[rest]
                fits = known.get((left, token))
                if not (may_follow(left, token) if fits is None else fits):
                    continue
            last[at] = token
            if done is not None and done(at):
                return at
        return stop

    def append(self, more: bytes) -> None:
        """Add bytes; the entries of earlier prefixes stay as they are."""
        n = len(self.data)
        self.data += more
        self.last += [-1] * len(more)
        self._fill(n, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes [start, stop); returns how many entries were made anew.

        An entry depends on the bytes and entries of the ``longest`` positions before it. Once that
        many in a row are what they were before the edit, all later ones are too and are kept.
        """
        if not 0 <= start <= stop <= len(self.data):
            raise ValueError(f"no bytes {start} to {stop} in a piece of {len(self.data)}")
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start + 1] + [-1] * (len(self.data) - start)
        same, least = 0, start + len(new)

        def settled(at: int) -> bool:
            nonlocal same
            same = same + 1 if at > least and self.last[at] == old[at - shift] else 0
            return same >= self.vocabulary.longest

        at = self._fill(start, len(self.data), settled)
        self.last[at + 1:] = old[at + 1 - shift:]
        return at - start

    def ids(self, n: int | None = None) -> list[int]:
        """The ids of the first ``n`` bytes (default: of all)."""
        at, out = len(self.data) if n is None else n, []
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.bytes[out[-1]])
        return out[::-1]


class Splitter:
    """The matches of a pattern, with the character classes that the tiktoken library has.

    Both regex engines read the same syntax but may know different versions of Unicode. Characters that
    they class differently are found once by asking both; a text that holds one is split with a stand-in of
    the right class in its place.
    """

    STAND_INS = ((r"\p{L}", "λ"), (r"\p{N}", "٣"), (r"\s", " "))

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).finditer
        self.find_all = regex.compile(pattern).findall
        self.grouped = bool(regex.compile(pattern).groups)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        odd: dict[str, str] = {}
        for kind, stand_in in self.STAND_INS:
            probe = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
            theirs = set(bytes(probe.encode_ordinary(every)).decode("utf-8"))
            ours = set(regex.findall(kind, every))
            odd |= dict.fromkeys(theirs - ours, stand_in)
            for c in ours - theirs:
                odd.setdefault(c, "￾")
        self.odd, self.table = frozenset(odd), str.maketrans(odd)
        # most texts have no character as high as the least odd one
        self.high = re.compile(f"[{min(odd)}-\U0010ffff]") if odd else None

    def split(self, text: str) -> list[str]:
        if self.high is not None and not text.isascii() and self.high.search(text) and not self.odd.isdisjoint(text):
            return [text[m.start():m.end()] for m in self.find(text.translate(self.table))]
        return [m.group() for m in self.find(text)] if self.grouped else self.find_all(text)


class Encoder:
    """Whole texts to the little-endian 32-bit ids of their pieces, and back. Short pieces are remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int = CACHED_PIECES):
        self.vocabulary, self.splitter, self.cached = Vocabulary(ranks), Splitter(pattern), cached
        self.known: dict[str, bytes] = {}
        size = max(ranks.values()) + 1
        self.sizes = np.zeros(size, dtype=np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.vocabulary.bytes.get(i, b"") for i in range(size)), np.uint8)

    def piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        whole = self.vocabulary.ranks.get(data)
        return array("I", PrefixTable(self.vocabulary, data).ids() if whole is None else [whole]).tobytes()

    def encode(self, text: str) -> bytes:
        pieces, known = self.splitter.split(text), self.known
        if len(known) > self.cached:
            known.clear()
        out = list(map(known.get, pieces))
        if None in out:
            for k, ids in enumerate(out):
                if ids is None:
                    ids = known.get(pieces[k]) or self.piece(pieces[k])
                    if len(pieces[k]) <= CACHED_LENGTH:
                        known[pieces[k]] = ids
                    out[k] = ids
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of all ids, gathered from one flat table; an unknown id is an error."""
        i = np.frombuffer(ids, "<u4").astype(np.int64)
        if len(i) and (i.max() >= len(self.sizes) or not self.sizes[i].all()):
            raise ValueError("an id that is no token")
        return b"".join(self._gather(i[at:at + 65_536]) for at in range(0, len(i), 65_536))

    def _gather(self, i: np.ndarray) -> bytes:
        sizes = self.sizes[i]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[i] - (ends - sizes), sizes)
        return self.flat[places].tobytes()


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def encoder(ranks_file: bytes, pattern: str) -> Encoder:
    """This worker's encoder, with what it has learned from earlier tasks."""
    key = (zlib.crc32(ranks_file), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(read_ranks(ranks_file), pattern)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, ranks_file: bytes, pattern: str, text: str = "text") -> DataFrame:
    """``doc_id, ids, n_tokens``: the ids of every whole text as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Each row is encoded on its own, so repeated rows agree, a null or
    repeated ``doc_id`` is kept as it is, and further columns take no part. An empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col(text).cast("string").alias("text"))

    def run(batches):
        own = encoder(ranks_file, pattern)
        for batch in batches:
            ids = [own.encode(t or "") for t in batch.column(1).to_pylist()]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), counts], ["doc_id", "ids", "n_tokens"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, n_tokens long")


def decode_documents(encoded: DataFrame, ranks_file: bytes, pattern: str) -> DataFrame:
    """``doc_id, bytes``: the text's bytes again, from ``ids`` alone (null ids: none)."""
    rows = encoded.select("doc_id", "ids")

    def run(batches):
        own = encoder(ranks_file, pattern)
        for batch in batches:
            data = [own.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "bytes"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, bytes binary")


def digests(docs: DataFrame, ranks_file: bytes, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document: encoded, then decoded from the ids.

    Same rules as ``encode_documents``; both steps are made where the text lies, so ids stay in their task.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        own = encoder(ranks_file, pattern)
        for batch in batches:
            sizes, ids_sha, text_sha = [], [], []
            for t in batch.column(1).to_pylist():
                ids = own.encode(t or "")
                sizes.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()),
                                              pa.array(text_sha, pa.string())], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
