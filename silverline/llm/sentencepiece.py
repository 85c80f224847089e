"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

A text is cut before every run of spaces (no piece of the model spans such a cut, which is
checked), and every unit is segmented by an agenda of candidate merges, best score first, then
leftmost. A candidate taken from the agenda is skipped for good when a hash keyed by (seed,
document, place of the unit, place of the merge) falls below ``dropout``, so every occurrence of a word has
draws of its own, and reruns agree. With ``dropout`` 0 the ids are those of the sentencepiece library.

The agenda of a unit is the same for all its occurrences up to the first skip. What is remembered are therefore
its runs: for a unit and the set of turns that were skipped, the candidates taken after the last skip and
the ids it ends with. An occurrence hashes the candidates of the run without skips; where one falls, it goes on with
the run that skips it, and so on. Runs are made when an occurrence first needs them.

The model file is read once on the driver and shipped with the tasks (half a megabyte).
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark.sql import DataFrame

SPACE = "▁"
DROPOUT = 0.1
CACHED_RUNS = 1_200_000
VECTOR_LENGTH = 48
# Turns of an agenda that a run's set of skips can name; units that take more are segmented one occurrence at a time.
MOST_TURNS = 62
# Texts are segmented together until they have so many bytes.
GROUP_BYTES = 2_000_000
_NONE = np.int32(2**31 - 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wrapping arithmetic)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def _hash_bytes(data: bytes) -> int:
    return zlib.crc32(data) << 32 | zlib.crc32(data, 0x9E3779B9)


class Segmenter:
    """Units to ids and ids to bytes for one BPE model with byte fallback."""

    def __init__(self, model: bytes, dropout: float = DROPOUT, seed: int = 0):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in normal):
            raise ValueError("the model has pieces with a space inside")
        self.ids = {pieces[i]: i for i in normal}
        bytes_of = {int(pieces[i][3:-1], 16): i for i in range(n) if sp.is_byte(i)}
        if len(bytes_of) != 256:
            raise ValueError("the model has no byte fallback")
        self.bytes_of = bytes_of
        order = sorted(normal, key=lambda i: -sp.get_score(i))
        self.rank = {i: r for r, i in enumerate(order)}
        # every way to make a piece of two, as sorted keys for vector look-up
        pairs = {}
        for i in normal:
            p = pieces[i]
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * n + b] = i
        self.pairs, self.size = pairs, n
        self.piece_of_rank = np.array(order, dtype=np.int32)
        # open addressing; an empty slot has the key of no pair and the rank of none
        self.slot_bits = max(8, (4 * len(pairs)).bit_length())
        self.slot_keys = np.full(1 << self.slot_bits, -1, np.int32 if n * n < 2**31 else np.int64)
        self.slot_ranks = np.full(1 << self.slot_bits, _NONE, np.int32)
        keys, ranks = np.array(list(pairs), dtype=np.int64), np.array([self.rank[m] for m in pairs.values()], dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):
            own = np.unique(np.where(self.slot_keys[slot] == -1, slot, -1), return_index=True)[1]
            own = own[self.slot_keys[slot[own]] == -1]
            self.slot_keys[slot[own]], self.slot_ranks[slot[own]] = keys[own], ranks[own]
            rest = np.setdiff1d(np.arange(len(keys)), own)
            keys, ranks, slot = keys[rest], ranks[rest], (slot[rest] + 1) & ((1 << self.slot_bits) - 1)
        self.limit = int(dropout * 2.0**64) if dropout else 0
        self.seed = seed
        # code point -> piece, or -1 - code point; a space stands for the space mark, which itself goes by bytes
        self.chars = -1 - np.arange(0x110000, dtype=np.int32)
        for i in normal:
            if len(pieces[i]) == 1:
                self.chars[ord(pieces[i])] = i
        self.chars[ord(" ")], self.chars[ord(SPACE)] = self.ids.get(SPACE, -1 - ord(" ")), -1 - ord(SPACE)
        self.raw = [b""] * n
        for i in normal:
            self.raw[i] = pieces[i].replace(SPACE, " ").encode("utf-8")
        for value, i in bytes_of.items():
            self.raw[i] = bytes([value])

    # -- one unit ---------------------------------------------------------------

    @staticmethod
    def points(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")

    @staticmethod
    def place_of(i, j, stop) -> np.ndarray:
        """What a hash knows of a candidate: where its left part, its right part and its end are."""
        i, j, stop = (np.asarray(x).astype(np.uint64) for x in (i, j, stop))
        with np.errstate(over="ignore"):
            return mix64(((i << np.uint64(42)) ^ (j << np.uint64(21)) ^ stop) + np.uint64(0x9E3779B97F4A7C15))

    def skipped(self, places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Whether occurrences with these keys skip the candidates at these places."""
        return mix64(places ^ keys) < np.uint64(self.limit)

    def scalar(self, unit: str, key: int = 0) -> list[int]:
        """The agenda for one occurrence of a unit; any length."""
        points = self.points(unit)
        sym = self.chars[points].tolist()
        n, key = len(sym), np.array([key], dtype=np.uint64)
        nxt, prv, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = nxt[i]
            if i >= 0 and j < n and sym[i] >= 0 and sym[j] >= 0:
                m = self.pairs.get(sym[i] * self.size + sym[j])
                if m is not None:
                    heapq.heappush(agenda, (self.rank[m], i, j, end[j], m))

        for i in range(n - 1):
            offer(i)
        alive = [True] * n
        while agenda:
            _, i, j, stop, m = heapq.heappop(agenda)
            if not (alive[i] and alive[j] and nxt[i] == j and end[j] == stop):
                continue
            if self.limit and self.skipped(self.place_of([i], [j], [stop]), key)[0]:
                continue
            sym[i], end[i], alive[j] = m, stop, False
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            if prv[i] >= 0:
                offer(prv[i])
            offer(i)
        return self.spell([s for s, a in zip(sym, alive, strict=True) if a])

    def spell(self, symbols: list[int]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            if s >= 0:
                out.append(s)
            else:
                out += [self.bytes_of[b] for b in chr(-1 - s).encode("utf-8", "surrogatepass")]
        return out

    # -- many units at once -----------------------------------------------------

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def _offers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of what each two symbols make, or ``_NONE``."""
        key = a.astype(np.int64) * self.size + b
        key[(a < 0) | (b < 0)] = -1
        slot = self._slot(key)
        found = self.slot_keys[slot]
        more = np.flatnonzero((found != key) & (found != -1))
        while len(more):
            slot[more] = (slot[more] + 1) & ((1 << self.slot_bits) - 1)
            found = self.slot_keys[slot[more]]
            more = more[(found != key[more]) & (found != -1)]
        return self.slot_ranks[slot]

    def vector(self, units: list[str], masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same agenda run for many short units side by side, one turn of each at a time.

        Bit t of a unit's mask skips the candidate of its turn t. Returns the ids of all units on end and how many each has, and
        for every unit and turn the candidate's place (one row a unit) and the number of turns.
        """
        rows = len(units)
        size = np.fromiter(map(len, units), np.int64, rows)
        width = int(size.max())
        if width >= 64 or len(self.piece_of_rank) >= 2**24:
            raise ValueError("the units are too long or the pieces too many for one agenda in numbers")
        # one column for each unit: a symbol's place in flat arrays is its place in the unit * rows + the unit
        row = np.repeat(np.arange(rows), size)
        col = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        sym = np.full((width + 1) * rows, -1, np.int32)
        sym[col * rows + row] = self.chars[self.points("".join(units))]
        cols = np.repeat(np.arange(width + 1, dtype=np.int32), rows)
        nxt, prv, end = cols + 1, cols - 1, cols + 1
        alive = (cols.reshape(-1, rows) < size).ravel()
        # best first, then leftmost: the rank and the place in one number
        agenda = np.full((width + 1) * rows, _NONE, np.int32)

        def offer(at: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            rank = self._offers(left, right)
            agenda[at] = np.where(rank == _NONE, _NONE, rank << 6 | place)

        offer(slice(0, width * rows), cols[:width * rows], sym[:width * rows], sym[rows:])
        taken: list[np.ndarray] = []
        turns = np.zeros(rows, np.int64)
        while True:
            best = agenda.reshape(-1, rows).min(axis=0)
            act = np.flatnonzero(best != _NONE)
            if not len(act):
                break
            best = best[act]
            i = best & 63
            at = i.astype(np.int64) * rows + act
            j = nxt[at]
            right = j.astype(np.int64) * rows + act
            stop = end[right]
            if self.limit:
                turn = len(taken)
                places = np.zeros(rows, np.uint64)
                places[act] = self.place_of(i, j, stop)
                taken.append(places)
                turns[act] = turn + 1
                if turn < 64:
                    skip = (masks[act] >> np.uint64(turn)) & np.uint64(1) != 0
                    if skip.any():
                        agenda[at[skip]] = _NONE
                        keep = ~skip
                        act, best, i, at, right, stop = act[keep], best[keep], i[keep], at[keep], right[keep], stop[keep]
            made = self.piece_of_rank[best >> 6]
            sym[at], end[at] = made, stop
            alive[right] = False
            agenda[right] = _NONE
            after = nxt[right]
            nxt[at] = after
            beyond = after.astype(np.int64) * rows + act
            prv[beyond] = i
            offer(at, i, made, sym[beyond])
            before = prv[at]
            has = np.flatnonzero(before >= 0)
            before = before[has]
            left = before.astype(np.int64) * rows + act[has]
            offer(left, before, sym[left], made[has])
        alive = np.ascontiguousarray(alive.reshape(-1, rows).T)
        counts = alive.sum(axis=1)
        flat = sym.reshape(-1, rows).T[alive]
        if (flat < 0).any():
            spelled = {k: self.spell([int(flat[k])]) for k in np.flatnonzero(flat < 0).tolist()}
            repeats = np.ones(len(flat), np.int64)
            repeats[list(spelled)] = list(map(len, spelled.values()))
            counts = np.bincount(np.repeat(np.arange(rows), counts), repeats, rows).astype(np.int64)
            begins = np.cumsum(repeats) - repeats
            flat = np.repeat(flat, repeats)
            for k, ids in spelled.items():
                flat[begins[k]:begins[k] + len(ids)] = ids
        return flat, counts, np.array(taken, dtype=np.uint64).reshape(len(taken), rows).T, turns

    # -- whole texts ------------------------------------------------------------

    @staticmethod
    def units(text: str) -> list[str]:
        """The text with a space before it, cut before every run of spaces."""
        parts = text.split(" ")
        if "" not in parts:
            return [" " + p for p in parts]
        return re.findall(r" +[^ ]*", " " + text) if text else []

    def decode(self, ids) -> str:
        data = b"".join(map(self.raw.__getitem__, ids))
        return data[1:].decode("utf-8", "surrogatepass") if data[:1] == b" " else data.decode("utf-8", "surrogatepass")


class Runs:
    """What a worker remembers of agendas: runs by unit and skipped turns, in flat arrays (a hundred bytes a run)."""

    def __init__(self, segmenter: Segmenter, most: int = CACHED_RUNS):
        self.segmenter, self.most = segmenter, most
        self.root: dict[str, int] = {}  # -1: no runs, by occurrence
        self.texts: list[str] = []  # of the units, in the order of their runs without skips
        self.n = self.n_places = self.n_ids = 0
        self.unit, self.mask = np.zeros(1024, np.int32), np.zeros(1024, np.uint64)
        self.first = np.zeros(1024, np.uint8)  # the turn that a run's candidates begin at
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.uint8)
        self.ids_start, self.ids_size = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        # candidates of all runs, and the run that skips each (0: not made, -1: none, by occurrence)
        self.places, self.child = np.zeros(4096, np.uint64), np.zeros(4096, np.int32)
        self.ids = np.zeros(4096, np.int32)

    def keep(self, n: int) -> None:
        """Forget all but the first ``n`` runs: what came first is met most, and a run comes after the one it branches from."""
        self.n, self.n_places, self.n_ids = n, int(self.start[n]), int(self.ids_start[n])
        self.texts = self.texts[:int(self.unit[:n].max()) + 1]
        self.root = {k: r for k, r in self.root.items() if 0 <= r < n}
        self.child[self.child >= n] = 0
        self.child[self.n_places:] = 0

    def _room(self, n: int, *names: str) -> None:
        for name in names:
            old = getattr(self, name)
            if n > len(old):
                new = np.zeros(max(n, len(old) + len(old) // 2), old.dtype)
                new[:len(old)] = old
                setattr(self, name, new)

    def _add(self, texts: list[str], units: np.ndarray | None, masks: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Make runs (of new units without ``units``); returns their numbers, -1 for units that take too many turns."""
        numbers = np.full(len(texts), -1, np.int64)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(lengths, kind="stable")
        order = order[:np.searchsorted(lengths[order], VECTOR_LENGTH, "right")]
        for begin in range(0, len(order), 16_384):
            batch = order[begin:begin + 16_384]
            own = [texts[k] for k in batch.tolist()]
            ids, counts, taken, turns = self.segmenter.vector(own, masks[batch])
            first = firsts[batch]
            keep = turns <= MOST_TURNS
            sizes = np.where(keep, np.maximum(turns - first, 0), 0)
            column = np.arange(taken.shape[1])
            new = taken[(column >= first[:, None]) & (column < (first + sizes)[:, None])] if taken.size else np.zeros(0, np.uint64)
            n, m = self.n, self.n + len(batch)
            self._room(m, "unit", "mask", "first", "start", "size", "ids_start", "ids_size")
            self._room(self.n_places + len(new), "places", "child")
            self._room(self.n_ids + len(ids), "ids")
            self.places[self.n_places:self.n_places + len(new)] = new
            self.ids[self.n_ids:self.n_ids + len(ids)] = ids
            self.start[n:m], self.size[n:m], self.first[n:m] = self.n_places + np.cumsum(sizes) - sizes, sizes, first
            self.ids_start[n:m], self.ids_size[n:m] = self.n_ids + np.cumsum(counts) - counts, counts
            self.mask[n:m] = masks[batch]
            self.unit[n:m] = np.arange(len(self.texts), len(self.texts) + len(batch)) if units is None else units[batch]
            if units is None:
                self.texts += own
            self.n, self.n_places, self.n_ids = m, self.n_places + len(new), self.n_ids + len(ids)
            numbers[batch] = np.where(keep, np.arange(n, m), -1)
        return numbers

    def flat(self, units: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all occurrences of units, each by its key, on end; and how many each has."""
        if self.n > self.most:
            self.keep(self.most // 2)
        limit = self.segmenter.limit
        if not limit:
            keys = np.zeros(len(units), np.uint64)
        found = list(map(self.root.get, units))
        if None in found:
            missing = list(dict.fromkeys(u for u, x in zip(units, found, strict=True) if x is None))
            made = self._add(missing, None, np.zeros(len(missing), np.uint64), np.zeros(len(missing), np.int64))
            self.root.update(zip(missing, made.tolist(), strict=True))
            found = list(map(self.root.__getitem__, units))
        run = np.array(found, dtype=np.int64)
        active = np.flatnonzero(run >= 0) if limit else np.empty(0, np.int64)
        while len(active):
            now = run[active]
            sizes = self.size[now].astype(np.int64)
            ends = np.cumsum(sizes)
            at = np.arange(int(ends[-1])) + np.repeat(self.start[now] - (ends - sizes), sizes)
            skip = np.flatnonzero(self.segmenter.skipped(self.places[at], np.repeat(keys[active], sizes)))
            row = np.searchsorted(ends, skip, "right")
            new = np.flatnonzero(np.diff(row, prepend=-1))  # the first skip of each
            active, now, at = active[row[new]], now[row[new]], at[skip[new]]
            going = self.child[at]
            if len(going) and not going.all():
                places, k = np.unique(np.where(going == 0, at, -1), return_index=True)
                places, k = (places[1:], k[1:]) if places[0] < 0 else (places, k)
                parent = now[k]
                turn = self.first[parent] + (places - self.start[parent])
                self.child[places] = self._add([self.texts[u] for u in self.unit[parent].tolist()], self.unit[parent],
                                                self.mask[parent] | np.uint64(1) << turn.astype(np.uint64), turn + 1)
                going = self.child[at]
            run[active] = going
            active = active[going >= 0]
        slow = np.flatnonzero(run < 0)
        begins, sizes = self.ids_start[run], self.ids_size[run].astype(np.int64)
        alone = [self.segmenter.scalar(units[k], int(keys[k])) for k in slow.tolist()]
        begins[slow], sizes[slow] = 0, list(map(len, alone))
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        self._room(max(sizes[slow], default=0), "ids")
        out = self.ids[np.arange(total) + np.repeat(begins - (ends - sizes), sizes)]
        for k, ids in zip(slow.tolist(), alone, strict=True):
            out[ends[k] - sizes[k]:ends[k]] = ids
        return out, sizes

    def segment(self, units: list[str], keys: np.ndarray) -> list[bytes]:
        """The ids of every occurrence of a unit, by its key."""
        return _split(*self.flat(units, keys))


def _split(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    data, ends = ids.astype("<i4").tobytes(), 4 * np.cumsum(sizes)
    return [data[a:b] for a, b in zip((ends - 4 * sizes).tolist(), ends.tolist(), strict=True)]


_CACHES: dict[tuple, Runs] = {}


def _worker(model: bytes, dropout: float, seed: int) -> Runs:
    name = (zlib.crc32(model), len(model), dropout, seed)
    if name not in _CACHES:
        _CACHES.clear()
        _CACHES[name] = Runs(Segmenter(model, dropout, seed))
    return _CACHES[name]


def _encode_flat(texts: list[str], keys: np.ndarray, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts on end, and how many each has."""
    units = [runs.segmenter.units(t) for t in texts]
    sizes = np.array(list(map(len, units)), dtype=np.int64)
    ends = np.cumsum(sizes)
    with np.errstate(over="ignore"):
        places = (np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        own = mix64(places + np.repeat(keys, sizes))
    ids, counts = runs.flat([u for t in units for u in t], own)
    until = np.concatenate(([0], np.cumsum(counts)))
    return ids, until[ends] - until[ends - sizes]


def _encode_batch(texts: list[str], keys: np.ndarray, runs: Runs) -> list[bytes]:
    return _split(*_encode_flat(texts, keys, runs))


def encode_documents(docs: DataFrame, model: bytes, dropout: float = DROPOUT, seed: int = 0) -> DataFrame:
    """``doc_id, ids, n_pieces, lossless`` for every row of ``docs``.

    ``lossless`` says that decoding ``ids`` gave the text back. Null text counts as empty and has no
    pieces. Rows with equal id and text get equal ids, but for copies that follow each other directly (as the mixing
    operator makes them): each has its own number in the key. Very long units take the agenda one at a time.
    Further columns take no part; an empty table gives no rows.
    """

    def run(batches):
        runs = _worker(model, dropout, seed)
        last, copy = None, 0
        for whole in batches:
            # keeps found segments of few texts at a time
            lengths = pa.compute.fill_null(pa.compute.binary_length(whole.column("text")), 0).to_numpy(zero_copy_only=False)
            groups = np.cumsum(lengths) // GROUP_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), whole.num_rows]
            for at, size in ((i, j - i) for i, j in zip(cuts, cuts[1:], strict=False) if j > i):
                batch = whole.slice(at, size)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                numbers = []
                for row in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                    copy = copy + 1 if row == last else 0
                    last = row
                    numbers.append(_hash_bytes(str(row[0]).encode()) + (copy << 17) * 0x9E3779B1 + seed)
                keys = mix64(np.array([x % 2**64 for x in numbers], dtype=np.uint64))
                flat, sizes = _encode_flat(texts, keys, runs)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                same = [runs.segmenter.decode(flat[a:b].tolist()) == t for a, b, t in zip(ends[:-1], ends[1:], texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                     pa.array(sizes), pa.array(same)], names=["doc_id", "ids", "n_pieces", "lossless"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, n_pieces long, lossless boolean")
