"""Main text of web pages, with a suffix array over the token streams of each host's pages.

Pages are cut into blocks. The streams of a group of pages of one host, with a mark at every block
boundary, are joined and their suffixes sorted by rank doubling up to ``min_tokens`` tokens; neighbours
that agree that far are a repeated substring. One that stands on ``SHARE`` of the host's pages (``ARTICLE_SHARE``
inside an article) is common, near-equal pages counted once by their sketches. A block covered whole by common
substrings, its marks too, is boilerplate; so is the beginning or end of a plain block that is, by itself, a common block.
All other blocks are kept, those of the article only where the page has one. A host of several groups has its groups' suffix
arrays merged: equal runs of suffixes meet by a hash of their first ``min_tokens`` tokens.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import materialise

GROUP_PAGES = 128
MIN_TOKENS = 6
SHARE, ARTICLE_SHARE, LEAST_PAGES = 0.02, 0.5, 3
SENT_RUNS = 1 << 18
BANDS, BAND_ROWS = 8, 16

# Elements and attribute words by what they hold.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "canvas", "audio", "video"}
BOILERPLATE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "label", "fieldset"}
ARTICLE = {"article", "main"}
BLOCKS = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
             "head header hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = BLOCKS - set("p li dt dd h1 h2 h3 h4 h5 h6 hr option tr td th tbody thead tfoot caption".split()) | {"button", "label"}
MARKS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs cookie "
            "cookies consent notice notices banner popup modal overlay newsletter subscribe share sharing social related comment comments disqus replies footer "
            "masthead toolbar login signup search pagination pager skip".split())
# A class name or id is a mark as a whole, by its first part, or by its last part after a word of place; a word of state makes it a flag of the page.
PLACES = set("site main page global top bottom left right primary secondary header inner outer mobile desktop post entry article js c u".split())
STATES = set("no not non with without has have is open opened closed enabled disabled on off active visible hidden collapsed expanded".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_SPECIAL = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[^\W\d_]+")


def _is_mark(name: str) -> bool:
    parts = _PARTS.findall(name)
    if not parts or not STATES.isdisjoint(parts):
        return False
    return parts[0] in MARKS or parts[-1] in MARKS and all(p in PLACES or p in MARKS for p in parts)


def _marked(attributes: str) -> bool:
    if "=" not in attributes:
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found = (a or b or c).lower().split()
        if not ROLES.isdisjoint(found) if name.lower() == "role" else any(map(_is_mark, found)):
            return True
    return False


class Scanner:
    """The tags of a page, by one forward scan: its time grows with the page, whatever the page holds.

    A tag ends at the first ``>`` outside quotes or, where its quotes do not close, at the first ``>``. A ``<`` that
    begins no tag is text. Where quoted parts lead is remembered by where they begin, so no part is walked twice.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.quoted: dict[int, int] = {}
        self.closers = {"-->": 0, "--!>": 0}

    def _next(self, what: str, at: int) -> int:
        """Where ``what`` comes next, -1 if nowhere; ``at`` only grows, so it is looked for once."""
        if 0 <= self.closers[what] < at:
            self.closers[what] = self.page.find(what, at)
        return self.closers[what]

    def _tag_end(self, at: int) -> int:
        """The place of the ``>`` that ends a tag whose attributes begin at ``at``."""
        page, chain, p = self.page, [], at
        while True:
            m = _SPECIAL.search(page, p)
            if m is None:
                found = -1
            elif m[0] == ">":
                found = m.start()
            else:
                found = self.quoted.get(m.start())
                if found is None:
                    chain.append(m.start())
                    close = page.find(m[0], m.end())
                    if close >= 0:
                        p = close + 1
                        continue
                    found = -1
            for s in chain:
                self.quoted[s] = found
            return found if found >= 0 else page.find(">", at)

    def piece(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """The next tag, comment or declaration from ``at``: (start, end, name or '', whether it ends an element, attributes)."""
        page = self.page
        while (i := page.find("<", at)) >= 0:
            if page.startswith("<!--", i):
                for short in (">", "->"):
                    if page.startswith(short, i + 4):
                        return i, i + 4 + len(short), "", False, ""
                ends = [(j, j + len(c)) for c in self.closers if (j := self._next(c, i + 4)) >= 0]
                return i, min(ends)[1] if ends else len(page), "", False, ""
            if i < self.last:
                if m := _NAME.match(page, i):
                    stop = self._tag_end(m.end())
                    return i, stop + 1, m[2].lower(), bool(m[1]), page[m.end():stop]
                if page[i + 1] in "!?/":
                    return i, page.index(">", i + 2) + 1, "", False, ""
                at = i + 1
            else:  # only a comment can begin without a closing mark behind it
                at = page.find("<!--", i)
                if at < 0:
                    return None
        return None


def blocks(page: str | None) -> list[tuple[str, int]]:
    """(text, kind) of a page's blocks in order; kind 2: in the article, 1: plain, 0: boilerplate by its markup.

    An article below a form or a marked element counts where the page has no article element outside of such.
    """
    page = page or ""
    out, held, stack = [], [], []  # stack: (element, kind before); kind -1: below a form or mark, 3: in an article or main below one, 4: in an article
    kind, at, scanner, opened = 1, 0, Scanner(page), Counter()

    def close() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((text, kind))
            held.clear()

    while found := scanner.piece(at):
        start, end, name, ending, attributes = found
        if start > at:
            held.append(page[at:start])
        at = end
        if not name:
            continue
        if name in RAW:
            if not ending and not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at, scanner.last + 1)
                at = stop.end() if stop else len(page)
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in BLOCKS:
            close()
        if name not in CONTAINERS:
            if not ending and name in BLOCKS and _marked(attributes) and kind > 0:
                stack.append((name, kind))
                opened[name] += 1
                kind = -1
            elif ending and stack and stack[-1][0] == name:
                kind = stack.pop()[1]
                opened[name] -= 1
            continue
        if ending:
            if opened[name]:
                while True:
                    element, before = stack.pop()
                    opened[element] -= 1
                    if element == name:
                        break
                close()
                kind = before
            continue
        close()
        stack.append((name, kind))
        opened[name] += 1
        if not kind:
            continue
        if name in BOILERPLATE and name != "form" or name == "header" and kind < 2:
            kind = 0
        elif name == "form" or name != "body" and name != "html" and _marked(attributes):
            kind = -1
        elif name in ARTICLE:
            kind = 3 if kind in (-1, 3) else 4 if name == "article" or kind == 4 else 2
    held.append(page[at:])
    close()
    below = 0 if any(kind == 4 for _, kind in out) else 2
    return [(text, below if kind == 3 else min(max(kind, 0), 2)) for text, kind in out]


def stream(page: list[tuple[str, int]]) -> tuple[list[str | None], list[int]]:
    """A page's tokens, with None at every block boundary, and where each block begins."""
    tokens, begin = [None], []
    for text, _ in page:
        begin.append(len(tokens))
        tokens += text.split(" ")
        tokens.append(None)
    return tokens, begin


def numbered(streams: list[list[str | None]]) -> list[np.ndarray]:
    ids: dict[str | None, int] = {None: 0}
    return [np.array([ids.setdefault(t, len(ids)) for t in s], dtype=np.int64) for s in streams]


def suffix_array(streams: list[np.ndarray], min_tokens: int = MIN_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of the joined streams by their first ``min_tokens`` tokens, where each run of equal ones begins, and the page of each position."""
    # a mark of its own ends every page, so no substring spans two
    top = max((int(s.max()) for s in streams if len(s)), default=0) + 1
    joined = np.concatenate([np.append(s, top + k) for k, s in enumerate(streams)]) if streams else np.empty(0, np.int64)
    page = np.repeat(np.arange(len(streams)), [len(s) + 1 for s in streams])
    n = len(joined)
    _, rank = np.unique(joined, return_inverse=True)
    length = 1
    while length < min_tokens:  # rank of each suffix by its first `length` tokens
        step = min(length, min_tokens - length)
        after = np.full(n, -1, np.int64)
        after[:n - step] = rank[step:]
        key = rank.astype(np.int64) * (n + 1) + after + 1
        suffixes = np.argsort(key, kind="stable")
        ordered = key[suffixes]
        rank = np.empty(n, np.int64)
        rank[suffixes] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1])) if n else 0
        length += step
    suffixes = np.argsort(rank, kind="stable")
    ordered = rank[suffixes]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if n else np.empty(0, np.int64)
    return suffixes, starts, page


def grown(shared: np.ndarray, min_tokens: int) -> np.ndarray:
    """The positions within ``min_tokens`` from a marked one."""
    steps = np.zeros(len(shared) + min_tokens, np.int64)
    at = np.flatnonzero(shared)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + min_tokens, -1)
    return np.cumsum(steps)[:len(shared)] > 0


def covered(streams: list[np.ndarray], min_tokens: int = MIN_TOKENS, counts: np.ndarray | None = None, least: int = 2) -> list[np.ndarray]:
    """For each page's token ids, which tokens lie in a substring of ``min_tokens`` or more that ``least`` of the pages that count have."""
    array = suffix_array(streams, min_tokens)
    return covered_by(streams, array, page_counts(*array, np.ones(len(streams), bool) if counts is None else counts), least, min_tokens)


def page_counts(suffixes: np.ndarray, starts: np.ndarray, page: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """On how many of the pages that count each run of equal suffixes stands."""
    if not len(suffixes):
        return np.empty(0, np.int64)
    pages = page[suffixes]  # ascending within a run
    fresh = np.append(True, pages[1:] != pages[:-1])
    fresh[starts] = True
    return np.add.reduceat((fresh & counts[pages]).astype(np.int64), starts)


def covered_by(streams: list[np.ndarray], array, found: np.ndarray, least: int, min_tokens: int) -> list[np.ndarray]:
    suffixes, starts, _ = array
    shared = np.zeros(len(suffixes), bool)
    shared[suffixes] = np.repeat(found >= least, np.diff(np.append(starts, len(suffixes))))
    marks = grown(shared, min_tokens)
    out, at = [], 0
    for s in streams:
        out.append(marks[at:at + len(s)])
        at += len(s) + 1
    return out


def needed(n_pages: int, share: float) -> int:
    return max(LEAST_PAGES, math.ceil(share * n_pages))


def is_open(page: list[tuple[str, int]]) -> bool:
    """Whether repeats of ``SHARE`` decide on a page's text: it has plain blocks and no article."""
    kinds = {kind for _, kind in page}
    return 1 in kinds and 2 not in kinds


def kept_text(page: list[tuple[str, int]], begin: list[int], marks: np.ndarray, article_marks: np.ndarray, common, min_tokens: int = MIN_TOKENS) -> str:
    """The main text of a page; ``common`` tells whether a text is a common block."""
    has_article = any(kind == 2 for _, kind in page)
    kept = []
    for (text, kind), at in zip(page, begin, strict=True):
        if not kind or has_article and kind != 2:
            continue
        words = text.split(" ")
        n = len(words)
        own = (article_marks if kind == 2 else marks)[at - 1:at + n + 1]
        if own.all():
            continue
        if kind == 1:
            head = int(own.argmin()) - 1  # words covered from the mark on
            first = next((k for k in range(head, min_tokens - 1, -1) if common(" ".join(words[:k]))), 0)
            tail = int(own[::-1].argmin()) - 1
            last = next((k for k in range(min(tail, n - first), min_tokens - 1, -1) if common(" ".join(words[n - k:]))), 0)
            text = " ".join(words[first:n - last])
        if text:
            kept.append(text)
    return "\n".join(kept)


def common_candidates(page: list[tuple[str, int]], min_tokens: int = MIN_TOKENS) -> set[str]:
    """The texts of a page's blocks that are long enough to be found in other blocks."""
    return {text for text, _ in page if text.count(" ") + 1 >= min_tokens}


# -- near-equal pages --------------------------------------------------------------


def hashed(tokens: list[str | None]) -> np.ndarray:
    known: dict[str | None, int] = {None: 0}
    for t in tokens:
        if t not in known:
            known[t] = xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"))
    return np.fromiter((known[t] for t in tokens), np.uint64, len(tokens))


def rolled(own: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A hash of the ``length`` tokens from each position that has so many."""
    n = max(0, len(own) - length + 1)
    out = np.full(n, seed, np.uint64)
    for k in range(length):
        out = (out ^ own[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def name_of(page: str | None) -> int:
    """A page's name: a hash of its html (null is empty)."""
    return xxhash.xxh64_intdigest((page or "").encode("utf-8", "surrogatepass")) - 2**63


def sketch(page: list[tuple[str, int]]) -> list[int]:
    """``BANDS`` hashes of a page's text, markup boilerplate left out; pages that agree in one are near-equal.

    Least hashes of the token triples in 64 classes, in bands of neighbouring classes and of distant ones: pages with
    95% of their triples in common agree in some band almost surely, pages with half of them hardly ever.
    """
    tokens = stream([b for b in page if b[1]])[0]
    triples = rolled(hashed(tokens + [None, None]), 3, 0)
    triples = triples * np.uint64(0xD6E8FEB86659FD93)
    least = np.full(BANDS * BAND_ROWS // 2, 2**64 - 1, np.uint64)
    np.minimum.at(least, (triples >> np.uint64(32)) % np.uint64(len(least)), triples)
    return [xxhash.xxh64_intdigest(band.tobytes()) - 2**63 for band in (*least.reshape(-1, BAND_ROWS), *least.reshape(BAND_ROWS, -1).T)]


def counting(names: list[int], sketches: list[list[int]]) -> np.ndarray:
    """Which pages count: those with the least name among all that share a band with them."""
    least: dict[tuple[int, int], int] = {}
    for name, bands in zip(names, sketches, strict=True):
        for key in enumerate(bands):
            least[key] = min(name, least.get(key, name))
    return np.array([all(least[key] == name for key in enumerate(bands)) for name, bands in zip(names, sketches, strict=True)], dtype=bool)


def main_texts(pages: list[str | None], min_tokens: int = MIN_TOKENS) -> list[str]:
    """The main text of each page of a host (equal pages given once)."""
    found = [blocks(p) for p in pages]
    streams = [stream(p) for p in found]
    ids = numbered([s for s, _ in streams])
    counts = counting([name_of(p) for p in pages], [sketch(p) for p in found])
    n = int(counts.sum())
    array = suffix_array(ids, min_tokens)
    runs = page_counts(*array, counts)
    marks = covered_by(ids, array, runs, needed(n, SHARE), min_tokens)
    article_marks = covered_by(ids, array, runs, needed(n, ARTICLE_SHARE), min_tokens)
    on = Counter(t for p, c in zip(found, counts, strict=True) if c for t in common_candidates(p, min_tokens))
    least = needed(n, SHARE)
    return [kept_text(p, begin, m, a, lambda t: on[t] >= least, min_tokens)
            for p, (_, begin), m, a in zip(found, streams, marks, article_marks, strict=True)]


# -- hosts of several groups -------------------------------------------------------


def run_hashes(tokens: list[str | None], host: str, min_tokens: int = MIN_TOKENS) -> np.ndarray:
    """A hash of the ``min_tokens`` tokens from each position that has so many, and of the host."""
    return rolled(hashed(tokens), min_tokens, xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass"))).view(np.int64)


def block_hash(text: str, host: str) -> int:
    """A whole block's hash, and the host's."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass"))) - 2**63


def page_hashes(page: list[tuple[str, int]], host: str, min_tokens: int) -> np.ndarray:
    """All runs and long blocks of a page, each once."""
    long = [block_hash(t, host) for t in common_candidates(page, min_tokens)]
    return np.unique(np.append(run_hashes(stream(page)[0], host, min_tokens), np.array(long, dtype=np.int64)))


def _sketches(batches):
    for pdf in batches:
        found = [blocks(h) for h in pdf["html"]]
        names = np.repeat([name_of(h) for h in pdf["html"]], BANDS)
        bands = [band for page in found for band in sketch(page)]
        yield pd.DataFrame({"host": np.repeat(pdf["host"].to_numpy(object), BANDS), "name": names, "band": np.tile(np.arange(BANDS), len(pdf)), "value": bands,
                            "open": np.repeat([is_open(page) for page in found], BANDS)})


def _group_runs(min_tokens: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The runs and blocks that stand on enough of a group's pages to be common on the host."""
        host, least = pdf["host"].iloc[0], pdf["need"].iloc[0] / pdf["groups"].iloc[0]
        found = [blocks(h) for h in dict.fromkeys(h or "" for h in pdf["html"])]
        streams = [stream(p)[0] for p in found]
        array = suffix_array(numbered(streams), min_tokens)
        suffixes, starts, _ = array
        # positions too near a page's end have no full run
        hashes, whole, at = np.zeros(len(suffixes), np.int64), np.zeros(len(suffixes), bool), 0
        for s in streams:
            own = run_hashes(s, host, min_tokens)
            hashes[at:at + len(own)] = own
            whole[at:at + len(own)] = True
            at += len(s) + 1
        heads = suffixes[starts]
        chosen = whole[heads] & (page_counts(*array, np.ones(len(found), bool)) >= least)
        on = Counter(t for p in found for t in common_candidates(p, min_tokens))
        runs = np.append(hashes[heads[chosen]], np.array([block_hash(t, host) for t, n in on.items() if n >= least], dtype=np.int64))
        return pd.DataFrame({"host": np.full(len(runs), host, object), "run": runs})

    return run


def _page_runs(min_tokens: int):
    def run(pdf: pd.DataFrame, wanted: np.ndarray) -> pd.DataFrame:
        """Which pages have which of a host's candidates."""
        names, runs, host = [], [], pdf["host"].iloc[0]
        for page in dict.fromkeys(h or "" for h in pdf["html"]) if len(wanted) else ():
            own = page_hashes(blocks(page), host, min_tokens)
            own = own[_among(own, wanted)]
            runs.append(own)
            names.append(np.full(len(own), name_of(page), np.int64))
        n = sum(map(len, runs))
        return pd.DataFrame({"host": np.full(n, host, object), "name": np.concatenate([np.empty(0, np.int64), *names]), "run": np.concatenate([np.empty(0, np.int64), *runs])})

    return run


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _finish(min_tokens: int):
    def run(pdf: pd.DataFrame, common: np.ndarray, most: np.ndarray) -> pd.DataFrame:
        host, text_of = pdf["host"].iloc[0], {}
        known = set(common.tolist())
        for text in dict.fromkeys(h or "" for h in pdf["html"]):
            page = blocks(text)
            tokens, begin = stream(page)
            marks = [np.zeros(len(tokens), bool)] * 2
            if len(common if is_open(page) else most):
                own = run_hashes(tokens, host, min_tokens)
                found = [np.append(_among(own, runs), np.zeros(len(tokens) - len(own), bool)) for runs in (common, most)]
                marks = [grown(shared, min_tokens) for shared in found]
            text_of[text] = kept_text(page, begin, *marks, lambda t: block_hash(t, host) in known, min_tokens)
        texts = [text_of[h or ""] for h in pdf["html"]]
        return pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return run


def _with_runs(dealt: DataFrame, parts: DataFrame, runs: DataFrame, run, schema: str) -> DataFrame:
    """``run(pages of one host, arrays of its runs)`` for all of ``dealt``; ``runs`` has host, run and ``most``.

    Few runs travel with the tasks. Many are dealt to each group of their host, so no host's pages meet in one task.
    """
    if runs.count() <= SENT_RUNS:
        of: dict[str, list] = {}
        for r in runs.collect():  # SENT_RUNS at most
            of.setdefault(r["host"], []).append((r["run"], r["most"]))
        sent = dealt.sparkSession.sparkContext.broadcast({h: _arrays(x) for h, x in of.items()})

        def pages(batches):
            known = sent.value
            for pdf in batches:
                for host, part in pdf.groupby("host", sort=False):
                    yield run(part.reset_index(drop=True), *known.get(host, _arrays([])))

        return dealt.select("page_id", "url", "html", "host").mapInPandas(pages, schema)

    def group(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame()
        return run(left, *_arrays(list(zip(right["run"], right["most"], strict=True))))

    spread = runs.join(parts, "host").select("host", "part", "run", "most")
    return dealt.select("page_id", "url", "html", "host", "part").groupBy("host", "part").cogroup(spread.groupBy("host", "part")).applyInPandas(group, schema)


def _arrays(runs: list) -> tuple[np.ndarray, np.ndarray]:
    return np.array(sorted(r for r, _ in runs), dtype=np.int64), np.array(sorted(r for r, most in runs if most), dtype=np.int64)


def _merged_texts(dealt: DataFrame, parts: DataFrame, schema: str, min_tokens: int) -> DataFrame:
    """The texts of ``dealt``, the pages of hosts of several groups.

    What is common on a host stands, in one group at least, on a part of the pages it needs; so
    every group's suffix array names candidates, all the host's pages that have one of them are
    counted, and the texts are cut by what reaches its share.
    """
    least = materialise(
        dealt.select("host", "html").mapInPandas(_sketches, "host string, name long, band int, value long, open boolean")
        .groupBy("host", "band", "value").agg(F.min("name").alias("name"), F.max("open").alias("open"))
        .groupBy("host", "name").agg(F.count("*").alias("bands"), F.max("open").alias("open")), "least-pages")
    counted = least.where(F.col("bands") == BANDS).select("host", "name")  # the least name in each of its bands
    need = lambda share: F.greatest(F.lit(LEAST_PAGES), F.ceil(F.lit(share) * F.col("n"))).cast("long")
    # on a host whose pages all have an article, only what reaches the article's share matters
    needs = materialise(least.groupBy("host").agg(F.sum((F.col("bands") == BANDS).cast("long")).alias("n"), F.max("open").alias("open")).select(
        "host", F.when(F.col("open"), need(SHARE)).otherwise(need(ARTICLE_SHARE)).alias("need"), need(ARTICLE_SHARE).alias("most")), "needs")
    candidates = materialise(dealt.select("html", "host", "part", "groups").join(needs.select("host", "need"), "host").groupBy("host", "part")
                             .applyInPandas(_group_runs(min_tokens), "host string, run long").distinct().withColumn("most", F.lit(False)), "runs")
    count = _page_runs(min_tokens)
    on = _with_runs(dealt, parts, candidates, lambda pdf, wanted, _: count(pdf, wanted), "host string, name long, run long").distinct()
    sums = on.join(counted, ["host", "name"], "left_semi").groupBy("host", "run").agg(F.count("*").alias("n"))
    common = materialise(sums.join(needs, "host").where("n >= need").select("host", "run", (F.col("n") >= F.col("most")).alias("most")), "common-runs")
    return _with_runs(dealt, parts, common, _finish(min_tokens), schema)


def _extract(min_tokens: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["page_id", "url", "html"], kind="stable", na_position="last")
        pages = [h if isinstance(h, str) else "" for h in pdf["html"]]
        distinct = list(dict.fromkeys(pages))  # copies of a page are one page
        text_of = dict(zip(distinct, main_texts(distinct, min_tokens), strict=True))
        texts = [text_of[h] for h in pages]
        return pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return run


def host(url) -> F.Column:
    """The authority of a URL in lower case (null and odd URLs share the empty host)."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def extract(pages: DataFrame, group_pages: int = GROUP_PAGES, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    A host with more than ``group_pages`` pages is dealt by hash into groups of about that many, whose
    suffix arrays are merged, so the grouping changes no text. Null html is
    empty; repeated rows come as often as they stand, and equal pages count as one page; further columns take no part; an empty table gives no rows.
    """
    own = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    sizes = materialise(own.groupBy("host").agg(F.ceil(F.count("*") / group_pages).alias("groups")), "hosts")
    dealt = own.join(sizes, "host")
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    texts = dealt.where("groups = 1").groupBy("host").applyInPandas(_extract(min_tokens), schema)
    if sizes.where("groups > 1").isEmpty():
        return texts
    several = dealt.where("groups > 1").withColumn("part", F.pmod(F.xxhash64("page_id", "url", F.monotonically_increasing_id()), F.col("groups")))
    parts = sizes.where("groups > 1").select("host", F.explode(F.expr("sequence(0, groups - 1)")).alias("part"))
    return texts.unionByName(_merged_texts(several, parts, schema, min_tokens))
