"""How far the sources of a language diverge, from exact sparse count vectors.

Every document becomes a sparse vector of its terms' counts. Vectors are summed per (lang, source), the
sums per language give the document frequencies, and the vocabulary of a language is every term in at
least ``min_df`` of its documents: a count vectorizer with that minimum and no cap on its size. Its
vocabulary is a table that Spark deals by term, as it grows with the corpus; neither the driver
nor a task ever holds it whole. As the sum of vectors is linear, terms below the minimum are left out
after summing, with the same result.

A vocabulary row holds the sums of one term in all sources that have it, which is a column of the
(source x term) matrix without its zeros. Pairs of sources are evaluated on these alone: what a pair adds
where a source has no occurrence depends on the other's count only, so it comes from histograms of
counts, and common terms correct it.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import materialise

MIN_DF = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
PAIRS_AT_ONCE = 1 << 20

# UTF-8 bytes of terms, A-Z lower-cased; ASCII characters other than letters become spaces
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256))


def count_vectors(docs: DataFrame) -> DataFrame:
    """``lang, source, terms, counts``: the sparse count vector of every document.

    Terms are maximal runs of letters A-Z, a-z and characters above U+007F, with only A-Z lower-cased. Null text, lang
    and source are read as ''; a document without terms has an empty vector.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            vectors = [Counter(t.translate(_TERMS).split()) for t in batch.column(2).to_pylist()]
            ends = pa.array(np.cumsum([0, *map(len, vectors)]), pa.int32())
            terms = pa.array([t for v in vectors for t in v], pa.binary()).cast(pa.string())
            counts = pa.array([n for v in vectors for n in v.values()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, terms),
                                              pa.ListArray.from_arrays(ends, counts)], ["lang", "source", "terms", "counts"])

    return rows.mapInArrow(run, "lang string, source string, terms array<string>, counts array<long>")


def group_sums(vectors: DataFrame) -> DataFrame:
    """``lang, source, term, n, df``: the sum of a group's vectors, and in how many of its documents a term is."""
    pairs = vectors.select("lang", "source", F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    return (pairs.select("lang", "source", F.col("e.terms").alias("term"), F.col("e.counts").alias("n"))
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.count("*").alias("df")))


def vocabulary(sums: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """``lang, term, df, n, by_source``: every term in ``min_df`` documents of its language; ``by_source`` lists (source, n)."""
    return (sums.groupBy("lang", "term")
            .agg(F.sum("df").alias("df"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("by_source"))
            .where(F.col("df") >= min_df))


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + size)), exact at any count."""
    below = (F.lit((1 << 63) - 1) / F.lit(SCALE)).cast("long") - 2
    plain = F.call_function("div", (n + 1) * F.lit(SCALE), total + size)
    wide = F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), (total + size).cast("decimal(20,0)"))
    return F.lit(1).cast("long") + F.when(n < below, plain).otherwise(wide)


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); no share is above SCALE + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def term_part(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """The ``top`` terms of each group with a share above their language's, by excess."""
    entries = kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("by_source").alias("e"))
    valued = (entries.select("lang", F.col("e.source").alias("source"), "term", "lang_n", F.col("e.n").alias("n"))
              .join(groups, ["lang", "source"])
              .withColumn("p", share(F.col("n"), F.col("total"), F.col("size")))
              .withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("size")))
              .where("p > q").select("lang", "source", F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value")))
    return _ranked(valued, "term").where(F.col("rank") <= top)


def _ranked(valued: DataFrame, part: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(w).alias("rank"))


def _excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def common_terms(columns: DataFrame) -> DataFrame:
    """``lang, a, b, fix``: what the terms that both sources have add to the sum made without them.

    ``columns`` holds per term ``lang, a`` (places of the sources that have it), ``p`` (their shares) and ``zero``
    (the shares they would have without an occurrence). A task adds up pairs of places as it goes, at
    most ``PAIRS_AT_ONCE`` entries at a time.
    """
    names = ["lang", "a", "b", "fix"]

    def summed(held: list[tuple]):
        lang, a, b, fix = (np.concatenate([h[k] for h in held]) for k in range(4))
        order = np.lexsort((b, a, lang))
        lang, a, b, fix = lang[order], a[order], b[order], fix[order]
        new = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        return lang[new], a[new], b[new], np.add.reduceat(fix, new)

    def run(batches):
        codes: dict[str, int] = {}
        held: list[tuple] = []
        waiting = 0

        def out():
            spell = list(codes)
            lang, a, b, fix = summed(held)
            return pa.RecordBatch.from_arrays([pa.array([spell[x] for x in lang.tolist()], pa.string()), pa.array(a, pa.int32()),
                                               pa.array(b, pa.int32()), pa.array(fix, pa.int64())], names)

        for batch in batches:
            langs = np.array([codes.setdefault(x, len(codes)) for x in batch.column(0).to_pylist()], dtype=np.int64)
            ends = np.cumsum(np.r_[0, batch.column(1).value_lengths().to_numpy(zero_copy_only=False)])
            place, p, zero = (batch.column(k).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2, 3))
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            partners = np.diff(ends)[row]
            done = np.cumsum(partners)
            at = 0
            while at < len(row):  # entry i meets every entry of its term
                stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
                left = np.repeat(np.arange(at, stop), partners[at:stop])
                first = np.cumsum(partners[at:stop]) - partners[at:stop]
                right = np.arange(len(left)) - np.repeat(first, partners[at:stop]) + ends[row[left]]
                apart = left != right
                left, right = left[apart], right[apart]
                fix = (_excess(p[left], p[right]) - _excess(p[left], zero[right])
                       - _excess(zero[left], p[right]) + _excess(zero[left], zero[right]))
                if len(left):
                    held.append(summed([(langs[row[left]], place[left], place[right], fix)]))
                    waiting += len(held[-1][0])
                at = stop
                if waiting > PAIRS_AT_ONCE:
                    held = [summed(held)]
                    waiting = 0
                    if len(held[0][0]) > PAIRS_AT_ONCE:
                        yield out()
                        held = []
        if held:
            yield out()

    return columns.mapInArrow(run, "lang string, a int, b int, fix long").groupBy("lang", "a", "b").agg(F.sum("fix").alias("fix"))


def pair_part(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """The excess of every source over every other source of its language, summed over the vocabulary."""
    zero = share(F.lit(0).cast("long"), F.col("total"), F.col("size"))
    placed = groups.where("size > 0").withColumn("zero", zero)
    per_lang = placed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total", "zero"))).alias("all"), F.first("size").alias("size"))
    names = per_lang.select("lang", F.col("all.source").alias("names"))
    facts = F.col("all")
    # by_source in the places that the language gives its sources
    places = F.map_from_arrays(F.col("all.source"), F.sequence(F.lit(0), F.size("all") - 1))
    located = per_lang.select("lang", "all", "size", places.alias("places"))
    joined = kept.join(located, "lang")
    at = F.transform("by_source", lambda e: F.struct(F.col("places")[e["source"]].alias("a"), e["n"].alias("n")))
    joined = joined.select("lang", at.alias("own"), "all", "size")
    columns = joined.where(F.size("own") > 1).select(
        "lang", F.col("own.a").alias("a"),
        F.transform("own", lambda e: share(e["n"], facts[e["a"]]["total"], F.col("size"))).alias("p"),
        F.transform("own", lambda e: facts[e["a"]]["zero"]).alias("zero"))
    fixes = common_terms(columns)
    spelled = fixes.join(names, "lang").select(
        "lang", F.col("names")[F.col("a")].alias("source"), F.col("names")[F.col("b")].alias("item"), "fix")

    # how many terms a group has at each count, and its share there
    entries = kept.select("lang", F.explode("by_source").alias("e")).select("lang", "e.source", "e.n")
    counts = entries.groupBy("lang", "source", "n").agg(F.count("*").alias("terms"))
    bars = counts.join(placed, ["lang", "source"]).select(
        "lang", "source", "terms", share(F.col("n"), F.col("total"), F.col("size")).alias("p"), "zero")
    # only the zero shares of the other sources matter, and those with the same one share a row
    others = placed.select("lang", F.col("zero").alias("other_zero")).distinct()
    met = bars.join(others, "lang")
    over = met.groupBy("lang", "source", "other_zero").agg(
        F.sum("terms").alias("terms"),
        F.sum(F.col("terms") * excess(F.col("p"), F.col("other_zero"))).alias("as_source"),
        F.sum(F.col("terms") * excess(F.col("other_zero"), F.col("p"))).alias("as_item"))
    side = lambda g, name: g.select("lang", F.col("source").alias(name), F.col("zero").alias(f"{name}_zero"), F.col("size").alias(f"{name}_size"))
    pairs = side(groups.withColumn("zero", F.when(F.col("size") > 0, zero)), "source").join(
        side(groups.withColumn("zero", F.when(F.col("size") > 0, zero)), "item").drop("item_size"), "lang").where("source <> item")
    mine = over.select("lang", "source", F.col("other_zero").alias("item_zero"), F.col("terms").alias("s_terms"), "as_source")
    theirs = over.select("lang", F.col("source").alias("item"), F.col("other_zero").alias("source_zero"), F.col("terms").alias("i_terms"), "as_item")
    none = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    bare = (F.col("source_size") - none("s_terms") - none("i_terms")) * excess(F.col("source_zero"), F.col("item_zero"))
    value = F.when(F.col("source_size") > 0, none("as_source") + none("as_item") + none("fix") + bare).otherwise(F.lit(0).cast("long"))
    valued = (pairs.join(mine, ["lang", "source", "item_zero"], "left").join(theirs, ["lang", "item", "source_zero"], "left")
              .join(spelled, ["lang", "source", "item"], "left").select("lang", "source", "item", value.alias("value")))
    return _ranked(valued, "pair")


def audit(docs: DataFrame, min_df: int = MIN_DF, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` (all other sources) and ``term`` (``top`` at most).

    Null text, lang and source are ''. Every occurring (lang, source) is a group, even without terms; a language without
    kept terms has pairs of value 0 and no terms. Each row is a document, so repeated rows count again. Ties go to
    the smaller item by UTF-8 bytes. Further columns take no part; an empty table gives no rows.
    """
    kept = materialise(vocabulary(group_sums(count_vectors(docs)), min_df), "vocabulary")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    occurring = docs.select(text("lang").alias("lang"), text("source").alias("source")).distinct()
    totals = (kept.select("lang", F.explode("by_source").alias("e")).groupBy("lang", F.col("e.source").alias("source"))
              .agg(F.sum("e.n").alias("total")))
    langs = kept.groupBy("lang").agg(F.count("*").alias("size"), F.sum("n").alias("lang_total"))
    none = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    groups = materialise(occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", none("total"), none("size"), none("lang_total")), "groups")
    return pair_part(kept, groups).unionByName(term_part(kept, groups, top))


ORACLE_SQL = r"""
WITH terms AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
occurrences AS (SELECT doc, lang, source, unnest(ws) AS term FROM terms),
vectors AS (SELECT doc, lang, source, term, count(*) AS n FROM occurrences GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM vectors GROUP BY ALL HAVING count(*) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM terms),
sums AS (SELECT g.lang, g.source, g.term, sum(g.n)::HUGEINT AS n FROM vectors g SEMI JOIN kept k ON g.lang = k.lang AND g.term = k.term GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM sums GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(s.n, 0) + 1)) // (coalesce(t.total, 0) + l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::HUGEINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  WHERE a.lang NOT IN (SELECT lang FROM langs)),
valued AS (
  SELECT * FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM valued)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
