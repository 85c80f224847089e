"""Quality rules with risk-controlled cutoffs, in built-in expressions only.

A document's severity is the largest of its rule measures, each divided by the rule's scale.
For every stratum (a language of a fixed list, or "other") the cutoff is the strictest level of
a fixed grid for which labelled good documents prove, by an exact binomial bound, that the rate of
false rejections is at most ``max_false_rejection``. The bound is taken at ``error / (strata x
levels)`` (Bonferroni), so with probability ``1 - error`` it holds for all strata at once. A
stratum without enough labelled documents gets no cutoff and loses none to the method.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import GAP, ROW, checkpointed, materialise, words

STRATA = ("en", "de", "fr", "es")
# measure at which a document reaches severity 1
SCALES = {"symbols": 0.5, "shouting": 0.5, "exclaims": 0.5, "dup_lines": 0.6, "repeats": 0.2, "long_words": 25.0}
LEVELS = tuple(round(0.1 * i, 1) for i in range(1, 21))
SHINGLE = 5


def sorted_windows(window_hashes: Column) -> Column:
    """(hash, position) in hash order; null where no hash repeats."""
    same = F.size(F.array_distinct(window_hashes)) == F.size(window_hashes)
    return F.when(~same, F.array_sort(F.transform(window_hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))


def repeated_words(by_hash: Column, width: int = SHINGLE) -> Column:
    """How many positions lie in windows whose hash occurs twice or more, from ``sorted_windows``."""
    # walk the sorted hashes: a window is repeated if it equals its neighbour on either side
    flagged = F.zip_with(
        by_hash, F.concat(F.slice(by_hash, 2, F.size(by_hash)), F.array(F.lit(None).cast("struct<h:bigint,i:int>"))),
        lambda a, b: F.struct(a["i"].alias("i"), a["h"].eqNullSafe(b["h"]).alias("next")))
    start = F.struct(F.lit(False).alias("prev"), F.array().cast("array<int>").alias("cur"), F.array().cast("array<array<int>>").alias("full"))

    def step(acc, x):
        cur = F.when(acc["prev"] | x["next"], F.concat(acc["cur"], F.array(x["i"]))).otherwise(acc["cur"])
        grown = F.size(cur) >= 256
        return F.struct(x["next"].alias("prev"), F.when(grown, F.array().cast("array<int>")).otherwise(cur).alias("cur"),
                        F.when(grown, F.concat(acc["full"], F.array(cur))).otherwise(acc["full"]).alias("full"))

    places = F.aggregate(flagged, start, step, lambda acc: F.array_sort(F.flatten(F.concat(acc["full"], F.array(acc["cur"])))))
    covered = F.aggregate(
        places, F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(width), x - acc["last"])).alias("n")), lambda acc: acc["n"])
    return F.coalesce(covered, F.lit(0)).cast("long")


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` (already there) plus the base measures and the severity."""
    text = F.coalesce(F.col("text"), F.lit(""))
    first = docs.select(
        *keep, text.alias("__text"), F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("__hash"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"))
    h = F.col("__hash")
    second = first.select(
        *keep, "__text", F.size("__lines").alias("__n_lines"), F.size(F.array_distinct("__lines")).alias("__n_distinct"),
        F.size(h).cast("long").alias("n_words"),
        F.when(F.size(h) < SHINGLE, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)]))
        ).alias("__windows"))
    count = lambda pattern: F.regexp_count(F.col("__text"), F.lit(pattern)).cast("long")
    second = second.withColumn("__windows", sorted_windows(F.col("__windows")))
    third = second.select(
        *keep, "n_words", (F.char_length("__text") - count(GAP.rstrip("+"))).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"), (F.col("__n_lines") - F.col("__n_distinct")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__windows")).alias("n_repeat_words"), "__n_lines", count("[A-Z]").alias("__upper"), count("!").alias("__bang"))
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    rules = {
        "symbols": F.col("n_symbols") / n, "shouting": F.col("__upper") / chars, "exclaims": F.col("__bang") / n,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("__n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / n, "long_words": F.col("word_chars") / n,
    }
    return third.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        F.greatest(*[v / F.lit(SCALES[k]) for k, v in rules.items()]).alias("severity"))


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series at x + 8."""
    y = x + 8.0
    product = F.lit(1.0)
    for i in range(8):
        product = product * (x + float(i))
    return ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
            + 1 / (1260 * y * y * y * y * y) - F.log(product))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact to rounding; 1 where k >= n p (never evidence for a rate below p).

    The sum runs downwards from k; its terms shrink by a ratio below 1, and those left out after
    200 + 60 sqrt(n p) of them are below rounding.
    """
    kd, nd = k.cast("double"), n.cast("double")
    top = (log_gamma(nd + 1) - log_gamma(kd + 1) - log_gamma(nd - kd + 1) + kd * math.log(p) + (nd - kd) * math.log1p(-p))
    last = F.least(k, (200 + 60 * F.sqrt(nd * p)).cast("long"))
    odds = (1 - p) / p
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), last), F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda acc, j: F.struct((acc["term"] * (kd - j) * odds / (nd - kd + j + 1)).alias("term"), (acc["sum"] + acc["term"]).alias("sum")),
        lambda acc: acc["sum"])
    return F.when(kd >= nd * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * total))


def stratum(lang: Column, strata=STRATA) -> Column:
    return F.when(lang.isin(*strata), lang).otherwise(F.lit("other"))


def cutoffs(measured: DataFrame, labels: DataFrame, max_false_rejection: float = 0.01, error: float = 0.05,
            strata=STRATA, levels=LEVELS) -> DataFrame:
    """``stratum, n_holdout, n_rejected, cutoff`` for the strata that have a certified cutoff.

    The holdout is every document with a label that passes the base rule: good where all its label rows say so (null
    labels and ids take no part). At most ``len(strata) + 1`` rows.
    """
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good")).where("good = 1")
    holdout = measured.where(~F.col("base_failed")).select("doc_id", "stratum", "severity").join(good, "doc_id", "left_semi")
    counted = holdout.groupBy("stratum").agg(
        F.count("*").alias("n_holdout"), F.array(*[F.sum((F.col("severity") > g).cast("long")) for g in levels]).alias("rejected"))
    tests = counted.select("stratum", "n_holdout", F.posexplode("rejected").alias("at", "n_rejected"))
    p = binomial_tail(F.col("n_rejected"), F.col("n_holdout"), max_false_rejection)
    level = F.element_at(F.array(*[F.lit(float(g)) for g in levels]), F.col("at") + 1)
    passed = tests.where(p <= error / ((len(strata) + 1) * len(levels)))
    return passed.groupBy("stratum", "n_holdout").agg(F.min(level).alias("cutoff"), F.max("n_rejected").alias("n_rejected"))


def judge(docs: DataFrame, labels: DataFrame, carry: bool = False, **options) -> DataFrame:
    """Per document its measures, ``base_failed``, ``cutoff`` and ``kept`` (and with ``carry`` its row).

    Null or empty text has no words and fails the base rule. Repeated rows are judged each on its
    own and alike; null languages belong to the stratum "other"; further columns take no part. An
    empty table gives no rows, an empty label table no cutoffs.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW)] if carry else []
    base = docs.select("doc_id", "text", stratum(F.col("lang"), options.get("strata", STRATA)).alias("stratum"), *row)
    measured = materialise(measures(base, ["doc_id", "stratum", *([ROW] if carry else [])]), "measures")
    # a row for each stratum of a fixed list
    limits = checkpointed(cutoffs(measured, labels, **options)).select("stratum", "cutoff")
    judged = measured.join(F.broadcast(limits), "stratum", "left")
    within = F.col("cutoff").isNull() | (F.col("severity") <= F.col("cutoff"))
    return judged.withColumn("kept", ~F.col("base_failed") & within)


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass."""
    return judge(docs, labels, carry=True, **options).where("kept").select(f"{ROW}.*")
