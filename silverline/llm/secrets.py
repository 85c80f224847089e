"""Secret scans in built-in expressions only: three base patterns, and long tokens that two
character Markov models tell from ordinary identifiers.

The models are first-order chains over one alphabet, one trained on strings labelled random and
one on strings labelled ordinary; a token is reported when the log-likelihood ratio of the
random model over the ordinary one reaches ``min_ratio`` in the token or a long part of it. Offsets count code points, ends are
exclusive.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import GAP, ROW

KINDS = ("assign", "access", "hex", "markov")
# The base patterns and the least length of what they report.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

CANDIDATE_LEAST = 16
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{CANDIDATE_LEAST},}}"
ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-"
BASE = len(ALPHABET) + 1
MIN_RATIO = 13.0
SAMPLE_DOCUMENTS = 1000
SAMPLE_RANDOM = 20000
SMOOTHING = 0.5
OPEN_SHARE = 0.2
REDACTED = "[SECRET]"

_SPAN = "struct<start:int,kind:int,stop:int>"


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _grow(acc: Column, extra: Column, kind: str) -> tuple[Column, Column]:
    """Append an array to an accumulator of full and current chunks (linear in all, not quadratic)."""
    cur = F.concat(acc["cur"], extra)
    grown = F.size(cur) >= 256
    return (F.when(grown, _empty(kind)).otherwise(cur).alias("cur"),
            F.when(grown, F.concat(acc["full"], F.array(cur))).otherwise(acc["full"]).alias("full"))


def _all(acc: Column) -> Column:
    return F.flatten(F.concat(acc["full"], F.array(acc["cur"])))


def find(text: Column, pattern: str, kind: int, fits) -> Column:
    """The spans of a pattern's matches for which ``fits(match, index)`` holds.

    Splitting at a pattern and extracting it walk the same matches, so their lengths add up to offsets.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(F.transform(matches, lambda m, i: F.struct(F.char_length(m).alias("n"), fits(m, i).alias("ok"))),
                         F.slice(gaps, 1, F.greatest(F.size(matches), F.lit(1))),
                         lambda m, g: F.struct(F.char_length(g).alias("gap"), m["n"].alias("n"), m["ok"].alias("ok")))
    start = F.struct(F.lit(0).alias("at"), _empty(_SPAN).alias("cur"), _empty(f"array<{_SPAN}>").alias("full"))

    def step(acc, x):
        begin, end = acc["at"] + x["gap"], acc["at"] + x["gap"] + x["n"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("stop"))
        cur, full = _grow(acc, F.when(x["ok"], F.array(span)).otherwise(_empty(_SPAN)), _SPAN)
        return F.struct(end.alias("at"), cur, full)

    spans = F.aggregate(lengths, start, step, _all)
    return F.when(text.rlike(pattern), spans).otherwise(_empty(_SPAN))


def base_spans(text: Column) -> Column:
    return F.concat(
        find(text, ASSIGN, 0, lambda m, i: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_LEAST),
        find(text, ACCESS, 1, lambda m, i: F.char_length(m) >= ACCESS_LEAST),
        find(text, HEX, 2, lambda m, i: F.lit(True)))


def _identifiers(a: Column, b: Column) -> Column:
    """What people and programs make of two words and a number: joined names, paths, dates, versions, counters."""
    n = F.pmod(F.xxhash64(a, b), F.lit(100_000))
    part = lambda k: F.pmod(n, F.lit(k)).cast("string")
    two = lambda k: F.lpad((F.pmod(n, F.lit(k)) + 1).cast("string"), 2, "0")
    year = (F.lit(1990) + F.pmod(n, F.lit(40))).cast("string")
    low = F.lower(a)
    return F.array(
        F.concat(a, F.lit("_"), b), F.concat(a, F.lit("-"), b), F.concat(a, F.lit("/"), b), F.concat(low, F.initcap(b)), F.concat(a, F.lit("="), b),
        F.concat(F.upper(a), F.lit("_"), F.upper(b)), F.concat(F.initcap(a), F.lower(b)),
        F.concat(F.lit("/"), a, F.lit("/"), year, F.lit("/"), two(12), F.lit("/"), two(28), F.lit("/"), b),
        F.concat(b, F.lit("-"), year, F.lit("-"), two(12), F.lit("-"), two(28)), F.concat(a, F.lit("_"), part(1000), F.lit("_"), b, F.lit("_"), part(100_000)),
        F.concat(low, part(10), F.initcap(b)), F.concat(b, part(100), F.lit("_"), part(64), F.lit("-"), a), F.concat(a, F.lit("+"), b))


def samples(docs: DataFrame, n_docs: int = SAMPLE_DOCUMENTS, n_random: int = SAMPLE_RANDOM) -> DataFrame:
    """``sample, is_random``: labelled training strings.

    Ordinary: the words of the ``n_docs`` documents lowest by a hash of their id, as they stand and as
    neighbours make identifiers (``_identifiers``); ``n_random`` UUIDs, rules of one character and numbers by hash.
    Random: ``n_random`` strings in base 64, base 64 for URLs, capitals with digits, lower case with digits and hexadecimal in capitals, by
    hash (hexadecimal in lower case is the base pattern's).
    Both bounds are parameters; an empty table leaves the models without words.
    """
    spark = docs.sparkSession
    chosen = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n_docs)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")  # at most n_docs ids
    plain = F.filter(F.split(F.col("text"), GAP), lambda w: w.rlike("^[A-Za-z]+[,.]?$"))
    w = texts.select(F.transform(plain, lambda x: F.regexp_replace(x, "[,.]", "")).alias("w"))
    joined = F.zip_with("w", F.expr("slice(w, 2, size(w))"), lambda a, b: F.when(b.isNotNull(), _identifiers(a, b)).otherwise(F.array(a)))
    ordinary = w.select(F.explode(F.concat("w", F.flatten(joined))).alias("sample"), F.lit(False).alias("is_random"))
    digest = F.sha2(F.concat(F.lit("random:"), F.col("id").cast("string")), 256)
    b64 = F.base64(F.unhex(digest))
    letters = F.regexp_replace(F.base64(F.unhex(F.concat(digest, F.sha2(digest, 256)))), "[+/=\r\n]", "")
    kinds = F.array(b64, F.translate(b64, "+/", "-_"), F.upper(letters), letters, F.lower(letters), F.upper(digest))
    made = spark.range(n_random).select(F.get(kinds, (F.col("id") % F.size(kinds)).cast("int")).alias("sample"), F.lit(True).alias("is_random"))
    cut = lambda at, n: F.substring(digest, at, n)
    uuid = F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))
    rule = F.repeat(F.substring(F.lit("-_=+/"), (F.col("id") % 5 + 1).cast("int"), F.lit(1)), 20 + F.col("id").cast("int") % 60)
    number = F.concat_ws("-", *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10**9)).cast("string") for k in range(3)])
    forms = F.array(uuid, rule, number)
    formal = spark.range(n_random).select(F.explode(forms).alias("sample"), F.lit(False).alias("is_random"))
    return ordinary.unionByName(made.withColumn("sample", F.regexp_replace("sample", "[\r\n]", ""))).unionByName(formal)


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def train(labelled: DataFrame, smoothing: float = SMOOTHING, open_share: float = OPEN_SHARE) -> list[float]:
    """Log-likelihood ratios (random over ordinary) of every character pair, ``BASE * BASE`` of them.

    Both models leave ``open_share`` of every row to all characters alike, as the samples know only the words of
    some languages. Code 0 stands for the start and for characters outside the alphabet. Null samples and labels take no part.
    """
    codes = labelled.where("sample IS NOT NULL AND is_random IS NOT NULL").select("is_random", F.concat(F.array(F.lit(0)), _codes(F.col("sample"))).alias("c"))
    pairs = codes.select("is_random", F.explode(F.zip_with(
        F.expr("slice(c, 1, size(c) - 1)"), F.expr("slice(c, 2, size(c))"), lambda a, b: a * BASE + b)).alias("pair"))
    counts = {(r["is_random"], r["pair"]): r["count"] for r in pairs.groupBy("is_random", "pair").count().collect()}  # 2 * BASE^2 at most
    tables = []
    for label in (True, False):
        table = []
        for a in range(BASE):
            row = [counts.get((label, a * BASE + b), 0) + smoothing for b in range(BASE)]
            table += [math.log((1 - open_share) * x / sum(row) + open_share / BASE) for x in row]
        tables.append(table)
    return [round(x - y, 6) for x, y in zip(*tables, strict=True)]


def ratio(token: Column, model: list[float], least: int = 20) -> Column:
    """The highest ratio of any part of a token with ``least`` characters or more.

    A part's ratio is a difference of two prefix sums, so one pass keeps the least sum up to ``least`` characters back.
    """
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")  # folded to a constant
    # each character with the one ``least`` places before it (-1: none)
    codes = _codes(token)
    pairs = F.zip_with(codes, F.concat(F.array_repeat(F.lit(-1), least), codes), lambda c, back: F.struct(c.alias("c"), back.alias("back")))
    start = F.struct(F.lit(0).alias("prev"), F.lit(0.0).alias("sum"), F.lit(0).alias("prev_back"), F.lit(0.0).alias("sum_back"),
                     F.lit(0.0).alias("low"), F.lit(0).alias("n"), F.lit(-1e300).alias("best"))

    def step(acc, x):
        now = acc["sum"] + F.element_at(table, acc["prev"] * BASE + x["c"] + 1)
        back = F.when(x["back"] >= 0, acc["sum_back"] + F.element_at(table, acc["prev_back"] * BASE + F.greatest(x["back"], F.lit(0)) + 1)).otherwise(F.lit(0.0))
        low = F.least(acc["low"], back)
        n = acc["n"] + 1
        return F.struct(x["c"].alias("prev"), now.alias("sum"), F.greatest(x["back"], F.lit(0)).alias("prev_back"), back.alias("sum_back"),
                        low.alias("low"), n.alias("n"), F.when(n >= least, F.greatest(acc["best"], now - low)).otherwise(acc["best"]).alias("best"))

    own = F.filter(pairs, lambda x: x["c"].isNotNull())  # the shifted copy is longer
    return F.aggregate(own, start, step, lambda acc: F.when(acc["n"] >= least, acc["best"]).otherwise(acc["sum"]))


def _covered(span: Column, known: Column) -> Column:
    """Whether sorted spans together cover one."""
    return F.aggregate(known, span["start"], lambda at, b: F.when(b["start"] <= at, F.greatest(at, b["stop"])).otherwise(at)) >= span["stop"]


def scan(docs: DataFrame, model: list[float], min_ratio: float = MIN_RATIO, carry: bool = False) -> DataFrame:
    """``doc_id, base, spans`` (and with ``carry`` the row): spans by start, then kind as listed.

    The method's spans are maximal runs of token characters, a part of which has a ratio of ``min_ratio`` or more
    and which base spans do not cover whole (they may overlap). Null text counts as empty; rows are scanned each on its own, so repeated
    rows get the same spans; further columns take no part.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW)] if carry else []
    text = F.coalesce(F.col("text"), F.lit(""))
    first = docs.select("doc_id", text.alias("__text"), F.array_sort(base_spans(text)).alias("base"), *row)
    tokens = find(F.col("__text"), CANDIDATE, 3, lambda m, i: ratio(m, model, CANDIDATE_LEAST) >= min_ratio)
    second = first.withColumn("__tokens", tokens).withColumn("__known", F.when(F.size("__tokens") > 0, F.col("base")).otherwise(_empty(_SPAN)))
    extra = F.filter("__tokens", lambda t: ~_covered(t, F.col("__known")))
    return second.withColumn("spans", F.array_sort(F.concat("base", extra))).drop("__tokens", "__known")


def spell(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by a marker."""
    kind = "struct<start:int,stop:int,secret:boolean>"
    start = F.struct(F.lit(0).alias("at"), _empty(kind).alias("cur"), _empty(f"array<{kind}>").alias("full"))

    def piece(a, b, secret):
        return F.array(F.struct(a.alias("start"), b.alias("stop"), F.lit(secret).alias("secret")))

    def step(acc, s):
        fresh = F.concat(piece(acc["at"], s["start"], False), piece(s["start"], s["stop"], True))
        cur, full = _grow(acc, F.when(s["start"] >= acc["at"], fresh).otherwise(_empty(kind)), kind)
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), cur, full)

    pieces = F.aggregate(spans, start, step, lambda acc: F.concat(_all(acc), piece(acc["at"], F.lit(2**31 - 1), False)))
    shown = F.transform(pieces, lambda p: F.when(p["secret"], F.lit(REDACTED)).otherwise(F.substring(text, p["start"] + 1, p["stop"] - p["start"])))
    return F.when(F.size(spans) > 0, F.array_join(shown, "")).otherwise(text)


def redacted_documents(docs: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """The rows of ``docs`` with secrets masked; ``n_chars`` follows the text where it changes."""
    found = scan(docs, train(samples(docs)), min_ratio, carry=True)
    own = {f"`{c}`": F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns}
    own["`text`"] = F.when(F.size("spans") > 0, redact(F.col("__text"), F.col("spans"))).otherwise(F.col(f"{ROW}.text")).alias("text")
    out = found.select(*own.values(), (F.size("spans") > 0).alias(ROW))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(ROW), F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop(ROW)
