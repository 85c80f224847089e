import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from oracle_compare import duck, normalise
from silverline.llm import divergence


def brute(rows, min_df=3, top=200):
    groups, df, n = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        groups[lang, source] += terms
        df[lang].update(terms.keys())
        n[lang] += terms
    out = []
    for (lang, source), mine in groups.items():
        kept = [t for t, d in df[lang].items() if d >= min_df]

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p, q = shares(mine), shares(n[lang])
        value = lambda a, b: (a - b) ** 2 // b
        pairs = [(s, sum(value(p[t], o[t]) for t in kept)) for (x, s), c in groups.items() if x == lang and s != source for o in [shares(c)]]
        terms = [(t, value(p[t], q[t])) for t in kept if mine[t] and p[t] > q[t]]
        for part, valued, most in (("pair", pairs, None), ("term", terms, top)):
            valued.sort(key=lambda r: (-r[1], r[0].encode()))
            out += [(lang, source, part, item, v, k + 1) for k, (item, v) in enumerate(valued[:most])]
    return sorted(out)


def test_fixture_matches_brute_force_and_sql(spark, docs, no_docs):
    want = brute([(r["lang"], r["source"], r["text"]) for r in docs.collect()])
    assert sorted(map(tuple, divergence.audit(docs).collect())) == want
    con = duck("/nowhere")
    documents = docs.select("doc_id", "text", "lang", "source").toPandas()
    con.register("documents", documents.astype(object).where(documents.notna(), None))
    assert normalise(con.sql(divergence.ORACLE_SQL).df()) == normalise(divergence.audit(docs).toPandas())
    assert divergence.audit(no_docs).count() == 0


def many(spark, n=400, sources=30, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        source = rng.choice([None, "hot", "hot", "hot", *map(str, range(sources))])
        rows.append((rng.choice(["en", "en", None, "de"]), source, " ".join(f"t{chr(97 + int(rng.random() ** 2 * 26))}{'é' * rng.randrange(3)}" for _ in range(rng.randrange(20)))))
    rows += [("fr", "a", "only one"), ("fr", "b", None), ("xx", "alone", "same same same"), ("xx", "alone", "same"), ("xx", "alone", "same")]
    return rows, spark.createDataFrame(rows, "lang string, source string, text string")


def test_many_sources_match_brute_force(spark, monkeypatch):
    rows, frame = many(spark)
    want = brute(rows, top=7)
    assert sorted(map(tuple, divergence.audit(frame, top=7).collect())) == want
    assert sorted(map(tuple, divergence.audit(frame.repartition(5), min_df=1, top=7).collect())) == brute(rows, 1, 7)


def test_common_terms_in_small_steps(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), sorted(rng.sample(range(9), k := rng.randrange(2, 9))), [rng.randrange(1, 10**9) for _ in range(k)],
             [rng.randrange(1, 10**4) for _ in range(k)]) for _ in range(200)]
    want = Counter()
    value = lambda p, q: (p - q) ** 2 // q
    for lang, a, p, z in rows:
        for i in range(len(a)):
            for j in range(len(a)):
                if i != j:
                    want[lang, a[i], a[j]] += value(p[i], p[j]) - value(p[i], z[j]) - value(z[i], p[j]) + value(z[i], z[j])
    frame = spark.createDataFrame(rows, "lang string, a array<int>, p array<long>, zero array<long>").repartition(2)
    for at_once in (1, 50, 1 << 20):
        # tasks get the value with the function they run
        common = divergence.common_terms.__globals__
        monkeypatch.setitem(common, "PAIRS_AT_ONCE", at_once)
        got = {(r["lang"], r["a"], r["b"]): r["fix"] for r in divergence.common_terms(frame).collect()}
        assert got == dict(want)


def test_vectors_and_shares(spark):
    frame = spark.createDataFrame([("en", "s", "Éa éA b-b B1b"), (None, None, None)], "lang string, source string, text string")
    got = {r["lang"]: dict(zip(r["terms"], r["counts"], strict=True)) for r in divergence.count_vectors(frame).collect()}
    assert got == {"en": {"Éa": 1, "éa": 1, "b": 4}, "": {}}
    big = spark.range(1).select(*[divergence.share(F.lit(n).cast("long"), F.lit(t).cast("long"), F.lit(7).cast("long")).alias(f"c{k}")
                                  for k, (n, t) in enumerate([(0, 0), (9_223_372_034, 10**13), (9_300_000_000, 10**13), (10**12, 10**13)])]).first()
    assert list(big) == [1 + 10**9 * (n + 1) // (t + 7) for n, t in [(0, 0), (9_223_372_034, 10**13), (9_300_000_000, 10**13), (10**12, 10**13)]]
