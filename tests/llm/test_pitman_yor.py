import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from silverline.llm import pitman_yor

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    toks, counts = [], Counter()
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        t = [*WORD.findall(low), None]
        held = zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
        toks.append((i, held, t))
        if not held:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    return [(i, held, len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)) for i, held, t in toks]


def key(r):
    return (r[0] is not None, r[0] or 0, r[2], r[5])


def check(df):
    got = sorted(map(tuple, pitman_yor.score(df, buckets=5).collect()), key=key)
    want = sorted(brute([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5]))
        assert g[6] < 0 and abs(math.log10(g[7]) * g[2] + g[6]) < 1e-6 * abs(g[6])
    return got


def test_base_columns_match_brute_force(docs, no_docs):
    check(docs)
    assert pitman_yor.score(no_docs).count() == 0


def test_model_beats_the_base_on_held_out_texts(spark):
    got = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    held = [g for g in got if g[1]]
    base, model = sum(g[5] for g in held), sum(g[6] for g in held)
    print("held-out bits a token", -base / sum(g[2] for g in held), -model / sum(g[2] for g in held))
    assert model > base
    again = sorted(map(tuple, pitman_yor.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), buckets=5).collect()), key=key)
    assert again == got


def test_probabilities_add_up():
    """Over all known words and one unknown, every context's predictive probabilities sum to one."""
    rng = np.random.default_rng(0)
    words, contexts = 50, 4
    w, u = (x.ravel() for x in np.meshgrid(np.arange(words + 1), np.arange(contexts), indexing="ij"))
    c = rng.zipf(1.5, len(w)).clip(0, 5000) * rng.integers(0, 2, len(w))
    c[w == words] = 0  # the unknown word
    at_root = np.append(rng.zipf(1.4, words).clip(1, 4000), 0)
    tables = pitman_yor.root_tables(at_root, 1 / (words + 1), 1.0, rng)
    spare = (pitman_yor.ROOT_STRENGTH + pitman_yor.ROOT_DISCOUNT * tables.sum()) / (words + 1)
    p = (at_root - pitman_yor.ROOT_DISCOUNT * tables + spare) / (pitman_yor.ROOT_STRENGTH + at_root.sum())
    assert abs(p.sum() - 1) < 1e-9
    others = np.arange(contexts) * 10.0
    mean, t = pitman_yor.seat(u, c, p[w], others * 3, others, np.ones(contexts), np.random.default_rng(1))
    # customers in other buckets hold the rest of a restaurant's probability
    missing = (others * 3 - pitman_yor.DISCOUNT * others) / (pitman_yor.STRENGTH + others * 3 + np.bincount(u, c))
    assert np.allclose(np.bincount(u, mean, contexts) + missing, 1)
    assert (t <= c).all() and (t[c > 0] > 0).all()


def test_tables_follow_the_exact_law():
    """Small counts: the drawn numbers of tables have the probabilities of an enumeration of seatings."""
    d, weight, c = 0.6, 0.8, 4
    law = Counter()

    def seat(sizes, p):
        if sum(sizes) == c:
            law[len(sizes)] += p
            return
        for k in range(len(sizes)):
            seat(sizes[:k] + [sizes[k] + 1] + sizes[k + 1:], p * (sizes[k] - d))
        seat([*sizes, 1], p * weight)

    seat([1], weight)
    total = sum(law.values())
    t = pitman_yor.draw_tables(np.full(200_000, c), np.full(200_000, weight), d, np.random.default_rng(3))
    for k, p in law.items():
        assert abs((t == k).mean() - p / total) < 0.005


def sequential(train, held, sweeps=60, burn_in=20, seed=4):
    """Mean log10 probability of held-out tokens by a Gibbs sampler that seats one customer at a time in both restaurants."""
    rng = np.random.default_rng(seed)
    d, theta, d0, theta0 = pitman_yor.DISCOUNT, pitman_yor.STRENGTH, pitman_yor.ROOT_DISCOUNT, pitman_yor.ROOT_STRENGTH
    vocabulary = {w for t in train for w in t}
    base = 1 / (len(vocabulary) + 1)
    tables, root = {}, {}  # (context, word) and word -> customers at each table
    totals, at_root = Counter(), [0, 0]  # context -> customers, tables under (context, "t"); root customers and tables

    def root_p(w):
        own = root.get(w, [])
        return (sum(own) - d0 * len(own) + (theta0 + d0 * at_root[1]) * base) / (theta0 + at_root[0])

    def enter(own, weights, n_tables):
        k = int(np.searchsorted(np.cumsum(weights), rng.random() * sum(weights)))
        k = min(k, n_tables)
        if k == n_tables:
            own.append(1)
            return True
        own[k] += 1
        return False

    def leave(own):
        k = int(np.searchsorted(np.cumsum(own), rng.random() * sum(own), side="right"))
        own[k] -= 1
        if not own[k]:
            own.pop(k)
            return True
        return False

    def add(u, w):
        own = tables.setdefault((u, w), [])
        if enter(own, [x - d for x in own] + [(theta + d * totals[u, "t"]) * root_p(w)], len(own)):
            totals[u, "t"] += 1
            above = root.setdefault(w, [])
            at_root[1] += enter(above, [x - d0 for x in above] + [(theta0 + d0 * at_root[1]) * base], len(above))
            at_root[0] += 1
        totals[u] += 1

    def remove(u, w):
        if leave(tables[u, w]):
            totals[u, "t"] -= 1
            at_root[1] -= leave(root[w])
            at_root[0] -= 1
        totals[u] -= 1

    pairs = [(u, w) for t in train for u, w in zip([" ", *t], t)]
    for u, w in pairs:
        add(u, w)
    wanted = [(u, w) for t in held for u, w in zip([" ", *t], t)]
    mean = np.zeros(len(wanted))
    for sweep in range(sweeps):
        for u, w in pairs:
            remove(u, w)
            add(u, w)
        if sweep >= burn_in:
            for k, (u, w) in enumerate(wanted):
                own = tables.get((u, w), [])
                mean[k] += (sum(own) - d * len(own) + (theta + d * totals[u, "t"]) * root_p(w)) / (theta + totals[u])
    return float(np.log10(mean / (sweeps - burn_in)).sum())


def test_scores_are_those_of_a_sampler_of_single_customers(spark):
    rng = np.random.default_rng(7)
    follows = {k: rng.permutation(40)[:6] for k in range(40)}

    def text():
        w, out = int(rng.integers(40)), []
        for _ in range(int(rng.integers(5, 25))):
            w = int(follows[w][min(5, int(rng.zipf(1.6)) - 1)])
            out.append(f"w{w}")
        return " ".join(out)

    rows = [(i, text()) for i in range(160)]
    rows += [(i, rows[i % 160][1]) for i in range(160, 180)]
    got = pitman_yor.score(spark.createDataFrame(rows, "doc_id long, text string"), buckets=3).collect()
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    want = sequential([[*t.split(), ""] for i, t in rows if i not in held], [[*t.split(), ""] for i, t in rows if i in held])
    mine = sum(r["score"] for r in got if r["held_out"])
    base = sum(r["base_score"] for r in got if r["held_out"])
    print(mine, want, base)
    assert abs(mine / want - 1) < 0.02 and want > 0.9 * base


def test_contexts_grow_with_the_corpus_and_frequent_ones_are_dealt(spark, monkeypatch):
    rows = [(i, " ".join(f"the x{i} of y{i % 50} the z{(i * 7) % 90} of".split() * 3)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r["doc_id"]: r["score"] for r in pitman_yor.score(docs, buckets=1).collect()}
    dealt = {r["doc_id"]: r["score"] for r in pitman_yor.score(docs, buckets=16).collect()}
    words, n = pitman_yor.frequent_words(docs)
    assert {w for w, _ in words} >= {b"the", b"of"}
    # the same model but for what other buckets hold of frequent contexts
    assert abs(sum(dealt.values()) / sum(whole.values()) - 1) < 0.02
    hot = {pitman_yor.word_hash(w): 16 for w, c in words if w in (b"the", b"of")}
    packed = pitman_yor.pack(docs, hot, 16, True).where("data IS NOT NULL").collect()
    contexts = [pitman_yor.Bucket(pa.table({"block": pa.array([r["block"]], pa.int64()), "data": pa.array([bytes(r["data"])])}), True).contexts for r in packed]
    assert len(set(np.concatenate(contexts).tolist())) > 400  # a restaurant for every word before
    assert sum(pitman_yor.word_hash(b"the") in c for c in contexts) > 8


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "one two"), (None, "one"), ("a", "one two")], "doc_id string, text string")
    got = pitman_yor.score(docs).collect()
    assert sorted((r["doc_id"] or "", r["n_tokens"]) for r in got) == [("", 2), ("a", 3), ("a", 3)]


def test_large_cells_follow_the_exact_law():
    """The table for up to 2000 customers agrees with the one for few, and draws with its mean."""
    small, large = pitman_yor.stirling(0.6, 20), pitman_yor.stirling(0.6, 200)
    assert np.allclose(small[1:, 1:][np.isfinite(small[1:, 1:])], large[1:21, 1:21][np.isfinite(small[1:, 1:])])
    c, weight = 150, 2.0
    logits = large[c, 1:] + np.log(weight) * np.arange(1, 201)
    law = np.exp(logits - logits.max())
    want = (law * np.arange(1, 201)).sum() / law.sum()
    t = pitman_yor.draw_tables(np.full(20_000, c), np.full(20_000, weight), 0.6, np.random.default_rng(3))
    assert abs(t.mean() / want - 1) < 0.01


def test_sums_are_held_for_one_block_at_a_time():
    """Many blocks of few documents: what a bucket holds goes by its tokens, not by the documents a block may have."""
    texts = [[f"w{k % 7} w{j} w{j + 1} w{j}" for j in range(3)] for k in range(60)]
    rows = [r for k, t in enumerate(texts) for r in pitman_yor._pack_block(
        k, [10 * k + j for j in range(3)], [pitman_yor._indexed(x) for x in t], {}, 1, True, pa.int64()).to_pylist() if r["data"]]
    table = pa.table({"block": pa.array([r["block"] for r in rows], pa.int64()), "data": pa.array([r["data"] for r in rows], pa.binary())})
    tracemalloc.start()
    b = pitman_yor.Bucket(table, True)
    value = np.arange(len(b.c), dtype=float) ** 2
    sums = list(b.by_document(value, np.ones(len(b.c))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    cell = {(int(b.contexts[u]), int(b.words[w])): v for u, w, v in zip(b.context, b.word, value, strict=True)}
    assert len(sums) == 60 and peak < 2_000_000
    for (docs, (own, n)), block in zip(sums, texts, strict=True):
        assert docs.tolist() == [0, 1, 2]
        for j, text in enumerate(block):
            words = [pitman_yor.START, *pitman_yor.tokens(text)]
            hashes = list(map(pitman_yor.word_hash, words))
            assert n[j] == len(words) - 1 and own[j] == sum(cell[p] for p in zip(hashes, hashes[1:], strict=False))


def test_draws_do_not_depend_on_how_many_are_drawn_at_a_time(monkeypatch):
    c, weight = np.arange(1, 3000), np.linspace(0.1, 5, 2999)
    at_once = pitman_yor.draw_tables(c, weight, 0.6, np.random.default_rng(1))
    monkeypatch.setattr(pitman_yor, "MATRIX", 10_000)
    assert (pitman_yor.draw_tables(c, weight, 0.6, np.random.default_rng(1)) == at_once).all()
