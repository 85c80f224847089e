from collections import defaultdict
from math import floor

from silverline.llm import mixing


def brute(rows):
    size = defaultdict(int)
    for r in rows:
        size[r["source"]] += len((r["text"] or "").split()) if r["text"] and r["text"].strip(" \t\n\x0b\f\r") else 0
    order = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, full = sum(size.values()), {}
    while True:
        free = [s for s in order if s not in full]
        left, share = total - sum(full.values()), sum(w[s] for s in free)
        over = [s for s in free if w[s] * left > 3 * size[s] * share]
        if not over:
            return size, {**full, **{s: w[s] * left / share for s in free}}
        full |= {s: 3 * size[s] for s in over}


def test_targets_and_copies(docs, no_docs):
    rows = docs.collect()
    size, target = brute(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    source = {(r["doc_id"]): r["source"] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == size[s] and abs(r["target"] - target[s]) < 1e-6
        rate = target[s] / size[s] if size[s] else 0
        assert r["copies"] in (floor(rate), floor(rate) + 1) and r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
    assert abs(sum(target.values()) - sum(size.values())) < 1e-3
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(no_docs).count() == 0


def test_documents_come_as_often_as_taken(docs):
    n = sum(r["copies"] for r in mixing.mix(docs).collect())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == n


def test_taken_words_come_near_the_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = mixing.mix(docs).groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    assert abs(sum(r["sum(taken)"] for r in got) / sum(r["target"] for r in got) - 1) < 0.03
    assert all(abs(r["sum(taken)"] - r["target"]) < 0.25 * r["target"] for r in got)
