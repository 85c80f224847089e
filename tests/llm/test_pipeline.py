"""The stages joined up, against the brute-force versions of the single operators."""

import hashlib
from math import floor

import pytest

import corpus_pipeline
from silverline.llm import sentencepiece
from silverline.llm.common import table
from silverline.llm.queries import piece_model

from .test_mixing import brute as brute_mix
from .test_quality import brute as brute_measures
from .test_secrets import brute as brute_secrets
from .test_simhash import brute_components, brute_fp


def written(spark, tmp_path, docs, labels):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def expected(rows):
    """doc_id -> (copies, text or None where the text has a secret) after all filtering stages."""
    measured = [(r, brute_measures(r["text"])) for r in rows]
    kept = [r for r, m in measured if m[0] >= 10 and 100 * m[4] <= 20 * m[0]]
    root = brute_components({brute_fp(r["text"]) for r in kept})
    least = {}
    for r in kept:
        g, order = root[brute_fp(r["text"])], (r["doc_id"] is None, r["doc_id"] or 0)
        if g not in least or order < least[g][0]:
            least[g] = (order, r)
    kept = [r for _, r in least.values()]
    size, target = brute_mix(kept)
    out = {}
    for r in kept:
        rate = target[r["source"]] / size[r["source"]] if size[r["source"]] else 0
        u = int(hashlib.md5(f"mix:{'null' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        out[r["doc_id"]] = (floor(rate) + (u < rate - floor(rate)), None if brute_secrets(r["text"]) else r["text"])
    return out


def check(spark, sf):
    rows = table(spark, sf, "documents").collect()
    got = corpus_pipeline.run(spark, sf).collect()
    segmenter = sentencepiece.Segmenter(piece_model())
    want = expected(rows)
    counts = {}
    for r in got:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
        text = want[r["doc_id"]][1]
        assert r["lossless"] and (text is None or segmenter.decode(r["ids"]) == text)
    assert counts == {i: n for i, (n, _) in want.items() if n}
    return got, want


def test_pipeline_matches_brute_force(spark, docs, labels, tmp_path):
    sf = written(spark, tmp_path, docs, labels.where("doc_id < 12"))  # too few labels to certify a cutoff
    got, want = check(spark, sf)
    assert got and any(text is None for _, text in want.values())


def test_pipeline_on_empty_tables(spark, no_docs, labels, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, no_docs, labels.limit(0))).count() == 0


def test_every_stage_keeps_columns_and_takes_odd_rows(spark, docs, no_docs, labels, tmp_path):
    sf = written(spark, tmp_path, docs, labels)
    nulls = spark.createDataFrame([tuple([None] * len(docs.columns))] * 3, docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, nulls, no_docs):
            out = stage(spark, given, sf)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
            assert out.count() <= 3 * given.count()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_names(name):
    assert name in ("quality rules", "SimHash near-dedup", "secret scans", "source mixing", "SentencePiece encoding")
