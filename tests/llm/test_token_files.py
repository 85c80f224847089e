import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from silverline.llm import token_files
from silverline.llm.queries import tokenizer_file

TOKENIZER = tokenizer_file()


def whole():
    t = Tokenizer.from_str(TOKENIZER)
    t.encode_special_tokens = True
    return t


def test_chunks_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 8, 1000, 5000):
        for top in (1, 50257, 2**32 - 1):
            ids = rng.integers(0, top, n, dtype=np.uint64, endpoint=True).astype("<u4")
            for bits in (False, True):
                assert (token_files.unpack(token_files.pack(ids, 1024, bits)) == ids).all()


def test_words_apart_are_the_whole_text():
    rng, tokens = random.Random(1), whole()
    parts = ["word", "Don't", "it's", "x'll", "1234", "a1", "日本", "é", "--", "!?", "'s", " ", "　", "\x1c", "\x85", "<|endoftext|>", "ß", "🎉", "​"]
    texts = ["", " ", "\n", "a", " a", "a ", "\na", "a\n", "a \n b", "a\n\nb", "a  b", "\t", "a\tb", "a\r\nb"]
    texts += ["".join(rng.choice(parts) + rng.choice([" ", "\n", "", " ", " ", "  ", "\t"][:rng.choice([5, 7])]) for _ in range(rng.randrange(1, 30))) for _ in range(500)]
    got = token_files.Encoder(TOKENIZER).encode(texts)
    for t, g in zip(texts, got):
        assert np.frombuffer(g, "<u4").tolist() == tokens.encode(t, add_special_tokens=False).ids, repr(t)


def test_files_match_brute_force(spark, docs, no_docs):
    tokens = whole()
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    for options in ({}, {"block": 64, "chunk_ids": 500, "bits": True}):
        got = sorted(token_files.token_files(docs, TOKENIZER, **options).collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in got] == [i for i, _ in rows]
        start = 0
        for r, (_, text) in zip(got, rows, strict=True):
            ids = np.array([*tokens.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
            assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
            start += len(ids)
    assert token_files.token_files(no_docs, TOKENIZER).count() == 0


def test_nul_and_special_tokens_are_the_librarys(spark):
    library = Tokenizer.from_str(TOKENIZER)
    texts = ["a \0b", "\0b", "a \0", "\0", "a\n\0b c", "\0, \0.", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "a b."]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(g, "<u4").tolist() for g in token_files.Encoder(TOKENIZER, special=True).encode(texts)] == want
    got = token_files.token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), TOKENIZER).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in got} == {i: zlib.crc32(np.array([*ids, 0], dtype="<u4").tobytes()) for i, ids in enumerate(want)}


def test_plain_words_are_encoded_by_the_merges_alone():
    tokens, own = whole(), token_files.Encoder(TOKENIZER)
    words = ["a", "Zürich", "naïveté", "ŁÓDŹ", "x" * 300, "ÿ", "The", "ß", "ﬁ", "日本", "a1", "don't", "dogs'", "x²)", "12;", "a's'", "end!", "why?", "q\"", "x_", "<|", "日本)", "(x)", "x,", "é.", ",", ".", "", "..", "a.,"]
    texts = [" ".join(p) for p in ((a, b) for a in words for b in words)] + ["\n".join(w for w in words if w), "\n" + "\nx".join(words[:12])]
    for t, g in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(g, "<u4").tolist() == tokens.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_tokenizer_with_other_rules_encodes_whole_texts():
    import json

    for change in ({"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}},
                   {"normalizer": {"type": "Lowercase"}},
                   {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Digits", "individual_digits": True}, {
                       "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}]}}):
        spec = json.dumps(json.loads(TOKENIZER) | change)
        own, library = token_files.Encoder(spec), Tokenizer.from_str(spec)
        assert not own.apart
        texts = ["Word and 123 more", "a\nB", ""]
        assert [np.frombuffer(g, "<u4").tolist() for g in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_unit_is_looked_up_once():
    """One new unit does not make the known units of its text be looked up again."""
    lookups = []

    class Known(dict):
        def get(self, *args):
            lookups.append(args[0])
            return super().get(*args)

        def __getitem__(self, key):
            lookups.append(key)
            return super().__getitem__(key)

    own, tokenizer = token_files.Encoder(TOKENIZER), whole()
    text = "several ordinary words, and more\n" * 100
    own.encode([text])
    own.known = Known(own.known)
    got = own.encode([text + "unseen"])[0]
    assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text + "unseen", add_special_tokens=False).ids and len(lookups) < 600


def test_units_that_were_forgotten_are_learned_again(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_UNITS", 40)
    own, tokenizer = token_files.Encoder(TOKENIZER), whole()
    for k in range(8):
        texts = [f"text{j}, of 'words' and été. line{j + k}\nend{j}! \u65e5\u672c" for j in range(12)] + ["", "a  b", "(x)"]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
