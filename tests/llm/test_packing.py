import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortloom.llm.packing import difference, fill_rate, op3_packing, pack, partition
from cohortloom.llm.tokens import encoder, load_spec
from conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "'s''s x's I'LL we'RE<|endoftext|>a <|startoftext|>", "İstanbul ﬁ é ñ Ü ß ÿ ²½ x²y áb  \t x y\x85z \x1c q w", "日本語 テスト 123abc45",
    "", "  ", "\n\n a", "don't DON'T 'tis ''' !!!...??", "Ⅷ ª º µ × ÷ ÀÖØ", "a_b-c@d.e+f=1", "​‍ x", "'S 'S'S x'sy's", "ΣΑΣ", None,
]


def direct(texts):
    t = Tokenizer.from_file(PATH)
    return [np.array(e.ids, np.uint32).tobytes() for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_cached_ids_equal_the_library(spark, monkeypatch):
    from cohortloom.llm import tokens

    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()] + ODD
    want = direct(texts)
    assert encoder(load_spec(PATH)).encode(texts) == want
    monkeypatch.setattr(tokens, "MAX_PIECES", 500)
    monkeypatch.setattr(tokens, "MAX_WORDS", 3)
    assert tokens.Encoder(load_spec(PATH)).encode(texts) == want
    other = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(other)
    got = encoder(load_spec(other)).encode(ODD)
    assert got == [np.array(t.encode(x or "", add_special_tokens=False).ids, np.uint32).tobytes() for x in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "the", "ß", "É", "x2", "10", "'s", "'", "''", ",", ".'", "!?", "(", ")", "|", " ", "  ", "\n", "'Re", "-", "ÿ", "à", "日", "\t"]), max_size=12).map("".join), max_size=6))
def test_chunks_equal_the_library(texts):
    assert encoder(load_spec(PATH)).encode(texts) == direct(texts)


def test_every_plain_character_and_long_texts(monkeypatch):
    from cohortloom.llm import tokens

    plain = [c for c in map(chr, range(256)) if tokens._PLAIN.fullmatch(c)]
    texts = [f"a{c}b {c}{c}, x{c} {c}s{c}" for c in plain] + ["word, another one.\nand more words " * 30, "endless" * 40]
    monkeypatch.setattr(tokens, "TOGETHER", 50)
    assert tokens.Encoder(load_spec(PATH)).encode(texts) == direct(texts)


def test_words_that_recur_stay_in_a_full_dictionary(monkeypatch):
    from cohortloom.llm import tokens

    learnt, whole = [], tokens.Encoder._learn
    monkeypatch.setattr(tokens, "MAX_PIECES", 200)
    monkeypatch.setattr(tokens.Encoder, "_learn", lambda self, new, *more: (learnt.extend(new), whole(self, new, *more))[1])
    coder = tokens.Encoder(load_spec(PATH))
    name = lambda k: "".join(chr(97 + k // 26**i % 26) for i in range(4))
    texts = ["common words, these. " + " ".join(name(20 * k + i) for i in range(20)) for k in range(60)]
    for t in texts:
        assert coder.encode([t]) == direct([t])
    assert len(coder.pieces) + len(coder.older) <= 300
    assert learnt.count("common") == learnt.count("these") == learnt.count(",") == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1024), max_size=60))
def test_windows_hold_all_items_within_capacity(sizes):
    window = partition(sizes, 1024)
    sums = np.bincount(window, weights=sizes) if sizes else np.zeros(1)
    assert sums.max() <= 1024 and len(window) == len(sizes)
    for k in (1, 3, 7):
        window, largest = difference(sizes, k)
        assert largest == (np.bincount(window, weights=sizes).max() if sizes else 0)


def check(rows, want, end):
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, ids in want.items():
        ids += np.array([end], np.uint32).tobytes()
        at = 0
        for r in sorted(docs.pop(i), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) // 4 and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(ids) // 4
    assert not docs
    for part in sequences.values():
        at = 0
        for r in sorted(part, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096


def test_query_covers_every_id_once(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = op3_packing(spark, SMALL)
    check(found.collect(), dict(zip([r.doc_id for r in docs], direct([r.text for r in docs]))), 2)
    assert fill_rate(found).collect()[0].fill > 0.98


def test_edges(spark):
    texts = [*ODD, "word " * 30_000, "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'k' AS ids", "1 AS start")
    found = pack(docs, PATH, end_id=2).selectExpr("*", "crc32(ids) AS ids_crc32")
    check(found.collect(), dict(enumerate(direct(texts))), 2)
    assert fill_rate(found).collect()[0].fill > 0.95
    assert pack(docs.limit(0), PATH, end_id=2).count() == 0
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None)], "doc_id long, text string")
    assert sum(r.length for r in pack(twice, PATH, end_id=2).collect()) == 7
