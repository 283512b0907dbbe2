import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm.common import shared_path
from cohortloom.llm import token_counts as tc
from cohortloom.llm.token_counts import commit, committed, count_tokens, deletes, inserts, op4_token_counts, revisions, totals
from conftest import SMALL

PATHS = {"word": public_tokenizers.path("word_bpe_49k.json"), "byte": public_tokenizers.path("byte_bpe_50k.json")}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = Counter()
    for tokenizer, path in (("word_bpe_49k", PATHS["word"]), ("byte_bpe_50k", PATHS["byte"])):
        for r, e in zip(docs, Tokenizer.from_file(path).encode_batch([r.text or "" for r in docs], add_special_tokens=False)):
            want[r.source, r.lang, tokenizer, "docs"] += 1
            want[r.source, r.lang, tokenizer, "tokens"] += len(e.ids)
    got = Counter()
    for r in op4_token_counts(spark, SMALL).collect():
        got[r.source, r.lang, r.tokenizer, "docs"] += r.docs
        got[r.source, r.lang, r.tokenizer, "tokens"] += r.tokens
    assert +got == +want


def state(spark, root, version=None):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in totals(spark, root, version).collect()}


def test_edges_and_repeated_commits(spark):
    root = shared_path(spark, "counts")
    rows = [("a", "en", "one two"), (None, None, "x"), ("a", "en", None), ("a", "en", "one two"), ("long", "en", "word " * 50_000)]
    docs = spark.createDataFrame(rows, "source string, lang string, text string").selectExpr("*", "7 AS Tokens", "1 AS tokenizer", "'c' AS counts", "'k' AS k", "'0' AS c0")
    counted = count_tokens(docs, PATHS)
    assert counted.columns == ["source", "lang", "text", "counts", "k", "c0", "tokenizer", "tokens"]
    assert counted.count() == 10 and {(r.counts, r.k, r.c0) for r in counted.collect()} == {("c", "k", "0")}
    assert state(spark, root) == {}
    assert [commit(root, 1, inserts(counted)) for _ in range(2)] == [True, False]
    one = state(spark, root)
    assert one[("a", "en", "word")] == (3, 4) and one[(None, None, "byte")] == (1, 1) and one[("long", "en", "word")] == (1, 50_000)
    word = counted.where("tokenizer = 'word'").withColumn("old_tokens", F.col("tokens")).withColumn("tokens", F.col("tokens") + 10)
    # a repeated number with other content changes nothing
    assert not commit(root, 1, deletes(counted)) and state(spark, root) == one
    commit(root, 2, revisions(word), deletes(counted.where("tokenizer = 'byte'")))
    two = state(spark, root)
    assert two == {("a", "en", "word"): (3, 34), (None, None, "word"): (1, 11), ("long", "en", "word"): (1, 50_010)}
    commit(root, 3, inserts(counted.limit(0)))
    assert state(spark, root) == two and state(spark, root, 1) == one


def test_crash_other_writers_and_early_deletes(spark, monkeypatch):
    root = shared_path(spark, "counts")
    rows = spark.createDataFrame([("a", "en", "t", 5), ("b", None, "t", None)], "source string, lang string, tokenizer string, tokens long")
    commit(root, 1, inserts(rows))
    before = state(spark, root)
    add = tc.V.add_entry

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(tc.V, "add_entry", crash)
    with pytest.raises(OSError):
        commit(root, 2, inserts(rows))
    assert state(spark, root) == before and committed(spark, root) == {1: 1}

    def late(spark, root, version, content):  # another writer takes the version first
        monkeypatch.setattr(tc.V, "add_entry", add)
        commit(root, 7, deletes(spark.createDataFrame([("new", "en", "t", 3)], rows.schema)))
        add(spark, root, version, content)

    monkeypatch.setattr(tc.V, "add_entry", late)
    assert commit(root, 2, inserts(rows))
    assert committed(spark, root) == {1: 1, 7: 2, 2: 3}
    assert state(spark, root) == {("a", "en", "t"): (2, 10), ("b", None, "t"): (2, 0), ("new", "en", "t"): (-1, -3)}
    commit(root, 8, inserts(spark.createDataFrame([("new", "en", "t", 3)], rows.schema)))
    assert ("new", "en", "t") not in state(spark, root)


def test_ledger_of_batch_numbers(spark, monkeypatch):
    rng = random.Random(1)
    numbers = [rng.randrange(-40, 40) for _ in range(300)]
    runs, seen = [], set()
    for n in numbers:
        assert tc._within(runs, n) == (n in seen)
        runs, seen = tc._with(runs, n), seen | {n}
        assert [x for lo, hi in runs for x in range(lo, hi + 1)] == sorted(seen)
    root = shared_path(spark, "counts")
    rows = spark.createDataFrame([("a", "en", "t", 5)], "source string, lang string, tokenizer string, tokens long")
    for batch in (5, 3, 4, 9):
        assert commit(root, batch, inserts(rows))
    reads, read = [], tc.V._read
    monkeypatch.setattr(tc.V, "_read", lambda *a: reads.append(a[2]) or read(*a))
    assert not commit(root, 4, inserts(rows)) and commit(root, 6, inserts(rows))
    assert reads == [4, 4]  # one entry a commit, however many there are
    assert state(spark, root) == {("a", "en", "t"): (5, 25)}


def test_a_torn_entry_stops_nobody(spark):
    root = shared_path(spark, "counts")
    rows = spark.createDataFrame([("a", "en", "t", 5)], "source string, lang string, tokenizer string, tokens long")
    commit(root, 1, inserts(rows))
    with open(f"{root.removeprefix('file:')}/_log/{2:020d}", "w") as f:
        f.write('{"batch": 2')
    assert state(spark, root) == {("a", "en", "t"): (1, 5)} and not commit(root, 1, inserts(rows))
    assert commit(root, 2, inserts(rows)) and state(spark, root) == {("a", "en", "t"): (2, 10)} and committed(spark, root) == {1: 1, 2: 3}


def test_rank_files_give_the_ids_of_the_same_tokenizer():
    from cohortloom.llm.tokens import encoder, load_spec

    rng = random.Random(2)
    parts = ["word", " Two", "'s", "'re", "it's", "  ", " ", "\n", "\n\n ", "\t", "12", " 345", "é", " ß中", "!?", " ...", "<|end", "a" * 300, "\u00a0", "\u2003x", "💥", "\r\n"]
    texts = ["", None, " ", "\n"] + ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(400)]
    direct = Tokenizer.from_file(PATHS["byte"])
    for t, ids in zip(texts, encoder(load_spec(public_tokenizers.path("byte_bpe_50k.tiktoken"))).encode(texts)):
        assert np.frombuffer(ids, np.uint32).tolist() == direct.encode(t or "", add_special_tokens=False).ids, t
