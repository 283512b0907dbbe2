import hashlib
import random
import re
from collections import Counter

import numpy as np

from cohortloom.llm import substring_dedup as sd
from cohortloom.llm.substring_dedup import op5_substring_dedup, remove_repeated_passages, repeated_windows
from conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = {r.doc_id: (n, k, hashlib.sha256(t.encode()).hexdigest()) for r, (n, k, t) in zip(docs, brute([r.text for r in docs], 35))}
    assert {r.doc_id: tuple(r)[1:] for r in op5_substring_dedup(spark, SMALL).collect()} == want
    assert any(k for _, k, _ in want.values())


def rows():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdefghij") for _ in range(n))
    shared = text(14)
    out = [(i, f"{text(20)}\n{shared}\t{text(9)}", "x") for i in range(12)]
    out += [(20, None, "x"), (21, "", None), (22, " \n ", "x"), (23, "ä ß \xa0 é", "x"), (None, shared, "x"), (None, shared, "x"), (24, "w " * 3000, "x")]
    return out + [(25, out[0][1], "y"), (25, out[1][1], "y")]


def test_edges_and_hot_minimisers(spark, monkeypatch):
    data = rows()
    docs = spark.createDataFrame(data, "id long, text string, ranges string")
    want = sorted((str(r[0]), *x) for r, x in zip(data, brute([r[1] for r in data], 6)))
    for share in (1000, 10**9):
        monkeypatch.setattr(sd, "HOT_SHARE", share)
        monkeypatch.setattr(sd, "SAMPLE", 1.0)
        found = remove_repeated_passages(docs, "id", window=6, m=2)
        assert found.columns == ["id", "text", "ranges", "n_words", "n_removed", "kept_text"]
        assert sorted((str(r.id), r.n_words, r.n_removed, r.kept_text) for r in found.collect()) == want
    assert remove_repeated_passages(docs.limit(0), "id").count() == 0


def test_equal_hashes_are_compared_in_full(monkeypatch):
    monkeypatch.setattr(sd, "word_hashes", lambda line, starts, ends: np.zeros(len(starts), np.uint64))
    flags, lengths = repeated_windows([b"a b c d", b"b c x", b"q r s"], np.array([1, 1, 1]), 2)
    assert flags.tolist() == [False, True, False, False, True, False, False, False, False, False] and lengths.tolist() == [4, 3, 3]
    assert repeated_windows([b"q r s"], np.array([2]), 2)[0].tolist() == [True, True, False]


def test_ids_of_any_type(spark):
    passage = " ".join(f"w{i}" for i in range(50))
    rows = [("a", passage + " one"), ("b", "two " + passage), (None, "three"), ("a", passage + " one")]
    got = remove_repeated_passages(spark.createDataFrame(rows, "id string, text string"), "id").collect()
    assert sorted((r.id or "", r.n_removed) for r in got) == [("", 0), ("a", 51), ("a", 51), ("b", 50)]
