import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np

from cohortloom.llm import language_id as li
from cohortloom.llm.language_id import drop_unidentified, fit_held_in, op2_language_id, predict
from conftest import SMALL


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_language_id(spark, sf).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    judged = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in judged)
    assert right / len(judged) > 0.97


def test_edges(spark):
    rows = [(i, "the cat and the dog of the house", "en") for i in range(20)]
    rows += [(100 + i, "die Katze und der Hund über dem Haus", "de") for i in range(20)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "123 !!", "en"), (None, "der Hund", "de"), (203, "the dog", None)]
    rows += [(204, "der Hund und die Katze " * 40_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS Score")
    model = fit_held_in(docs)
    assert model[0] == ["de", "en"]
    found = predict(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r.doc_id: r for r in found.collect()}
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3
    assert got[203].lang_pred == "en" and got[204].lang_pred == "de" and got[None].lang_pred == "de"
    left = drop_unidentified(docs)
    assert left.columns == docs.columns and left.count() == len(rows) - 3
    nothing = predict(docs, fit_held_in(docs.limit(0)))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert predict(docs.limit(0), model).count() == 0


def letters(text):
    """Runs of lower-case letters, one space around and between them."""
    out = "".join((c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] == "L" else " " for c in text or "")
    return f" {' '.join(out.split(' '))} " if out.split() else ""


def bucket(gram):
    """The hash of one n-gram in plain integers."""
    m, h = (1 << 64) - 1, 0
    for k, c in enumerate(gram, 1):
        h = (h * 0xD6E8FEB86659FD93 & m) ^ (ord(c) * 0x9E3779B97F4A7C15 + k & m)
    return ((h ^ h >> 29) * 0xBF58476D1CE4E5B9 & m) >> 40


def grams(text, seen):
    line = " ".join(letters(text).split())
    line = f" {line} " if line else ""
    for n in li.SIZES:
        for i in range(len(line) - n + 1):
            g = line[i : i + n]
            if g not in seen:
                seen[g] = bucket(g) % li.BUCKETS
            yield seen[g]


def test_query_equals_brute_force(spark):
    """Counts by dictionaries and scores by loops give the same languages and the same probabilities."""
    docs = [r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    seen, counts = {}, {}
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in docs}
    for r in docs:
        if r.lang is not None and r.text is not None and not held[r.doc_id]:
            counts.setdefault(r.lang, Counter()).update(grams(r.text, seen))
    langs = sorted(counts)
    size = {x: sum(counts[x].values()) + 0.5 * li.BUCKETS for x in langs}
    table = {x: {b: float(np.float32(math.log((c + 0.5) / size[x]))) for b, c in counts[x].items()} for x in langs}
    rest = {x: float(np.float32(math.log(0.5 / size[x]))) for x in langs}
    got = {r.doc_id: r for r in op2_language_id(spark, SMALL).collect()}
    assert got.keys() == held.keys()
    for r in docs:
        own = list(grams(r.text, seen))
        row = got[r.doc_id]
        assert row.held_out == held[r.doc_id]
        if not own:
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        total = [sum(table[x].get(b, rest[x]) for b in own) for x in langs]
        best = max(range(len(langs)), key=lambda k: (total[k], -k))
        weight = min(1.0, li.EVIDENCE / len(own))
        chance = 1 / sum(math.exp((t - total[best]) * weight) for t in total)
        assert row.lang_pred == langs[best]
        assert abs(row.score - chance) < 1e-4


def test_unclear_documents_go(spark):
    en, de = "the cat and the dog of the house sat on the mat with a hat", "die Katze und der Hund lagen auf der Matte neben dem alten Haus"
    rows = [(i, en, "en") for i in range(20)] + [(100 + i, de, "de") for i in range(20)]
    rows += [(200, " ".join(f"{a} {b}" for a, b in zip(en.split(), de.split())), None), (201, en + " " + de, None), (202, en + " " + en, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' AS score", "'p' AS lang_pred", "1 AS row", "2 AS c0")
    left = drop_unidentified(docs)
    assert left.columns == docs.columns
    got = {r.doc_id: r for r in left.collect()}
    assert 200 not in got and 201 not in got and 202 in got and len(got) == 41
    assert {(r.score, r.lang_pred, r.row, r.c0) for r in got.values()} == {("s", "p", 1, 2)}


def test_ties_repeated_ids_and_too_many_labels(spark):
    rows = [(1, "abc", "b"), (1, "abc", "a"), (5, "abc", "a"), (5, "abc", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = predict(docs, li.train(docs))
    assert [(r.lang_pred, round(r.score, 6)) for r in found.collect()] == [("a", 0.5)] * 4
    junk = spark.range(li.MAX_LANGS + 5).selectExpr("id AS doc_id", "'abc' AS text", "string(id) AS lang")
    try:
        li.train(junk)
    except ValueError as e:
        assert "language label" in str(e)
    else:
        raise AssertionError("a junk label column passed")


def test_slices_give_the_ngrams_of_the_whole_text(monkeypatch):
    rng = random.Random(3)
    alphabet = "abcdeéß ñ  ..1\n中𝒜"
    texts = [None, "", "...", "a"] + ["".join(rng.choices(alphabet, k=n)) for n in (5, 9, 10, 11, 40, 41, 333, 1000)] + ["a" * 31, " " * 25 + "b", "b" + " " * 25, "x" * 10 + " " * 20 + "y" * 10]

    def counted():
        found = Counter()
        for points, owner in li._slices(texts, li.SIZES):
            for bucket, doc in li._grams(points, owner, li.SIZES, li.BUCKETS):
                found.update(zip(bucket.tolist(), doc.tolist()))
        return found

    def one_by_one():
        found = Counter()
        for i, text in enumerate(texts):
            parts = list(li._points(text or ""))
            if parts:
                points = np.concatenate(parts)
                for bucket, _ in li._grams(points, np.full(len(points), i, np.int32), li.SIZES, li.BUCKETS):
                    found.update((b, i) for b in bucket.tolist())
        return found

    whole = one_by_one()
    assert counted() == whole
    for size in (1, 2, 3, 10, 64):
        monkeypatch.setattr(li, "SLICE", size)
        assert counted() == whole, size
