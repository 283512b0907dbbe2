import random
import re

import pytest

from cohortloom.llm import license_scan as L
from cohortloom.llm.license_texts import NOTICES, PHRASES
from conftest import SMALL


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    w = words(text)
    places = [(i, label) for label, phrase in PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def base(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


@pytest.mark.parametrize("sf_dir", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf_dir):
    docs = {r.doc_id: brute(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = L.op13_license_scan(spark, sf_dir)
    assert got.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = got.collect()
    assert {r.doc_id: base(r) for r in rows} == docs and len(rows) == len(docs)
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 and (r.score == 1 or not r.base_labels)
    assert any(r.base_labels for r in rows) and any(not r.labels for r in rows)


def test_edges(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice(["mit", "license", "cc", "by", "apache", "word", "GNU general public license"]) for _ in range(60_000))
    texts = [None, "", "MIT", "mit license", "CC-BY 4.0, cc_by! CC  BY", "the MIT License, the mit\nlicense", "gnu general public licenses", "GNU General Public License", "é mit license é", "mit licenſe", "Kcc by", long]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "mit license"), (None, "apache license"), (None, "apache license"), (None, None)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, rid int, label string, words string")
    got = L.label_documents(df).collect()
    assert sorted(((r.doc_id, *base(r)) for r in got), key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    assert L.label_documents(df.limit(0)).count() == 0 and L.find_licenses(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        L.find_licenses(df, [("a", "word")])


def test_notices_with_words_changed(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, want = [], {}

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    for label, text in NOTICES:
        for share in (0, 0.03, 0.06):  # of the words: replaced, left out, or with a word put in
            out = []
            for w in words(text):
                what = rng.random()
                out += [w] if what >= share else rng.choice([[rng.choice(vocabulary)], [], [w, rng.choice(vocabulary)]])
            rows.append((len(rows), " ".join([*prose(200), *out, *prose(300)])))
            want[rows[-1][0]] = (label, 200, 199 + len(out), share)
    for label, text in NOTICES:  # half a notice and mixed words are none
        w = words(text)
        rows.append((len(rows), " ".join([*prose(50), *w[: len(w) // 2], *prose(50)])))
        rows.append((len(rows), " ".join(rng.sample(w, len(w)))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = L.find_licenses(df, NOTICES).collect()
    assert {r.doc_id for r in found} <= set(want)
    for i, (label, first, last, share) in want.items():
        mine = [r for r in found if r.doc_id == i and r.label == label]
        assert len(mine) == 1 if share < 0.06 else len(mine) <= 1, (i, label, share)
        for r in mine:
            assert first <= r.first_word <= first + 25 and last - 25 <= r.last_word <= last and (share or (r.coverage == 1 and (r.first_word, r.last_word) == (first, last)))
    assert len({r.doc_id for r in found}) >= len(want) - 2


def test_both_joins_agree(spark, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    few = sorted(map(tuple, L.label_documents(df).collect()), key=repr)
    monkeypatch.setattr(L, "BROADCAST_GRAMS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, L.label_documents(df).collect()), key=repr) == few
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
