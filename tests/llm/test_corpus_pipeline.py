import re
import zlib

import corpus_pipeline
from cohortloom.llm.language_id import MIN_SCORE, fit_held_in, predict
from conftest import SMALL
from test_decontaminate import brute as brute_hits
from test_packing import direct
from test_shingle_join import brute_groups


def brute_lines(docs):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, t in docs.items():
        for line in set(map(key, t.split("\n"))):
            if len(line) >= 10:
                holders.setdefault(line, set()).add(i)
    return {i: "\n".join(x for x in t.split("\n") if min(holders.get(key(x), {i})) == i) for i, t in docs.items()}


def test_stages_equal_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = {r.doc_id: r.text for r in table.collect()}
    judged = {r.doc_id: r for r in predict(table, fit_held_in(table)).collect()}
    kept = {i: t for i, t in docs.items() if judged[i].lang_pred != "und" and judged[i].score >= MIN_SCORE}
    assert 0 < len(kept) <= len(docs)
    kept = brute_lines(kept)
    roots, _ = brute_groups(kept)
    kept = {i: t for i, t in kept.items() if roots[i] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = {i: t for i, t in kept.items() if not brute_hits(t, items)[1]}
    want = dict(zip(kept, direct(list(kept.values()))))

    got = {}
    for r in sorted(corpus_pipeline.run(spark, SMALL).collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(got.get(r.doc_id, b"")) // 4
        got[r.doc_id] = got.get(r.doc_id, b"") + bytes(r.ids)
    assert {i: zlib.crc32(x) for i, x in got.items()} == {i: zlib.crc32(x + b"\2\0\0\0") for i, x in want.items()}


ODD = [
    (1, "a clean text of several words that stays as it is in every stage of it", "en"),
    (1, "a clean text of several words that stays as it is in every stage of it", "en"),
    (2, None, None),
    (None, "another text of some words that has no identifier at all but stays", "en"),
    (3, "", "en"),
    (4, "1234 5678", None),
    (5, "word and word " * 30_000, "en"),
]


def test_stages_on_odd_rows(spark):
    """Nulls, repeated rows, empty and very long texts, no rows, and columns with names of results: the columns stay."""
    small = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").limit(60)
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    names = ["row", "score", "lang_pred", "kept_text", "n_hit", "th", "key", "rep"]
    docs = small.union(odd).selectExpr("*", "'s' AS source", "length(text) AS n_chars", *[f"'{n}' AS {n}" for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            left = stage(spark, table, SMALL)
            assert left.columns == docs.columns
            rows = left.collect()
            assert all(r[n] == n for r in rows for n in names)
        assert not rows and stage(spark, docs, SMALL).where("doc_id = 1 AND text LIKE 'a clean%'").count() >= 1
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SMALL).count() == 0


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
