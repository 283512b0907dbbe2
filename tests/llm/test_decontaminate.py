import re

import pytest

from cohortloom.llm.decontaminate import decontaminate, drop_contaminated, op1_decontaminate

from conftest import SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text, items, window=10):
    words = WORD.findall(lower(text))
    hit, names = set(), set()
    for item, body in items:
        w = WORD.findall(lower(body))
        for i in range(max(1, len(w) - window + 1)) if w else ():
            part = w[i : i + window]
            for a in range(len(words) - len(part) + 1):
                if words[a : a + len(part)] == part:
                    hit |= set(range(a, a + len(part)))
                    names.add(str(item))
    return len(words), len(hit), sorted(names)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    import hashlib

    want = {}
    for r in docs:
        n, k, names = brute(r.text, items)
        want[r.doc_id] = (n, k, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), k > 0)
    got = {r.doc_id: tuple(r)[1:] for r in op1_decontaminate(spark, SMALL).collect()}
    assert got == want
    assert any(x[1] for x in want.values())


ITEMS = [
    (1, "One two THREE four five six seven eight nine ten eleven"),
    (2, "short Äx item"),
    (3, ""),
    (4, None),
    (None, "short Äx item"),
    (5, "a a a a a a a a a a a"),
]
DOCS = [
    (1, "zero one-two three FOUR five, six seven eight nine ten eleven twelve", "k"),
    (2, "xshort Äx item; short Äx ITEM.", None),
    (3, None, "k"),
    (4, "", "k"),
    (None, "a " * 40, "k"),
    (2, "xshort Äx item; short Äx ITEM.", None),
    (6, "short äx item one two", "k"),
    (7, "word " * 50_000 + "short Äx item", "k"),
]


def test_edges_and_offsets(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, n_words string").selectExpr("*", "'r' AS row", "'t' AS __row")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontaminate(docs, bench).collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        n, k, names = brute(r.text, ITEMS)
        assert (r.n_words, r.n_hit, r.row) == (n, k, "r")
        assert set(r.item_ids) == {"null" if x == "None" else x for x in names}
        assert sum(len(WORD.findall(lower(r.text[a:b]))) for a, b in r.hit_spans) == k
    one = next(r for r in rows if r.doc_id == 1)
    assert one.text[one.hit_spans[0][0] : one.hit_spans[-1][1]].lower().startswith("one-two")
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    got = left.collect()
    assert sorted(r.doc_id for r in got) == [3, 4, 6]
    assert {(r.n_words, r.row, r["__row"]) for r in got} == {("k", "r", "t")}


@pytest.mark.parametrize("max_bytes", [30, 60])
def test_large_benchmarks_go_block_by_block(spark, max_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, n_words string").selectExpr("*", "'r' AS row", "'t' AS ranges")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    one, many = decontaminate(docs, bench), decontaminate(docs, bench, max_bytes=max_bytes)
    assert one.columns == many.columns
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))
    assert sorted(r.doc_id for r in drop_contaminated(docs, bench, max_bytes=max_bytes).collect()) == [3, 4, 6]


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, n_words string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate(docs.limit(0), bench).count() == 0
    assert all(r.n_hit == 0 for r in decontaminate(docs, bench.limit(0)).collect())
