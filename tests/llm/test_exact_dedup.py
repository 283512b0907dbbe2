import hashlib

import duckdb

from cohortloom.llm import exact_dedup as ed
from cohortloom.llm.exact_dedup import drop_exact_duplicates, exact_groups, op9_exact_dedup
from conftest import SMALL


def test_query_equals_sql(spark):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = sorted(c.sql(ed.OP9_SQL).fetchall())
    assert sorted(tuple(r) for r in op9_exact_dedup(spark, SMALL).collect()) == want


ROWS = [(1, "a"), (2, "a"), (2, "a"), (None, "a"), (3, None), (4, ""), (None, "b"), (None, "b"), (5, "x" * 200_000), (6, "x" * 200_000 + "y"), (7, "A")]


def brute(rows, best):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = best(named) if named else None
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.append((str(i), str(keep), len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


def test_edges(spark, monkeypatch):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'k' AS keep_id", "1 AS row")
    many = spark.createDataFrame([(i, "hot") for i in range(300)], "doc_id long, text string").selectExpr("*", "'k' AS keep_id", "1 AS row")
    for keep, best, share in (("max", max, 0.01), ("min", min, 0.01), ("max", max, 1.0), ("min", min, 1.0)):
        monkeypatch.setattr(ed, "SAMPLE", share)  # the whole table as sample: the 300 rows are salted
        found = exact_groups(docs.union(many), keep=keep)
        assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in found.collect()) == brute([*ROWS, *((i, "hot") for i in range(300))], best)
    left = drop_exact_duplicates(docs, keep="max")
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["2", "4", "5", "6", "7", "None"]
    assert exact_groups(docs.limit(0)).count() == 0
    from pyspark.sql import functions as F

    assert {r.group_size for r in exact_groups(docs.where("doc_id IN (1, 7)"), normalise=F.lower).collect()} == {2}
