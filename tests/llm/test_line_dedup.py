import duckdb

from cohortloom.llm import line_dedup as ld
from cohortloom.llm.line_dedup import drop_duplicate_lines, mark_duplicate_lines, op8_line_dedup
from conftest import SMALL


def test_query_equals_sql(spark):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = sorted(c.sql(ld.OP8_SQL).fetchall())
    assert sorted(tuple(r) for r in op8_line_dedup(spark, SMALL).collect()) == want


def test_edges(spark):
    line = "Some LINE that repeats"
    rows = [
        (1, f"{line}\nown line of one\n{line}"),
        (2, f"  {line.lower()}\t\nshort\n\nend"),
        (3, None),
        (4, ""),
        (None, f"x\n{line}\ny"),
        (5, "short\nÄÖÜ is not lowered here"),
        (6, "äöü is not lowered here\nshort"),
        (7, "alone in this document\nalone in this document"),
        (8, "\n".join(f"line number {i} of a long text" for i in range(20_000))),
        (9, "\n".join(f"line number {i} of a long text" for i in range(20_000))),
        (1, f"{line}\nown line of one\n{line}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS n_lines", "2 AS __x")
    found = mark_duplicate_lines(docs)
    assert found.columns == ["doc_id", "text", "__x", "n_lines", "n_dropped", "kept_text"]
    got = {(str(r.doc_id), r.text): (r.n_lines, r.n_dropped, r.kept_text) for r in found.collect()}
    assert len(found.collect()) == len(rows)
    want = {1: (3, 0, rows[0][1]), 2: (4, 1, "short\n\nend"), 3: (1, 0, ""), 4: (1, 0, ""), None: (3, 1, "x\ny"), 5: (2, 0, rows[5][1]), 6: (2, 0, rows[6][1]), 7: (2, 0, rows[7][1]), 8: (20_000, 0, rows[8][1]), 9: (20_000, 20_000, "")}
    assert got == {(str(i), t): want[i] for i, t in rows}
    left = drop_duplicate_lines(docs)
    assert left.columns == docs.columns and {r.doc_id: r.text for r in left.collect()}[3] is None
    names = ["kept_text", "n_dropped", "row", "id", "h", "lines", "k1", "drop"]
    odd = drop_duplicate_lines(docs.selectExpr("doc_id", "text", *[f"'mine' AS {c}" for c in names]))
    assert odd.columns == ["doc_id", "text", *names]
    assert all(r[c] == "mine" for r in odd.collect() for c in names)
    assert {str(r.doc_id): r.text for r in odd.collect()} == {str(r.doc_id): r.text for r in left.collect()}
    assert {r.n_dropped for r in mark_duplicate_lines(docs, min_docs=3).where("doc_id = 2").collect()} == {1}
    assert {r.n_dropped for r in mark_duplicate_lines(docs, min_docs=3).where("doc_id = 9").collect()} == {0}
    three = mark_duplicate_lines(docs, min_docs=4)
    assert {r.n_dropped for r in three.collect()} == {0}
    assert mark_duplicate_lines(docs.limit(0)).count() == 0
