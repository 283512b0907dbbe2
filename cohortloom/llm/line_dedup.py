"""Line deduplication with DataFrame operations only.

Explode the normalised lines of each document, hash the keys (two XXH64 with different seeds, 128 bits together), count
the distinct documents of each hash with map-side combining, look up the lines of frequent keys, and reassemble each
document from the positions that stay. Counting distinct ids goes by (key, id) first, so a hot line is spread over its
documents; the frequent keys are checkpointed, so that both sides of the look-up are plain shuffles and adaptive
execution can split the partition of a hot line.

Keys are told apart by their 128 bits alone: among n different keys some two agree with a chance of about n * n / 2**129,
1.5e-15 for 10**12 keys.

Nulls and edges: a null text is one empty line; a null id counts as one more document that comes after all others;
rows that agree in id are the same document, so a line is not a duplicate for standing in both; an empty table gives an
empty result; columns other than id and text are carried through and may have any name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, documents, fields_of, row_of, text_or_empty

BLANK = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; texts of ASCII alone take the fast path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def _line_hashes(rows: DataFrame, min_chars: int) -> DataFrame:
    lines = rows.select("id", "h", F.posexplode(F.split(ascii_lower(F.col("text")), "\n", -1)).alias("pos", "line"))
    lines = lines.withColumn("key", F.btrim(F.col("line"), F.lit(BLANK))).where(F.length("key") >= min_chars)
    return lines.select("id", "h", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(7), "key").alias("k2"))


def _marked(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """row (the input columns), n_lines, n_dropped and kept_text."""
    text = text_or_empty(F.col(f"`{text_col}`").cast("string"))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), row_of(docs).alias("row")).withColumn("h", F.xxhash64("text"))
    lines = _line_hashes(base, min_chars)
    # keys of too few documents need no further look; a null id is one more document, after all others
    n_docs = F.col("n") + F.col("null").cast("int")
    repeated = cut_lineage(
        lines.groupBy("k1", "k2")
        .agg(F.count_distinct("id").alias("n"), F.min("id").alias("first"), F.bool_or(F.col("id").isNull()).alias("null"))
        .where((n_docs >= min_docs) & F.col("first").isNotNull())
        .select("k1", "k2", "first")
    )
    dropped = (
        lines.join(repeated, ["k1", "k2"])
        .where(F.coalesce(F.col("id") > F.col("first"), F.lit(True)))
        .groupBy("id", "h")
        .agg(F.collect_set("pos").alias("drop"))
        .select(F.col("id").alias("d_id"), F.col("h").alias("d_h"), "drop")
    )
    joined = base.join(dropped, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("h") == F.col("d_h")), "left")
    joined = joined.withColumn("lines", F.split("text", "\n", -1))
    n = F.size("lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drop"))
    kept = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.col("lines")[i]), "\n"))
    n_dropped = F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop"))
    return joined.select("row", n.cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"), kept.alias("kept_text"))


def mark_duplicate_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text (the document without the lines that repeat elsewhere).

    A key (line stripped of blanks, A-Z lower-cased) of at least ``min_chars`` code points that at least ``min_docs``
    documents hold keeps its lines only in the document with the smallest id. Input columns named like a result are
    replaced.
    """
    results = ["n_lines", "n_dropped", "kept_text"]
    return _marked(docs, id_col, text_col, min_chars, min_docs).select(*fields_of("row", [c for c in docs.columns if c.lower() not in results]), *results)


def drop_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text; the columns stay as they were (a null text stays null)."""
    marked = _marked(docs, id_col, text_col, min_chars, min_docs)
    was = F.col("row").getField(text_col)
    text = F.when(was.isNull(), was).otherwise(F.col("kept_text"))
    return marked.select(*[(text if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    marked = mark_duplicate_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return marked.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), counted AS (
  SELECT key, min(doc_id) AS first_doc, count(DISTINCT doc_id) AS n_docs FROM lines WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT l.doc_id, l.pos, l.line, coalesce(c.n_docs >= 2 AND l.doc_id <> c.first_doc, false) AS drop_it
  FROM lines l LEFT JOIN counted c ON l.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop_it) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT drop_it), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
