"""Exact deduplication by content sort, with DataFrame operations only.

Sampled splitters range-partition the normalised texts by a bounded content key (a short prefix and the SHA-256 of the
whole text), Spark's external sort puts equal texts next to each other, and the window over the run of neighbours
compares the texts in full. The row with the chosen (largest or smallest) identifier of each run stays.

A text that many rows share would fill one task. Such texts are looked for in a sample of the rows; their rows spread
over ``SALTS`` sort keys, and the partial runs that the sort leaves are put together again: one row for each run, of a
few texts (a text with more than one in ``HOT_SHARE`` of the sampled rows; there are fewer than ``HOT_SHARE`` of those).
A text that the sample misses is one run like any other: the sample spreads work and decides nothing.

Nulls and edges: a null text counts as empty; a null identifier loses against any other; of rows that agree in text and
identifier exactly one is kept; an empty table gives an empty result; other columns are never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, documents, fields_of, row_of, text_or_empty

HOT_SHARE = 2000
SALTS = 64
SAMPLE = 0.01
PREFIX = 64


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    normalise=None,
    carry: bool = False,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256; with ``carry`` also ``row``, the input row."""
    if keep not in ("max", "min"):
        raise ValueError("keep is 'max' or 'min'")
    ident: Column = F.col(f"`{id_col}`")
    text = text_or_empty(F.col(f"`{text_col}`").cast("string"))
    text = normalise(text) if normalise else text
    rows = docs.select(ident.alias("id"), text.alias("text"), *([row_of(docs).alias("row")] if carry else [])).withColumn("sha", F.sha2("text", 256))

    counted = cut_lineage(docs.sample(SAMPLE, seed=11).select(F.sha2(text, 256).alias("sha")).groupBy("sha").agg(F.count("*").alias("n")))
    least = max(4, (counted.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE)
    hot = counted.where(F.col("n") > least).select("sha", F.lit(True).alias("hot"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).otherwise(0)
    dealt = rows.join(F.broadcast(hot), "sha", "left").withColumns({"prefix": F.substring("text", 1, PREFIX), "salt": salt, "hot": F.coalesce("hot", F.lit(False))})
    dealt = dealt.repartitionByRange("prefix", "sha", "salt")

    order = [F.col("id").desc_nulls_last() if keep == "max" else F.col("id").asc_nulls_last()]
    run = Window.partitionBy("prefix", "sha", "salt", "text").orderBy(*order)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    judged = dealt.select(
        "id", "sha", "hot", F.first("id").over(whole).alias("keep_id"), F.count("*").over(whole).alias("group_size"), F.row_number().over(run).alias("rank"), *(["row"] if carry else [])
    )
    judged = cut_lineage(judged) if not hot.isEmpty() else judged
    # the partial runs of hot texts: at most SALTS rows for each
    best = F.max if keep == "max" else F.min
    parts = judged.where("hot AND rank = 1").groupBy("sha").agg(best("keep_id").alias("all_id"), F.sum("group_size").alias("all_n"))
    judged = judged.join(F.broadcast(parts), "sha", "left")
    keep_id, size = F.when(F.col("hot"), F.col("all_id")).otherwise(F.col("keep_id")), F.coalesce("all_n", "group_size")
    # of a hot text the null ids lie in one run (their salt is the same), and so do equal ids
    kept = (F.col("rank") == 1) & F.col("id").eqNullSafe(keep_id)
    return judged.select(F.col("id").alias(id_col), keep_id.alias("keep_id"), size.alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"), *(["row"] if carry else []))


def drop_exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return exact_groups(docs, carry=True, **options).where("kept").select(*fields_of("row", docs.columns))


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir), keep="max")


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
