"""Licence scans by diagonal voting.

All rolling word k-grams of the documents are hashed (a polynomial over word hashes, a block of texts at a time) and joined
in Spark to the positions of the same k-grams in the templates; a bitmap of the templates' hashes spares the join those that
no template can have. A hit of document word i on template word j votes for the diagonal i - j: a template that stands in a text word
by word puts all its votes on one diagonal, and each word put in or left out moves the rest to the next one. Votes are
gathered by document, template and diagonal; diagonals at most ``DRIFT`` words apart whose places follow each other are
merged to one span. A span is verified by its words: every vote is kept only if its k words equal the template's (hashes
only find them), and the share of the template's words that votes cover is its coverage. Names must be covered whole on one diagonal, notices
(templates of ``NOTICE_WORDS`` words and more) by at least ``COVERAGE``.

Templates of fewer than ``NOTICE_WORDS`` words use k-grams of ``NAME_GRAM`` words, the others of ``NOTICE_GRAM``. Their
positions are broadcast if they are at most ``BROADCAST_GRAMS``, and joined by a shuffle beyond. One narrow pass over the
texts writes the votes (and a row for each document) to the shared folder; one exchange of these by document follows.
No text is shuffled.

Nulls and edges: a null or empty text has no words; a null id stays; repeated rows are each returned; a template of fewer
words than its k-gram is refused with a ValueError; overlapping places of a template all count; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, map_arrow, stored, text_or_empty
from .license_texts import NAMES, NOTICES, PHRASES

NAME_GRAM, NOTICE_GRAM = 2, 5
NOTICE_WORDS = 12
DRIFT = 8
COVERAGE = 0.6
BROADCAST_GRAMS = 1 << 20
#: What is no part of a word becomes a blank.
BLANKS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Bits of the bitmap, and words whose hashes a worker remembers.
MAP_BITS, KNOWN = 20, 1 << 20


def split_words(text: str) -> list[bytes]:
    """The words of a text, A-Z lower-cased, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().translate(BLANKS).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KNOWN:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """One number for each k consecutive words."""
    n = max(len(hashes) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for d in range(k):
        out = out * MULTIPLIER + hashes[d : d + n]
    return (out ^ np.uint64(k)) * MULTIPLIER


def _hashed(words: list[bytes], known: _Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def template_grams(templates: Sequence[tuple[str, str]]) -> list[tuple]:
    """(k, hash, gram, t, label, m, j): the k-grams of each template, its number, label, words, and the position."""
    rows, known = [], _Hashes()
    for t, (label, text) in enumerate(templates):
        words = split_words(text)
        k = NAME_GRAM if len(words) < NOTICE_WORDS else NOTICE_GRAM
        if len(words) < k:
            raise ValueError(f"template {t} has fewer than {k} words")
        found = rolling(_hashed(words, known), k).view(np.int64).tolist()
        rows += [(k, h, b" ".join(words[j : j + k]).decode(), t, label, len(words), j) for j, h in enumerate(found)]
    return rows


def votes(docs: DataFrame, templates: Sequence[tuple[str, str]], id_col: str, text_col: str) -> DataFrame:
    """One row for each document (t is null) and for each k-gram it shares with a template: rid (the row), id, n_words,
    t, label, m, k, i, j. Written in one pass, so that ``rid`` names the same row ever after."""
    spark, rows = docs.sparkSession, template_grams(templates)
    marked = np.zeros(1 << MAP_BITS, bool)
    marked[np.array([r[1] for r in rows], np.int64).view(np.uint64) >> np.uint64(64 - MAP_BITS)] = True
    shared = spark.sparkContext.broadcast(marked)
    source = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"), text_or_empty(F.col(f"`{text_col}`").cast("string")).alias("text"))
    schema = T.StructType(
        [T.StructField("rid", T.LongType()), T.StructField("id", source.schema["id"].dataType), T.StructField("n_words", T.LongType())]
        + [T.StructField("k", T.IntegerType()), T.StructField("i", T.LongType()), T.StructField("hash", T.LongType()), T.StructField("gram", T.StringType())]
    )

    def run(batches):
        table, known = shared.value, _Hashes()
        for b in batches:
            at, n_words, found = [], [], []
            for row, text in enumerate(b.column(2).to_pylist()):
                words = split_words(text)
                mine = [(0, -1, 0, None)]
                hashes = _hashed(words, known)
                for k in (NAME_GRAM, NOTICE_GRAM):
                    h = rolling(hashes, k)
                    hits = np.flatnonzero(table[h >> np.uint64(64 - MAP_BITS)]).tolist()
                    mine += [(k, i, v, b" ".join(words[i : i + k]).decode("utf-8", "replace")) for i, v in zip(hits, h[hits].view(np.int64).tolist())]
                at += [row] * len(mine)
                n_words += [len(words)] * len(mine)
                found += mine
            take = pa.array(at, pa.int32())
            columns = zip(*found) if found else ((),) * 4
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(n_words, pa.int64()), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=schema.names)

    each = map_arrow(source, run, schema)
    known = spark.createDataFrame(rows, "t_k int, t_hash long, t_gram string, t int, label string, m int, j int")
    known = F.broadcast(known) if len(rows) <= BROADCAST_GRAMS else known
    met = each.join(known, (F.col("hash") == F.col("t_hash")) & (F.col("k") == F.col("t_k")) & (F.col("gram") == F.col("t_gram")), "left")
    return stored(met.where("i < 0 OR t IS NOT NULL").select("rid", "id", "n_words", "t", "label", "m", "k", "i", "j"), "licence-votes")


def spans(found: DataFrame) -> DataFrame:
    """Verified and rejected spans of ``votes``: rid, id, t, label, m, first and last word, coverage, whole (one diagonal
    covers the template)."""
    by = Window.partitionBy("rid", "t")
    diagonals = (
        found.where("t IS NOT NULL")
        .repartition("rid")
        .groupBy("rid", "t", (F.col("i") - F.col("j")).alias("diagonal"))
        .agg(*[F.first(c).alias(c) for c in ("id", "label", "m", "k")], F.min("i").alias("first"), F.max(F.col("i") + F.col("k") - 1).alias("last"), F.collect_set("j").alias("js"))
    )
    whole = F.size("js") == F.col("m") - F.col("k") + 1
    name = F.col("m") < NOTICE_WORDS
    # a name is one diagonal; a notice goes on where the next diagonal is near, in words and in what was put in or left out
    before = by.orderBy("first", "diagonal")
    apart = name | ((F.col("first") - F.max("last").over(before.rowsBetween(Window.unboundedPreceding, -1))) > DRIFT) | (F.abs(F.col("diagonal") - F.lag("diagonal").over(before)) > DRIFT)
    islands = diagonals.withColumns({"whole": whole, "new": F.coalesce(apart, F.lit(True)).cast("int")}).withColumn("island", F.sum("new").over(before))
    merged = islands.groupBy("rid", "t", "island").agg(
        *[F.first(c).alias(c) for c in ("id", "label", "m", "k")],
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("whole").alias("whole"),
        F.array_distinct(F.flatten(F.collect_list("js"))).alias("js"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("js", lambda j: F.sequence(j, j + F.col("k") - 1)))))
    return merged.select("rid", "id", "t", "label", "m", "first", "last", "whole", (covered / F.col("m")).alias("coverage"))


def verified() -> Column:
    return F.when(F.col("m") < NOTICE_WORDS, F.col("whole")).otherwise(F.col("coverage") >= COVERAGE)


ALL = [*PHRASES, *NAMES, *NOTICES]


def find_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = ALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified spans: id, label, template (its number), first_word, last_word, coverage."""
    found = spans(votes(docs, templates, id_col, text_col)).where(verified())
    return found.select(F.col("id").alias(id_col), "label", F.col("t").alias("template"), F.col("first").alias("first_word"), F.col("last").alias("last_word"), "coverage")


def label_documents(docs: DataFrame, templates: Sequence[tuple[str, str]] = ALL, base: int = len(PHRASES), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: places of the first ``base`` templates and the labels of all; ``score`` is the greatest
    coverage of any template, labelled or not."""
    found = votes(docs, templates, id_col, text_col)
    none = lambda kind: F.lit(None).cast(kind)
    ok, is_base = F.coalesce(verified(), F.lit(False)), F.col("t") < base
    spoken = spans(found).select("rid", F.when(ok & is_base, F.col("first")).alias("place"), F.when(ok, F.col("label")).alias("label"), is_base.alias("is_base"), "coverage")
    read = found.where("t IS NULL").select("rid", F.col("id"), "n_words")
    rows = read.select("*", none(T.LongType()).alias("place"), none("string").alias("label"), F.lit(False).alias("is_base"), F.lit(0.0).alias("coverage"))
    both = rows.unionByName(spoken.withColumn("place", F.col("place").cast("long")), allowMissingColumns=True)
    joined = lambda labels: F.array_join(F.sort_array(labels), ",")
    return (
        both.groupBy("rid")
        .agg(
            F.any_value("id", True).alias(id_col),
            F.max("n_words").alias("n_words"),
            F.count("place").alias("n_base"),
            F.min("place").alias("first_word"),
            F.max("place").alias("last_word"),
            joined(F.collect_set(F.when(F.col("is_base"), F.col("label")))).alias("base_labels"),
            joined(F.collect_set("label")).alias("labels"),
            F.max("coverage").alias("score"),
        )
        .drop("rid")
    )


def op13_license_scan(spark, sf_dir: str) -> DataFrame:
    return label_documents(documents(spark, sf_dir).select("doc_id", "text"))
