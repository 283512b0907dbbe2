"""Delta-maintained token counts by source, language and tokenizer version.

A batch of changes (inserted documents, deleted documents, revised counts) becomes signed sums, combined before the
shuffle. Committing a batch writes its sums and the new totals, which are the totals before plus these sums (both are as
many rows as there are groups, never the documents), to folders of their own and then adds one entry to the log of
versions (``operators.versions``); the entry appears whole, and only if that version is not there yet. It names the batch and
all committed batch numbers, as ranges, so a commit reads one entry however many there are. So

* a batch is committed whole or not at all: a crash before the entry leaves folders that nobody reads;
* a batch number that is committed already is left as it is, whatever the repeated commit brings;
* of two writers one adds the version, the other reads the log again and goes on from there.

Nulls and edges: null source or language is a group of its own; a null text has no tokens; a null count is zero; a group
whose documents and tokens are both zero leaves the totals; a delete of what was never inserted counts below zero until
its insert comes; an empty batch commits as empty; without a commit the totals are empty; input columns named
``tokenizer`` or ``tokens`` are replaced.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import versions as V
from .common import cut_lineage, documents, map_batches, numbered, shared_path
from .tokens import encoder, load_spec

KEYS = ("source", "lang", "tokenizer")
BATCH = T.StructType([T.StructField(k, T.StringType()) for k in KEYS] + [T.StructField("docs", T.LongType()), T.StructField("tokens", T.LongType())])


def count_tokens(docs: DataFrame, tokenizers: dict[str, str], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` once for each tokenizer version, with ``tokenizer`` and ``tokens``."""
    names = sorted(tokenizers)
    shared = docs.sparkSession.sparkContext.broadcast([load_spec(tokenizers[n]) for n in names])

    def run(batches):
        encoders = [encoder(s) for s in shared.value]
        for texts, _ in batches:
            counts = [[0] * len(texts) for _ in encoders]
            for k, e in enumerate(encoders):
                for a in range(0, len(texts), 256):
                    counts[k][a : a + 256] = [len(ids) // 4 for ids in e.encode(texts[a : a + 256])]
            yield [pa.array([list(c) for c in zip(*counts)] if encoders else [[]] * len(texts), pa.list_(pa.int64()))]

    schema = T.StructType([T.StructField("counts", T.ArrayType(T.LongType()))])
    plain, of = numbered(docs if keep is None else docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])]))
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("tokenizer", "tokens")]
    counted = map_batches(plain, of[text_col], run, schema, [of[c] for c in kept])
    each = counted.select(*[of[c] for c in kept], F.posexplode("counts").alias("k", "tokens"))
    return each.select(*[F.col(of[c]).alias(c) for c in kept], F.element_at(F.array(*map(F.lit, names)), F.col("k") + 1).alias("tokenizer"), "tokens")


def _signed(rows: DataFrame, docs: Column, tokens: Column) -> DataFrame:
    return rows.select(*[F.col(k).cast("string").alias(k) for k in KEYS], docs.cast("long").alias("docs"), F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"))


def inserts(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    return _signed(rows, F.lit(1), F.col(tokens))


def deletes(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    return _signed(rows, F.lit(-1), -F.col(tokens))


def revisions(rows: DataFrame, old: str = "old_tokens", new: str = "tokens") -> DataFrame:
    return _signed(rows, F.lit(0), F.coalesce(F.col(new), F.lit(0)) - F.coalesce(F.col(old), F.lit(0)))


def committed(spark: SparkSession, root: str) -> dict[int, int]:
    """The history: batch numbers and their versions."""
    return {V.entry(spark, root, v)["batch"]: v for v in V.versions(spark, root)}


def _within(runs: list[list[int]], batch: int) -> bool:
    i = bisect_right(runs, [batch, float("inf")])
    return i > 0 and batch <= runs[i - 1][1]


def _with(runs: list[list[int]], batch: int) -> list[list[int]]:
    """Ranges of numbers, in order, with one more number."""
    out: list[list[int]] = []
    for lo, hi in sorted([*runs, [batch, batch]]):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _write(sums: DataFrame, root: str, name: str) -> str:
    folder = V.new_folder(root, name)
    sums.write.parquet(folder)
    return folder


def commit(root: str, batch: int, *changes: DataFrame) -> bool:
    """Commit signed changes under a batch number; False if that number is committed already, and nothing changes."""
    spark = changes[0].sparkSession
    folder = None
    while True:
        following = V.next_version(spark, root)
        version, content = V.latest(spark, root)
        runs = content.get("batches", [])
        if _within(runs, batch):
            return False
        if folder is None:
            rows = changes[0]
            for more in changes[1:]:
                rows = rows.unionByName(more)
            folder = _write(_summed(rows), root, f"batch-{batch}")
        sums = spark.read.schema(BATCH).parquet(folder)
        before = spark.read.schema(BATCH).parquet(content["totals"]) if version else sums.limit(0)
        after = _write(_summed(before.union(sums)).where("docs <> 0 OR tokens <> 0"), root, f"totals-{following}")
        try:
            V.add_entry(spark, root, following, {"batch": batch, "batches": _with(runs, batch), "sums": folder, "totals": after})
            return True
        except V.StaleVersion:
            continue  # somebody else has added that version


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def totals(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """source, lang, tokenizer, docs and tokens after all commits, or as they were at a version."""
    content = {} if version == 0 else V.entry(spark, root, version) if version else V.latest(spark, root)[1]
    return spark.read.schema(BATCH).parquet(content["totals"]) if content else spark.createDataFrame([], BATCH)


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    """Totals of all documents by source, language and two tokenizer versions.

    All documents come in with a provisional count and get their exact one; the toxic ones leave and, once they have been
    looked at, come back. The revision is committed twice, as after a lost driver.
    """
    import public_tokenizers

    root = shared_path(spark, "token-counts")
    tokenizers = {"word_bpe_49k": public_tokenizers.path("word_bpe_49k.json"), "byte_bpe_50k": public_tokenizers.path("byte_bpe_50k.tiktoken")}
    docs = documents(spark, sf_dir).select("doc_id", "source", "lang", "text", F.ceil(F.length("text") / 4).cast("long").alias("old_tokens"))
    counted = cut_lineage(count_tokens(docs, tokenizers, keep=["doc_id", "source", "lang", "old_tokens"]))
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").select("doc_id")
    marked = cut_lineage(counted.join(toxic, "doc_id", "left_semi"))
    commit(root, 1, inserts(counted, "old_tokens"))
    for _ in range(2):
        commit(root, 2, revisions(counted))
    commit(root, 3, deletes(marked))
    commit(root, 4, inserts(marked))
    return totals(spark, root)
