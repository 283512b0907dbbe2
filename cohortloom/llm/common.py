"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a batch of whole texts, and what Spark has for it unless told otherwise.
BATCH_BYTES = 2 << 20
DEFAULT_BATCH = f"{64 << 20}b"
#: Bitmaps of 32,768 bits, 8 MB in all.
BITMAPS = 2048


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only for a session within one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def compact(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` checkpointed, then read in a partition for every ``rows`` rows: the shuffles of small tables make few files."""
    kept = cut_lineage(df)
    return kept.coalesce(1 + kept.count() // rows)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def place(c: Column) -> Column:
    """The bit of a 64-bit number: Spark numbers them from 1 on, number p is bit (p - 1) % 32768 of bitmap 1 + (p - 1) // 32768."""
    return F.pmod(c, F.lit(BITMAPS * 32768)) + 1


def bitmap(places: DataFrame) -> np.ndarray:
    """8 MB with a bit set for each ``p`` (see ``place``) of ``places``; it thins what workers return, others may fall on the same bits."""
    bits = places.groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    table = np.zeros((BITMAPS + 1, 4096), np.uint8)
    for r in bits.toLocalIterator():
        table[r.k] = np.frombuffer(bytes(r.bits), np.uint8)
    return table


def in_bitmap(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    p = values % (BITMAPS * 32768)
    return (table[1 + (p >> 15), (p & 32767) >> 3] >> (p & 7) & 1).astype(bool)


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow``, with Arrow batches of ``BATCH_BYTES`` unless the session sets a size of its own.

    A batch is held several times (by the JVM on its way to the worker and back, by the worker as bytes and as texts),
    by every task of an executor.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, DEFAULT_BATCH) == DEFAULT_BATCH:
        spark.conf.set(key, f"{BATCH_BYTES}b")
    return df.mapInArrow(fn, schema)


def row_of(df: DataFrame, names: Sequence[str] | None = None) -> Column:
    """The columns of ``df`` (or those named) as one struct: operators work beside it, so that no name can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if names is None else names)])


def fields_of(row: str, names: Sequence[str]) -> list[Column]:
    """The columns that ``row_of`` has put away."""
    return [F.col(row).getField(c).alias(c) for c in names]


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns c0, c1, ..., and the new name of each: no result column can clash with them."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns that ``numbered`` has renamed, under their own names."""
    return df.select(*[F.col(n).alias(c) for c, n in names.items()])


def map_batches(
    df: DataFrame,
    text_col: str,
    fn: Callable[[Iterator[tuple[list, pa.RecordBatch]]], Iterator[Sequence[pa.Array]]],
    fields: T.StructType,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add columns that ``fn`` makes from whole texts, batch by batch, in one narrow step.

    ``fn`` gets an iterator of (texts, batch) and yields the new columns of each batch, row for row; the batch's first
    column is the struct of the input columns that are kept. Input columns named as a new column are replaced; ``keep``
    restricts the input columns that are returned.
    """
    names = [f.name for f in fields]
    taken = {n.lower() for n in names}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    row = (row_of(df, kept) if kept else F.lit(True)).alias("row")
    # a text that is kept anyway travels once
    at = kept.index(text_col) if text_col in kept and df.schema[text_col].dataType == T.StringType() else None
    source = df.select(row) if at is not None else df.select(row, F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([source.schema["row"], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def feed():
            for b in batches:
                if b.num_rows:
                    held.append(b)
                    yield (b.column(1) if at is None else b.column(0).field(at)).to_pylist(), b

        for columns in fn(feed()):
            b = held.pop(0)
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["row", *names])

    return map_arrow(source, run, schema).select(*fields_of("row", kept), *names)
