"""A keyed table in hash buckets: a small batch rewrites the buckets it touches and no other.

Version v of the log (``operators.versions``) names a manifest, a Parquet table with a row for each file: bucket, path,
rows and a Bloom filter of the file's keys. Readers take a version's manifest and so see whole versions. A merge

* deals the batch's rows out by the hash of their key, so k keys touch k buckets at most;
* looks the keys up in the filters: where none of a bucket's keys can be there yet, its rows go to a further file of it,
  else the bucket's files are read, merged with the batch and written as one new file (copy on write);
* publishes the manifest with the touched buckets' files changed. Of two writers one fails (``StaleVersion``) and merges
  again on top of the other; files of lost writers are named by no manifest.

``compact`` puts buckets of several files together and deals the table out to more buckets once these hold more than
``BUCKET_ROWS`` rows on average. Data never pass through the driver; of the manifest it sees the touched rows' paths.

Filters have ``BITS`` bits and ``PROBES`` probes a key: at 3,000 keys a bucket about 1 of 35 new keys is taken for one that
may be there, which costs a rewrite and changes no result; at ``BUCKET_ROWS`` nearly all are.

Null keys are values like others; a batch without rows publishes nothing; of a key's rows in a batch the last by ``order``
counts (nulls first), ties are decided by all columns of the row in ascending order, so a repeated batch gives the same state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions as V
from .timeline import first_by

BITS, PROBES = 32768, 3
BUCKETS = 64
BUCKET_ROWS = 200_000
MANIFEST = "bucket int, path string, rows long, filter binary"


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _probes(key: Sequence[str]) -> list[Column]:
    """The bits of a key, numbered from 1 as Spark's bitmaps do."""
    return [F.pmod(F.xxhash64(F.lit(i), *key), F.lit(BITS)) + 1 for i in range(PROBES)]


def _has_bit(bits: Column, place: Column) -> Column:
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1


def _filters(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """path, rows and filter of each value of ``path``."""
    probes = rows.select("path", F.explode(F.array(F.lit(0).cast("long"), *_probes(key))).alias("p"))
    counted = F.sum((F.col("p") == 0).cast("long")).alias("rows")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.when(F.col("p") > 0, F.col("p")).otherwise(F.lit(None)))).alias("filter")
    return probes.groupBy("path").agg(counted, bits)


def _manifest(spark: SparkSession, content: dict) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(content["manifest"]) if content.get("manifest") else spark.createDataFrame([], MANIFEST)


def _files(spark: SparkSession, root: str, folder: str) -> list[tuple[int, str]]:
    """(bucket, path) of the files that a write by bucket has left."""
    fs, p = V._files(spark, folder)
    out = []
    for d in fs.listStatus(p):
        name = d.getPath().getName()
        if name.startswith("bucket="):
            out += [(int(name[7:]), f"{folder}/{name}/{f.getPath().getName()}") for f in fs.listStatus(d.getPath()) if f.getPath().getName().endswith(".parquet")]
    return out


def _write(rows: DataFrame, root: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Write rows to one file for each bucket; their part of the manifest."""
    spark, folder = rows.sparkSession, V.new_folder(root, "files")
    dealt = rows.withColumn("bucket", _bucket(key, buckets)).repartition("bucket")
    dealt.write.partitionBy("bucket").parquet(folder)
    made = spark.createDataFrame(_files(spark, root, folder), "bucket int, path string")
    names = made.withColumn("name", F.substring_index("path", "/", -1)).select("bucket", "name", "path")
    if names.isEmpty():
        return spark.createDataFrame([], MANIFEST)
    back = spark.read.parquet(folder).select(*key, F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("name"), "bucket")
    found = _filters(back.join(F.broadcast(names), ["bucket", "name"]).drop("bucket", "name"), key)
    return names.select("bucket", "path").join(found, "path").select("bucket", "path", "rows", "filter")


def _publish(spark: SparkSession, root: str, base: int, content: dict, manifest: DataFrame, **changed) -> int:
    following = V.next_version(spark, root)
    if V.latest(spark, root)[0] != base:
        raise V.StaleVersion(f"version {base} is not the current one")
    folder = V.new_folder(root, "manifest")
    manifest.coalesce(1).write.parquet(folder)
    V.add_entry(spark, root, following, content | {"manifest": folder} | changed)
    return following


def create(spark: SparkSession, root: str, schema: str, key: Sequence[str], buckets: int = BUCKETS) -> int:
    """Publish an empty table as version 1."""
    V.add_entry(spark, root, 1, {"schema": schema, "key": list(key), "buckets": buckets, "manifest": None})
    return 1


def _read(spark: SparkSession, content: dict, paths: list[str]) -> DataFrame:
    return spark.read.schema(content["schema"]).parquet(*paths) if paths else spark.createDataFrame([], content["schema"])


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the latest by default."""
    content = V.entry(spark, root, version) if version else V.latest(spark, root)[1]
    return _read(spark, content, [r.path for r in _manifest(spark, content).select("path").toLocalIterator()])


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    return _manifest(spark, V.entry(spark, root, version) if version else V.latest(spark, root)[1])


def newest(order: Sequence[str]) -> Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]:
    """Merge rule: of all rows of a key the last by ``order`` stays."""
    return lambda old, new, key: _last(old.unionByName(new), key, order)


def _last(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_by(rows, list(key), [F.col(c).desc_nulls_last() for c in order] + [F.col(c).asc_nulls_first() for c in rows.columns if c not in order])


def merge(batch: DataFrame, root: str, order: Sequence[str], rule: Callable | None = None, attempts: int = 10, marks: dict | None = None) -> int:
    """Merge ``batch`` into the table; the version that has it.

    ``rule(old, new, key)`` gives the new rows of rewritten buckets (default: ``newest(order)``), for instance
    ``changes.upsert``; rows of new keys come in. Columns that the batch lacks are null in new rows. ``marks`` are kept with
    the version.
    """
    spark = batch.sparkSession
    rule = rule or newest(order)
    for attempt in range(attempts):
        base, content = V.latest(spark, root)
        key, buckets = content["key"], content["buckets"]
        staged = V.new_folder(root, "batch")
        empty = spark.createDataFrame([], content["schema"])
        _last(batch.select(*[c for c in empty.columns if c in batch.columns]), key, order).withColumn("bucket", _bucket(key, buckets)).write.parquet(staged)
        rows = spark.read.parquet(staged)
        files = _manifest(spark, content)
        touched = rows.select("bucket").distinct().join(files, "bucket", "left")
        probed = rows.select("bucket", *[p.alias(f"p{i}") for i, p in enumerate(_probes(key))])
        hit = reduce(lambda a, b: a & b, [_has_bit(F.col("filter"), F.col(f"p{i}")) for i in range(PROBES)])
        known = probed.join(touched.where("filter IS NOT NULL"), "bucket").where(hit).select("bucket").distinct()
        # paths of the touched buckets come to the driver, as a read must name its files
        of = touched.join(known.withColumn("known", F.lit(True)), "bucket", "left").select("bucket", "path", F.coalesce("known", F.lit(False)).alias("known")).collect()
        if not of:
            return base
        rewritten = sorted({r.bucket for r in of if r.known})
        old = _read(spark, content, [r.path for r in of if r.known])
        again = spark.createDataFrame([(b,) for b in rewritten], "bucket int")
        fresh = empty.unionByName(rows.join(again, "bucket", "left_anti").drop("bucket"), allowMissingColumns=True)
        merged = rule(old, rows.join(again, "bucket", "left_semi").drop("bucket"), key) if rewritten else None
        made = _write(fresh if merged is None else merged.unionByName(fresh), root, key, buckets)
        kept = files.join(again, "bucket", "left_anti")
        try:
            return _publish(spark, root, base, {k: v for k, v in content.items() if k != "marks"} | {"marks": marks}, kept.unionByName(made), rewritten=rewritten)
        except V.StaleVersion:
            if attempt + 1 == attempts:
                raise
    raise V.StaleVersion(root)


def compact(spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS) -> int:
    """One file a bucket, and twice the buckets until these hold ``bucket_rows`` rows on average; the version that has it."""
    base, content = V.latest(spark, root)
    files = _manifest(spark, content)
    total = files.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    buckets = content["buckets"]
    while total > bucket_rows * buckets:
        buckets *= 2
    several = files.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    moved = files if buckets != content["buckets"] else files.join(several, "bucket", "left_semi")
    paths = [r.path for r in moved.select("path").toLocalIterator()]
    if not paths:
        return base
    made = _write(_read(spark, content, paths), root, content["key"], buckets)
    kept = files.join(moved.select("bucket").distinct(), "bucket", "left_anti")
    return _publish(spark, root, base, content, kept.unionByName(made), buckets=buckets, rewritten=[])
