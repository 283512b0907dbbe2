"""Sources and sinks: typed readers, snapshots, file inventories, manifests, annotation exports and audit counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_tables(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Tables of one folder (one database); several folders give several databases."""
    return {n: spark.read.parquet(f"{root}/{n}.parquet") for n in names}


def restrict_to_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of a key list of any length; ids compare as text, so quoted and unquoted ones meet."""
    wanted = keys.select(F.col(on).cast("string").alias("_k")).distinct()
    return df.join(wanted, df[on].cast("string") == wanted["_k"], "left_semi")


def read_csv_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S3: the columns of the schema, found by their names in the header (in lower case), so text ids keep their zeros.

    Other columns are left out; a value that is none of the type is null; an absent column is an error.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    have = {c.strip().lower(): c for c in raw.columns}
    fields = T.StructType.fromDDL(schema)
    if absent := [f.name for f in fields if f.name.lower() not in have]:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    return raw.select(*[F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType).alias(f.name) for f in fields])


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    """Arrays as joined text."""
    flat = {f.name: F.array_join(F.col(f.name).cast("array<string>"), sep) for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    df.withColumns(flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A line that is no record stays as a row with its text in ``error``."""
    return spark.read.schema(f"{schema}, error string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "error").json(path)


def worklist(df: DataFrame, key: str, text: str, least: int, most: int | None = None) -> DataFrame:
    """One JSON object per row with a text of at least ``least`` characters, in order of the key."""
    size = F.length(F.trim(F.col(text)))
    rows = df.where((size >= least) & (F.lit(True) if most is None else size <= most))
    return rows.orderBy(key).select(F.to_json(F.struct(F.col(key).alias("id"), F.col(text).alias("text"))).alias("value"))


def write_worklist(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def where_params(spark: SparkSession, table: DataFrame, condition: str, **params) -> DataFrame:
    """Rows that meet a condition with named parameters."""
    return spark.sql(f"SELECT * FROM {{t}} WHERE {condition}", args=params, t=table)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def snapshot(df: DataFrame, path: str, rebuild: bool = False) -> DataFrame:
    """The Parquet copy of a table, made where there is none (or anew if asked)."""
    spark = df.sparkSession
    if rebuild or not _exists(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def snapshot_or_csv(spark: SparkSession, path: str, csv: str, schema: str) -> DataFrame:
    """The snapshot, or the CSV files it would be made from where there is none."""
    return spark.read.parquet(path) if _exists(spark, path) else read_csv_typed(spark, csv, schema)


def snapshot_status(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Name, and whether its snapshot is complete."""
    return spark.createDataFrame([(n, _exists(spark, p)) for n, p in sorted(paths.items())], "name string, present boolean")


def file_inventory(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, stem and parent folder of the files; only names are read, no content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    return files.select("path", *path_columns(F.col("path")), "length")


def path_columns(path: Column) -> list[Column]:
    parts = F.split(path, "/")
    return [F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "").alias("stem"), F.try_element_at(parts, F.lit(-2)).alias("parent")]


def write_manifest(rows: DataFrame, files: DataFrame, key: str, label: str, codes: dict[str, int], template: str) -> DataFrame:
    """Rows whose file is there, with the code of their label and their path."""
    lookup = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    there = rows.join(files.select(F.col("stem").alias(key)).distinct(), key, "left_semi")
    head, tail = template.split("{}")
    return there.withColumns({"code": F.try_element_at(lookup, F.col(label)), "path": F.concat(F.lit(head), F.col(key), F.lit(tail))})


class Audit:
    """Counters by dotted key, collected while the stages run (no extra pass) and kept as a long table."""

    def __init__(self, run: str):
        self.run, self.rows, self.pending = run, [], []

    def record(self, key: str, value: float) -> None:
        self.rows.append((self.run, key, float(value)))

    def watch(self, df: DataFrame, prefix: str, **measures: Column) -> DataFrame:
        seen = Observation(prefix)
        self.pending.append((prefix, seen))
        return df.observe(seen, *[c.alias(n) for n, c in measures.items()])

    def table(self, spark: SparkSession) -> DataFrame:
        """What the watched stages counted, once they have run."""
        for prefix, seen in self.pending:
            for name, value in seen.get.items():
                self.record(f"{prefix}.{name}", value or 0)
        self.pending = []
        return spark.createDataFrame(self.rows, "run string, key string, value double")


EXPORT = """data_row struct<id: string, global_key: string, external_id: string>,
projects map<string, struct<project_details: struct<workflow_status: string>,
  labels: array<struct<annotations: struct<classifications: array<struct<name: string, checklist_answers: array<struct<name: string, value: string>>>>>>>>>"""


def flatten_annotations(df: DataFrame, column: str, status: str = "IN_REVIEW", disqualified: str = "disqualified") -> DataFrame:
    """One row per label and classification of an annotation export, answers joined; items in another status and
    items with a disqualifying answer are left out."""
    item = df.select(F.from_json(column, EXPORT).alias("x")).select("x.data_row", F.explode(F.map_values("x.projects")).alias("p"))
    item = item.where(F.col("p.project_details.workflow_status") == status)
    labels = item.select(F.col("data_row.global_key").alias("key"), F.posexplode("p.labels").alias("label", "l"))
    bad = F.exists("l.annotations.classifications", lambda c: F.exists(c["checklist_answers"], lambda a: a["value"] == disqualified))
    each = labels.where(~F.coalesce(bad, F.lit(False))).select("key", "label", F.explode("l.annotations.classifications").alias("c"))
    answers = F.array_join(F.array_sort(F.transform("c.checklist_answers", lambda a: a["name"])), "; ")
    return each.select("key", "label", F.col("c.name").alias("feature"), answers.alias("answers"))
