"""Set operations, reshaping and table changes on natural keys.

A change makes the new state of a table from its old one; ``publish`` swaps it in under a version.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import versions as V
from .timeline import first_by
from .versions import StaleVersion


def union_all_by_name(*frames: DataFrame) -> DataFrame:
    """G1: rows of tables with different columns; absent ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Numbers of keys in both, in one only, and the shared part of each in percent."""
    sides = a.select(key).distinct().withColumn("in_a", F.lit(1)).unionByName(b.select(key).distinct().withColumn("in_b", F.lit(1)), allowMissingColumns=True)
    per = sides.groupBy(key).agg(F.max("in_a").alias("a"), F.max("in_b").alias("b"))
    counts = per.agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both"), F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b"))
    part = lambda c: F.round(100 * F.try_divide(F.col("both"), F.col("both") + F.col(c)), 4)
    return counts.withColumns({"percent_a": part("only_a"), "percent_b": part("only_b")})


def insert_ignore(table: DataFrame, rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of new keys come in, the first of each key; present keys stay as they are."""
    fresh = first_by(rows, key, order).join(table.select(*key).distinct(), list(key), "left_anti")
    return table.unionByName(fresh.select(*table.columns))


def _merged(table: DataFrame, rows: DataFrame, key: Sequence[str], pick) -> DataFrame:
    old = table.select(*key, F.struct(*table.columns).alias("_old"))
    new = rows.select(*key, F.struct(*rows.columns).alias("_new"))
    joined = old.join(new, list(key), "full")
    return joined.select(*[F.col(c) if c in key else (pick(c) if c in rows.columns else F.col(f"_old.{c}")).alias(c) for c in table.columns])


def upsert(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of present keys replace the columns that they have, rows of new keys come in."""
    return _merged(table, rows, key, lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")))


def upsert_coalesce(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """As upsert, but absent new values leave the old ones."""
    return _merged(table, rows, key, lambda c: F.coalesce(F.col(f"_new.{c}"), F.col(f"_old.{c}")))


def update_only(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """As upsert without new keys."""
    new = rows.select(*key, F.struct(*rows.columns).alias("_new"))
    joined = table.join(new, list(key), "left")
    pick = lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c))
    return joined.select(*[pick(c).alias(c) if c in rows.columns and c not in key else F.col(c) for c in table.columns])


def to_flag(c: Column) -> Column:
    """T, 1 and true are 1, all else is 0."""
    return F.when(F.lower(c.cast("string")).isin("t", "1", "true"), 1).otherwise(0)


def coerce(df: DataFrame, flags: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """Flags to 0/1, absent texts to empty ones."""
    return df.withColumns({**{c: to_flag(F.col(c)) for c in flags}, **{c: F.coalesce(F.col(c), F.lit("")) for c in texts}})


def cascade_delete(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children whose parent is there."""
    return children.join(parents.select(key).distinct(), key, "left_semi")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """G10."""
    return df.unpivot(list(ids), list(values), name, value)


def override_group(df: DataFrame, key: str, column: str, when: Column, value) -> DataFrame:
    """If any row of the key meets the condition, all of them get the value."""
    any_row = F.max(F.coalesce(when, F.lit(False)).cast("int")).over(Window.partitionBy(key)) == 1
    return df.withColumn(column, F.when(any_row, F.lit(value)).otherwise(F.col(column)))


def split_bilateral(studies: DataFrame, images: DataFrame, key: str = "accession_number", side: str = "laterality") -> tuple[DataFrame, DataFrame]:
    """Bilateral studies become a left and a right one (key with _L, _R) for the sides that their images show.

    A study with images of one side becomes that side under its own key; one without any sided image goes. Images
    follow their side; those of no or another side go with a study that was split or removed.
    """
    has = images.groupBy(key).agg(F.bool_or(F.coalesce(F.col(side) == "LEFT", F.lit(False))).alias("_l"), F.bool_or(F.coalesce(F.col(side) == "RIGHT", F.lit(False))).alias("_r"))
    both = studies.join(has, key, "left").withColumns({"_l": F.coalesce("_l", F.lit(False)), "_r": F.coalesce("_r", F.lit(False))})
    bilateral = F.coalesce(F.col("study_laterality") == "BILATERAL", F.lit(False))
    sides = F.when(~bilateral, F.array("study_laterality")).otherwise(F.array_compact(F.array(F.when(F.col("_l"), F.lit("LEFT")), F.when(F.col("_r"), F.lit("RIGHT")))))
    parts = both.withColumn("_split", bilateral & F.col("_l") & F.col("_r")).withColumn("_side", F.explode(sides))
    new_key = F.when(F.col("_split"), F.concat(F.col(key).cast("string"), F.lit("_"), F.substring("_side", 1, 1))).otherwise(F.col(key).cast("string"))
    out = parts.select(*[(F.col("_side").alias(c) if c == "study_laterality" else new_key.alias(c) if c == key else F.col(c)) for c in studies.columns])
    links = parts.select(key, "_split", F.col("_side"), new_key.alias("_new"), bilateral.alias("_was"))
    moved = images.join(links, (images[key] == links[key]) & (~links["_was"] | F.coalesce(images[side] == links["_side"], F.lit(False))))
    return out, moved.select(*[(F.col("_new").alias(c) if c == key else images[c]) for c in images.columns])


def split_sides_for_export(rows: DataFrame, side: str = "laterality", split: bool = True, keep_unknown: bool = False) -> DataFrame:
    """Rows of both sides as two rows if wanted, rows of no side only if wanted; with was_bilateral and
    has_unknown_laterality."""
    both, none = F.coalesce(F.col(side) == "BILATERAL", F.lit(False)), F.col(side).isNull()
    flagged = rows.withColumns({"was_bilateral": both, "has_unknown_laterality": none})
    flagged = flagged if keep_unknown else flagged.where(~none)
    if not split:
        return flagged
    parts = F.when(both, F.array(F.lit("LEFT"), F.lit("RIGHT"))).otherwise(F.array(side))
    return flagged.withColumn(side, F.explode(parts))


def resolve_duplicates(df: DataFrame, key: str, modality: str, order: Sequence[str]) -> DataFrame:
    """Of rows with the same key: just one US row, keep it; several, drop all; none, one row with all modalities.

    Rows without a key are nobody's duplicate.
    """
    w = Window.partitionBy(key)
    us = F.count_if(F.coalesce(F.col(modality) == "US", F.lit(False))).over(w)
    rows = df.withColumns({"_n": F.count("*").over(w), "_us": us, "_k": F.row_number().over(w.orderBy(*order)), "_all": F.array_join(F.array_sort(F.collect_set(modality).over(w)), ", ")})
    single = F.col(key).isNull() | (F.col("_n") == 1)
    kept = single | ((F.col("_us") == 1) & (F.col(modality) == "US")) | ((F.col("_us") == 0) & (F.col("_k") == 1))
    value = F.when(~single & (F.col("_us") == 0), F.col("_all")).otherwise(F.col(modality))
    return rows.where(kept).withColumn(modality, value).select(*df.columns)


def evolve(df: DataFrame, columns: dict[str, str], rename: dict[str, str] | None = None) -> DataFrame:
    """Columns that are not there yet, as null of their type; renames first."""
    out = df.withColumnsRenamed(rename or {})
    return out.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in out.columns})


def flip_pointer(df: DataFrame, key: str, pointer: str) -> DataFrame:
    """A pointer from child to parent becomes one from parent to child: each row gets the least key that names it."""
    back = df.where(F.col(pointer).isNotNull()).groupBy(F.col(pointer).alias(key)).agg(F.min(key).alias("_back"))
    return df.join(back, key, "left").withColumn(pointer, F.col("_back")).select(*df.columns)


def project_shared(source: DataFrame, target: DataFrame) -> DataFrame:
    """Target plus the rows of source, in the columns that both have (others of the target null)."""
    shared = [c for c in target.columns if c in source.columns]
    return target.unionByName(source.select(*shared), allowMissingColumns=True)


def labels_from_rows(rows: DataFrame, key: str, label: str, order: Sequence[str], quality: str) -> DataFrame:
    """The first label of each key; absent labels are none; a fixed quality."""
    return first_by(rows.where(F.col(label).isNotNull()), [key], order).select(key, label, F.lit(quality).alias("quality"))


def current_version(spark: SparkSession, root: str) -> int:
    """The highest version under ``root``, 0 if there is none."""
    return V.latest(spark, root)[0]


def publish(df: DataFrame, root: str, expected: int) -> int:
    """Write the table's next version if ``expected`` is the current one, else fail; readers never see a part.

    The new version's number: the next one, or a later one where something else than an entry holds that name.
    """
    spark = df.sparkSession
    following = V.next_version(spark, root)
    if current_version(spark, root) != expected:
        raise StaleVersion(f"version {expected} is not the current one")
    folder = V.new_folder(root, "data")
    df.write.parquet(folder)
    V.add_entry(spark, root, following, {"folder": folder})
    return following


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    content = V.entry(spark, root, version) if version else V.latest(spark, root)[1]
    if not content:
        raise ValueError(f"no version under {root}")
    return spark.read.parquet(content["folder"])
