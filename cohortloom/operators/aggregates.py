"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .predicates import Rules, first_reason


def joined_set(c: Column, sep: str = "; ") -> Column:
    """Distinct non-empty texts in order, joined; null if there is none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(F.nullif(F.trim(c), F.lit("")))), sep), F.lit(""))


def collapse_fanout(df: DataFrame, key: str, joined: Sequence[str], order: str) -> DataFrame:
    """A1: one row per key: ``joined`` columns as sorted sets, of the others the first value that is there; rows
    without a key pass."""
    rest = [c for c in df.columns if c not in (key, *joined)]
    aggs = [joined_set(F.col(c)).alias(c) for c in joined]
    aggs += [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest]
    keyed = df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    return keyed.select(*df.columns).unionByName(df.where(F.col(key).isNull()))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """A2: nulls are no value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def n_unique(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """A3."""
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(count.alias("n_unique"))


def per_group_stats(df: DataFrame, key: str) -> DataFrame:
    """A4: number, least, largest and mean size of the groups."""
    sizes = df.groupBy(key).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("groups"), F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.avg("n"), 6).alias("mean"))


def split_matrix(df: DataFrame, by: Sequence[str], cells: dict[str, Column]) -> DataFrame:
    """A5: conditional counts."""
    return df.groupBy(*by).agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in cells.items()])


def any_flags(df: DataFrame, key: str | Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """Whether any row of the group meets each condition."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(*[F.bool_or(F.coalesce(cond, F.lit(False))).alias(n) for n, cond in flags.items()])


def mode_per_group(df: DataFrame, key: str, column: str) -> DataFrame:
    """The most frequent value; of equally frequent ones the least."""
    return df.groupBy(key).agg(F.mode(column, True).alias(column))


def majority_per_group(df: DataFrame, key: str, column: str) -> DataFrame:
    """The most frequent value, null where two are equally frequent."""
    counts = df.where(F.col(column).isNotNull()).groupBy(key, column).agg(F.count("*").alias("n"))
    best = counts.groupBy(key).agg(F.max("n").alias("n"))
    top = counts.join(best, [key, "n"]).groupBy(key).agg(F.min(column).alias("value"), F.count("*").alias("tied"))
    return top.select(key, F.when(F.col("tied") == 1, F.col("value")).alias(column))


def collect_by_key(df: DataFrame, key: str, column: str, distinct: bool = False) -> DataFrame:
    """A10: sorted list of the values of a key."""
    gather = F.collect_set if distinct else F.collect_list
    return df.groupBy(key).agg(F.sort_array(gather(column)).alias(column))


def dominant_label(c: Column, order: Sequence[str]) -> Column:
    """The first label of ``order`` that the group has."""
    out = F.lit(None).cast("string")
    for v in reversed(order):
        out = F.when(F.bool_or(F.coalesce(c == v, F.lit(False))), F.lit(v)).otherwise(out)
    return out


def lesion_skeletons(lesions: DataFrame) -> DataFrame:
    """Lesions of the same place (exam, clock, distance) as one, with their ids; a lesion without place is its own.

    Columns: accession_number, clock, distance_cm, laterality, size_cm, lesion_id -> source_ids, n, size_mm, unplaced.
    """
    placed = F.col("accession_number").isNotNull() & F.col("clock").isNotNull() & F.col("distance_cm").isNotNull()
    rows = lesions.withColumn("unplaced", ~placed).withColumn("own", F.when(~placed, F.col("lesion_id")))
    return (
        rows.groupBy("accession_number", "clock", "distance_cm", "unplaced", "own")
        .agg(
            F.array_join(F.array_sort(F.collect_set("lesion_id")), ",").alias("source_ids"),
            F.count("*").alias("n"),
            F.min(F.when(F.col("laterality").isNotNull(), F.struct("lesion_id", "laterality")))["laterality"].alias("laterality"),
            F.round(F.max("size_cm") * 10, 6).alias("size_mm"),
        )
        .drop("own")
    )


def longest(c: Column, tie: Column) -> Column:
    """The longest text that is not empty; the least ``tie`` wins among equally long ones."""
    size = F.when(F.length(c) > 0, F.length(c))
    return F.max_by(c, F.when(size.isNotNull(), F.struct(size, -tie)))


def class_summary(df: DataFrame, key: str, value: str, least: int = 1) -> DataFrame:
    """Mean, deviation, count and sum of each class with at least ``least`` rows."""
    out = df.groupBy(key).agg(
        F.round(F.avg(value), 4).alias("mean"), F.round(F.stddev_samp(value), 4).alias("std"), F.count(value).alias("n"), F.round(F.sum(value), 4).alias("total")
    )
    return out.where(F.col("n") >= least)


def numeric_summary(df: DataFrame, column: str) -> DataFrame:
    """Of what can be read as a number."""
    x = F.col(column).try_cast("double")
    return df.agg(F.min(x).alias("least"), F.max(x).alias("most"), F.round(F.avg(x), 6).alias("mean"), F.count(x).alias("n"))


def capped_distribution(df: DataFrame, by: str, value: Column, cap: int) -> DataFrame:
    """Rows by capped value and their share of the class in percent."""
    bucket = F.when(value > cap, F.lit(f">{cap}")).otherwise(value.cast("string"))
    counts = df.groupBy(by, bucket.alias("bucket")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(by)), 4))


def funnel(df: DataFrame, steps: Rules) -> DataFrame:
    """What each step removes (a row counts for the first that removes it), largest first, and what remains.

    The counts come from the order of the steps, the display from their size; one pass over the rows.
    """
    counts = df.groupBy(first_reason(steps).alias("step")).agg(F.count("*").alias("removed"))
    # one row for each step, and one for what remains
    every = Window.partitionBy(F.lit(0))
    order = every.orderBy(F.col("removed").desc(), "step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = counts.withColumn("total", F.sum("removed").over(every)).where("step IS NOT NULL")
    return named.select("step", "removed", (F.col("total") - F.sum("removed").over(order)).alias("remaining"))
