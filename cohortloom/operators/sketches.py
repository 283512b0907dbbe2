"""Distinct counts that add up: a HyperLogLog sketch for each day, kept in a version log beside nothing else.

A day's sketch is written once; a day that comes again changes nothing. Any stretch of days is counted by the union of its
sketches, without its rows: the relative standard error is 0.8 percent at ``LOG2`` = 14 (16,384 registers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions as V

LOG2 = 14
ERROR = 1.04 / (1 << LOG2) ** 0.5
SKETCHES = "day date, sketch binary"


def _days(spark: SparkSession, root: str) -> DataFrame:
    content = V.latest(spark, root)[1]
    return spark.read.schema(SKETCHES).parquet(*content["folders"]) if content else spark.createDataFrame([], SKETCHES)


def add_days(rows: DataFrame, root: str, ts: str, value: str) -> int:
    """Add the sketches of the days in ``rows`` that are not there yet; the version that has them.

    Rows without a time are left out; a day whose values are all null has an empty sketch.
    """
    spark = rows.sparkSession
    while True:
        following = V.next_version(spark, root)
        version, content = V.latest(spark, root)
        dated = rows.select(F.to_date(ts).alias("day"), F.col(value).alias("v")).where("day IS NOT NULL")
        fresh = dated.join(_days(spark, root).select("day"), "day", "left_anti")
        made = fresh.groupBy("day").agg(F.hll_sketch_agg("v", LOG2).alias("sketch"))
        folder = V.new_folder(root, "days")
        made.write.parquet(folder)
        if spark.read.schema(SKETCHES).parquet(folder).isEmpty():
            return version
        try:
            V.add_entry(spark, root, following, {"folders": [*content.get("folders", []), folder]})
            return following
        except V.StaleVersion:
            continue


def distinct_in(spark: SparkSession, root: str, first=None, last=None) -> DataFrame:
    """One row: days, and the estimated number of distinct values from ``first`` to ``last`` (inclusive; None: no bound)."""
    days = _days(spark, root)
    if first is not None:
        days = days.where(F.col("day") >= F.lit(first))
    if last is not None:
        days = days.where(F.col("day") <= F.lit(last))
    return days.agg(F.count("*").alias("days"), F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("n_unique"))
