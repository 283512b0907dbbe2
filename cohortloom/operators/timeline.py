"""Per-patient timelines as windows.

"Earlier rows" are row frames over a total order (time, then the tie key); "strictly earlier or later in time" are range
frames over microseconds. Operators over the same partition and order share one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

DAY = 86_400_000_000
#: About so many rows meet in one task of a running sum (of others: see ``dealt_by``), however many there are in all.
PART_ROWS = 1 << 20


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _by_time(patient: str, us: str = "us"):
    return Window.partitionBy(patient).orderBy(us)


def _by_row(patient: str, ts: str, tie: str):
    return Window.partitionBy(patient).orderBy(ts, tie)


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def dedupe_prefer(df: DataFrame, key: str, prefer: str, tie: str) -> DataFrame:
    """One row per key, rows that have ``prefer`` first."""
    order = Window.partitionBy(key).orderBy(F.col(prefer).isNull(), F.col(tie))
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def dealt_by(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """Rows of a key in one task, for long rows that are sorted several times: tasks of about ``PART_ROWS`` / 4 rows, at
    least the session's number. The rows are counted first, unless the caller knows about how many there are."""
    rows = df.count() if rows is None else rows
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // (PART_ROWS // 4)))
    return df.repartition(parts, *keys)


def side_applies(side: Column, wanted: str) -> Column:
    return side.isin(wanted, "BILATERAL")


def running_worst(df: DataFrame, patient: str, ts: str, tie: str, side: str, rank: str, source: str) -> DataFrame:
    """Worst rank of earlier rows on the row's side(s), with the row it comes from (the earliest of the worst).

    A bilateral row counts for both sides and reads the worse of both (left first).
    """
    rows = df.withColumn("_seq", F.row_number().over(_by_row(patient, ts, tie)))
    order = _before(Window.partitionBy(patient).orderBy("_seq"))
    for name in ("LEFT", "RIGHT"):
        entry = F.when(side_applies(F.col(side), name) & F.col(rank).isNotNull(), F.struct(F.col(rank).alias("rank"), (-F.col("_seq")).alias("seq"), F.col(source).alias("source")))
        rows = rows.withColumn(f"_{name}", F.max(entry).over(order))
    left, right = F.col("_LEFT"), F.col("_RIGHT")
    both = F.when(left.isNull(), right).when(right.isNull(), left).when(right["rank"] > left["rank"], right).otherwise(left)
    worst = F.when(F.col(side) == "LEFT", left).when(F.col(side) == "RIGHT", right).when(F.col(side) == "BILATERAL", both)
    return rows.withColumns({"worst_rank": worst["rank"], "worst_source": worst["source"]}).drop("_seq", "_LEFT", "_RIGHT")


def days_to_event(df: DataFrame, patient: str, ts: str, is_event: Column) -> DataFrame:
    """Whole days to the next event, else minus the days since the last one; 0 on an event, null without any."""
    rows = df.withColumn("us", micros(F.col(ts)))
    at = F.when(is_event, F.col("us"))
    ahead = F.min(at).over(_by_time(patient).rangeBetween(1, Window.unboundedFollowing))
    behind = F.max(at).over(_by_time(patient).rangeBetween(Window.unboundedPreceding, -1))
    here = F.max(at).over(_by_time(patient).rangeBetween(0, 0))
    days = F.when(is_event | here.isNotNull(), F.lit(0)).when(ahead.isNotNull(), F.floor((ahead - F.col("us")) / DAY)).otherwise(-F.floor((F.col("us") - behind) / DAY))
    return rows.withColumn("days_to_event", days.cast("long")).drop("us")


def propagate_from_events(df: DataFrame, patient: str, ts: str, is_event: Column, value: str, before: int, after: int) -> DataFrame:
    """An empty value is taken from the earliest event whose whole days from the row lie in [-before, after]."""
    rows = df.withColumn("us", micros(F.col(ts)))
    near = _by_time(patient).rangeBetween(-before * DAY, (after + 1) * DAY - 1)
    first = F.min(F.when(is_event & F.col(value).isNotNull(), F.struct("us", F.col(value).alias("v")))).over(near)
    return rows.withColumn(value, F.coalesce(F.col(value), first["v"])).drop("us")


def prior_counts(df: DataFrame, patient: str, ts: str, tie: str, flag: Column, side: str) -> DataFrame:
    """Flagged earlier rows on each side; a bilateral row counts on both."""
    order = _before(_by_row(patient, ts, tie))
    count = lambda s: F.coalesce(F.sum((flag & side_applies(F.col(side), s)).cast("long")).over(order), F.lit(0))
    return df.withColumns({"prior_left": count("LEFT"), "prior_right": count("RIGHT")})


def prior_flag(df: DataFrame, patient: str, ts: str, tie: str, flag: Column, side: str) -> DataFrame:
    """Whether an earlier row on the row's side(s) is flagged."""
    order = _before(_by_row(patient, ts, tie))
    seen = lambda s: F.coalesce(F.max((flag & side_applies(F.col(side), s)).cast("int")).over(order), F.lit(0)) == 1
    left, right = seen("LEFT"), seen("RIGHT")
    own = F.when(F.col(side) == "LEFT", left).when(F.col(side) == "RIGHT", right).otherwise(left | right)
    return df.withColumn("prior_positive", own)


def exists_in_range(df: DataFrame, patient: str, ts: str, flag: Column, before: int, after: int, name: str = "near_event") -> DataFrame:
    """Whether a flagged row lies within [-before, after] days, the row itself included."""
    rows = df.withColumn("us", micros(F.col(ts)))
    near = _by_time(patient).rangeBetween(-before * DAY, after * DAY)
    return rows.withColumn(name, F.coalesce(F.max(flag.cast("int")).over(near), F.lit(0)) == 1).drop("us")


def followup_stats(df: DataFrame, patient: str, ts: str, good: Column, days: int) -> DataFrame:
    """Of the rows in (0, days]: their number, whether all are good, and the days until the last of them."""
    rows = df.withColumn("us", micros(F.col(ts)))
    later = _by_time(patient).rangeBetween(1, days * DAY)
    return rows.withColumns(
        {
            "followups": F.count("*").over(later),
            "all_good": F.coalesce(F.min(F.coalesce(good, F.lit(False)).cast("int")).over(later), F.lit(0)) == 1,
            "last_days": F.floor((F.max("us").over(later) - F.col("us")) / DAY),
        }
    ).drop("us")


def future_labels(df: DataFrame, patient: str, ts: str, label: str, side: str, values: Sequence[str], days: int) -> DataFrame:
    """Which labels stand on each side in (0, days]."""
    rows = df.withColumn("us", micros(F.col(ts)))
    later = _by_time(patient).rangeBetween(1, days * DAY)
    out = {}
    for s in ("LEFT", "RIGHT"):
        for v in values:
            out[f"{v.lower()}_{s.lower()}"] = F.coalesce(F.max((side_applies(F.col(side), s) & (F.col(label) == v)).cast("int")).over(later), F.lit(0)) == 1
    return rows.withColumns(out).drop("us")


def event_gaps(df: DataFrame, patient: str, ts: str, limit: int) -> DataFrame:
    """Whole days since the previous time, and whether they lie outside [0, limit]; null for the first."""
    rows = df.withColumn("us", micros(F.col(ts)))
    last = F.max("us").over(_by_time(patient).rangeBetween(Window.unboundedPreceding, -1))
    gap = F.floor((F.col("us") - last) / DAY)
    return rows.withColumns({"gap_days": gap, "outside": ~gap.between(0, limit)}).drop("us")


def with_row_id(df: DataFrame, order: Sequence, name: str = "row_id") -> DataFrame:
    """Dense ids from 1 in a total order, without gathering the rows: partitions by range, then offsets.

    Only one count of each range partition meets in one task.
    """
    # written once: a second sampling of the ranges could cut elsewhere
    dealt = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    ranked = dealt.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    sizes = dealt.groupBy("_p").agg(F.count("*").alias("_size"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row for each range partition
    return ranked.join(F.broadcast(before.select("_p", "_before")), "_p").withColumn(name, F.col("_before") + F.col("_k")).drop("_p", "_k", "_before")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def is_duplicated(df: DataFrame, keys: Sequence[str], name: str = "duplicated") -> DataFrame:
    """Whether other rows have the same key."""
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*keys)) > 1)


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence, values: dict[str, Column]) -> DataFrame:
    """Running sums of ``values`` within groups in a total order, and the groups' sums (name with ``_all``).

    No group is gathered, so a few groups may hold the whole table: rows are dealt by ranges of group and order, summed
    within a range, and each range adds what the ranges before it have of the group.
    """
    # the rows are worked out once, for their number, the sampling of the ranges and the dealing
    rows = cut(df.withColumns(values))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART_ROWS))
    # written once: a second sampling of the ranges could cut elsewhere
    dealt = cut(rows.repartitionByRange(parts, *by, *order).withColumn("_p", F.spark_partition_id()))
    upto = Window.partitionBy("_p", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = dealt.groupBy("_p", *by).agg(*[F.sum(v).alias(v) for v in values])
    group = Window.partitionBy(*by)
    before = group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("_p").alias("_q"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_b{i}") for i, v in enumerate(values)], *[F.sum(v).over(group).alias(f"{v}_all") for v in values])
    same = F.col("_p") == F.col("_q")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    inner = dealt.repartition(parts, "_p").withColumns({v: F.sum(v).over(upto) for v in values}).join(ranges, same)
    return inner.withColumns({v: F.col(v) + F.col(f"_b{i}") for i, v in enumerate(values)}).drop("_p", "_q", *[f"_g{i}" for i in range(len(by))], *[f"_b{i}" for i in range(len(values))])


def precision_recall(df: DataFrame, by: Sequence[str], score: str, tie: str, hit: Column, positives: Column) -> DataFrame:
    """Precision and recall after each row by falling score; ``positives`` is the number to be found."""
    rows = running_totals(df, by, [F.col(score).desc(), F.col(tie)], {"_hits": F.coalesce(hit.cast("int"), F.lit(0)), "_rows": F.lit(1)})
    return rows.withColumns({"precision": F.col("_hits") / F.col("_rows"), "recall": F.try_divide("_hits", positives)}).drop("_hits", "_rows", "_hits_all", "_rows_all")


def average_precision(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean of the best precision at recall of at least 0, 0.1 ... 1."""
    best = [F.coalesce(F.max(F.when(F.col("recall") >= i / 10, F.col("precision"))), F.lit(0.0)) for i in range(11)]
    total = best[0]
    for b in best[1:]:
        total = total + b
    return curve.groupBy(*by).agg(F.round(total / 11, 6).alias("ap"))
