"""Order, limits, samples and splits; everything random is a hash of the key, so it repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .timeline import running_totals


def page(df: DataFrame, order: Sequence, start: int, n: int) -> DataFrame:
    """K2: rows [start, start + n) in a total order."""
    return df.orderBy(*order).offset(start).limit(n)


def top_fraction(df: DataFrame, group: str, score: Column, tie: str, share: float, most: int) -> DataFrame:
    """K3: of groups of at most ``most`` rows, the best floor(share * rows) rows each."""
    size = F.count("*").over(Window.partitionBy(group))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(score.desc(), tie))
    out = df.withColumns({"_n": size, "_k": rank})
    return out.where((F.col("_n") <= most) & (F.col("_k") <= F.floor(F.col("_n") * share + 1e-9))).drop("_n", "_k")


def seeded(key: Column, seed: int) -> Column:
    """A hash that orders rows as if at random: md5 of seed and key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """K4: n rows, always the same ones for a seed."""
    return df.orderBy(seeded(F.col(key), seed), key).limit(n)


def _in_hash_order(df: DataFrame, by: Sequence[str], key: str, seed: int) -> DataFrame:
    """``_k``, the row's number within its group in hash order, and ``_k_all``, the group's size; groups may be of any size."""
    return running_totals(df.withColumn("_h", F.unhex(seeded(F.col(key), seed))), by, ["_h", key], {"_k": F.lit(1)}).drop("_h")


def sample_per_class(df: DataFrame, group: str, key: str, n: int, seed: int, least: int = 0) -> DataFrame:
    """K5: up to n rows of each class; classes of fewer than ``least`` rows are left out."""
    out = _in_hash_order(df, [group], key, seed)
    return out.where((F.col("_k") <= n) & (F.col("_k_all") >= least)).drop("_k", "_k_all")


def rebalance(df: DataFrame, group: str, key: str, mode: str, seed: int) -> DataFrame:
    """K6: as many rows of each class as the smallest ('under') or the largest ('over') has; copies get a number."""
    goal = df.groupBy(group).agg(F.count("*").alias("_n")).agg((F.min if mode == "under" else F.max)("_n").alias("_goal"))
    rows = _in_hash_order(df, [group], key, seed).join(F.broadcast(goal))  # one row
    copies = F.sequence(F.lit(0), F.ceil(F.col("_goal") / F.col("_k_all")).cast("int") - 1) if mode == "over" else F.array(F.lit(0))
    rows = rows.withColumn("copy", F.explode(copies))
    return rows.where(F.col("copy") * F.col("_k_all") + F.col("_k") <= F.col("_goal")).drop("_k", "_k_all", "_goal")


def unit_hash(key: Column) -> Column:
    """The first 64 bits of the key's md5 as a number from 0 to 1, bit for bit as unsigned / 2**64."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


def hash_split(key: Column, test: float = 0.15, validation: float = 0.15) -> Column:
    """K7: split by key; a null key trains."""
    u = unit_hash(key)
    return F.when(key.isNull(), "train").when(u < test, "test").when(u < test + validation, "val").otherwise("train")


def md5_mod(text: Column, modulus: int) -> Column:
    """md5 as a 128-bit number, modulo a small number, from four 32-bit parts."""
    digest = F.md5(text)
    out = F.lit(0).cast("long")
    for i in range(4):
        part = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
        out = (out * ((1 << 32) % modulus) + part) % modulus
    return out


def mini_split(key: Column, share: float, seed: int) -> Column:
    """K8: whether md5('seed:key') modulo 10000 is below the share."""
    return md5_mod(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), 10_000) < F.lit(share * 10_000)


def random_split(df: DataFrame, key: str, share: float, seed: int, strata: Sequence[str] = ()) -> DataFrame:
    """K9: 'test' for the first round(share * rows) rows of each stratum in hash order, else 'train'.

    Without strata each row is drawn by its own hash, so that no rows have to be ranked.
    """
    if not strata:
        u = unit_hash(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
        return df.withColumn("split", F.when(u < share, "test").otherwise("train"))
    rows = _in_hash_order(df, strata, key, seed)
    return rows.withColumn("split", F.when(F.col("_k") <= F.round(F.col("_k_all") * share), "test").otherwise("train")).drop("_k", "_k_all")


def choose_fraction(df: DataFrame, group: str, key: str, share: float, seed: int, name: str = "chosen") -> DataFrame:
    """Flags int(share * rows) rows of each group."""
    rows = _in_hash_order(df, [group], key, seed)
    return rows.withColumn(name, F.col("_k") <= F.floor(F.col("_k_all") * share + 1e-9)).drop("_k", "_k_all")
