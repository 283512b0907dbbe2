"""Dates, geometry, arrays and nested values as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import clock_distance  # noqa: F401  H37 stands with the joins that use it
from ..operators.timeline import DAY, micros


def age_at(birth: Column, ts: Column) -> Column:
    """Whole years, birthdays counted."""
    early = F.date_format(ts, "MMdd") < F.date_format(birth, "MMdd")
    return F.year(ts) - F.year(birth) - early.cast("int")


def floor_days(a: Column, b: Column) -> Column:
    """Whole days from a to b, rounded down."""
    return F.floor((micros(b) - micros(a)) / DAY)


def month_start(c: Column) -> Column:
    """A date text as the first of its month; 'none' and '' stay."""
    return F.when(F.lower(c).isin("none", ""), c).otherwise(F.regexp_replace(c, r"^(\d{4}-\d{2})-\d{2}.*$", "$1-01"))


def year_start(c: Column) -> Column:
    """A header date YYYYMMDD as January 1 of its year."""
    return F.when(c.rlike(r"^\d{8}$"), F.concat(F.substring(c, 1, 4), F.lit("0101"))).otherwise(c)


def year_of(c: Column) -> Column:
    """The year that a date text begins with."""
    return F.regexp_extract(c, r"^(\d{4})", 1).try_cast("int")


def to_ts(c: Column) -> Column:
    """A timestamp, null for what is none."""
    return F.try_to_timestamp(c)


def aspect(width: Column, height: Column) -> Column:
    """H33."""
    return F.round(F.try_divide(width, height), 2)


def share_below(values: Column, limit: float) -> Column:
    """Percent of the values that are at most ``limit``."""
    return F.round(100 * F.size(F.filter(values, lambda x: x <= limit)) / F.nullif(F.size(values), F.lit(0)), 4)


def parse_boxes(c: Column) -> Column:
    """H34: '[x1, y1, x2, y2];[...]' as array<struct<x1, y1, x2, y2>>; what has not four numbers is no box."""
    raw = F.regexp_extract_all(c, F.lit(r"\[([^\]]*)\]"), F.lit(1))
    numbers = F.transform(raw, lambda b: F.transform(F.split(b, ","), lambda x: F.trim(x).try_cast("double")))
    good = F.filter(numbers, lambda b: (F.size(b) == 4) & ~F.exists(b, lambda x: x.isNull()))
    return F.transform(good, lambda b: F.struct(*[b[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))]))


def box_count(c: Column) -> Column:
    return F.size(parse_boxes(c))


def format_boxes(boxes: Column) -> Column:
    one = lambda b: F.concat(F.lit("["), F.concat_ws(", ", *[b[n].cast("long") for n in ("x1", "y1", "x2", "y2")]), F.lit("]"))
    return F.array_join(F.transform(boxes, one), ";")


def shift_box(b: Column, x: Column, y: Column, width: Column, height: Column) -> Column:
    """A box in the coordinates of a crop that begins at (x, y), clamped to its size."""
    clamp = lambda v, most: F.least(F.greatest(v, F.lit(0.0)), most.cast("double"))
    return F.struct(clamp(b["x1"] - x, width).alias("x1"), clamp(b["y1"] - y, height).alias("y1"), clamp(b["x2"] - x, width).alias("x2"), clamp(b["y2"] - y, height).alias("y2"))


def to_center(b: Column, width: Column, height: Column) -> Column:
    """Centre and size in parts of the image."""
    part = lambda v, whole: F.round(F.try_divide(v, whole), 6)
    return F.struct(
        part((b["x1"] + b["x2"]) / 2, width).alias("cx"), part((b["y1"] + b["y2"]) / 2, height).alias("cy"), part(b["x2"] - b["x1"], width).alias("w"), part(b["y2"] - b["y1"], height).alias("h")
    )


def from_center(c: Column, width: Column, height: Column) -> Column:
    edge = lambda mid, size, whole, sign: (mid + sign * size / 2) * whole
    return F.struct(
        edge(c["cx"], c["w"], width, -1).alias("x1"), edge(c["cy"], c["h"], height, -1).alias("y1"), edge(c["cx"], c["w"], width, 1).alias("x2"), edge(c["cy"], c["h"], height, 1).alias("y2")
    )


def parse_polygon(c: Column) -> Column:
    """H35: 'x,y;x,y' as array<struct<x, y>>."""
    points = F.transform(F.split(c, ";"), lambda p: F.struct(F.trim(F.split_part(p, F.lit(","), F.lit(1))).try_cast("double").alias("x"), F.trim(F.split_part(p, F.lit(","), F.lit(2))).try_cast("double").alias("y")))
    return F.filter(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull())


def _mean(points: Column, axis: str) -> Column:
    return F.aggregate(points, F.lit(0.0), lambda s, p: s + p[axis]) / F.nullif(F.size(points), F.lit(0))


def centroid(points: Column) -> Column:
    return F.struct(_mean(points, "x").alias("x"), _mean(points, "y").alias("y"))


def shrink(points: Column, factor: float) -> Column:
    """Every point moved towards the centroid."""
    # the centroid is worked out once, not for every point
    towards = lambda mid: F.transform(points, lambda p: F.struct((mid["x"] + (p["x"] - mid["x"]) * factor).alias("x"), (mid["y"] + (p["y"] - mid["y"]) * factor).alias("y")))
    return F.element_at(F.transform(F.array(centroid(points)), towards), 1)


def bbox(points: Column) -> Column:
    xs, ys = lambda ps: F.transform(ps, lambda p: p["x"]), lambda ps: F.transform(ps, lambda p: p["y"])
    edges = lambda ps: F.struct(F.array_min(xs(ps)).alias("x1"), F.array_min(ys(ps)).alias("y1"), F.array_max(xs(ps)).alias("x2"), F.array_max(ys(ps)).alias("y2"))
    return F.element_at(F.transform(F.array(points), edges), 1)


def shape_class(points: Column) -> Column:
    """By the number of corners."""
    n = F.size(points)
    return F.when(n == 4, "rectangle").when(n == 6, "hexagon").when(n > 6, "arc").otherwise("other")


def ensemble(p_whole: Column, p_crop: Column, peaks: Column, peak: Column) -> Column:
    """struct<flag, confidence, source>: one classifier needs support by the locator or weak support by the other;
    both, or two peaks, suffice."""
    whole, crop = p_whole > 0.5, p_crop > 0.5
    one, two = (peaks >= 1) & (peak > 0.3), (peaks >= 2) & (peak > 0.3)
    flag = (whole & crop) | (whole & (one | (p_crop > 0.2))) | (crop & (one | (p_whole > 0.2))) | two
    names = F.concat_ws("+", F.when(whole, "uncropped"), F.when(crop, "cropped"), F.when(one, "locator"))
    sure = F.greatest(p_whole, p_crop, F.when(one, peak).otherwise(0.0))
    return F.struct(flag.cast("int").alias("flag"), sure.alias("confidence"), F.when(names == "", "none").otherwise(names).alias("source"))


def measurements(df: DataFrame, key: str, points: str, spacing: str, most: int = 9) -> DataFrame:
    """Distances of all point pairs of an image (at most ``most`` points, else it has none), nearest first, and the
    largest. Pairs are made within a row, whose number of points is bounded."""
    rows = df.select(key, F.posexplode(points).alias("i", "a"), F.col(points).alias("_all"), F.col(spacing).alias("_mm")).where(F.size("_all") <= most)
    pairs = rows.select(key, "i", "a", "_mm", F.posexplode("_all").alias("j", "b")).where("i < j")
    length = F.round(F.sqrt((F.col("a.x") - F.col("b.x")) ** 2 + (F.col("a.y") - F.col("b.y")) ** 2) * F.col("_mm"), 6)
    out = pairs.select(key, "i", "j", length.alias("length"))
    w = Window.partitionBy(key)
    return out.withColumns({"rank": F.row_number().over(w.orderBy("length", "i", "j")), "longest": F.max("length").over(w)})


def tri_state(side: Column, left: Column, right: Column, word: str = "MALIGNANT") -> Column:
    """-1 without any label, else whether the label of the row's side has the word (left before right for no side)."""
    own = F.when(F.upper(side) == "LEFT", left).when(F.upper(side) == "RIGHT", right).otherwise(F.coalesce(left, right))
    return F.when(left.isNull() & right.isNull(), -1).when(F.upper(own).contains(word), 1).otherwise(0)


def content_hash(c: Column) -> Column:
    """H41."""
    return F.md5(c)


def flatten_extraction(df: DataFrame, column: str, schema: str, paths: dict[str, str]) -> DataFrame:
    """Fields of a nested JSON record as columns; absent parents give null, flags are 0/1, lists are JSON."""
    parsed = df.withColumn("_x", F.from_json(column, schema))
    out = {}
    for name, path in paths.items():
        kind = reduce(lambda t, p: t[p].dataType, path.split("."), parsed.schema["_x"].dataType)
        value = F.col(f"_x.{path}")
        out[name] = value.cast("int") if kind.typeName() == "boolean" else F.to_json(value) if kind.typeName() in ("array", "struct", "map") else value
    return parsed.withColumns(out).drop("_x")


def explode_ids(df: DataFrame, column: str, name: str = "source_id") -> DataFrame:
    """A row for each id of a JSON list."""
    return df.withColumn(name, F.explode(F.from_json(column, "array<long>")))
