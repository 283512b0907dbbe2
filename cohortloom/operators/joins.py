"""Joins: equality on a key with residual conditions on time, distance or geometry; keys without a partner stay visible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .timeline import DAY, first_by, micros


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str | list[str], str]]) -> DataFrame:
    """A fact table with its dimensions, (table, key, inner or left) each."""
    out = fact
    for dim, on, how in dims:
        out = out.join(dim, on, how)
    return out


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key is among ``keys``."""
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, done: DataFrame, on) -> DataFrame:
    """Rows whose key is not among ``done``; a null key is never done."""
    return df.join(done, on, "left_anti")


def unique_by(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """``df``, failing at run time if two rows share a key."""
    n = F.count("*").over(Window.partitionBy(*on))
    checked = F.when(n > 1, F.raise_error(F.concat(F.lit("key occurs more than once: "), F.concat_ws(",", *[F.col(c).cast("string") for c in on]))).cast("string"))
    # the key carries the check, so no optimisation can drop it
    first = on[0]
    return df.withColumn(first, F.when(checked.isNull(), F.col(first)))


def attach(df: DataFrame, dim: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join of some columns of a table that has each key once (asserted)."""
    return df.join(unique_by(dim.select(*on, *columns), on), list(on), "left")


def side_matches(exam_side: Column, side: Column) -> Column:
    return (exam_side == "BILATERAL") | (exam_side == side)


def _in_reach(left: DataFrame, left_ts: str, right: DataFrame, right_ts: str, before_days: int, after_days: int) -> DataFrame:
    """Rows of the same patient whose times may lie within [-before, after] days: pairs of neighbouring stretches of time.

    A stretch is as long as the reach, so each left row has one and each right row stands in those around its own; the
    caller tests the exact times. A patient's rows of other years never meet.
    """
    reach = (before_days + after_days + 1) * DAY
    stretch = lambda c: F.floor(micros(F.col(c)) / F.lit(reach)).cast("long")
    around = F.array(*[stretch(right_ts) + k for k in ((-1, 0, 1) if before_days else (-1, 0))])
    return left.withColumn("_s", stretch(left_ts)).join(right.withColumn("_s", F.explode(around)), ["patient_id", "_s"]).drop("_s")


def link_events_asof(events: DataFrame, path: DataFrame, exams: DataFrame, before_days: int = 1, after_days: int = 180) -> DataFrame:
    """Pathology within [-before, after] days of an event of the same patient, each with the latest exam strictly
    before the event whose side fits (a bilateral exam fits any side).

    events: patient_id, event_id, event_ts. path: patient_id, path_id, path_ts, path_side. exams: patient_id, exam_id,
    exam_ts, exam_side. One row for each (event, path) with exam_id and exam_ts, null where no exam fits.
    """
    gap = micros(F.col("path_ts")) - micros(F.col("event_ts"))
    linked = _in_reach(events, "event_ts", path, "path_ts", before_days, after_days).where(gap.between(-before_days * DAY, after_days * DAY))
    # the latest exam of each event and side by a window over exams and events together: no pair of them is made
    kind = lambda df, c: df.schema[c].dataType
    none = lambda df, c: F.lit(None).cast(kind(df, c)).alias(c)
    marks = events.select("patient_id", F.col("event_ts").alias("ts"), "event_id", none(exams, "exam_id"), none(exams, "exam_side"))
    marks = marks.unionByName(exams.select("patient_id", F.col("exam_ts").alias("ts"), none(events, "event_id"), "exam_id", "exam_side")).withColumn("us", micros(F.col("ts")))
    past = Window.partitionBy("patient_id").orderBy("us").rangeBetween(Window.unboundedPreceding, -1)
    exam = F.struct("us", "exam_id", F.col("ts").alias("exam_ts"))
    fits = {s: F.col("exam_side").isin(s, "BILATERAL") for s in ("LEFT", "RIGHT", "BILATERAL")}
    latest = marks.withColumns({s: F.max(F.when(F.col("exam_id").isNotNull() & fit, exam)).over(past) for s, fit in fits.items()}).where("event_id IS NOT NULL").select("event_id", *fits)
    joined = linked.join(latest, "event_id", "left")
    chosen = F.lit(None)
    for s in fits:
        chosen = F.when(F.col("path_side") == s, F.col(s)).otherwise(chosen)
    return joined.withColumn("_x", chosen).withColumns({"exam_id": F.col("_x.exam_id"), "exam_ts": F.col("_x.exam_ts")}).drop("_x", *fits)


def link_all_in_window(exams: DataFrame, path: DataFrame, days: int = 240) -> DataFrame:
    """All pathology of the same patient in [0, days] days after an exam, with the category of the match.

    exams: patient_id, accession_number, exam_ts, study_laterality. path: patient_id, path_accession, path_ts,
    path_laterality. One row for each (accession_number, path_accession): the nearest in days, then the first category;
    ``source`` tells a link that the pathology's own accession gives from one that was found by time.
    """
    gap = F.floor((micros(F.col("path_ts")) - micros(F.col("exam_ts"))) / DAY)
    pairs = _in_reach(exams, "exam_ts", path, "path_ts", 0, days + 1).withColumn("days", gap).where(F.col("days").between(0, days))
    side = F.col("study_laterality")
    category = F.when(side == F.col("path_laterality"), "same_side").when(side == "BILATERAL", "bilateral_exam").when(side.isNull() | F.col("path_laterality").isNull(), "unknown_side").otherwise("other_side")
    source = F.when(F.col("accession_number") == F.col("path_accession"), "given").otherwise("found")
    return first_by(pairs.withColumns({"match": category, "source": source}), ["accession_number", "path_accession"], ["days", "match"])


def encounter_link(rows: DataFrame, keys: Sequence[str], side: str, label: str, order: Sequence[str]) -> DataFrame:
    """For each key the dominant label of each side bucket (left, right, unknown)."""
    bucket = F.when(F.col(side) == "LEFT", "left").when(F.col(side) == "RIGHT", "right").otherwise("unknown")
    rank = F.coalesce(*[F.when(F.col(label) == v, F.lit(i)) for i, v in enumerate(order)])
    wide = rows.select(*keys, bucket.alias("bucket"), rank.alias("rank")).groupBy(*keys).pivot("bucket", ["left", "right", "unknown"]).agg(F.min("rank"))
    name = lambda c: F.coalesce(*[F.when(F.col(c) == i, F.lit(v)) for i, v in enumerate(order)]).alias(c)
    return wide.select(*keys, name("left"), name("right"), name("unknown"))


def fill_from_group(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """An absent value is taken from the first row of the key that has one."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({c: F.coalesce(F.col(c), F.when(F.col(key).isNotNull(), F.first(c, ignorenulls=True).over(w))) for c in columns})


def update_from(target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Values of ``updates`` replace those of the same key; absent ones replace nothing."""
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(new, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in columns}).select(*target.columns)


def fill_null_from(df: DataFrame, dim: DataFrame, key: str, column: str) -> DataFrame:
    """Only where the value is absent."""
    joined = df.join(dim.select(key, F.col(column).alias("_dim")), key, "left")
    return joined.withColumn(column, F.coalesce(column, "_dim")).select(*df.columns)


def clock_distance(a: Column, b: Column) -> Column:
    """Hours between two positions on a clock face."""
    d = F.abs(a - b) % 12
    return F.least(d, 12 - d)


def match_lesions(images: DataFrame, described: DataFrame, hours: float = 1.5, cm: float = 2.0) -> DataFrame:
    """All described lesions of the exam near an image's position.

    images: accession_number, image_name, clock, distance_cm. described: accession_number, lesion_id, d_clock, d_distance.
    """
    apart = clock_distance(F.col("clock"), F.col("d_clock"))
    gap = F.abs(F.col("distance_cm") - F.col("d_distance"))
    pairs = images.join(described, "accession_number").where((apart <= hours) & (gap <= cm))
    return pairs.withColumn("score", F.round(apart + gap / 2, 6))


def merge_lesions(existing: DataFrame, matched: DataFrame, cm: float = 0.5) -> DataFrame:
    """What becomes of each matched description of an image: the image's first lesion of about its size is
    updated, else a new one is created.

    existing: lesion_id, image_name, measured_cm. matched: image_name, description_id, sizing_cm. Rows: image_name,
    description_id, action, lesion_id (null for a new one).
    """
    own = existing.select("image_name", "measured_cm", "lesion_id")
    near = F.abs(F.col("measured_cm") - F.col("sizing_cm")) <= cm
    own = own.withColumnRenamed("image_name", "_image")
    # matches are made and dealt out once: those without a lesion of their size stay in the join and in the group
    pairs = matched.join(own, (F.col("image_name") == F.col("_image")) & near, "left")
    rows = pairs.groupBy("image_name", "description_id").agg(F.min("lesion_id").alias("lesion_id"))
    return rows.withColumn("action", F.when(F.col("lesion_id").isNull(), "create").otherwise("update"))


def best_match(matches: DataFrame) -> DataFrame:
    """Of each image the described lesion with the lowest score; the lowest id of equally good ones."""
    return matches.groupBy("accession_number", "image_name").agg(F.min(F.struct("score", "lesion_id")).alias("m")).select("accession_number", "image_name", "m.lesion_id", "m.score")


def flagged_clean_pairs(nearest: DataFrame, key: str, flag: str, limit: float) -> DataFrame:
    """Pairs of a flagged and an unflagged row within the distance, once for either order, one for each flagged row."""
    near = nearest.where((F.col("distance") <= limit) & (F.col(flag).cast("boolean") != F.col("near_flag").cast("boolean")))
    flagged = F.col(flag).cast("boolean")
    pairs = near.select(F.when(flagged, F.col(key)).otherwise(F.col("near_key")).alias("flagged"), F.when(flagged, F.col("near_key")).otherwise(F.col(key)).alias("clean"), "distance")
    return pairs.groupBy("flagged").agg(F.min(F.struct("distance", "clean")).alias("m")).select("flagged", "m.clean", "m.distance")


def relabel_by_content(labels: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """Labels (old_id) -> content hash of the old images -> new ids with that hash (null if there is none)."""
    return labels.join(old.select("old_id", "hash"), "old_id").join(new.select("new_id", "hash"), "hash", "left")


def enrich_annotations(annotations: DataFrame, original: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Annotations with the first original row of their key."""
    return annotations.join(first_by(original, [key], order), key, "left")


def with_labels(rows: DataFrame, labels: DataFrame, key: str, version: str) -> DataFrame:
    """Rows with the labels of one version; rows without stay."""
    return rows.join(labels.where(F.col("version") == version).drop("version"), key, "left")


def coverage(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Numbers of keys in both, left only and right only."""
    sides = left.select(*on).distinct().withColumn("_l", F.lit(1)).join(right.select(*on).distinct().withColumn("_r", F.lit(1)), list(on), "full")
    where = F.when(F.col("_l").isNull(), "right_only").when(F.col("_r").isNull(), "left_only").otherwise("both")
    return sides.groupBy(where.alias("side")).agg(F.count("*").alias("n"))
