"""Quality of labels, extractions and detections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import space as S
from ..operators import timeline as W
from ..operators.lineage import cut


def agreement(truth: DataFrame, pred: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Per feature the rows, exact agreement (absent equals absent), and hits, false finds, misses, true blanks."""
    t = truth.select(key, *[F.col(f).cast("string").alias(f"t_{f}") for f in features])
    p = pred.select(key, *[F.col(f).cast("string").alias(f"p_{f}") for f in features])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"t_{f}").alias("t"), F.col(f"p_{f}").alias("p")) for f in features])
    rows = t.join(p, key).select(F.inline(pairs))
    same, has_t, has_p = F.col("t").eqNullSafe(F.col("p")), F.col("t").isNotNull(), F.col("p").isNotNull()
    out = rows.groupBy("feature").agg(
        F.count("*").alias("n"), F.count_if(same).alias("same"), F.count_if(has_t & same).alias("tp"), F.count_if(has_p & ~same).alias("fp"), F.count_if(has_t & ~has_p).alias("fn"), F.count_if(~has_t & ~has_p).alias("tn"), F.count_if(has_t).alias("labelled")
    )
    return out.withColumns({"accuracy": F.round(F.col("same") / F.col("n"), 6), "labelled_accuracy": F.round(F.try_divide("tp", "labelled"), 6)})


def row_agreement(truth: DataFrame, pred: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Each row with whether all its features agree, whether it is labelled at all, and the features that differ."""
    t = truth.select(key, *[F.col(f).cast("string").alias(f"t_{f}") for f in features])
    p = pred.select(key, *[F.col(f).cast("string").alias(f"p_{f}") for f in features])
    differs = F.array_compact(F.array(*[F.when(~F.col(f"t_{f}").eqNullSafe(F.col(f"p_{f}")), F.lit(f)) for f in features]))
    labelled = F.coalesce(*[F.col(f"t_{f}") for f in features]).isNotNull()
    return t.join(p, key).select(key, (F.size(differs) == 0).alias("exact"), labelled.alias("labelled"), F.array_join(differs, ",").alias("differs"))


def set_overlap(truth: DataFrame, pred: DataFrame, key: str, value: str, ranks: Sequence[str]) -> DataFrame:
    """Of each key in both: equal sets, share of common values, and whether the values that rank first agree."""
    t = truth.groupBy(key).agg(F.collect_set(value).alias("t"))
    p = pred.groupBy(key).agg(F.collect_set(value).alias("p"))
    first = lambda c: F.element_at(F.filter(F.array(*map(F.lit, ranks)), lambda r: F.array_contains(c, r)), 1)
    common, all_ = F.size(F.array_intersect("t", "p")), F.size(F.array_union("t", "p"))
    primary = lambda c: F.when(F.arrays_overlap(F.col(c), F.array(*map(F.lit, ranks))), first(F.col(c)))
    return t.join(p, key).select(key, ((common == F.size("t")) & (common == F.size("p"))).alias("equal"), F.round(F.try_divide(common, all_), 6).alias("overlap"), primary("t").eqNullSafe(primary("p")).alias("same_primary"))


def set_agreement(truth: DataFrame, pred: DataFrame, key: str, value: str) -> DataFrame:
    """Per class what was hit, missed and found too much, over keys that both have."""
    t = truth.groupBy(key).agg(F.collect_set(value).alias("t"))
    p = pred.groupBy(key).agg(F.collect_set(value).alias("p"))
    rows = t.join(p, key)
    part = lambda a, name: rows.select(F.explode(a).alias("class"), F.lit(name).alias("kind"))
    long = part(F.array_intersect("t", "p"), "hit").union(part(F.array_except("t", "p"), "miss")).union(part(F.array_except("p", "t"), "extra"))
    out = long.groupBy("class").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("hit", "miss", "extra")])
    return out.withColumn("recall", F.round(F.try_divide(F.col("hit"), F.col("hit") + F.col("miss")), 6))


#: Images of more overlapping pairs are matched in rounds.
CROWDED_PAIRS = 256


def _by_rounds(pairs: DataFrame) -> DataFrame:
    """Pairs (limit, image_id, x) that the greedy choice takes: in each round those that come first of all that their boxes
    still have, which is the choice's own order for them; the pairs of their boxes go, and the next round follows."""
    own = lambda c: F.min("x").over(Window.partitionBy("limit", "image_id", f"x.{c}"))
    left, taken = cut(pairs), None
    while not left.isEmpty():
        won = cut(left.withColumns({"a": own("box_id"), "b": own("gt_id")}).where("x = a AND x = b").select("limit", "image_id", "x"))
        taken = won if taken is None else taken.union(won)
        for c in ("box_id", "gt_id"):
            gone = won.select(F.col("limit").alias("l"), F.col("image_id").alias("i"), F.col(f"x.{c}").alias("c"))
            left = left.join(gone, (F.col("limit") == F.col("l")) & (F.col("image_id") == F.col("i")) & (F.col(f"x.{c}") == F.col("c")), "left_anti")
        left = cut(left)
    return pairs if taken is None else taken


def greedy_matches(pred: DataFrame, truth: DataFrame, limits: Sequence[float], crowded: int = CROWDED_PAIRS) -> DataFrame:
    """For each overlap limit the predictions by falling score, each taking the free true box of its image with the
    largest overlap: limit, image_id, box_id, gt_id, score, iou.

    Only overlapping pairs travel; the pairs of a small image are folded in order, those of a crowded one in rounds.
    """
    pairs = S.iou_join(pred, truth, min(limits)).select("image_id", F.struct((-F.col("score")).alias("s"), "box_id", (-F.col("iou")).alias("i"), "gt_id", "score", "iou").alias("x"))
    fits = F.filter(F.array(*[F.lit(float(x)) for x in limits]), lambda limit: F.col("x.iou") >= limit)
    pairs = cut(pairs.withColumn("limit", F.explode(fits)).select("limit", "image_id", "x"))
    many = cut(pairs.groupBy("limit", "image_id").agg(F.count("*").alias("n")).where(F.col("n") > crowded).drop("n"))
    ordered = pairs.join(many, ["limit", "image_id"], "left_anti").groupBy("limit", "image_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    free = lambda taken, x: ~F.exists(taken, lambda t: (t["box_id"] == x["box_id"]) | (t["gt_id"] == x["gt_id"]))
    kept = F.aggregate("xs", F.slice("xs", 1, 0), lambda taken, x: F.when(free(taken, x), F.array_append(taken, x)).otherwise(taken))
    found = ordered.select("limit", "image_id", F.explode(kept).alias("x"))
    if not many.isEmpty():
        found = found.unionByName(_by_rounds(pairs.join(many, ["limit", "image_id"], "left_semi")))
    return found.select("limit", "image_id", "x.box_id", "x.gt_id", "x.score", "x.iou")


def detection_metrics(pred: DataFrame, truth: DataFrame, least: float) -> DataFrame:
    """Counts, precision, recall, F1, miss rate and false finds per image."""
    part = lambda df, kind: df.select("image_id", F.lit(kind).alias("kind"))
    rows = part(pred, "pred").union(part(truth, "true")).union(part(greedy_matches(pred, truth, [least]), "tp"))
    counts = rows.agg(*[F.count_if(F.col("kind") == k).alias(n) for k, n in (("pred", "n_pred"), ("true", "n_true"), ("tp", "tp"))], F.count_distinct("image_id").alias("images"))
    precision, recall = F.try_divide("tp", "n_pred"), F.try_divide("tp", "n_true")
    return counts.select(
        "tp",
        (F.col("n_pred") - F.col("tp")).alias("fp"),
        (F.col("n_true") - F.col("tp")).alias("fn"),
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(F.try_divide(2 * precision * recall, precision + recall), 6).alias("f1"),
        F.round(1 - recall, 6).alias("miss_rate"),
        F.round(F.try_divide(F.col("n_pred") - F.col("tp"), "images"), 6).alias("fp_per_image"),
    )


BACKGROUND = "background"


def confusion_matrix(pred: DataFrame, truth: DataFrame, least: float) -> DataFrame:
    """true_class, pred_class, n over matched boxes; what has no match meets the background. Both have ``cls``."""
    hits = greedy_matches(pred, truth, [least]).select("image_id", "box_id", "gt_id")
    p, t = pred.select("image_id", "box_id", F.col("cls").alias("pred_class")), truth.select("image_id", F.col("box_id").alias("gt_id"), F.col("cls").alias("true_class"))
    both = p.join(hits, ["image_id", "box_id"], "full").join(t, ["image_id", "gt_id"], "full")
    named = lambda c: F.coalesce(F.col(c), F.lit(BACKGROUND)).alias(c)
    return both.select(named("true_class"), named("pred_class")).groupBy("true_class", "pred_class").agg(F.count("*").alias("n"))


def image_metrics(images: DataFrame, pred: DataFrame, truth: DataFrame, least: float) -> DataFrame:
    """One row on the level of images: how many have true boxes, predictions, false and missed boxes, images without
    either, the part of images with a false box among those without true ones, boxes an image."""
    n = lambda df, name: df.groupBy("image_id").agg(F.count("*").alias(name))
    per = images.select("image_id").distinct()
    for df, name in ((truth, "gt"), (pred, "pred"), (greedy_matches(pred, truth, [least]), "tp")):
        per = per.join(n(df, name), "image_id", "left")
    per = per.fillna(0).withColumns({"fp": F.col("pred") - F.col("tp"), "fn": F.col("gt") - F.col("tp")})
    counts = per.agg(
        F.count("*").alias("images"), F.count_if(F.col("gt") > 0).alias("with_gt"), F.count_if(F.col("pred") > 0).alias("with_pred"), F.count_if(F.col("fp") > 0).alias("with_fp"),
        F.count_if(F.col("fn") > 0).alias("with_fn"), F.count_if((F.col("gt") == 0) & (F.col("pred") == 0)).alias("true_negative"),
        F.round(F.avg("gt"), 6).alias("gt_per_image"), F.round(F.avg("pred"), 6).alias("pred_per_image"),
    )
    return counts.withColumn("fpr_image", F.round(F.coalesce(F.try_divide(F.col("with_fp"), F.col("images") - F.col("with_gt")), F.lit(0.0)), 6))


def mean_average_precision(pred: DataFrame, truth: DataFrame, limits: Sequence[float]) -> DataFrame:
    """Average precision for each overlap limit and their mean (limit null).

    The order is the same for every limit, so a prediction travels once, with a mark for each limit that it hits at.
    """
    total, marks = truth.count(), {f"_hit{i}": F.col("limit") == float(x) for i, x in enumerate(limits)}
    hits = greedy_matches(pred, truth, limits).groupBy("image_id", "box_id").agg(*[F.max(hit.cast("int")).alias(m) for m, hit in marks.items()])
    rows = pred.select("image_id", "box_id", "score").join(hits, ["image_id", "box_id"], "left").select("score", "box_id", *marks)
    curve = W.running_totals(rows, [], [F.col("score").desc(), "box_id"], {m: F.coalesce(m, F.lit(0)) for m in marks} | {"_rows": F.lit(1)})
    best = [F.array(*[F.coalesce(F.max(F.when(F.try_divide(m, F.lit(total)) >= i / 10, F.col(m) / F.col("_rows"))), F.lit(0.0)) for i in range(11)]).alias(m) for m in marks]
    found = curve.agg(F.count("*").alias("n"), *best).where("n > 0")
    mean = lambda m: F.round(F.aggregate(m, F.lit(0.0), lambda s, x: s + x) / 11, 6)
    ap = found.select(F.inline(F.array(*[F.struct(F.lit(float(x)).alias("limit"), mean(m).alias("ap")) for x, m in zip(limits, marks)])))
    return ap.unionByName(ap.agg(F.lit(None).cast("double").alias("limit"), F.round(F.avg("ap"), 6).alias("ap")))


def zero_hit_rate(images: DataFrame, boxes: DataFrame, key: str, cls: str) -> DataFrame:
    """E5: of each class the images without any box."""
    per = images.join(boxes.groupBy(key).agg(F.count("*").alias("boxes")), key, "left")
    return per.groupBy(cls).agg(F.count("*").alias("n"), F.count_if(F.col("boxes").isNull()).alias("zero"), F.round(100 * F.count_if(F.col("boxes").isNull()) / F.count("*"), 4).alias("percent"))


def fill_rate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows have each column."""
    filled = df.agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in columns])
    long = filled.unpivot(["n"], list(columns), "column", "filled")
    return long.withColumn("percent", F.round(100 * F.try_divide("filled", "n"), 4))
