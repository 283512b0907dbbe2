"""Queries of quality measures."""

from pyspark.sql import functions as F

from ..registry import query
from . import evaluate as E
from .joins import IOU


@query(
    "E1_agreement",
    """SELECT 'laterality' AS feature, count(*) AS n, count(*) FILTER (WHERE t IS NOT DISTINCT FROM p) AS same, count(*) FILTER (WHERE t = p) AS tp, count(*) FILTER (WHERE p IS NOT NULL AND t IS DISTINCT FROM p) AS fp,
  count(*) FILTER (WHERE t IS NOT NULL AND p IS NULL) AS fn, count(*) FILTER (WHERE t IS NULL AND p IS NULL) AS tn, count(t) AS labelled, round(count(*) FILTER (WHERE t IS NOT DISTINCT FROM p) / count(*), 6) AS accuracy,
  round(count(*) FILTER (WHERE t = p) / count(t), 6) AS labelled_accuracy FROM (SELECT l.laterality AS t, i.laterality AS p FROM lesions l JOIN images i ON l.image_name = i.image_name)""",
)
def e1(t):
    return E.agreement(t.lesions, t.images, "image_name", ["laterality"])


@query(
    "E2_set_agreement",
    """WITH a AS (SELECT DISTINCT l_orderkey AS k, l_returnflag AS v FROM lineitem WHERE l_linenumber <= 3), b AS (SELECT DISTINCT l_orderkey AS k, l_returnflag AS v FROM lineitem WHERE l_linenumber >= 3),
r AS (SELECT coalesce(a.v, b.v) AS class, count(*) FILTER (WHERE a.v IS NOT NULL AND b.v IS NOT NULL) AS hit, count(*) FILTER (WHERE b.v IS NULL) AS miss, count(*) FILTER (WHERE a.v IS NULL) AS extra
FROM (SELECT * FROM a WHERE k IN (SELECT k FROM b)) a FULL JOIN (SELECT * FROM b WHERE k IN (SELECT k FROM a)) b ON a.k = b.k AND a.v = b.v GROUP BY 1) SELECT *, round(hit / (hit + miss), 6) AS recall FROM r""",
)
def e2(t):
    return E.set_agreement(t.lineitem.where("l_linenumber <= 3"), t.lineitem.where("l_linenumber >= 3"), "l_orderkey", "l_returnflag")


@query(
    "E1_row_agreement",
    """SELECT l.image_name, l.laterality IS NOT DISTINCT FROM i.laterality AND l.kind IS NOT DISTINCT FROM i.area AS exact, l.laterality IS NOT NULL OR l.kind IS NOT NULL AS labelled,
  concat_ws(',', CASE WHEN l.laterality IS DISTINCT FROM i.laterality THEN 'laterality' END, CASE WHEN l.kind IS DISTINCT FROM i.area THEN 'area' END) AS differs
FROM (SELECT image_name, laterality, CASE kind WHEN 'R' THEN 'BREAST' WHEN 'N' THEN 'AXILLA' END AS kind FROM lesions) l JOIN images i ON l.image_name = i.image_name""",
)
def e1b(t):
    truth = t.lesions.select("image_name", "laterality", F.when(F.col("kind") == "R", "BREAST").when(F.col("kind") == "N", "AXILLA").alias("area"))
    return E.row_agreement(truth, t.images, "image_name", ["laterality", "area"])


@query(
    "E2_set_overlap",
    """WITH a AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_returnflag)) AS t FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1), b AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_returnflag)) AS p FROM lineitem WHERE l_linenumber >= 3 GROUP BY 1)
SELECT k AS l_orderkey, t = p AS equal, round(len(list_intersect(t, p)) / len(list_distinct(list_concat(t, p))), 6) AS overlap,
  CASE WHEN list_contains(t, 'R') THEN 'R' WHEN list_contains(t, 'A') THEN 'A' END IS NOT DISTINCT FROM CASE WHEN list_contains(p, 'R') THEN 'R' WHEN list_contains(p, 'A') THEN 'A' END AS same_primary FROM a JOIN b USING (k)""",
)
def e2b(t):
    return E.set_overlap(t.lineitem.where("l_linenumber <= 3"), t.lineitem.where("l_linenumber >= 3"), "l_orderkey", "l_returnflag", ["R", "A"])


def boxes(t):
    rows = t.boxes.withColumn("box_id", F.concat_ws("_", "box_id", "part", "supp"))
    return rows.where("role = 'pred'"), rows.where("role = 'gt'")


@query("E3_detection_metrics")
def e3(t):
    return E.detection_metrics(*boxes(t), 0.5)


@query("E3_confusion_matrix")
def e3_confusion(t):
    cls = F.when(F.col("part") % 3 == 0, "malignant").otherwise("benign")
    return E.confusion_matrix(*[b.withColumn("cls", cls) for b in boxes(t)], 0.5)


@query("E3_image_metrics")
def e3_images(t):
    return E.image_metrics(t.boxes.select("image_id"), *boxes(t), 0.5)


@query("E4_mean_average_precision")
def e4(t):
    return E.mean_average_precision(*boxes(t), [0.3, 0.5, 0.7])


@query("E3_overlapping_pairs", IOU + "SELECT count(*) AS n FROM m WHERE round(i / (u - i), 6) >= 0.5")
def e3b(t):
    from ..operators.space import iou_join

    return iou_join(*boxes(t), 0.5).agg(F.count("*").alias("n"))


@query(
    "E5_zero_hit_rate",
    "SELECT scanner, count(*) AS n, count(*) FILTER (WHERE l.image_name IS NULL) AS zero, round(100 * count(*) FILTER (WHERE l.image_name IS NULL) / count(*), 4) AS percent FROM images i LEFT JOIN (SELECT DISTINCT image_name FROM lesions WHERE clock > 6) l ON i.image_name = l.image_name GROUP BY scanner",
)
def e5(t):
    return E.zero_hit_rate(t.images, t.lesions.where("clock > 6"), "image_name", "scanner")


@query(
    "E6_fill_rate",
    """SELECT count(*) AS n, 'area' AS "column", count(area) AS filled, round(100 * count(area) / count(*), 4) AS percent FROM images UNION ALL SELECT count(*), 'laterality', count(laterality), round(100 * count(laterality) / count(*), 4) FROM images""",
)
def e6(t):
    return E.fill_rate(t.images, ["area", "laterality"])
