"""Queries of joins."""

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import space as S
from ..registry import query

GAP = "date_diff('day', exam_ts, path_ts)"


@query(
    "J1_star_join",
    """SELECT o_orderkey, c_name, n_name, r_name, s_name, p_brand FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey""",
)
def j1(t):
    fact = t.lineitem.withColumnsRenamed({"l_orderkey": "o_orderkey", "l_suppkey": "s_suppkey", "l_partkey": "p_partkey"})
    dims = [
        (t.orders.withColumnRenamed("o_custkey", "c_custkey"), "o_orderkey", "inner"),
        (t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), "c_custkey", "inner"),
        (t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), "n_nationkey", "inner"),
        (t.region, "r_regionkey", "inner"),
        (t.supplier, "s_suppkey", "left"),
        (t.part, "p_partkey", "left"),
    ]
    return J.star_join(fact, dims).select("o_orderkey", "c_name", "n_name", "r_name", "s_name", "p_brand")


@query("J2_bridge_join", "SELECT p.path_accession, e.accession_number, e.modality, c.c_name FROM path p JOIN customer c ON p.patient_id = c.c_custkey LEFT JOIN exams e ON p.path_accession = e.accession_number")
def j2(t):
    dims = [(t.customer.withColumnRenamed("c_custkey", "patient_id"), "patient_id", "inner"), (t.exams.drop("patient_id").withColumn("path_accession", F.col("accession_number")), "path_accession", "left")]
    return J.star_join(t.path, dims).select("path_accession", "accession_number", "modality", "c_name")


@query("J3_semi", "SELECT accession_number FROM exams WHERE patient_id IN (SELECT patient_id FROM path WHERE path_interpretation = 'MALIGNANT')")
def j3(t):
    return J.semi(t.exams, t.path.where("path_interpretation = 'MALIGNANT'"), "patient_id").select("accession_number")


@query("J4_anti", "SELECT accession_number FROM exams e WHERE NOT EXISTS (SELECT 1 FROM path p WHERE p.patient_id = e.patient_id)")
def j4(t):
    return J.anti(t.exams, t.path, "patient_id").select("accession_number")


@query("J5_attach", "SELECT i.image_name, e.study_laterality, e.modality FROM images i LEFT JOIN exams e ON i.accession_number = e.accession_number")
def j5(t):
    return J.attach(t.images, t.exams, ["accession_number"], ["study_laterality", "modality"]).select("image_name", "study_laterality", "modality")


@query(
    "J6_link_events_asof",
    """WITH ev AS (SELECT patient_id, accession_number AS event_id, exam_ts AS event_ts FROM exams WHERE is_biopsy = 'T'),
ex AS (SELECT patient_id, accession_number AS exam_id, exam_ts, study_laterality AS side FROM exams WHERE is_biopsy = 'F')
SELECT event_id, path_accession AS path_id, (SELECT max(struct_pack(t := exam_ts, i := exam_id)).i FROM ex WHERE ex.patient_id = ev.patient_id AND ex.exam_ts < ev.event_ts AND ex.side IN ('BILATERAL', p.path_laterality)) AS exam_id
FROM ev JOIN path p ON p.patient_id = ev.patient_id AND date_diff('day', event_ts, path_ts) BETWEEN -1 AND 180""",
)
def j6(t):
    events = t.exams.where("is_biopsy = 'T'").selectExpr("patient_id", "accession_number AS event_id", "exam_ts AS event_ts")
    exams = t.exams.where("is_biopsy = 'F'").selectExpr("patient_id", "accession_number AS exam_id", "exam_ts", "study_laterality AS exam_side")
    path = t.path.selectExpr("patient_id", "path_accession AS path_id", "path_ts", "path_laterality AS path_side")
    return J.link_events_asof(events, path, exams).select("event_id", "path_id", "exam_id")


@query(
    "J7_link_all_in_window",
    f"""SELECT accession_number, path_accession, match, CASE WHEN accession_number = path_accession THEN 'given' ELSE 'found' END AS source FROM (SELECT *, row_number() OVER (PARTITION BY accession_number, path_accession ORDER BY days, match) AS k FROM (SELECT accession_number, path_accession, {GAP} AS days,
  CASE WHEN study_laterality = path_laterality THEN 'same_side' WHEN study_laterality = 'BILATERAL' THEN 'bilateral_exam' ELSE 'other_side' END AS match
FROM exams e JOIN path p ON e.patient_id = p.patient_id WHERE is_biopsy = 'F' AND {GAP} BETWEEN 0 AND 240)) WHERE k = 1""",
)
def j7(t):
    return J.link_all_in_window(t.exams.where("is_biopsy = 'F'"), t.path, 240).select("accession_number", "path_accession", "match", "source")


@query(
    "J8_encounter_link",
    """SELECT patient_id, CASE min(k) FILTER (WHERE path_laterality = 'LEFT') WHEN 0 THEN 'MALIGNANT' WHEN 1 THEN 'BENIGN' END AS "left",
  CASE min(k) FILTER (WHERE path_laterality = 'RIGHT') WHEN 0 THEN 'MALIGNANT' WHEN 1 THEN 'BENIGN' END AS "right", CAST(NULL AS STRING) AS "unknown"
FROM (SELECT patient_id, path_laterality, CASE path_interpretation WHEN 'MALIGNANT' THEN 0 WHEN 'BENIGN' THEN 1 END AS k FROM path) GROUP BY patient_id""",
)
def j8(t):
    return J.encounter_link(t.path, ["patient_id"], "path_laterality", "path_interpretation", ["MALIGNANT", "BENIGN"])


@query(
    "J9_fill_from_group",
    "SELECT image_name, coalesce(area, first_value(area IGNORE NULLS) OVER (PARTITION BY accession_number ORDER BY image_name ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS area FROM images",
)
def j9(t):
    return J.fill_from_group(t.images, "accession_number", ["area"], ["image_name"]).select("image_name", "area")


@query("J10_update_from", "SELECT e.accession_number, coalesce(p.path_interpretation, e.modality) AS modality FROM exams e LEFT JOIN (SELECT path_accession, min(path_interpretation) AS path_interpretation FROM path GROUP BY 1) p ON e.accession_number = p.path_accession")
def j10(t):
    new = t.path.groupBy(F.col("path_accession").alias("accession_number")).agg(F.min("path_interpretation").alias("modality"))
    return J.update_from(t.exams, new, "accession_number", ["modality"]).select("accession_number", "modality")


@query("J11_fill_null_from", "SELECT i.image_name, coalesce(i.laterality, e.study_laterality) AS laterality FROM images i LEFT JOIN exams e ON i.accession_number = e.accession_number")
def j11(t):
    return J.fill_null_from(t.images, t.exams.withColumnRenamed("study_laterality", "laterality"), "accession_number", "laterality").select("image_name", "laterality")


DESCRIBED = "SELECT accession_number, image_name AS lesion_id, CAST(size_cm * 2 AS BIGINT) % 12 + 1 AS d_clock, CAST(ord AS DOUBLE) AS d_distance FROM lesions"
MATCH = f"""WITH d AS ({DESCRIBED}), m AS (SELECT l.accession_number, l.image_name, d.lesion_id, least(abs(clock - d_clock) % 12, 12 - abs(clock - d_clock) % 12) AS a, abs(distance_cm - d_distance) AS g
FROM lesions l JOIN d ON l.accession_number = d.accession_number) """


@query("J12_match_lesions", MATCH + "SELECT image_name, lesion_id, round(a + g / 2, 6) AS score FROM m WHERE a <= 1.5 AND g <= 2")
def j12(t):
    described = t.lesions.selectExpr("accession_number", "image_name AS lesion_id", "CAST(size_cm * 2 AS BIGINT) % 12 + 1 AS d_clock", "CAST(ord AS DOUBLE) AS d_distance")
    return J.match_lesions(t.lesions, described).select("image_name", "lesion_id", "score")


@query("J13_best_match", MATCH + "SELECT image_name, lesion_id FROM (SELECT image_name, lesion_id, row_number() OVER (PARTITION BY accession_number, image_name ORDER BY round(a + g / 2, 6), lesion_id) AS k FROM m WHERE a <= 1.5 AND g <= 2) WHERE k = 1")
def j13(t):
    described = t.lesions.selectExpr("accession_number", "image_name AS lesion_id", "CAST(size_cm * 2 AS BIGINT) % 12 + 1 AS d_clock", "CAST(ord AS DOUBLE) AS d_distance")
    return J.best_match(J.match_lesions(t.lesions, described)).select("image_name", "lesion_id")


NEAREST = """WITH v AS (SELECT vec_id, label, vec_id // 50 AS exam, vec_id % 3 = 0 AS flag, embedding FROM embeddings),
f AS (SELECT *, bool_or(flag) OVER (PARTITION BY label, exam) AS some FROM v),
p AS (SELECT a.vec_id, a.flag, b.vec_id AS near_key, b.flag AS near_flag, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: abs(CAST(x[1] AS FLOAT) - CAST(x[2] AS FLOAT))::DOUBLE)) / len(a.embedding), 6) AS distance
  FROM f a JOIN f b ON a.label = b.label AND a.exam = b.exam AND a.vec_id <> b.vec_id WHERE a.some),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, near_key) AS k FROM p) WHERE k = 1) """


def nearest(t):
    rows = t.embeddings.withColumns({"exam": F.floor(F.col("vec_id") / 50), "flag": F.col("vec_id") % 3 == 0})
    return S.nearest_in_block(rows, ["label", "exam"], "vec_id", "embedding", "flag")


@query("J14_nearest_in_block", NEAREST + "SELECT vec_id, near_key FROM n")
def j14(t):
    return nearest(t).select("vec_id", "near_key")


@query(
    "J14_nearest_large_blocks",
    """WITH n AS (SELECT a.vec_id, b.vec_id AS near_key, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: abs(CAST(x[1] AS FLOAT) - CAST(x[2] AS FLOAT))::DOUBLE)) / len(a.embedding), 6) AS distance
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)
SELECT vec_id, near_key FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, near_key) AS k FROM n) WHERE k = 1""",
)
def j14_large(t):
    rows = t.embeddings.withColumn("flag", F.lit(True))
    return S.nearest_in_block(rows, ["label"], "vec_id", "embedding", "flag").select("vec_id", "near_key")


@query(
    "J15_flagged_clean_pairs",
    NEAREST + """SELECT flagged, clean FROM (SELECT flagged, clean, row_number() OVER (PARTITION BY flagged ORDER BY distance, clean) AS k FROM (
  SELECT CASE WHEN flag THEN vec_id ELSE near_key END AS flagged, CASE WHEN flag THEN near_key ELSE vec_id END AS clean, distance FROM n WHERE flag <> near_flag AND distance <= 0.2)) WHERE k = 1""",
)
def j15(t):
    return J.flagged_clean_pairs(nearest(t), "vec_id", "flag", 0.2).select("flagged", "clean")


@query(
    "J16_relabel_by_content",
    "SELECT l.doc_id AS old_id, l.quality, n.new_id FROM labels l JOIN documents o ON l.doc_id = o.doc_id LEFT JOIN (SELECT md5(text) AS hash, max(doc_id) AS new_id FROM documents GROUP BY 1) n ON md5(o.text) = n.hash",
)
def j16(t):
    old = t.documents.select(F.col("doc_id").alias("old_id"), F.md5("text").alias("hash"))
    new = old.groupBy("hash").agg(F.max("old_id").alias("new_id"))
    return J.relabel_by_content(t.labels.withColumnRenamed("doc_id", "old_id"), old, new).select("old_id", "quality", "new_id")


@query("J17_enrich_annotations", "SELECT p.path_accession, e.accession_number FROM path p LEFT JOIN (SELECT patient_id, min(accession_number) AS accession_number FROM exams GROUP BY patient_id) e ON p.patient_id = e.patient_id")
def j17(t):
    return J.enrich_annotations(t.path.select("path_accession", "patient_id"), t.exams.select("patient_id", "accession_number"), "patient_id", ["accession_number"]).select("path_accession", "accession_number")


@query("J18_with_labels", "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.toxic = 0")
def j18(t):
    labels = t.labels.select("doc_id", "quality", F.when(F.col("toxic") == 0, "v1").otherwise("v2").alias("version"))
    return J.with_labels(t.documents.select("doc_id"), labels, "doc_id", "v1")


@query(
    "J19_coverage",
    """SELECT CASE WHEN e.patient_id IS NULL THEN 'right_only' WHEN p.patient_id IS NULL THEN 'left_only' ELSE 'both' END AS side, count(*) AS n
FROM (SELECT DISTINCT patient_id FROM exams WHERE modality = 'US') e FULL JOIN (SELECT DISTINCT patient_id FROM path) p ON e.patient_id = p.patient_id GROUP BY 1""",
)
def j19(t):
    return J.coverage(t.exams.where("modality = 'US'"), t.path, ["patient_id"])


@query(
    "J20_gold_labels",
    """SELECT l.image_name, l.kind, e.modality FROM lesions l JOIN images i ON l.image_name = i.image_name JOIN exams e ON i.accession_number = e.accession_number
  WHERE i.darkness <= 60 AND e.modality IN ('US', 'MR') AND l.clock IS NOT NULL""",
)
def j20(t):
    labels = t.lesions.where("clock IS NOT NULL").select("image_name", "kind")
    images = t.images.where("darkness <= 60").select("image_name", "accession_number")
    return J.star_join(labels, [(images, "image_name", "inner"), (t.exams.where(F.col("modality").isin("US", "MR")), "accession_number", "inner")]).select("image_name", "kind", "modality")


IOU = """WITH p AS (SELECT * FROM boxes WHERE role = 'pred'), g AS (SELECT * FROM boxes WHERE role = 'gt'),
m AS (SELECT p.image_id, p.box_id, g.box_id AS gt_id, greatest(least(p.x2, g.x2) - greatest(p.x1, g.x1), 0) * greatest(least(p.y2, g.y2) - greatest(p.y1, g.y1), 0) AS i,
  (p.x2 - p.x1) * (p.y2 - p.y1) + (g.x2 - g.x1) * (g.y2 - g.y1) AS u, p.part, p.supp, g.part AS gpart, g.supp AS gsupp FROM p JOIN g ON p.image_id = g.image_id) """


@query("J21_iou_join", IOU + "SELECT box_id, gt_id, round(i / (u - i), 6) AS iou FROM m WHERE round(i / (u - i), 6) >= 0.3")
def j21(t):
    boxes = t.boxes
    return S.iou_join(boxes.where("role = 'pred'"), boxes.where("role = 'gt'"), 0.3).select("box_id", "gt_id", "iou")


@query(
    "J12_merge_lesions",
    """WITH m AS (SELECT l.image_name, d.image_name AS description_id, d.size_cm AS sizing FROM lesions l JOIN lesions d ON l.accession_number = d.accession_number AND abs(l.distance_cm - d.distance_cm) <= 2),
e AS (SELECT image_name, image_name AS lesion_id, size_cm AS measured FROM lesions WHERE kind <> 'N')
SELECT m.image_name, m.description_id, CASE WHEN min(lesion_id) IS NULL THEN 'create' ELSE 'update' END AS action, min(lesion_id) AS lesion_id
FROM m LEFT JOIN e ON m.image_name = e.image_name AND abs(measured - sizing) <= 0.5 GROUP BY 1, 2""",
)
def j12b(t):
    described = t.lesions.select("accession_number", F.col("image_name").alias("description_id"), F.col("distance_cm").alias("d"), F.col("size_cm").alias("sizing_cm"))
    matched = t.lesions.select("accession_number", "image_name", "distance_cm").join(described, "accession_number").where("abs(distance_cm - d) <= 2")
    existing = t.lesions.where("kind <> 'N'").select(F.col("image_name").alias("lesion_id"), "image_name", F.col("size_cm").alias("measured_cm"))
    return J.merge_lesions(existing, matched).select("image_name", "description_id", "action", "lesion_id")
