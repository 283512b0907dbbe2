"""Queries of dates, geometry, arrays and nested values."""

from pyspark.sql import functions as F

from ..functions import values as V
from ..registry import query


@query("H28_age_at", "SELECT image_name, CAST(date_diff('year', b, ts) - CASE WHEN strftime(ts, '%m%d') < strftime(b, '%m%d') THEN 1 ELSE 0 END AS INT) AS age FROM (SELECT image_name, acquired AS b, e.exam_ts + INTERVAL 3650 DAY AS ts FROM images i JOIN exams e ON i.accession_number = e.accession_number)")
def h28(t):
    rows = t.images.join(t.exams, "accession_number")
    return rows.select("image_name", V.age_at(F.col("acquired"), F.col("exam_ts") + F.expr("INTERVAL 3650 DAY")).alias("age"))


@query("H29_floor_days", "SELECT event_id, CAST(floor((epoch_us(TIMESTAMP '2024-01-01') - epoch_us(ts)) / 86400000000) AS BIGINT) AS days FROM events")
def h29(t):
    return t.events.select("event_id", V.floor_days(F.col("ts"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("days"))


@query("H30_month_start", "SELECT accession_number, CASE WHEN modality = 'MR' THEN 'none' ELSE strftime(exam_ts, '%Y-%m-01') END AS month, strftime(exam_ts, '%Y0101') AS year FROM exams")
def h30(t):
    text = F.when(F.col("modality") == "MR", "none").otherwise(F.date_format("exam_ts", "yyyy-MM-dd"))
    return t.exams.select("accession_number", V.month_start(text).alias("month"), V.year_start(F.date_format("exam_ts", "yyyyMMdd")).alias("year"))


@query("H31_year_of", "SELECT accession_number, CASE WHEN modality <> 'MR' THEN CAST(year(exam_ts) AS INT) END AS year FROM exams")
def h31(t):
    return t.exams.select("accession_number", V.year_of(F.when(F.col("modality") == "MR", "n/a").otherwise(F.col("exam_ts").cast("string"))).alias("year"))


@query("H32_to_ts", "SELECT accession_number, CASE WHEN modality <> 'MR' THEN CAST(year(exam_ts) AS INT) END AS year FROM exams")
def h32(t):
    return t.exams.select("accession_number", F.year(V.to_ts(F.when(F.col("modality") == "MR", "31/31/x").otherwise(F.date_format("exam_ts", "yyyy-MM-dd HH:mm:ss")))).alias("year"))


@query(
    "H33_aspect_and_darkness",
    """SELECT i.image_name, round(crop_w / crop_h, 2) AS aspect, v.dark FROM images i JOIN (SELECT vec_id, round(100 * len(list_filter(embedding, lambda x: x <= 0)) / len(embedding), 4) AS dark FROM embeddings) v ON i.accession_number = v.vec_id""",
)
def h33(t):
    dark = t.embeddings.select(F.col("vec_id").alias("accession_number"), V.share_below(F.col("embedding"), 0).alias("dark"))
    return t.images.join(dark, "accession_number").select("image_name", V.aspect(F.col("crop_w"), F.col("crop_h")).alias("aspect"), "dark")


@query(
    "H34_boxes",
    """SELECT box_id, part, supp, 2 AS n, least(greatest(x1 - 10, 0), 30) AS x1, least(greatest(y2 - 5, 0), 60) AS y2, round((x1 + x2) / 2 / 200, 6) AS cx, round((y2 - y1) / 100, 6) AS h,
  '[' || CAST(CAST(x1 AS BIGINT) AS STRING) || ', ' || CAST(CAST(y1 AS BIGINT) AS STRING) || ', ' || CAST(CAST(x2 AS BIGINT) AS STRING) || ', ' || CAST(CAST(y2 AS BIGINT) AS STRING) || '];[1, 2, 3, 4]' AS text FROM boxes""",
)
def h34(t):
    raw = F.concat(F.lit("["), F.concat_ws(", ", *[F.col(c).cast("long") for c in ("x1", "y1", "x2", "y2")]), F.lit("];[1, 2,3,4];[1,2,x,4]"))
    rows = t.boxes.select("box_id", "part", "supp", V.parse_boxes(raw).alias("b"))
    rows = rows.withColumn("s", V.shift_box(F.col("b")[0], F.lit(10), F.lit(5), F.lit(30), F.lit(60))).withColumn("c", V.to_center(F.col("b")[0], F.lit(200), F.lit(100)))
    return rows.select("box_id", "part", "supp", F.size("b").alias("n"), "s.x1", "s.y2", "c.cx", "c.h", V.format_boxes(F.col("b")).alias("text"))


@query(
    "H35_polygons",
    """SELECT box_id, part, supp, 'rectangle' AS shape, round((x1 + x2) / 2, 6) AS mid_x, x2 - x1 AS width, round((x1 + x2) / 2 - (x2 - x1) / 4, 6) AS small_x1 FROM boxes""",
)
def h35(t):
    text = F.concat_ws(";", *[F.concat_ws(",", a, b) for a in ("x1", "x2") for b in ("y1", "y2")])
    rows = t.boxes.select("box_id", "part", "supp", V.parse_polygon(text).alias("p"))
    rows = rows.withColumns({"m": V.centroid(F.col("p")), "b": V.bbox(F.col("p")), "s": V.bbox(V.shrink(F.col("p"), 0.5))})
    return rows.select("box_id", "part", "supp", V.shape_class(F.col("p")).alias("shape"), F.round("m.x", 6).alias("mid_x"), (F.col("b.x2") - F.col("b.x1")).alias("width"), F.round("s.x1", 6).alias("small_x1"))


@query("H37_clock_distance", "SELECT image_name, least(abs(clock - ord) % 12, 12 - abs(clock - ord) % 12) AS d FROM lesions")
def h37(t):
    return t.lesions.select("image_name", V.clock_distance(F.col("clock"), F.col("ord")).alias("d"))


@query(
    "H38_ensemble",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST((u AND c) OR (u AND (k OR pc > 0.2)) OR (c AND (k OR pu > 0.2)) OR (n >= 2 AND pk > 0.3) AS INT) AS flag, greatest(pu, pc, CASE WHEN k THEN pk ELSE 0 END) AS confidence,
  coalesce(nullif(concat_ws('+', CASE WHEN u THEN 'uncropped' END, CASE WHEN c THEN 'cropped' END, CASE WHEN k THEN 'locator' END), ''), 'none') AS source
FROM (SELECT *, pu > 0.5 AS u, pc > 0.5 AS c, n >= 1 AND pk > 0.3 AS k FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount * 10 AS pu, l_tax * 12 AS pc, l_linenumber - 1 AS n, l_quantity / 100 AS pk FROM lineitem))""",
)
def h38(t):
    x = V.ensemble(F.col("l_discount") * 10, F.col("l_tax") * 12, F.col("l_linenumber") - 1, F.col("l_quantity") / 100)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", x.alias("x")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "x.flag", "x.confidence", "x.source")


@query(
    "H39_measurements",
    """WITH p AS (SELECT accession_number AS k, image_name AS n, CAST(crop_w AS DOUBLE) AS x, CAST(crop_h AS DOUBLE) AS y, row_number() OVER (PARTITION BY accession_number ORDER BY crop_w, crop_h, image_name) - 1 AS i FROM images),
c AS (SELECT k FROM p GROUP BY k HAVING count(*) <= 9)
SELECT a.k AS accession_number, CAST(a.i AS INT) AS i, CAST(b.i AS INT) AS j, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) * 0.5, 6) AS length FROM p a JOIN p b ON a.k = b.k AND a.i < b.i WHERE a.k IN (SELECT k FROM c)""",
)
def h39(t):
    point = F.struct(F.col("crop_w").cast("double").alias("x"), F.col("crop_h").cast("double").alias("y"), "image_name")
    rows = t.images.groupBy("accession_number").agg(F.sort_array(F.collect_list(point)).alias("points")).withColumn("mm", F.lit(0.5))
    return V.measurements(rows, "accession_number", "points", "mm").select("accession_number", "i", "j", "length")


@query(
    "H40_tri_state",
    """SELECT accession_number, CASE WHEN l IS NULL AND r IS NULL THEN -1 WHEN own LIKE '%MALIGNANT%' THEN 1 ELSE 0 END AS state FROM (SELECT *, CASE study_laterality WHEN 'LEFT' THEN l WHEN 'RIGHT' THEN r ELSE coalesce(l, r) END AS own FROM (
  SELECT accession_number, study_laterality, CASE bi_rads WHEN '5' THEN 'MALIGNANT1' WHEN '2' THEN 'BENIGN2' END AS l, CASE bi_rads WHEN '6' THEN 'MALIGNANT1' WHEN '2' THEN 'BENIGN2' END AS r FROM exams))""",
)
def h40(t):
    left = F.when(F.col("bi_rads") == "5", "MALIGNANT1").when(F.col("bi_rads") == "2", "BENIGN2")
    right = F.when(F.col("bi_rads") == "6", "MALIGNANT1").when(F.col("bi_rads") == "2", "BENIGN2")
    return t.exams.select("accession_number", V.tri_state(F.col("study_laterality"), left, right).alias("state"))


@query("H41_content_hash", "SELECT doc_id, md5(text) AS hash FROM documents")
def h41(t):
    return t.documents.select("doc_id", V.content_hash(F.col("text")).alias("hash"))


@query(
    "H42_flatten_extraction",
    "SELECT accession_number, bi_rads AS score, CAST(is_biopsy = 'T' AS INT) AS biopsy, '[\"' || modality || '\",\"x\"]' AS codes, CASE WHEN modality = 'US' THEN CAST(patient_id AS BIGINT) END AS size FROM exams",
)
def h42(t):
    tumor = F.when(F.col("modality") == "US", F.struct(F.col("patient_id").alias("size")))
    doc = F.to_json(F.struct(F.col("bi_rads").alias("score"), F.struct((F.col("is_biopsy") == "T").alias("done"), F.array("modality", F.lit("x")).alias("codes")).alias("biopsy"), tumor.alias("tumor")))
    schema = "score string, biopsy struct<done: boolean, codes: array<string>>, tumor struct<size: long>"
    rows = t.exams.select("accession_number", doc.alias("doc"))
    return V.flatten_extraction(rows, "doc", schema, {"score": "score", "biopsy": "biopsy.done", "codes": "biopsy.codes", "size": "tumor.size"}).drop("doc")


@query("H43_explode_ids", "SELECT patient_id, accession_number AS source_id FROM exams")
def h43(t):
    rows = t.exams.groupBy("patient_id").agg(F.to_json(F.collect_list("accession_number")).alias("ids"))
    return V.explode_ids(rows, "ids").select("patient_id", "source_id")
