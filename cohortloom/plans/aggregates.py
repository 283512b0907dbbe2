"""Queries of grouped summaries."""

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import sketches as S
from ..operators.lineage import new_path
from ..registry import query
from .predicates import RULE_SQL, image_rules


@query(
    "A1_collapse_fanout",
    """SELECT patient_id, string_agg(DISTINCT modality, '; ' ORDER BY modality) AS modality, arg_min(bi_rads, accession_number) FILTER (WHERE bi_rads IS NOT NULL) AS bi_rads,
  min(accession_number) AS accession_number FROM exams WHERE patient_id % 10 <> 0 GROUP BY patient_id
UNION ALL SELECT NULL, modality, bi_rads, accession_number FROM exams WHERE patient_id % 10 = 0""",
)
def a1(t):
    rows = t.exams.select(F.when(F.col("patient_id") % 10 != 0, F.col("patient_id")).alias("patient_id"), "modality", "bi_rads", "accession_number")
    return A.collapse_fanout(rows, "patient_id", ["modality"], "accession_number")


@query("A2_value_counts", "SELECT bi_rads, count(*) AS n FROM exams WHERE bi_rads IS NOT NULL GROUP BY bi_rads")
def a2(t):
    return A.value_counts(t.exams, "bi_rads")


@query("A3_n_unique", "SELECT count(DISTINCT patient_id) AS n_unique FROM exams")
def a3(t):
    return A.n_unique(t.exams, "patient_id")


@query("A3_sketches_by_day", "SELECT count(DISTINCT CAST(exam_ts AS DATE)) AS days, count(DISTINCT patient_id) AS exact, true AS within FROM exams")
def a3_sketches(t):
    """The union of the days' sketches beside the exact count; the days come twice."""
    root = new_path(t.spark, "sketches")
    for _ in range(2):
        S.add_days(t.exams, root, "exam_ts", "patient_id")
    counted = S.distinct_in(t.spark, root).crossJoin(A.n_unique(t.exams, "patient_id").withColumnRenamed("n_unique", "exact"))
    return counted.select("days", "exact", (F.abs(F.col("n_unique") - F.col("exact")) <= 4 * S.ERROR * F.col("exact") + 1).alias("within"))


@query("A4_per_group_stats", "SELECT count(*) AS groups, min(n) AS least, max(n) AS most, round(avg(n), 6) AS mean FROM (SELECT count(*) AS n FROM exams GROUP BY patient_id)")
def a4(t):
    return A.per_group_stats(t.exams, "patient_id")


@query(
    "A5_split_matrix",
    """SELECT modality, study_laterality, count(*) FILTER (WHERE bi_rads IN ('4', '4A', '4B', '4C', '5', '6')) AS suspicious,
  count(*) FILTER (WHERE is_biopsy = 'T') AS biopsies, count(*) FILTER (WHERE bi_rads IS NULL) AS unscored FROM exams GROUP BY ALL""",
)
def a5(t):
    cells = {"suspicious": F.col("bi_rads").isin("4", "4A", "4B", "4C", "5", "6"), "biopsies": F.col("is_biopsy") == "T", "unscored": F.col("bi_rads").isNull()}
    return A.split_matrix(t.exams, ["modality", "study_laterality"], cells)


@query("A6_device_counts", "SELECT laterality, scanner, count(*) AS n FROM images GROUP BY laterality, scanner")
def a6(t):
    return t.images.groupBy("laterality", "scanner").agg(F.count("*").alias("n"))


@query(
    "A7_keyword_counts",
    """SELECT CASE WHEN description LIKE '%ECONOMY%' THEN 'dense' WHEN description LIKE '%SMALL%' OR description LIKE '%LARGE%' THEN 'scattered'
  WHEN description IS NULL THEN 'missing' ELSE 'other' END AS density, count(*) AS n FROM images GROUP BY 1""",
)
def a7(t):
    from ..functions.text import map_codes

    words = {"ECONOMY": "dense", "SMALL": "scattered", "LARGE": "scattered"}
    return t.images.groupBy(map_codes(F.col("description"), words, other="other", missing="missing").alias("density")).agg(F.count("*").alias("n"))


@query(
    "A8_any_flags",
    """SELECT accession_number, bool_or(coalesce(laterality = 'LEFT', false)) AS has_left, bool_or(coalesce(laterality = 'RIGHT', false)) AS has_right,
  bool_or(laterality IS NULL) AS has_unknown FROM images GROUP BY accession_number""",
)
def a8(t):
    side = F.col("laterality")
    return A.any_flags(t.images, "accession_number", {"has_left": side == "LEFT", "has_right": side == "RIGHT", "has_unknown": side.isNull()})


@query(
    "A9_mode_per_group",
    """SELECT accession_number, scanner FROM (SELECT accession_number, scanner, row_number() OVER (PARTITION BY accession_number
  ORDER BY count(*) DESC, scanner) AS k FROM images GROUP BY accession_number, scanner) WHERE k = 1""",
)
def a9(t):
    return A.mode_per_group(t.images, "accession_number", "scanner")


@query(
    "A9_majority_per_group",
    """SELECT accession_number, CASE WHEN count(*) = 1 THEN min(laterality) END AS laterality FROM (SELECT accession_number, laterality,
  rank() OVER (PARTITION BY accession_number ORDER BY n DESC) AS k FROM (SELECT accession_number, laterality, count(*) AS n FROM images
  WHERE laterality IS NOT NULL GROUP BY accession_number, laterality)) WHERE k = 1 GROUP BY accession_number""",
)
def a9b(t):
    return A.majority_per_group(t.images, "accession_number", "laterality")


@query("A10_collect_by_key", "SELECT accession_number, string_agg(image_name, '|' ORDER BY image_name) AS image_name FROM images GROUP BY accession_number")
def a10(t):
    return A.collect_by_key(t.images, "accession_number", "image_name").withColumn("image_name", F.array_join("image_name", "|"))


@query(
    "A11_dominant_label",
    """SELECT patient_id, CASE min(CASE path_interpretation WHEN 'MALIGNANT' THEN 0 WHEN 'BENIGN' THEN 1 END) WHEN 0 THEN 'MALIGNANT' WHEN 1 THEN 'BENIGN' END AS label
  FROM path GROUP BY patient_id""",
)
def a11(t):
    return t.path.groupBy("patient_id").agg(A.dominant_label(F.col("path_interpretation"), ["MALIGNANT", "BENIGN"]).alias("label"))


@query(
    "A12_lesion_skeletons",
    """SELECT accession_number, clock, distance_cm, clock IS NULL AS unplaced, string_agg(DISTINCT image_name, ',' ORDER BY image_name) AS source_ids, count(*) AS n,
  min(struct_pack(a := image_name, b := laterality)).b AS laterality, round(max(size_cm) * 10, 6) AS size_mm FROM lesions
  GROUP BY accession_number, clock, distance_cm, CASE WHEN clock IS NULL THEN image_name END""",
)
def a12(t):
    return A.lesion_skeletons(t.lesions.withColumnRenamed("image_name", "lesion_id"))


@query(
    "A13_longest",
    """SELECT conv_id, text FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) AS k FROM conversations WHERE text <> '') WHERE k = 1""",
)
def a13(t):
    return t.conversations.groupBy("conv_id").agg(A.longest(F.col("text"), F.col("turn")).alias("text"))


@query(
    "A14_class_summary",
    """SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean, round(stddev_samp(c_acctbal), 4) AS std, count(*) AS n, round(sum(c_acctbal), 4) AS total
  FROM customer GROUP BY c_mktsegment HAVING count(*) >= 10""",
)
def a14(t):
    return A.class_summary(t.customer, "c_mktsegment", "c_acctbal", 10)


@query(
    "A15_numeric_summary",
    "SELECT min(x) AS least, max(x) AS most, round(avg(x), 6) AS mean, count(x) AS n FROM (SELECT try_cast(bi_rads AS DOUBLE) AS x FROM exams)",
)
def a15(t):
    return A.numeric_summary(t.exams, "bi_rads")


@query(
    "A16_capped_distribution",
    """SELECT modality, bucket, n, round(100 * n / sum(n) OVER (PARTITION BY modality), 4) AS share FROM (SELECT modality,
  CASE WHEN k > 3 THEN '>3' ELSE CAST(k AS STRING) END AS bucket, count(*) AS n FROM (SELECT e.accession_number, e.modality, count(i.image_name) AS k
  FROM exams e LEFT JOIN images i ON e.accession_number = i.accession_number GROUP BY ALL) GROUP BY ALL)""",
)
def a16(t):
    per = t.exams.join(t.images.groupBy("accession_number").agg(F.count("*").alias("k")), "accession_number", "left")
    return A.capped_distribution(per, "modality", F.coalesce("k", F.lit(0)), 3)


@query(
    "A17_funnel",
    f"""WITH c AS (SELECT {RULE_SQL} AS step, count(*) AS removed FROM images GROUP BY 1)
SELECT step, removed, CAST((SELECT sum(removed) FROM c) - sum(removed) OVER (ORDER BY removed DESC, step ROWS UNBOUNDED PRECEDING) AS BIGINT) AS remaining
FROM c WHERE step IS NOT NULL""",
)
def a17(t):
    return A.funnel(t.images, image_rules())


@query("A18_distinct", "SELECT DISTINCT modality, bi_rads FROM exams")
def a18(t):
    return t.exams.select("modality", "bi_rads").distinct()
