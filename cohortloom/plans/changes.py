"""Queries of set operations, reshaping and table changes."""

from pyspark.sql import functions as F

from ..operators import buckets as B
from ..operators import changes as G
from ..operators.lineage import new_path
from ..registry import query

NEW_EXAMS = "SELECT accession_number + 7 AS accession_number, CASE WHEN patient_id % 2 = 0 THEN 'CT' END AS modality, bi_rads FROM exams WHERE modality = 'MR'"


def table(t):
    return t.exams.select("accession_number", "modality", "bi_rads", "is_biopsy")


def news(t):
    return t.exams.where("modality = 'MR'").selectExpr("accession_number + 7 AS accession_number", "CASE WHEN patient_id % 2 = 0 THEN 'CT' END AS modality", "bi_rads")


@query("G1_union_all_by_name", "SELECT patient_id, exam_ts AS ts, modality, NULL AS path_interpretation FROM exams UNION ALL SELECT patient_id, path_ts, NULL, path_interpretation FROM path")
def g1(t):
    exams = t.exams.select("patient_id", F.col("exam_ts").alias("ts"), "modality")
    return G.union_all_by_name(exams, t.path.select("patient_id", F.col("path_ts").alias("ts"), "path_interpretation"))


@query(
    "G2_key_overlap",
    """WITH a AS (SELECT DISTINCT patient_id FROM exams WHERE modality = 'US'), b AS (SELECT DISTINCT patient_id FROM path),
c AS (SELECT count(*) FILTER (WHERE a.patient_id IS NOT NULL AND b.patient_id IS NOT NULL) AS "both", count(*) FILTER (WHERE b.patient_id IS NULL) AS only_a, count(*) FILTER (WHERE a.patient_id IS NULL) AS only_b
FROM a FULL JOIN b ON a.patient_id = b.patient_id) SELECT *, round(100 * "both" / ("both" + only_a), 4) AS percent_a, round(100 * "both" / ("both" + only_b), 4) AS percent_b FROM c""",
)
def g2(t):
    return G.key_overlap(t.exams.where("modality = 'US'"), t.path, "patient_id")


@query(
    "G3_insert_ignore",
    f"""WITH n AS ({NEW_EXAMS}) SELECT accession_number, modality, bi_rads FROM exams
UNION ALL SELECT accession_number, modality, bi_rads FROM n WHERE accession_number NOT IN (SELECT accession_number FROM exams)""",
)
def g3(t):
    return G.insert_ignore(table(t).drop("is_biopsy"), news(t), ["accession_number"], ["modality"])


MERGE = f"""WITH n AS ({NEW_EXAMS}) SELECT coalesce(e.accession_number, n.accession_number) AS accession_number, {{}}, e.is_biopsy FROM exams e {{}} JOIN n ON e.accession_number = n.accession_number"""
REPLACED = ", ".join(f"CASE WHEN n.accession_number IS NOT NULL THEN n.{c} ELSE e.{c} END AS {c}" for c in ("modality", "bi_rads"))


@query("G4_upsert", MERGE.format(REPLACED, "FULL"))
def g4(t):
    return G.upsert(table(t), news(t), ["accession_number"])


@query("G5_upsert_coalesce", MERGE.format("coalesce(n.modality, e.modality) AS modality, coalesce(n.bi_rads, e.bi_rads) AS bi_rads", "FULL"))
def g5(t):
    return G.upsert_coalesce(table(t), news(t), ["accession_number"])


@query("G6_update_only", MERGE.format(REPLACED, "LEFT"))
def g6(t):
    return G.update_only(table(t), news(t), ["accession_number"])


@query(
    "G4_upsert_buckets",
    f"""WITH n AS ({NEW_EXAMS}) SELECT coalesce(n.accession_number, e.accession_number) AS accession_number,
CASE WHEN n.accession_number IS NOT NULL THEN n.modality ELSE e.modality END AS modality, CASE WHEN n.accession_number IS NOT NULL THEN n.bi_rads ELSE e.bi_rads END AS bi_rads, e.is_biopsy
FROM exams e FULL JOIN n ON e.accession_number = n.accession_number""",
)
def g4_buckets(t):
    root, key = new_path(t.spark, "exams"), ["accession_number"]
    B.create(t.spark, root, table(t).schema.simpleString()[7:-1].replace(":", " "), key, 16)
    B.merge(table(t), root, [])
    B.merge(news(t), root, [], rule=G.upsert)
    return B.read(t.spark, root)


@query("G7_coerce", "SELECT accession_number, CAST(is_biopsy = 'T' AS INT) AS is_biopsy, coalesce(bi_rads, '') AS bi_rads FROM exams")
def g7(t):
    return G.coerce(table(t), ["is_biopsy"], ["bi_rads"]).drop("modality")


@query("G8_publish_replace", "SELECT modality, CAST(count(*) AS BIGINT) AS n FROM exams GROUP BY modality")
def g8(t):
    root = new_path(t.spark, "exams")
    first = G.publish(table(t).limit(0), root, 0)
    G.publish(table(t), root, first)
    return G.read_version(t.spark, root).groupBy("modality").agg(F.count("*").alias("n"))


@query("G9_cascade_delete", "SELECT image_name FROM images WHERE accession_number IN (SELECT accession_number FROM exams WHERE modality = 'US')")
def g9(t):
    return G.cascade_delete(t.images, t.exams.where("modality = 'US'"), "accession_number").select("image_name")


@query(
    "G10_melt",
    "SELECT accession_number, 'modality' AS variable, modality AS value FROM exams UNION ALL SELECT accession_number, 'bi_rads', bi_rads FROM exams UNION ALL SELECT accession_number, 'side', study_laterality FROM exams",
)
def g10(t):
    return G.melt(t.exams.withColumnRenamed("study_laterality", "side"), ["accession_number"], ["modality", "bi_rads", "side"])


@query("G11_override_group", "SELECT accession_number, CASE WHEN bool_or(coalesce(bi_rads = '6', false)) OVER (PARTITION BY patient_id) THEN '6' ELSE bi_rads END AS bi_rads FROM exams")
def g11(t):
    return G.override_group(t.exams, "patient_id", "bi_rads", F.col("bi_rads") == "6", "6").select("accession_number", "bi_rads")


SIDES = """WITH h AS (SELECT accession_number, bool_or(coalesce(laterality = 'LEFT', false)) AS l, bool_or(coalesce(laterality = 'RIGHT', false)) AS r FROM images GROUP BY 1),
s AS (SELECT e.accession_number AS k, study_laterality AS side, coalesce(l, false) AS l, coalesce(r, false) AS r FROM exams e LEFT JOIN h ON e.accession_number = h.accession_number),
o AS (SELECT k, CAST(k AS STRING) AS accession_number, side AS study_laterality, false AS was FROM s WHERE side <> 'BILATERAL'
UNION ALL SELECT k, CAST(k AS STRING) || CASE WHEN r THEN '_L' ELSE '' END, 'LEFT', true FROM s WHERE side = 'BILATERAL' AND l
UNION ALL SELECT k, CAST(k AS STRING) || CASE WHEN l THEN '_R' ELSE '' END, 'RIGHT', true FROM s WHERE side = 'BILATERAL' AND r) """


@query("G12_split_bilateral_studies", SIDES + "SELECT accession_number, study_laterality FROM o")
def g12(t):
    return G.split_bilateral(t.exams, t.images)[0].select("accession_number", "study_laterality")


@query("G12_split_bilateral_images", SIDES + "SELECT i.image_name, o.accession_number FROM images i JOIN o ON i.accession_number = o.k AND (NOT was OR coalesce(i.laterality = o.study_laterality, false))")
def g12b(t):
    return G.split_bilateral(t.exams, t.images)[1].select("image_name", "accession_number")


@query(
    "G13_split_sides_for_export",
    """SELECT accession_number, unnest(CASE WHEN study_laterality = 'BILATERAL' THEN ['LEFT', 'RIGHT'] ELSE [study_laterality] END) AS laterality, study_laterality = 'BILATERAL' AS was_bilateral,
  false AS has_unknown_laterality FROM exams""",
)
def g13(t):
    rows = t.exams.select("accession_number", F.col("study_laterality").alias("laterality"))
    return G.split_sides_for_export(rows)


@query(
    "G14_resolve_duplicates",
    """SELECT accession_number, CASE WHEN n > 1 AND us = 0 THEN mods ELSE modality END AS modality FROM (SELECT accession_number, modality, count(*) OVER w AS n, count(*) FILTER (WHERE modality = 'US') OVER w AS us,
  row_number() OVER (PARTITION BY patient_id, exam_ts ORDER BY accession_number) AS k, m.mods FROM exams e JOIN (SELECT patient_id AS p, exam_ts AS x, string_agg(DISTINCT modality, ', ' ORDER BY modality) AS mods FROM exams GROUP BY 1, 2) m
  ON e.patient_id = m.p AND e.exam_ts = m.x WINDOW w AS (PARTITION BY patient_id, exam_ts)) WHERE n = 1 OR (us = 1 AND modality = 'US') OR (us = 0 AND k = 1)""",
)
def g14(t):
    rows = t.exams.withColumn("key", F.concat_ws("@", F.col("patient_id").cast("string"), F.col("exam_ts").cast("string")))
    return G.resolve_duplicates(rows, "key", "modality", ["accession_number"]).select("accession_number", "modality")


@query("G15_evolve", "SELECT accession_number, modality AS kind, CAST(NULL AS DOUBLE) AS age FROM exams")
def g15(t):
    return G.evolve(table(t).select("accession_number", "modality"), {"age": "double", "kind": "string"}, {"modality": "kind"})


@query("G15_flip_pointer", "SELECT a.accession_number, min(b.accession_number) AS sister FROM exams a LEFT JOIN (SELECT accession_number, patient_id AS sister FROM exams) b ON b.sister = a.accession_number GROUP BY a.accession_number")
def g15b(t):
    return G.flip_pointer(t.exams.select("accession_number", F.col("patient_id").alias("sister")), "accession_number", "sister")


@query("G16_project_shared", "SELECT accession_number, modality, NULL AS reader FROM exams WHERE modality = 'US' UNION ALL SELECT accession_number, modality, NULL FROM exams WHERE modality = 'MG'")
def g16(t):
    target = t.exams.where("modality = 'US'").select("accession_number", "modality", F.lit(None).cast("string").alias("reader"))
    return G.project_shared(t.exams.where("modality = 'MG'"), target)


@query("G17_labels_from_rows", "SELECT accession_number, area, 'gold' AS quality FROM (SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY image_name) AS k FROM images WHERE area IS NOT NULL) WHERE k = 1")
def g17(t):
    return G.labels_from_rows(t.images, "accession_number", "area", ["image_name"], "gold")


@query("G18_publish_versions", "SELECT 'current' AS version, count(*) AS n FROM exams WHERE modality = 'US' UNION ALL SELECT 'first', count(*) FROM exams UNION ALL SELECT 'stale', 1")
def g18(t):
    root = new_path(t.spark, "versions")
    first = G.publish(table(t), root, 0)
    G.publish(table(t).where("modality = 'US'"), root, first)
    try:
        G.publish(table(t), root, first)
        stale = 0
    except G.StaleVersion:
        stale = 1
    count = lambda df, name: df.agg(F.lit(name).alias("version"), F.count("*").alias("n"))
    return count(G.read_version(t.spark, root), "current").union(count(G.read_version(t.spark, root, first), "first")).union(t.nation.limit(1).select(F.lit("stale"), F.lit(stale).cast("long")))
