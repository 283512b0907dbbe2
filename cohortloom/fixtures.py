"""Adapter views: the cohort tables (exams, pathology, images, ...) derived from the given tables.

Each view is plain SQL that Spark and other SQL engines accept alike; ``view`` runs it on the tables of a folder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS = {
    "exams": """
SELECT o_orderkey AS accession_number, o_custkey AS patient_id, o_orderdate AS exam_ts,
  CASE o_orderkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'MG' ELSE 'MR' END AS modality,
  CASE o_orderstatus WHEN 'F' THEN 'LEFT' WHEN 'O' THEN 'RIGHT' ELSE 'BILATERAL' END AS study_laterality,
  CASE o_orderkey % 11 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' WHEN 4 THEN '4'
    WHEN 5 THEN '4A' WHEN 6 THEN '4B' WHEN 7 THEN '4C' WHEN 8 THEN '5' WHEN 9 THEN '6' END AS bi_rads,
  CASE WHEN o_orderkey % 5 = 0 THEN 'T' ELSE 'F' END AS is_biopsy,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'OUTSIDE READ ' || o_orderpriority WHEN '5-LOW' THEN NULL
    ELSE 'DIAGNOSTIC ' || o_orderpriority END AS description
FROM orders""",
    "path": """
SELECT l.l_orderkey AS path_accession, l.l_partkey AS path_part, l.l_suppkey AS path_lab, o.o_custkey AS patient_id,
  l.l_shipdate AS path_ts,
  CASE l.l_linestatus WHEN 'O' THEN 'LEFT' ELSE 'RIGHT' END AS path_laterality,
  CASE l.l_returnflag WHEN 'R' THEN 'MALIGNANT' WHEN 'A' THEN 'BENIGN' ELSE 'UNKNOWN' END AS path_interpretation
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_linenumber = 1""",
    "images": """
SELECT CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING) || '_' ||
  CAST(l_suppkey AS STRING) AS image_name, l_orderkey AS accession_number, l_quantity * 2 AS darkness,
  CAST(p_size AS BIGINT) * 20 AS crop_w, CAST(p_size AS BIGINT) * 10 + l_linenumber * 30 AS crop_h,
  1 + l_linenumber % 2 AS region_count, p_brand AS scanner, p_type AS description,
  CASE l_returnflag WHEN 'R' THEN 'BREAST' WHEN 'A' THEN 'AXILLA' END AS area,
  CASE WHEN l_linestatus = 'O' THEN 'LEFT' WHEN l_returnflag = 'R' THEN 'RIGHT' END AS laterality,
  l_linenumber % 2 AS has_calipers, l_shipdate AS acquired, l_suppkey AS device
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "timeline": """
SELECT event_id, user_id AS patient_id, ts, event_type, value, event_type = 'purchase' AS is_event,
  CASE event_id % 3 WHEN 0 THEN 'LEFT' WHEN 1 THEN 'RIGHT' ELSE 'BILATERAL' END AS side,
  CASE event_type WHEN 'purchase' THEN 4 WHEN 'error' THEN 3 WHEN 'signup' THEN 2 WHEN 'click' THEN 1 END AS score
FROM events""",
    "lesions": """
SELECT CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING) || '_' ||
  CAST(l_suppkey AS STRING) AS image_name, l_orderkey AS accession_number,
  CASE WHEN l_quantity <= 48 THEN CAST(l_quantity AS BIGINT) % 12 + 1 END AS clock,
  CAST(l_partkey % 9 AS DOUBLE) AS distance_cm, CAST(l_suppkey % 7 AS DOUBLE) / 2 AS size_cm,
  CASE l_linestatus WHEN 'O' THEN 'LEFT' ELSE 'RIGHT' END AS laterality, l_returnflag AS kind, l_linenumber AS ord
FROM lineitem""",
    "boxes": """
SELECT l_orderkey AS image_id, l_orderkey * 10 + l_linenumber AS box_id, l_partkey AS part, l_suppkey AS supp,
  CAST(l_partkey % 50 AS DOUBLE) AS x1, CAST(l_suppkey % 40 AS DOUBLE) AS y1,
  CAST(l_partkey % 50 + 5 + l_quantity AS DOUBLE) AS x2, CAST(l_suppkey % 40 + 5 + l_linenumber * 7 AS DOUBLE) AS y2,
  l_discount AS score, l_tax AS shift, CASE WHEN l_linenumber % 2 = 1 THEN 'gt' ELSE 'pred' END AS role
FROM lineitem""",
    "reports": """
SELECT o_orderkey AS report_id, o_custkey AS patient_id, o_orderdate AS exam_ts, o_orderkey % 6 AS f, o_orderkey % 4 AS d, o_orderkey % 5 AS s,
  CASE o_orderkey % 4 WHEN 0 THEN 'US BREAST LEFT LIMITED' WHEN 1 THEN 'MAMMO SCREENING BILATERAL' WHEN 2 THEN 'US GUIDED BX R BI' ELSE 'MR BREAST RT W CONTRAST' END AS description,
  'EXAM: ' || o_orderpriority || ' MODALITY: Ultrasound Hand DENSITY: heterogeneously dense ' || o_orderstatus || ' FINDINGS: - ' ||
  CASE o_orderkey % 6 WHEN 0 THEN 'oval circumscribed hypoechoic mass with posterior enhancement.' WHEN 1 THEN 'no spiculated mass.' WHEN 2 THEN 'no oval area but irregular spiculated mass.'
    WHEN 3 THEN 'anechoic and hypoechoic round areas, circumscribed and indistinct.' WHEN 4 THEN 'complex cyst is no longer seen.' ELSE 'lymph node with echogenic halo.' END ||
  ' IMPRESSION: BI-RADS ' || CASE o_orderkey % 5 WHEN 0 THEN '4a' WHEN 1 THEN '2' WHEN 2 THEN '(5)' WHEN 3 THEN '3' ELSE 'unknown' END || ' - probably benign finding. CONCORDANCE: ' ||
  CASE WHEN o_orderkey % 7 = 0 THEN 'no' ELSE 'Yes' END || CASE WHEN o_orderkey % 3 = 0 THEN ' Addendum on 01/02/2003 at 10:11:12 for Dr. Smith' ELSE '' END AS body
FROM orders""",
    "notes": """
SELECT l_orderkey AS note_id, l_partkey AS note_part, l_suppkey AS note_lab, l_partkey % 6 AS k, l_quantity AS q,
  'SPECIMEN FINAL DIAGNOSIS: ' || CASE l_partkey % 6 WHEN 0 THEN 'A. Left breast, invasive ductal carcinoma.' WHEN 1 THEN 'A) Right breast, negative for carcinoma.' WHEN 2 THEN 'Fibroadenoma, left.'
    WHEN 3 THEN 'A. Right breast, lobular carcinoma in situ.' WHEN 4 THEN 'A. No evidence of malignancy in nodes; DCIS was found elsewhere and far away in the second specimen.' ELSE 'A. Skin.' END ||
  CASE WHEN l_suppkey % 2 = 0 THEN chr(10) || 'B. Right breast, benign. COMMENT none' ELSE '' END || ' CLINICAL: text' AS note
FROM lineitem""",
}


def tables_of(sql: str) -> list[str]:
    return [t for t in [*TABLES, *VIEWS] if re.search(rf"\b{t}\b", sql)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return table(spark, sf_dir, name)
    sql = VIEWS[name]
    frames = {t: table(spark, sf_dir, t) for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", sql)}
    for t in frames:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    return spark.sql(sql, **frames)


def with_views(sql: str) -> str:
    """``sql`` with the views that it reads put before it."""
    used = [v for v in VIEWS if re.search(rf"\b(FROM|JOIN|,) ?{v}\b", sql)]
    head = ", ".join(f"{v} AS ({VIEWS[v]}\n)" for v in used)
    body = sql.strip()
    if not head:
        return body
    return f"WITH {head}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {head}\n{body}"
