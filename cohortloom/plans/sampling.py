"""Queries of order, limits, samples and splits."""

from pyspark.sql import functions as F

from ..operators import sampling as K
from ..operators.timeline import with_row_id
from ..registry import query


def _hash(key, seed):
    return f"md5('{seed}:' || CAST({key} AS STRING))"


@query("K1_order_by", "SELECT patient_id, exam_ts, accession_number, row_number() OVER (ORDER BY patient_id, exam_ts DESC, accession_number) AS k FROM exams")
def k1(t):
    return with_row_id(t.exams.select("patient_id", "exam_ts", "accession_number"), ["patient_id", F.col("exam_ts").desc(), "accession_number"], "k")


@query("K2_page", "SELECT accession_number FROM exams ORDER BY accession_number OFFSET 20 LIMIT 30")
def k2(t):
    return K.page(t.exams.select("accession_number"), ["accession_number"], 20, 30)


@query(
    "K3_top_fraction",
    """SELECT image_name FROM (SELECT image_name, count(*) OVER (PARTITION BY accession_number) AS n, row_number() OVER (PARTITION BY accession_number ORDER BY darkness DESC, image_name) AS k
  FROM images) WHERE n <= 12 AND k <= floor(n * 0.4 + 1e-9)""",
)
def k3(t):
    return K.top_fraction(t.images, "accession_number", F.col("darkness"), "image_name", 0.4, 12).select("image_name")


@query("K4_sample_n", f"SELECT accession_number FROM exams ORDER BY {_hash('accession_number', 7)}, accession_number LIMIT 50")
def k4(t):
    return K.sample_n(t.exams.select("accession_number"), "accession_number", 50, 7)


@query(
    "K5_sample_per_class",
    f"SELECT modality, accession_number FROM (SELECT modality, accession_number, row_number() OVER (PARTITION BY modality ORDER BY {_hash('accession_number', 3)}, accession_number) AS k FROM exams) WHERE k <= 20",
)
def k5(t):
    return K.sample_per_class(t.exams, "modality", "accession_number", 20, 3, least=5).select("modality", "accession_number")


@query(
    "K6_rebalance_under",
    f"""SELECT accession_number FROM (SELECT accession_number, row_number() OVER (PARTITION BY study_laterality ORDER BY {_hash('accession_number', 5)}, accession_number) AS k FROM exams)
WHERE k <= (SELECT min(n) FROM (SELECT count(*) AS n FROM exams GROUP BY study_laterality))""",
)
def k6(t):
    return K.rebalance(t.exams, "study_laterality", "accession_number", "under", 5).select("accession_number")


@query(
    "K6_rebalance_over",
    f"""WITH c AS (SELECT study_laterality, count(*) AS n, max(count(*)) OVER () AS goal FROM exams GROUP BY study_laterality),
r AS (SELECT accession_number, study_laterality, row_number() OVER (PARTITION BY study_laterality ORDER BY {_hash('accession_number', 5)}, accession_number) AS k FROM exams)
SELECT accession_number, CAST(copy AS INT) AS copy FROM r JOIN c USING (study_laterality), range(0, 1000) g(copy) WHERE copy * n + k <= goal""",
)
def k6b(t):
    return K.rebalance(t.exams, "study_laterality", "accession_number", "over", 5).select("accession_number", "copy")


UNIT = "CAST(('0x' || substr(md5(CAST(patient_id AS STRING)), 1, 16))::UBIGINT AS DOUBLE) / 18446744073709551616.0"


@query("K7_hash_split", f"SELECT accession_number, CASE WHEN u < 0.15 THEN 'test' WHEN u < 0.3 THEN 'val' ELSE 'train' END AS split FROM (SELECT accession_number, {UNIT} AS u FROM exams)")
def k7(t):
    return t.exams.select("accession_number", K.hash_split(F.col("patient_id")).alias("split"))


@query(
    "K8_mini_split",
    """SELECT accession_number, CAST(('0x' || m)::UHUGEINT % 10000 AS BIGINT) < 500 AS mini FROM (SELECT accession_number, md5('42:' || CAST(accession_number AS STRING)) AS m FROM exams)""",
)
def k8(t):
    return t.exams.select("accession_number", K.mini_split(F.col("accession_number"), 0.05, 42).alias("mini"))


@query(
    "K9_random_split",
    f"""SELECT accession_number, CASE WHEN k <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM (SELECT accession_number, count(*) OVER (PARTITION BY modality, is_biopsy) AS n,
  row_number() OVER (PARTITION BY modality, is_biopsy ORDER BY {_hash('accession_number', 9)}, accession_number) AS k FROM exams)""",
)
def k9(t):
    return K.random_split(t.exams, "accession_number", 0.2, 9, ["modality", "is_biopsy"]).select("accession_number", "split")


@query(
    "K10_choose_fraction",
    f"""SELECT image_name, k <= floor(n * 0.15 + 1e-9) AS chosen FROM (SELECT image_name, count(*) OVER (PARTITION BY scanner) AS n,
  row_number() OVER (PARTITION BY scanner ORDER BY {_hash('image_name', 1)}, image_name) AS k FROM images)""",
)
def k10(t):
    return K.choose_fraction(t.images, "scanner", "image_name", 0.15, 1).select("image_name", "chosen")
