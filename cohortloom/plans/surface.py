"""Queries through user functions in SQL."""

from pyspark.sql import functions as F

from ..functions.surface import first_rule, fold_groups, register
from ..registry import query


def sql(t, text, **frames):
    register(t.spark)
    return t.spark.sql(text, **frames)


@query("U1_scalar_functions", "SELECT image_name, least(abs(clock - ord) % 12, 12 - abs(clock - ord) % 12) AS d, lower(kind) || ' x' AS caption, CASE kind WHEN 'R' THEN 'MALIGNANT' ELSE 'BENIGN' END AS label FROM lesions")
def u1(t):
    return sql(t, "SELECT image_name, clock_distance(clock, ord) AS d, tidy_caption(concat(kind, '  X ')) AS caption, strip_rank(CASE kind WHEN 'R' THEN 'MALIGNANT4' ELSE 'BENIGN2' END) AS label FROM {l}", l=t.lesions)


@query("U2_aggregate_function", "SELECT patient_id, string_agg(DISTINCT modality, '; ' ORDER BY modality) AS modalities FROM exams GROUP BY patient_id")
def u2(t):
    return sql(t, "SELECT patient_id, join_values(collect_set(modality)) AS modalities FROM {e} GROUP BY patient_id", e=t.exams)


@query("U3_table_function", "SELECT note_id, note_part, note_lab, 'B' AS letter FROM notes WHERE note_lab % 2 = 0")
def u3(t):
    return sql(t, "SELECT note_id, note_part, note_lab, letter FROM {n}, LATERAL lettered_parts(note)", n=t.notes)


@query(
    "U4_fold_groups",
    """WITH r AS (SELECT patient_id, is_biopsy, row_number() OVER (PARTITION BY patient_id ORDER BY exam_ts, accession_number) - row_number() OVER (PARTITION BY patient_id, is_biopsy ORDER BY exam_ts, accession_number) AS g FROM exams)
SELECT patient_id, CAST(coalesce(max(n) FILTER (WHERE is_biopsy = 'F'), 0) AS INT) AS longest FROM (SELECT patient_id, is_biopsy, g, count(*) AS n FROM r GROUP BY 1, 2, 3) GROUP BY patient_id""",
)
def u4(t):
    """Of each patient the longest run of exams without a biopsy."""
    run = lambda best, now: F.struct(best.alias("best"), now.alias("now"))
    now = lambda acc, x: F.when(x["is_biopsy"] == "F", acc["now"] + 1).otherwise(0)
    step = lambda acc, x: run(F.greatest(acc["best"], now(acc, x)), now(acc, x))
    out = fold_groups(t.exams, "patient_id", ["exam_ts", "accession_number"], ["is_biopsy"], run(F.lit(0), F.lit(0)), step, lambda acc: acc["best"])
    return out.withColumnRenamed("result", "longest")


@query("U5_pattern_tables", "SELECT report_id, CASE d WHEN 1 THEN 'x-ray' WHEN 3 THEN 'magnetic' ELSE 'sound' END AS code FROM reports")
def u5(t):
    """Rules as rows: a small pattern table becomes one expression; the first rule in order wins."""
    rules = t.spark.createDataFrame([(1, "MAMMO", "x-ray"), (2, r"\bMR\b", "magnetic"), (3, r"\bUS\b", "sound")], "rule int, pattern string, code string")
    return t.reports.select("report_id", first_rule(rules, F.col("description")).alias("code"))
