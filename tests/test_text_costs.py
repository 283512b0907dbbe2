"""What text rules must not do by row: search for forms whose words are not there, cast what is no number, run in few tasks."""

import re

from cohortloom.functions import text as H
from cohortloom.operators import timeline as W
from cohortloom.plans import cohort as C
from cohortloom.plans.jobs import raw_reports
from cohortloom.registry import Tables
from conftest import SMALL
from pyspark.sql import functions as F

TEXTS = [
    "Category 4a: suspicious", "category number 3 (probably benign)", "ACR code: 2 benign", "BI-RADS: ASSESSMENT: CODE: 4b-suspicious", "BIRADS code 2, benign", "US BI-RADS: (3) stable", "bi-rads 5 - malignant finding",
    "IMPRESSION: BI-RADS 4C, suspicious", "BI-RADS: probably benign (3)", "final assessment: 2 - benign", "BI-RADS® ATLAS category (overall): 4 x", "BI-RADS® Category: 6 - known", "BI-RADS category overall: 4a suspicious", "OVERALL STUDY BI-RADS: 1",
    "BI-RADS Category No. 2", "Category 0", "ASSESSMENT: BI-RADS 2 benign", "birads unknown", "no score", "", "Category 7", "ultrasound bi-rads:4", "BIRADS:\t2", "ﬁnal aſſessment: 3 x", None,
]


def test_score_is_that_of_the_forms(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select(H.score(F.col("t")).alias("a"), H.ordinal_score(F.col("t"))["score"].alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] and sum(r.a is not None for r in rows) >= 17


def test_no_cast_of_what_is_no_number(spark):
    texts = [("LT AX 3:30 5 CM",), ("rt 2-5 cm",), ("breast",), (None,), ("$cm 3-scm",)]
    rows = spark.createDataFrame(texts, "t string").repartition(1).select(H.caption_attributes(F.col("t")).alias("x"))
    assert [r.x.nipple_dist for r in rows.collect()] == [5, 4, None, None, 4]
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "try_cast(nullif(regexp_extract" in plan and "try_cast(regexp_extract" not in plan


def test_tasks_of_the_exam_job_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(W, "PART_ROWS", 4000)
    rows = C.clean_exams(raw_reports(Tables(spark, SMALL)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\(patient_id#\d+L?, (\d+)\)", plan) == ["6"]
