"""The diagnosis rules against plain loops over each patient's rows."""

from datetime import timedelta

from pyspark.sql import functions as F

from cohortloom.operators import timeline as W
from cohortloom.plans import jobs
from cohortloom.plans.jobs import diagnosed
from cohortloom.registry import Tables
from conftest import SMALL

DAY = timedelta(days=1)


def brute(rows):
    """rows: all timeline rows of one patient."""
    out = {}
    for r in rows:
        if r.kind != "exam":
            continue
        own = {"LEFT": ["LEFT"], "RIGHT": ["RIGHT"], "BILATERAL": ["LEFT", "RIGHT"]}.get(r.study_laterality, [])
        diag, why = {"LEFT": None, "RIGHT": None}, {"LEFT": None, "RIGHT": None}

        def fill(side, value, source):
            if value and diag[side] is None:
                diag[side], why[side] = value, source

        within = lambda a, b: [x for x in rows if a <= x.ts - r.ts <= b]  # noqa: B023, E731
        later = lambda days: [x for x in rows if r.ts < x.ts <= r.ts + days * DAY]  # noqa: B023, E731
        if r.encounter_id is not None and r.concordance != "F":
            same = [x for x in rows if x.encounter_id == r.encounter_id and x.path_interpretation in ("MALIGNANT", "BENIGN")]
            for s in own:
                names = {x.path_interpretation for x in same if x.path_laterality == s or (r.study_laterality == s and x.path_laterality not in ("LEFT", "RIGHT"))}
                fill(s, "MALIGNANT0" if "MALIGNANT" in names else "BENIGN0" if names else None, "encounter linked path")
        after = [x.ts for x in rows if x.ts > r.ts]
        calm = after and (max(after) - r.ts).days >= 180 and not any(x.is_biopsy == "T" for x in within(-30 * DAY, 120 * DAY)) and not any("MALIGNANT" in (x.path_interpretation or "") for x in later(450))
        if calm and r.bi_rads in ("1", "2") and all(x.bi_rads in ("1", "2") for x in later(730) if x.kind == "exam" and x.bi_rads):
            for s in own:
                fill(s, "BENIGN1", "assumed benign")
        exams = [x for x in later(1095) if x.kind == "exam"]
        far = any((x.ts - r.ts).days >= 730 for x in later(1095))
        if calm and r.bi_rads == "3" and (all(x.bi_rads in ("1", "2") for x in exams) or (all(x.bi_rads in ("1", "2", "3") for x in exams) and far)):
            for s in own:
                fill(s, "BENIGN3", "assumed benign - birads 3")
        bad = {x.path_laterality for x in rows if "MALIGNANT" in (x.path_interpretation or "")}
        if r.bi_rads == "6" and (r.study_laterality == "BILATERAL" or not any(diag.values())):
            for s in own:
                fill(s, "MALIGNANT1" if s in bad else None, "birads 6 with malignancy")
        if not any(diag.values()):
            ahead = later(240)
            biopsy = any(x.is_biopsy == "T" for x in ahead)
            for s in own:
                names = {x.path_interpretation for x in ahead if x.path_laterality == s}
                if "MALIGNANT" in names and biopsy and r.bi_rads in ("4", "4A", "4B", "4C", "5", "6"):
                    fill(s, "MALIGNANT2", "malignant pathology")
                elif "BENIGN" in names and "MALIGNANT" not in names and r.bi_rads in ("1", "2", "3", "4", "4A", "4B"):
                    fill(s, "BENIGN2", "benign pathology")
        for text, source in ((r.a2_category, "addendum A2"), (r.a1_category, "addendum A1")):
            if text and text.strip():
                for s in own:
                    diag[s] = "MALIGNANT4" if "malignant" in text.lower() or "invasive" in text.lower() else "BENIGN4"
                    why[s] = source
                break
        out[r.row_id] = (diag["LEFT"], why["LEFT"], diag["RIGHT"], why["RIGHT"])
    return out


def test_rules_equal_plain_loops(spark):
    rows = diagnosed(Tables(spark, SMALL)).collect()
    by_patient = {}
    for r in rows:
        by_patient.setdefault(r.patient_id, []).append(r)
    want = {}
    for part in by_patient.values():
        want |= brute(part)
    got = {r.row_id: (r.left_diagnosis, r.left_diagnosis_source, r.right_diagnosis, r.right_diagnosis_source) for r in rows if r.kind == "exam"}
    assert got == want
    seen = {v for x in want.values() for v in (x[0], x[2]) if v}
    assert {"BENIGN0", "MALIGNANT0", "BENIGN4", "MALIGNANT4", "BENIGN2"} <= seen


def test_tasks_of_the_rules_follow_the_rows(spark, monkeypatch):
    """C4, both queries of C5 and C6 share the windows by patient."""
    monkeypatch.setattr(W, "PART_ROWS", 400, raising=False)
    largest = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    t = Tables(spark, SMALL)
    assert largest(diagnosed(t)) <= 400  # of 2,900
    assert largest(jobs.C.final_tables(jobs.exam_rows(t), jobs.path_rows(t))["exams"]) <= 400
