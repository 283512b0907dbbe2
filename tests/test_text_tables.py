"""Text rules on literal texts: at least one for each pattern and each negation."""

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import text as H


def run(spark, rule, texts):
    df = spark.createDataFrame([(i, *(t if isinstance(t, tuple) else (t,))) for i, t in enumerate(texts)], "i int, " + ", ".join(f"c{k} string" for k in range(len(texts[0]) if isinstance(texts[0], tuple) else 1)))
    return [r.x for r in df.select("i", rule(*[F.col(c) for c in df.columns[1:]]).alias("x")).orderBy("i").collect()]


SCORES = [
    ("Category 4A: Suspicious abnormality.", "4A", "Suspicious"),
    ("Category number: (2), Benign. More", "2", "Benign"),
    ("Category # 1 / Negative.", "1", "/ Negative"),  # the first separator that fits is the blank
    ("Category 3 (probably benign)", "3", "(probably benign"),
    ("ACR code: 3 Probably benign finding.", "3", "Probably benign"),
    ("BIRADS ASSESSMENT: CODE: 4-suspicious", "4", "suspicious"),
    ("BI-RADS Code 2, benign", "2", "benign"),
    ("Ultrasound BI-RADS: (3) Probable thing", "3", "Probable"),
    ("BI-RADS ASSESSMENT: 5 - highly suggestive of malignancy. End", "5", "- highly suggestive of malignancy"),
    ("ASSESSMENT: BI-RADS CATEGORY: 4b, suspicious.", "4B", "suspicious"),
    ("IMPRESSION: BI-RADS 1 - Negative.", "1", "- Negative"),
    ("BI-RADS: benign (2)", "2", "benign"),
    ("Final Assessment: 4c, suspicious", "4C", "suspicious"),
    ("BI-RADS® ATLAS category (overall): 6 Known cancer.", "6", "Known cancer"),
    ("BI-RADS® Category: 0 - Incomplete.", "0", "- Incomplete"),
    ("US BIRADS: 2", "2", None),
    ("BI-RADS 3", "3", None),
    ("OVERALL STUDY BI-RADS: 1", "1", None),
    ("BI-RADS Category No. 4a", "4A", None),
    ("Category 6", "6", None),
    ("category no. 5", "5", None),
    ("no score here", None, None),
    (None, None, None),
]


def test_scores(spark):
    got = run(spark, H.ordinal_score, [t for t, *_ in SCORES])
    assert [(t, x.score, x.description) for (t, *_), x in zip(SCORES, got)] == SCORES


TABLES = {
    "findings": (H.findings, [("FINDINGS: - a mass. IMPRESSION: x", "a mass."), ("Ultrasound Findings: cyst", "cyst"), ("Findings: node IMPRESSION", "node"), ("nothing", None), (None, None)]),
    "impression": (H.impression, [("IMPRESSION: benign. PLAN: none", "benign."), ("IMPRESSION benign: stable NOTE: x", "benign stable NOTE x"), ("IMPRESSION " + "b" * 60 + " NOTE: x", "b" * 60), ("none", None)]),
    "section": (lambda c: H.section(c, "DENSITY:"), [("DENSITY: dense FINDINGS: x", "dense"), ("DENSITY: fatty", "fatty"), ("x", None)]),
    "final_diagnosis": (H.final_diagnosis, [("FINAL DIAGNOSIS: A. Skin. CLINICAL: x", "A. Skin."), ("FINAL DIAGNOSIS Node.", "A. Node."), ("FINAL DIAGNOSIS: A) Duct. GROSS TEXT - y", "A) Duct."), ("none", None)]),
    "synoptic": (H.synoptic, [("SYNOPTIC REPORT: grade 2 ", "grade 2"), ("Synoptic Report: grade 2", None)]),
    "old_synoptic": (lambda c: H.synoptic(c, "old"), [("x Synoptic Report : grade 2", "grade 2"), ("SYNOPTIC REPORT: a", None)]),
    "labelled_value": (lambda c: H.labelled_value(c, "MODALITY"), [("Modality: Ultrasound Hand DENSITY: x", "ULTRASOUND HAND"), ("modality:mr", "MR"), ("x", None)]),
    "side": (
        lambda c: H.laterality(c),
        [("US BILAT", "BILATERAL"), ("BOTH breasts", "BILATERAL"), ("US RIGHT", "RIGHT"), ("US GUIDED BX R BI", "RIGHT"), ("MR RT", "RIGHT"), ("RT US", "RIGHT"), ("LEFT", "LEFT"), ("BX L BI", "LEFT"), ("US LT", "LEFT"), ("LT US", "LEFT"), ("RIGHT and LEFT", "RIGHT"), ("US", None), (None, None)],
    ),
    "lesion_side": (H.lesion_laterality, [("R I G H T", "RIGHT"), ("left node", "LEFT"), ("left, right", "UNKNOWN"), (None, "UNKNOWN")]),
    "biopsy": (lambda c: H.biopsy_flags(c)["any"], [("core biopsy", True), ("US BX", True), ("cyst asp", True), ("SPECIMEN", True), ("US", False), (None, False)]),
    "us_biopsy": (lambda c: H.biopsy_flags(c)["us"], [("US BIOPSY", True), ("ultrasound bx", True), ("UL asp", True), ("MR BIOPSY", False), ("US", False)]),
    "guidance": (
        lambda c: H.guidance(c, F.lit(True)),
        [("BX ULTRASOUND GUIDED", "US"), ("US GUID", "US"), ("MAMMO GUIDED", "MAMMO"), ("TOMO GUIDED", "TOMO"), ("STEREOTACTIC GUIDED", "STEREOTACTIC"), ("MR US STEREO GUIDED", "STEREOTACTIC"), ("MR X GUIDED", "MR"), ("X GUIDED", "OTHER"), ("US", None)],
    ),
    "no_biopsy": (lambda c: H.guidance(c, F.lit(False)), [("X GUIDED", None), ("MR GUIDED", "MR")]),
    "addendum": (H.tail_from_first, [("a ADDENDUM b AMENDMENT c", "ADDENDUM b AMENDMENT c"), ("a amendment b ", "amendment b"), ("x Appended y", "Appended y"), ("none", None)]),
    "yes_no": (lambda c: H.yes_no_after(c, "CONCORDANCE"), [("Concordance: yes", "T"), ("CONCORDANCE : - NO", "F"), ("CONCORDANCE: not", None), ("yes", None)]),
    "isolate": (
        H.isolate_section,
        [("MAMMO: fine. ULTRASOUND: a mass", "ULTRASOUND: a mass"), ("SONO only", "SONO only"), ("mammogram only", None), ("due to mammo findings a mass", "due to mammo findings a mass"), ("correlate with mammo. a mass", "correlate with mammo. a mass"), ("a mass", "a mass")],
    ),
}


@pytest.mark.parametrize("name", TABLES)
def test_tables(spark, name):
    rule, cases = TABLES[name]
    assert list(zip([t for t, _ in cases], run(spark, rule, [t for t, _ in cases]))) == cases


KINDS = {
    "Node": ["lymph node", "lymphnode", "intramammary node", "intramammary lymph node", "axillary  node", "axillary lymph node"],
    "Lesion": [
        "mass", "lesion", "complex cyst", "complicated cyst", "bilobed cyst", "calcified cyst", "solid", "nodule", "tumor", "tumour", "cancer", "carcinoma", "malignancy", "septate", "septated", "septates", "septation", "blood flow", "bloodflow",
        "vascularity", "vascular", "shadowing", "sebaceous cyst", "adenoma", "fibroadenoma", "papilloma", "biopsy-proven", "biopsy proven", "clip", "intraductal", "less defined", "ill-defined", "ill defined", "irregular margin", "partially circumscribed",
    ],
    "Simple cyst": ["cyst", "microcysts", "cystic"],
    "Other": ["area", "nodes", "massive"],
}


def test_lesion_types(spark):
    cases = [(t.upper() if i % 2 else t, kind) for kind, texts in KINDS.items() for i, t in enumerate(texts)] + [(" ", None), (None, None)]
    assert list(zip([t for t, _ in cases], run(spark, H.first_rule_label, [t for t, _ in cases]))) == cases


def test_lettered_parts_in_sql(spark):
    from cohortloom.functions.surface import register

    register(spark)
    rows = spark.createDataFrame([(1, "A. left\nB) right\nmore"), (2, "no parts"), (3, None), (4, "C. one")], "id int, note string")
    got = {(r.id, r.letter, r.part) for r in spark.sql("SELECT id, letter, part FROM {n}, LATERAL lettered_parts(note)", n=rows).collect()}
    assert got == {(1, "A", "left"), (1, "B", "right\nmore"), (4, "C", "one")}


def test_words_that_every_match_holds():
    assert H.words_of(r"INVASIVE\s+(?:GRADE\s+\d+.*?)?DUCTAL\s+CARCINOMA") == ("INVASIVE", "DUCTAL", "CARCINOMA")
    assert H.words_of(r"\bMALIGNAN(?:T|CY)\b") == ("MALIGNAN",) and H.words_of(r"DYSTROPHIC\s+CALCIFICATIONS?") == ("DYSTROPHIC", "CALCIFICATION")
    assert H.words_of("LEFT|RIGHT") == H.words_of(r"\b(?:oval|ovoid)\b") == ()
    for p in [*H.MALIGNANT, *H.NEGATED, *H.BENIGN, *H.TYPE_BENIGN, *[p for p, _ in H.CANCER_TYPES]]:
        assert H.words_of(p), p  # a text without them is not searched at all


def test_plain_words_first_finds_what_the_search_finds(spark):
    texts = ["", "BENIGN", "MALIGNANCY", "xBENIGNx", "FREE OF\nTUMOR", "FREE  TUMOR OF", "NO RESIDUAL DCIS", "FIBROTIC", "FIBROTIC X", "IN SITU LOBULAR CARCINOMA", "LOBULAR CARCINOMA IN-SITU"]
    patterns = [*H.MALIGNANT, *H.NEGATED, *H.BENIGN]
    df = spark.createDataFrame([(x,) for x in [*texts, None]], "t string")
    assert [r.a for r in df.select(H.some_of(F.col("t"), patterns).alias("a")).collect()] == [r.a for r in df.select(H.any_of(F.col("t"), patterns).alias("a")).collect()]


def test_markup_blanks_and_ends(spark):
    raw = ["{\\rtf1\\plain\\f1\\fs20 a \t b\t\tc  d e\\tab f\\'e9g\\~h \\par\\par\\par\\par i }", " a b ", "\ta", "a \t", "\x0b a\r\n"]
    got = [r.a for r in spark.createDataFrame([(x,) for x in raw], "t string").select(H.strip_rtf(F.col("t")).alias("a")).collect()]
    assert got == ["a b c d e f gh\n\ni", "a b", "a", "a", "a"]
