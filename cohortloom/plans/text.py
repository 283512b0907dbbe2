"""Queries of text rules over reports and notes."""

from pyspark.sql import functions as F

from ..functions import text as H
from ..registry import query

BODY = "body"


def c(name="body"):
    return F.col(name)


@query(
    "H1_section",
    """SELECT report_id, 'heterogeneously dense ' || regexp_extract(body, 'dense ([FOP])', 1) AS density, regexp_extract(body, '(?s)IMPRESSION: *(.*) CONCORDANCE:', 1) AS impression FROM reports""",
)
def h1(t):
    return t.reports.select("report_id", H.section(c(), "DENSITY:").alias("density"), H.impression(c()).alias("impression"))


@query("H2_findings", "SELECT report_id, regexp_extract(body, 'FINDINGS: - (.*) IMPRESSION', 1) AS findings FROM reports")
def h2(t):
    return t.reports.select("report_id", H.findings(F.when(F.col("report_id") % 2 == 0, "none"), c()).alias("findings"))


@query(
    "H3_final_diagnosis",
    """SELECT note_id, note_part, note_lab, CASE WHEN k = 2 THEN 'A. ' ELSE '' END || regexp_extract(note, '(?s)DIAGNOSIS: (.*) CLINICAL:', 1) AS diagnosis FROM notes""",
)
def h3(t):
    return t.notes.select("note_id", "note_part", "note_lab", H.final_diagnosis(c("note")).alias("diagnosis"))


@query("H4_synoptic", "SELECT note_id, note_part, note_lab, CASE WHEN note_lab % 3 = 0 THEN note END AS synoptic FROM notes")
def h4(t):
    text = F.when(F.col("note_lab") % 3 == 0, F.concat(F.lit("x SYNOPTIC REPORT:  "), c("note"))).otherwise(c("note"))
    return t.notes.select("note_id", "note_part", "note_lab", H.synoptic(text).alias("synoptic"))


@query(
    "H5_rtf_final",
    """SELECT note_id, note_part, note_lab, CASE WHEN note_lab % 2 = 0 THEN 'A. Breast, left:' || chr(10) || repeat('malignant cells ', 20) || CAST(note_id AS STRING) END AS final FROM notes""",
)
def h5(t):
    head = r"{\rtf1\ansi {\fonttbl x}\plain\f1\fs20 "
    final = F.concat(F.lit(head + r"A. Breast, left:\par "), F.repeat(F.lit(r"malignant \b cells "), 20), F.col("note_id").cast("string"), F.lit("}"))
    note = F.concat(F.lit(head + r"Received fresh in two parts}"), F.when(F.col("note_lab") % 2 == 0, final).otherwise(F.lit(head + "Source: x}")))
    return t.notes.select("note_id", "note_part", "note_lab", H.rtf_final(note).alias("final"))


@query("H6_labelled_value", "SELECT report_id, 'ULTRASOUND HAND' AS modality FROM reports")
def h6(t):
    return t.reports.select("report_id", H.labelled_value(c(), "MODALITY").alias("modality"))


@query(
    "H7_ordinal_score",
    """SELECT report_id, CASE s WHEN 0 THEN '4A' WHEN 1 THEN '2' WHEN 2 THEN '5' WHEN 3 THEN '3' END AS score, CASE WHEN s < 4 THEN '- probably benign' END AS description FROM reports""",
)
def h7(t):
    return t.reports.select("report_id", H.ordinal_score(c()).alias("x")).select("report_id", "x.score", "x.description")


@query("H8_laterality", "SELECT report_id, CASE d WHEN 0 THEN 'LEFT' WHEN 1 THEN 'BILATERAL' ELSE 'RIGHT' END AS side FROM reports")
def h8(t):
    return t.reports.select("report_id", H.laterality(c("description"), c(), c()).alias("side"))


@query("H8_lesion_laterality", "SELECT note_id, note_part, note_lab, CASE WHEN note_lab % 2 = 0 AND k IN (0, 2) THEN 'UNKNOWN' WHEN note_lab % 2 = 0 OR k IN (1, 3) THEN 'RIGHT' WHEN k IN (0, 2) THEN 'LEFT' ELSE 'UNKNOWN' END AS side FROM notes")
def h8b(t):
    return t.notes.select("note_id", "note_part", "note_lab", H.lesion_laterality(c("note")).alias("side"))


@query("H9_biopsy_flags", 'SELECT report_id, d = 2 AS "any", d = 2 AS us FROM reports')
def h9(t):
    return t.reports.select("report_id", H.biopsy_flags(c("description"), F.lit(None).cast("string")).alias("x")).select("report_id", "x.any", "x.us")


@query("H10_guidance", "SELECT report_id, CASE WHEN d = 2 THEN 'US' END AS guidance FROM reports")
def h10(t):
    return t.reports.select("report_id", H.guidance(c("description"), F.lit(True)).alias("guidance"))


@query("H11_tail_from_first", "SELECT report_id, CASE WHEN report_id % 3 = 0 THEN 'Addendum on 01/02/2003 at 10:11:12 for Dr. Smith' END AS addendum FROM reports")
def h11(t):
    return t.reports.select("report_id", H.tail_from_first(c()).alias("addendum"))


@query("H12_yes_no_after", "SELECT report_id, CASE WHEN report_id % 7 = 0 THEN 'F' ELSE 'T' END AS concordance FROM reports")
def h12(t):
    return t.reports.select("report_id", H.yes_no_after(c(), "CONCORDANCE").alias("concordance"))


@query(
    "H13_split_lettered_parts",
    """WITH n AS (SELECT *, CASE WHEN k = 2 THEN 'A. ' ELSE '' END || regexp_extract(note, '(?s)DIAGNOSIS: (.*) CLINICAL:', 1) AS dx FROM notes)
SELECT note_id, note_part, note_lab, upper(replace(string_split(dx, chr(10))[1], 'A) ', 'A. ')) AS part FROM n
UNION ALL SELECT note_id, note_part, note_lab, 'B. RIGHT BREAST, BENIGN.' FROM n WHERE note_lab % 2 = 0""",
)
def h13(t):
    rows = t.notes.withColumn("dx", H.final_diagnosis(c("note")))
    return H.split_lettered_parts(rows, "dx").select("note_id", "note_part", "note_lab", "part")


@query("H14_path_category", "SELECT note_id, note_part, note_lab, CASE WHEN k = 0 THEN 'MALIGNANT' WHEN note_lab % 2 = 0 OR k IN (1, 2, 3, 4) THEN 'BENIGN' ELSE 'UNKNOWN' END AS category FROM notes")
def h14(t):
    return t.notes.select("note_id", "note_part", "note_lab", H.path_category(c("note")).alias("category"))


@query(
    "H15_first_unnegated",
    """SELECT note_id, note_part, note_lab, CASE k WHEN 0 THEN 'INVASIVE DUCTAL CARCINOMA' WHEN 1 THEN 'BENIGN' WHEN 2 THEN 'BENIGN' WHEN 3 THEN 'LOBULAR CARCINOMA IN SITU' WHEN 4 THEN 'BENIGN'
  ELSE CASE WHEN note_lab % 2 = 0 THEN 'BENIGN' ELSE 'UNKNOWN' END END AS cancer_type FROM notes""",
)
def h15(t):
    return t.notes.select("note_id", "note_part", "note_lab", H.first_unnegated(c("note")).alias("cancer_type"))


@query(
    "H16_lexicon_features",
    """SELECT report_id, CASE f WHEN 0 THEN 'circumscribed' WHEN 2 THEN 'spiculated' WHEN 3 THEN 'indistinct' END AS margin, CASE f WHEN 0 THEN 'oval' WHEN 2 THEN 'irregular' WHEN 3 THEN 'round' END AS shape,
  CASE f WHEN 0 THEN 'hypoechoic' WHEN 3 THEN 'heterogeneous' END AS echo, CASE f WHEN 0 THEN 'enhancement' END AS posterior, CASE f WHEN 5 THEN 'echogenic halo' END AS boundary FROM reports""",
)
def h16(t):
    return t.reports.select("report_id", H.lexicon_features(H.findings(c())).alias("x")).select("report_id", "x.margin", "x.shape", "x.echo", "x.posterior", "x.boundary")


@query(
    "H16_lexicon_decisions",
    """SELECT report_id, feature, value, negated, CAST(strpos(CASE f WHEN 0 THEN 'oval circumscribed hypoechoic mass with posterior enhancement.' WHEN 1 THEN 'no spiculated mass.'
    WHEN 2 THEN 'no oval area but irregular spiculated mass.' WHEN 3 THEN 'anechoic and hypoechoic round areas, circumscribed and indistinct.' WHEN 4 THEN 'complex cyst is no longer seen.'
    ELSE 'lymph node with echogenic halo.' END, value) AS INT) - 1 AS begins, begins + CAST(length(value) AS INT) AS ends
  FROM reports JOIN (VALUES (0, 'margin', 'circumscribed', false), (0, 'shape', 'oval', false), (0, 'echo', 'hypoechoic', false), (0, 'posterior', 'enhancement', false),
  (1, 'margin', 'spiculated', true), (2, 'shape', 'oval', true), (2, 'shape', 'irregular', false), (2, 'margin', 'spiculated', false), (3, 'echo', 'anechoic', false), (3, 'echo', 'hypoechoic', false), (3, 'shape', 'round', false),
  (3, 'margin', 'circumscribed', false), (3, 'margin', 'indistinct', false), (4, 'echo', 'complex', true), (5, 'boundary', 'echogenic halo', false)) v(k, feature, value, negated) ON f = k""",
)
def h16b(t):
    return t.reports.select("report_id", F.inline(H.lexicon_decisions(H.findings(c()))))


@query("H17_isolate_section", "SELECT report_id, CASE d WHEN 0 THEN 'US BREAST LEFT LIMITED' WHEN 2 THEN 'US GUIDED BX R BI' WHEN 3 THEN 'MR BREAST RT W CONTRAST' END AS section FROM reports")
def h17(t):
    return t.reports.select("report_id", H.isolate_section(c("description")).alias("section"))


@query("H18_scrub_text", "SELECT report_id, CASE WHEN report_id % 3 = 0 THEN 'Addendum on [DATE REMOVED] at [TIME REMOVED] for [NAME REMOVED]' END AS scrubbed FROM reports")
def h18(t):
    return t.reports.select("report_id", H.scrub_text(H.tail_from_first(c())).alias("scrubbed"))


@query(
    "H19_caption_attributes",
    """SELECT image_name, CASE WHEN area = 'AXILLA' THEN 'axilla' WHEN area = 'BREAST' THEN 'breast' ELSE 'unknown' END AS area, CASE laterality WHEN 'LEFT' THEN 'left' WHEN 'RIGHT' THEN 'right' ELSE 'unknown' END AS laterality,
  CASE region_count WHEN 1 THEN 'radial' ELSE 'unknown' END AS orientation, CAST(has_calipers + 1 AS STRING) || ':30' AS clock_pos, CAST(CASE WHEN crop_w / 20 <= 25 THEN crop_w / 20 END AS INT) AS nipple_dist FROM images""",
)
def h19(t):
    side = F.when(F.col("laterality") == "LEFT", " LT, ").when(F.col("laterality") == "RIGHT", " RT, ").otherwise(" ")
    text = F.concat(F.coalesce("area", F.lit("x")), side, F.when(F.col("region_count") == 1, "radial ").otherwise(""), F.col("has_calipers") + 1, F.lit(" : 30 "), (F.col("crop_w") / 20).cast("int"), F.lit(" cm"))
    x = t.images.select("image_name", H.caption_attributes(F.lower(text)).alias("x"))
    return x.select("image_name", *[f"x.{n}" for n in ("area", "laterality", "orientation", "clock_pos", "nipple_dist")])


@query("H20_first_rule_label", "SELECT report_id, CASE f WHEN 3 THEN 'Other' WHEN 5 THEN 'Node' ELSE 'Lesion' END AS kind FROM reports")
def h20(t):
    return t.reports.select("report_id", H.first_rule_label(H.findings(c())).alias("kind"))


@query(
    "H21_to_cm_and_clock",
    "SELECT image_name, CASE WHEN ord % 2 = 0 THEN size_cm ELSE size_cm / 10 END AS cm, CAST(clock AS INT) AS hour, CASE WHEN ord % 2 = 0 THEN clock + 0.5 ELSE CAST(clock AS DOUBLE) END AS decimal_hour FROM lesions",
)
def h21(t):
    text = F.concat(F.col("size_cm").cast("string"), F.when(F.col("ord") % 2 == 0, " CM").otherwise("mm x"))
    clock = F.concat(F.col("clock").cast("string"), F.when(F.col("ord") % 2 == 0, ":30").otherwise(" o'clock"))
    return t.lesions.select("image_name", H.to_cm(text).alias("cm"), H.clock_hour(clock).alias("hour"), H.clock_decimal(clock).alias("decimal_hour"))


@query("H22_dicom_time", "SELECT event_id, strftime(ts, '%H:%M:%S') || '.5' || '00' AS t FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, strftime(ts, '%H:%M:%S') FROM events WHERE event_id % 2 = 1")
def h22(t):
    stamp = F.date_format("ts", "HHmmss")
    return t.events.select("event_id", H.dicom_time(F.lit("12:3"), F.when(F.col("event_id") % 2 == 0, F.concat(stamp, F.lit(".5"))), stamp).alias("t"))


@query(
    "H23_parse_reply",
    "SELECT image_name, CASE WHEN ord % 3 = 0 THEN '' ELSE '[' || CAST(ord AS STRING) || ':00, 5 cm, 2 mm, cyst], [12:00, 1 cm, 3 mm, mass]' END AS label, CASE WHEN ord % 3 = 0 THEN 0 ELSE 2 END AS n, CASE WHEN ord % 3 = 0 THEN 'unreadable' END AS error FROM lesions",
)
def h23(t):
    one = F.concat(F.lit('[{"direction": "'), F.col("ord"), F.lit(':00", "distance": "5 cm", "size": "2 mm", "type": "cyst"}, {"direction": "12:00", "distance": "1 cm", "size": "3 mm", "type": "mass"}]'))
    reply = F.when(F.col("ord") % 3 == 0, "sorry").when(F.col("ord") % 3 == 1, F.concat(F.lit("```json\n"), one, F.lit("\n```"))).otherwise(one)
    return t.lesions.select("image_name", H.parse_reply(reply).alias("x")).select("image_name", "x.label", "x.n", "x.error")


@query("H24_path_part", "SELECT page_id, string_split(url, '/')[-1] AS last, regexp_replace(string_split(url, '/')[-1], '\\.[^.]*$', '') AS stem, string_split(url, '/')[3] AS host FROM pages")
def h24(t):
    return t.pages.select("page_id", H.path_part(c("url"), -1).alias("last"), H.stem(c("url")).alias("stem"), H.path_part(c("url"), 3).alias("host"))


@query("H25_map_codes", "SELECT report_id, CASE d WHEN 1 THEN 'x-ray' WHEN 3 THEN 'magnetic' ELSE 'sound' END AS code FROM reports")
def h25(t):
    return t.reports.select("report_id", H.map_codes(c("description"), {"mammo": "x-ray", "us ": "sound", "mr ": "magnetic"}).alias("code"))


@query(
    "H26_side_match",
    """SELECT image_name, CASE WHEN l IS NULL AND e IS NULL THEN 'UNKNOWN_BOTH' WHEN l IS NULL THEN 'UNKNOWN_PATH' WHEN e = 'BILATERAL' THEN 'BILATERAL_US' WHEN e = l THEN 'EXACT' WHEN e IS NULL THEN 'UNKNOWN_US' ELSE 'MISMATCH' END AS match
FROM (SELECT i.image_name, i.laterality AS l, x.study_laterality AS e FROM images i LEFT JOIN exams x ON i.accession_number = x.accession_number)""",
)
def h26(t):
    rows = t.images.join(t.exams, "accession_number", "left")
    return rows.select("image_name", H.side_match(F.when(F.col("study_laterality") == "BILATERAL", "both").otherwise(F.lower("study_laterality")), F.substring("laterality", 1, 1)).alias("match"))


@query("H27_strip_evidence_rank", "SELECT path_accession, path_interpretation AS label FROM path")
def h27(t):
    return t.path.select("path_accession", H.strip_evidence_rank(F.concat("path_interpretation", F.col("path_accession") % 5)).alias("label"))
