"""Queries of composed cohort jobs."""

from pyspark.sql import functions as F

from ..operators import claims as Q
from ..operators import timeline as W
from ..operators.lineage import new_path
from ..registry import query
from ..sources.spec import ExportSpec
from . import cohort as C
from .joins import MATCH
from .predicates import RULE_SQL, image_rules


def exam_rows(t):
    return t.exams.select("patient_id", "accession_number", "exam_ts", "study_laterality", "bi_rads", "is_biopsy", "modality")


def path_rows(t):
    return t.path.groupBy("path_accession").agg(*[F.min(c).alias(c) for c in ("patient_id", "path_ts", "path_laterality", "path_interpretation")]).withColumnRenamed("path_accession", "path_id")


def raw_reports(t):
    modality = F.when(F.col("d").isin(0, 2), "US").when(F.col("d") == 1, "MG").otherwise("MR")
    return t.reports.select("patient_id", F.col("report_id").alias("accession_number"), "exam_ts", modality.alias("modality"), "description", F.col("body").alias("report"), F.lit(None).cast("string").alias("narrative"))


@query(
    "C1_clean_exams",
    """WITH u AS (SELECT *, bool_or(d IN (0, 2)) OVER (PARTITION BY patient_id) AS us FROM reports)
SELECT report_id AS accession_number, CASE s WHEN 0 THEN '4A' WHEN 1 THEN '2' WHEN 2 THEN '5' WHEN 3 THEN '3' END AS bi_rads, CASE d WHEN 0 THEN 'LEFT' WHEN 1 THEN 'BILATERAL' ELSE 'RIGHT' END AS study_laterality,
  CASE WHEN d = 2 THEN 'T' ELSE 'F' END AS is_biopsy, CASE WHEN report_id % 7 = 0 THEN 'F' ELSE 'T' END AS concordance FROM u WHERE us""",
)
def c1(t):
    return C.clean_exams(raw_reports(t)).select("accession_number", "bi_rads", "study_laterality", "is_biopsy", "concordance")


@query("C1_clean_exams_windows")
def c1b(t):
    return C.clean_exams(raw_reports(t)).select("accession_number", "worst_rank", "worst_source", "days_to_biopsy", "guidance", "prior_left", "prior_right", "features")


@query(
    "C2_clean_pathology",
    """WITH n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY note_id ORDER BY note_part, note_lab) AS r FROM notes) WHERE r = 1)
SELECT note_id, 1 AS part, CASE WHEN k = 0 THEN 'MALIGNANT' WHEN k = 5 THEN 'UNKNOWN' ELSE 'BENIGN' END AS path_interpretation FROM n UNION ALL SELECT note_id, 2, 'BENIGN' FROM n WHERE note_lab % 2 = 0""",
)
def c2(t):
    rows = C.clean_pathology(t.notes, "note_id", ["note_part", "note_lab"])
    return rows.select("note_id", F.when(F.col("lesion_diag").startswith("B."), 2).otherwise(1).alias("part"), "path_interpretation")


@query(
    "C3_link_timeline",
    """WITH p AS (SELECT path_accession AS id, min(patient_id) AS patient_id, min(path_ts) AS ts, min(path_laterality) AS side FROM path GROUP BY 1),
o AS (SELECT *, id % 7 = 0 AS own, CASE WHEN id % 3 = 0 THEN 'S' || id END AS syn FROM p),
f AS (SELECT o.id, max(struct_pack(t := x.exam_ts, i := x.accession_number)).i AS acc FROM o JOIN exams b ON b.patient_id = o.patient_id AND b.is_biopsy = 'T' AND date_diff('day', b.exam_ts, o.ts) BETWEEN -1 AND 180
  JOIN exams x ON x.patient_id = o.patient_id AND x.exam_ts < b.exam_ts AND x.study_laterality IN ('BILATERAL', o.side) WHERE NOT own AND o.id % 5 > 0 GROUP BY o.id),
r AS (SELECT -o.id AS row_id, CASE WHEN own THEN o.id ELSE f.acc END AS acc, o.ts, syn FROM o LEFT JOIN f ON o.id = f.id UNION ALL SELECT accession_number, accession_number, exam_ts, NULL FROM exams),
l AS (SELECT acc, first(syn ORDER BY ts, -row_id) AS lent FROM r WHERE syn IS NOT NULL AND acc IS NOT NULL GROUP BY acc)
SELECT row_id, r.acc AS accession_number, coalesce(syn, lent) AS synoptic FROM r LEFT JOIN l ON r.acc = l.acc""",
)
def c3(t):
    own = F.when(F.col("path_id") % 7 == 0, F.col("path_id")).alias("accession_number")
    path = path_rows(t).select("*", own, F.when(F.col("path_id") % 5 > 0, "text").alias("lesion_diag"), F.when(F.col("path_id") % 3 == 0, F.concat(F.lit("S"), "path_id")).alias("synoptic"))
    return C.link_timeline(exam_rows(t), path).select(F.when(F.col("kind") == "exam", F.col("accession_number")).otherwise(-F.col("path_id")).alias("row_id"), "accession_number", "synoptic")


def diagnosed(t):
    exams = exam_rows(t).selectExpr(
        "patient_id", "accession_number AS row_id", "exam_ts AS ts", "'exam' AS kind", "CAST(year(exam_ts) AS STRING) AS encounter_id", "study_laterality", "CAST(NULL AS STRING) AS path_laterality", "bi_rads", "is_biopsy",
        "CAST(NULL AS STRING) AS path_interpretation", "CASE WHEN accession_number % 13 = 0 THEN 'F' END AS concordance", "CASE WHEN accession_number % 17 = 0 THEN 'Malignant' WHEN accession_number % 19 = 0 THEN 'Benign' END AS a1_category",
        "CASE WHEN accession_number % 34 = 0 THEN 'benign finding' ELSE ' ' END AS a2_category",
    )
    path = path_rows(t).selectExpr(
        "patient_id", "-path_id AS row_id", "path_ts AS ts", "'path' AS kind", "CASE WHEN path_id % 3 = 0 THEN CAST(year(path_ts) AS STRING) END AS encounter_id", "CAST(NULL AS STRING) AS study_laterality",
        "CASE WHEN path_id % 5 > 0 THEN path_laterality END AS path_laterality", "CAST(NULL AS STRING) AS bi_rads", "CAST(NULL AS STRING) AS is_biopsy", "path_interpretation", "CAST(NULL AS STRING) AS concordance",
        "CAST(NULL AS STRING) AS a1_category", "CAST(NULL AS STRING) AS a2_category",
    )
    return C.diagnose(exams.unionByName(path))


def _diagnose_sql(overrides: bool = False) -> str:
    """The rules once more, side by side, as SQL windows; or what the addendum rule changed: row_id, side, prior, diagnosis."""
    later = "OVER (PARTITION BY patient_id ORDER BY us RANGE BETWEEN 1 FOLLOWING AND {} FOLLOWING)"
    day = 86_400_000_000
    w = {n: later.format(n * day) for n in (240, 450, 730, 1095)}
    some = lambda cond, over: f"coalesce(bool_or(coalesce({cond}, false)) {over}, false)"
    enc = "OVER (PARTITION BY patient_id, enc)"
    marks, sides = [], ("LEFT", "RIGHT")
    for v, k in (("MALIGNANT", "m"), ("BENIGN", "b")):
        marks.append(some(f"pi = '{v}' AND (pl IS NULL OR pl NOT IN ('LEFT', 'RIGHT'))", enc) + f" AS e{k}_x")
        for s in sides:
            marks += [some(f"pi = '{v}' AND pl = '{s}'", enc) + f" AS e{k}_{s}", some(f"pi = '{v}' AND pl = '{s}'", w[240]) + f" AS n{k}_{s}"]
    marks += [some(f"pi = 'MALIGNANT' AND pl = '{s}'", "OVER (PARTITION BY patient_id)") + f" AS ever_{s}" for s in sides]
    marks += [
        some("bx = 'T'", f"OVER (PARTITION BY patient_id ORDER BY us RANGE BETWEEN {30 * day} PRECEDING AND {120 * day} FOLLOWING)") + " AS near",
        some("bx = 'T'", w[240]) + " AS next_bx",
        some("pi = 'MALIGNANT'", w[450]) + " AS m450",
        some("ex AND b IS NOT NULL AND b NOT IN ('1', '2')", w[730]) + " AS n730",
        some("ex AND coalesce(b NOT IN ('1', '2'), true)", w[1095]) + " AS n12",
        some("ex AND coalesce(b NOT IN ('1', '2', '3'), true)", w[1095]) + " AS n123",
        f"coalesce(max(us) {w[1095]} - us >= {730 * day}, false) AS far",
        f"coalesce(max(us) OVER (PARTITION BY patient_id ORDER BY us RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - us >= {180 * day}, false) AS followed",
    ]
    steps = {}
    for s in sides:
        here, calm = f"ex AND sl IN ('{s}', 'BILATERAL')", "followed AND NOT near AND NOT m450"
        steps[s] = [
            (f"{here} AND enc IS NOT NULL AND coalesce(cc <> 'F', true) AND (em_{s} OR (sl = '{s}' AND em_x))", "MALIGNANT0", "encounter linked path"),
            (f"{here} AND enc IS NOT NULL AND coalesce(cc <> 'F', true) AND (eb_{s} OR (sl = '{s}' AND eb_x))", "BENIGN0", "encounter linked path"),
            (f"{here} AND b IN ('1', '2') AND {calm} AND NOT n730", "BENIGN1", "assumed benign"),
            (f"{here} AND b = '3' AND {calm} AND (NOT n12 OR (NOT n123 AND far))", "BENIGN3", "assumed benign - birads 3"),
        ]
    case = lambda rules, k: "CASE " + " ".join(f"WHEN {r[0]} THEN '{r[k]}'" for r in rules) + " END"
    first = ", ".join(f"{case(steps[s], 1)} AS d_{s}, {case(steps[s], 2)} AS e_{s}" for s in sides)
    six = lambda s: f"d_{s} IS NULL AND ex AND sl IN ('{s}', 'BILATERAL') AND b = '6' AND ever_{s} AND (sl = 'BILATERAL' OR (d_LEFT IS NULL AND d_RIGHT IS NULL))"
    second = ", ".join(f"CASE WHEN {six(s)} THEN 'MALIGNANT1' ELSE d_{s} END AS f_{s}, CASE WHEN {six(s)} THEN 'birads 6 with malignancy' ELSE e_{s} END AS g_{s}" for s in sides)
    out, changes = [], []
    for s in sides:
        follow = f"""CASE WHEN ex AND sl IN ('{s}', 'BILATERAL') AND f_LEFT IS NULL AND f_RIGHT IS NULL THEN CASE WHEN nm_{s} AND next_bx AND b IN ('4', '4A', '4B', '4C', '5', '6') THEN 'MALIGNANT2'
          WHEN nb_{s} AND NOT nm_{s} AND b IN ('1', '2', '3', '4', '4A', '4B') THEN 'BENIGN2' END END"""
        over = f"CASE WHEN ex AND sl IN ('{s}', 'BILATERAL') AND cat IS NOT NULL THEN CASE WHEN lower(cat) LIKE '%malignant%' OR lower(cat) LIKE '%invasive%' THEN 'MALIGNANT4' ELSE 'BENIGN4' END END"
        name = s.lower()
        changes.append(f"SELECT row_id, '{name}' AS side, coalesce(f_{s}, {follow}) AS prior, {over} AS diagnosis FROM s2 WHERE {over} IS NOT NULL")
        out.append(f"coalesce({over}, f_{s}, {follow}) AS {name}_diagnosis")
        out.append(f"CASE WHEN {over} IS NOT NULL THEN CASE WHEN trim(a2) <> '' THEN 'addendum A2' ELSE 'addendum A1' END WHEN f_{s} IS NOT NULL THEN g_{s} WHEN {follow} = 'MALIGNANT2' THEN 'malignant pathology' WHEN {follow} IS NOT NULL THEN 'benign pathology' END AS {name}_diagnosis_source")
    last = " UNION ALL ".join(changes) if overrides else f"SELECT row_id, {', '.join(out)} FROM s2 WHERE ex"
    return f"""WITH p AS (SELECT path_accession AS path_id, min(patient_id) AS patient_id, min(path_ts) AS path_ts, min(path_laterality) AS side, min(path_interpretation) AS pi FROM path GROUP BY path_accession),
t AS (SELECT patient_id, accession_number AS row_id, epoch_us(exam_ts) AS us, true AS ex, CAST(year(exam_ts) AS STRING) AS enc, study_laterality AS sl, CAST(NULL AS STRING) AS pl, bi_rads AS b, is_biopsy AS bx, CAST(NULL AS STRING) AS pi,
  CASE WHEN accession_number % 13 = 0 THEN 'F' END AS cc, CASE WHEN accession_number % 17 = 0 THEN 'Malignant' WHEN accession_number % 19 = 0 THEN 'Benign' END AS a1, CASE WHEN accession_number % 34 = 0 THEN 'benign finding' ELSE ' ' END AS a2 FROM exams
UNION ALL SELECT patient_id, -path_id, epoch_us(path_ts), false, CASE WHEN path_id % 3 = 0 THEN CAST(year(path_ts) AS STRING) END, NULL, CASE WHEN path_id % 5 > 0 THEN side END, NULL, NULL, pi, NULL, NULL, NULL FROM p),
m AS (SELECT *, coalesce(nullif(trim(a2), ''), nullif(trim(a1), '')) AS cat, {', '.join(marks)} FROM t),
s1 AS (SELECT *, {first} FROM m), s2 AS (SELECT *, {second} FROM s1), last AS ({last})
SELECT * FROM last"""


@query("C4_diagnose", _diagnose_sql())
def c4(t):
    return diagnosed(t).where("kind = 'exam'").select("row_id", "left_diagnosis", "left_diagnosis_source", "right_diagnosis", "right_diagnosis_source")


OVERRIDES = _diagnose_sql(True).removesuffix("SELECT * FROM last")


@query(
    "C5_override_audit",
    OVERRIDES + "SELECT side, CASE WHEN prior IS NULL THEN 'filled_empty' WHEN substr(prior, 1, 3) = substr(diagnosis, 1, 3) THEN 'equivalent' ELSE 'disagreement' END AS change, count(*) AS n FROM last GROUP BY 1, 2",
)
def c5(t):
    return C.override_audit(diagnosed(t))


@query("C5_override_disagreements", OVERRIDES + "SELECT row_id, side, prior, diagnosis FROM last WHERE substr(prior, 1, 3) <> substr(diagnosis, 1, 3)")
def c5b(t):
    return C.override_disagreements(diagnosed(t)).select("row_id", "side", "prior", "diagnosis")


@query("C6_final_dataset")
def c6(t):
    rows = C.final_dataset(exam_rows(t), path_rows(t))
    return rows.select("accession_number", "patient_id", "modality", "left_diagnosis", "right_diagnosis", "prior_positive")


@query("C6_final_tables")
def c6b(t):
    """Study ids from endpoints and the cancer types of the lesions of accessions that stay."""
    endpoint = F.when(F.col("accession_number") % 9 > 0, F.concat(F.lit("https://archive/studies/"), "accession_number"))
    words = F.when(F.col("path_id") % 3 == 0, "A. invasive ductal carcinoma").when(F.col("path_id") % 3 == 1, "A. no evidence of carcinoma")
    found = C.final_tables(exam_rows(t).withColumn("endpoint", endpoint), path_rows(t).withColumn("lesion_diag", words))
    exams = found["exams"].select("accession_number", F.lit("exam").alias("kind"), "endpoint", "study_id", F.lit(None).cast("string").alias("cancer_type"))
    return exams.unionByName(found["lesions"].select("accession_number", F.lit("lesion").alias("kind"), F.lit(None).cast("string").alias("endpoint"), F.lit(None).cast("string").alias("study_id"), "cancer_type"))


@query(
    "C7_pseudonymise",
    """SELECT id, shape, 1 AS pseudonyms, 1 AS ids, n, CAST(date_trunc('month', first) AS DATE) AS month FROM (
  SELECT CASE patient_id % 3 WHEN 0 THEN 'P-' ELSE '' END || CAST(patient_id AS STRING) || CASE patient_id % 4 WHEN 0 THEN 'B' ELSE '' END AS id, count(*) AS n, min(exam_ts) AS first FROM exams GROUP BY 1),
  LATERAL (SELECT regexp_replace(id, '[0-9]', '0', 'g') AS shape)""",
)
def c7(t):
    p = F.col("patient_id")
    old = F.concat(F.when(p % 3 == 0, "P-").otherwise(""), p.cast("string"), F.when(p % 4 == 0, "B").otherwise(""))
    exams = t.exams.withColumns({"patient_id": old, "old": old})
    first = C.pseudonym_table(exams.where("modality = 'US'"), "patient_id", "key")
    table = C.pseudonym_table(exams, "patient_id", "key", first)
    out = C.pseudonymise(exams, table, ["patient_id"], ["exam_ts"], ["bi_rads"], ["description"])
    # each id has one pseudonym of its own shape, which is nobody else's
    owners = out.groupBy("patient_id").agg(F.count_distinct("old").cast("int").alias("ids"))
    per = out.join(owners, "patient_id").groupBy(F.col("old").alias("id"))
    shape = F.regexp_replace(F.min("patient_id"), "[0-9]", "0").alias("shape")
    return per.agg(shape, F.count_distinct("patient_id").cast("int").alias("pseudonyms"), F.max("ids").alias("ids"), F.count("*").alias("n"), F.min("exam_ts").cast("date").alias("month"))


LOADED = "SELECT accession_number FROM exams WHERE modality = 'MG'"


@query("C8_load_studies", f"SELECT accession_number FROM exams WHERE accession_number IN (SELECT accession_number FROM images) AND accession_number NOT IN ({LOADED})")
def c8(t):
    return C.load_entities(t.exams, t.images, t.exams.where("modality = 'MG'"))[0].select("accession_number")


@query("C8_load_images", f"SELECT image_name FROM images WHERE accession_number IN (SELECT accession_number FROM exams WHERE accession_number IN (SELECT accession_number FROM images)) OR accession_number IN ({LOADED})")
def c8b(t):
    return C.load_entities(t.exams, t.images, t.exams.where("modality = 'MG'"))[1].select("image_name")


def videos(t):
    """Images of two regions count as videos of so many frames."""
    return t.images.where("region_count = 2").select(F.col("image_name").alias("video_name"), "accession_number", "laterality", (F.col("crop_w") / 20).cast("int").alias("saved_frames"))


VIDEOS = "SELECT image_name AS video_name, accession_number, laterality, CAST(crop_w / 20 AS INT) AS saved_frames FROM images WHERE region_count = 2"


def _load(t):
    says = F.when(F.col("bi_rads").isin("4A", "4B", "4C", "5", "6"), "MALIGNANT2").when(F.col("bi_rads").isin("1", "2"), "BENIGN1")
    studies = t.exams.select("patient_id", "accession_number", "study_laterality", says.alias("left_diagnosis"), F.lit(None).cast("string").alias("right_diagnosis"))
    images = t.images.join(t.exams.select("accession_number", "patient_id"), "accession_number").select("patient_id", "accession_number", "image_name", "laterality")
    return C.load_job(studies, images, t.exams.where("modality = 'MG'"), videos(t).join(t.exams.select("accession_number", "patient_id"), "accession_number"))


SEEN = "SELECT e.patient_id, i.* FROM images i JOIN exams e ON i.accession_number = e.accession_number"


@query(
    "C8_load_flags",
    f"""SELECT accession_number, coalesce(bi_rads IN ('4A', '4B', '4C', '5', '6'), false) AS has_malignant, coalesce(bi_rads IN ('1', '2'), false) AS has_benign FROM exams WHERE patient_id IN (SELECT patient_id FROM ({SEEN}))""",
)
def c8c(t):
    return _load(t)[0].select("accession_number", "has_malignant", "has_benign")


@query(
    "C8_load_new_images",
    f"""SELECT image_name, coalesce(s.laterality, e.study_laterality) AS laterality FROM ({SEEN}) s JOIN exams e ON s.accession_number = e.accession_number WHERE s.patient_id NOT IN (SELECT patient_id FROM exams WHERE modality = 'MG')""",
)
def c8d(t):
    return _load(t)[1].select("image_name", "laterality")


@query(
    "C8_load_new_videos",
    f"""SELECT video_name, coalesce(v.laterality, e.study_laterality) AS laterality, saved_frames FROM ({VIDEOS}) v JOIN exams e ON v.accession_number = e.accession_number WHERE e.patient_id NOT IN (SELECT patient_id FROM exams WHERE modality = 'MG')""",
)
def c8e(t):
    return _load(t)[2].select("video_name", "laterality", "saved_frames")


@query(
    "C9_select_new_files",
    """SELECT image_name AS hash FROM images i JOIN exams e ON i.accession_number = e.accession_number WHERE e.modality = 'US' AND i.has_calipers = 0""",
)
def c9(t):
    named = t.images.join(t.exams.select("accession_number", "patient_id"), "accession_number")
    path = lambda root: F.concat(F.lit(root), "patient_id", F.lit("_"), "accession_number", F.lit("/"), "image_name", F.lit(".dcm"))
    files = named.select(path("/b/").alias("path"), F.col("image_name").alias("hash")).union(named.select(path("/a/"), "image_name"))
    cohort = t.exams.where("modality = 'US'").select(F.col("patient_id").cast("string").alias("patient_id"), F.col("accession_number").cast("string").alias("accession_number"))
    files = W.dealt_by(files, "hash", rows=2 * t.lineitem.count())  # an image is a row of lineitem
    return C.select_new_files(files, cohort, t.images.where("has_calipers = 1").select(F.col("image_name").alias("hash"))).select("hash")


@query("C10_image_attributes", """SELECT i.image_name, CASE WHEN study_laterality IN ('LEFT', 'RIGHT') THEN lower(study_laterality) WHEN region_count = 1 THEN 'left' ELSE 'right' END AS laterality, CASE WHEN has_calipers = 1 THEN 'axilla' ELSE 'breast' END AS area,
  CAST(crop_w // 20 % 12 + 1 AS STRING) || ':30' AS clock_pos, CASE WHEN i.accession_number % 30 BETWEEN 1 AND 25 THEN CAST(i.accession_number % 30 AS INT) END AS nipple_dist FROM images i JOIN exams e ON i.accession_number = e.accession_number""")
def c10(t):
    side = F.when(F.col("region_count") == 1, "LT ").otherwise("RT ")
    place = F.when(F.col("has_calipers") == 1, "AX ").otherwise("BREAST ")
    clock = ((F.col("crop_w") / 20).cast("long") % 12 + 1).cast("string")
    caption = F.concat(side, place, clock, F.lit(":30 "), (F.col("accession_number") % 30).cast("string"), F.lit(" CM"))
    return C.image_attributes(t.images.select("image_name", "accession_number", caption.alias("caption")), "caption", t.exams).select("image_name", "laterality", "area", "clock_pos", "nipple_dist")


@query(
    "C11_image_quality_filters",
    """SELECT image_name, CASE WHEN darkness > 75 THEN 'dark' WHEN area = 'AXILLA' THEN 'other_area' WHEN laterality IS NULL THEN 'unknown_side' WHEN region_count > 1 THEN 'many_regions'
  WHEN NOT round(crop_w / crop_h, 2) BETWEEN 0.5 AND 4 THEN 'aspect' ELSE 'kept' END AS reason FROM images""",
)
def c11(t):
    kept, rejects = C.image_quality_filters(t.images)
    return kept.select("image_name", F.lit("kept").alias("reason")).union(rejects.select("image_name", "reason"))


@query(
    "C12_match_and_type_lesions",
    MATCH + """SELECT b.image_name, b.lesion_id, CASE d.kind WHEN 'R' THEN 'Lesion' WHEN 'A' THEN 'Simple cyst' ELSE 'Node' END AS lesion_type FROM (SELECT image_name, lesion_id,
  row_number() OVER (PARTITION BY accession_number, image_name ORDER BY round(a + g / 2, 6), lesion_id) AS k FROM m WHERE a <= 1.5 AND g <= 2) b JOIN lesions d ON d.image_name = b.lesion_id WHERE k = 1""",
)
def c12(t):
    words = F.when(F.col("kind") == "R", "solid mass").when(F.col("kind") == "A", "cyst").otherwise("lymph node")
    described = t.lesions.select("accession_number", F.col("image_name").alias("lesion_id"), ((F.col("size_cm") * 2).cast("long") % 12 + 1).alias("d_clock"), F.col("ord").cast("double").alias("d_distance"), words.alias("description"))
    return C.match_and_type_lesions(t.lesions, described).select("image_name", "lesion_id", "lesion_type")


UNIT = "CAST(('0x' || substr(md5(CAST({} AS STRING)), 1, 16))::UBIGINT AS DOUBLE) / 18446744073709551616.0"


@query(
    "C13_export_dataset",
    f"""WITH g AS (SELECT accession_number, string_agg(image_name, '|' ORDER BY image_name) AS images, count(*) AS n_images FROM images WHERE NOT darkness > 60 AND NOT has_calipers <> 0 GROUP BY 1)
SELECT e.accession_number, unnest(CASE WHEN study_laterality = 'BILATERAL' THEN ['LEFT', 'RIGHT'] ELSE [study_laterality] END) AS laterality, images, n_images,
  CASE WHEN {UNIT.format('patient_id')} < 0.15 THEN 'test' WHEN {UNIT.format('patient_id')} < 0.3 THEN 'val' ELSE 'train' END AS split FROM exams e JOIN g ON e.accession_number = g.accession_number""",
)
def c13(t):
    spec = ExportSpec(max_darkness=60, allow_calipers=False)
    return C.export_dataset(t.images, t.exams, spec).select("accession_number", "laterality", "images", "n_images", "split")


def _release(t):
    return C.export_tables(t.images, t.exams, t.lesions, t.path, ExportSpec(max_darkness=60, allow_calipers=False, mini_share=0.2), videos(t))


SPLIT = f"CASE WHEN {UNIT.format('patient_id')} < 0.15 THEN 'test' WHEN {UNIT.format('patient_id')} < 0.3 THEN 'val' ELSE 'train' END"
KEPT = f"SELECT i.*, e.patient_id, {SPLIT.replace('patient_id', 'e.patient_id')} AS split FROM images i JOIN exams e ON i.accession_number = e.accession_number WHERE NOT darkness > 60 AND NOT has_calipers <> 0"
BREASTS = f"""SELECT accession_number, patient_id, unnest(CASE WHEN study_laterality = 'BILATERAL' THEN ['LEFT', 'RIGHT'] ELSE [study_laterality] END) AS laterality, {SPLIT} AS split,
  CAST(('0x' || md5('42:' || CAST(patient_id AS STRING)))::UHUGEINT % 10000 AS BIGINT) < 2000 AS mini FROM exams WHERE accession_number IN (SELECT accession_number FROM ({KEPT}))"""


@query("C13_export_images", f"SELECT image_name, patient_id, split FROM ({KEPT})")
def c13b(t):
    return _release(t)["images"].select("image_name", "patient_id", "split")


@query("C13_export_lesions", f"SELECT l.image_name, l.kind, k.split FROM lesions l JOIN ({KEPT}) k ON l.image_name = k.image_name")
def c13c(t):
    return _release(t)["lesions"].select("image_name", "kind", "split")


@query("C13_export_pathology", f"SELECT p.path_accession, p.path_part, p.path_lab, b.split FROM path p JOIN (SELECT DISTINCT patient_id, split FROM ({BREASTS})) b ON p.patient_id = b.patient_id")
def c13d(t):
    return _release(t)["pathology"].select("path_accession", "path_part", "path_lab", "split")


@query(
    "C13_export_labelled",
    f"""SELECT b.accession_number, b.laterality, EXISTS (SELECT 1 FROM path p WHERE p.patient_id = b.patient_id AND p.path_laterality = b.laterality AND p.path_interpretation IN ('MALIGNANT', 'BENIGN')) AS labelled FROM ({BREASTS}) b""",
)
def c13e(t):
    return _release(t)["breasts"].select("accession_number", "laterality", "labelled")


@query("C13_export_mini", f"SELECT accession_number, laterality FROM ({BREASTS}) WHERE mini")
def c13f(t):
    return _release(t)["breasts_mini"].select("accession_number", "laterality")


@query("C13_export_videos", VIDEOS)
def c13g(t):
    return _release(t)["videos"]


AUDITED = f"""SELECT {SPLIT} AS split, study_laterality AS side, CASE WHEN bi_rads IN ('4A', '4B', '4C', '5', '6') THEN 'MALIGNANT2' WHEN bi_rads IN ('1', '2') THEN 'BENIGN1' END AS diagnosis,
  CASE accession_number % 6 WHEN 0 THEN 'fatty' WHEN 1 THEN 'fibroglandular' WHEN 2 THEN 'heterogeneously' WHEN 3 THEN 'extremely' END AS density FROM exams"""


@query(
    "C14_audit_breasts",
    f"""WITH a AS ({AUDITED}), s AS (SELECT unnest(['train', 'val', 'test']) AS split), n AS (
SELECT s.split, unnest(['right_malignant', 'right_benign', 'left_malignant', 'left_benign', 'density_entirely_fatty', 'density_fibroglandular', 'density_heterogeneously', 'density_extremely_dense', 'density_unknown']) AS name,
  unnest([count(*) FILTER (WHERE side = 'RIGHT' AND diagnosis LIKE 'MALIGNANT%'), count(*) FILTER (WHERE side = 'RIGHT' AND diagnosis LIKE 'BENIGN%'), count(*) FILTER (WHERE side = 'LEFT' AND diagnosis LIKE 'MALIGNANT%'),
    count(*) FILTER (WHERE side = 'LEFT' AND diagnosis LIKE 'BENIGN%'), count(*) FILTER (WHERE density = 'fatty'), count(*) FILTER (WHERE density = 'fibroglandular'), count(*) FILTER (WHERE density = 'heterogeneously'),
    count(*) FILTER (WHERE density = 'extremely'), count(*) FILTER (WHERE density IS NULL AND a.split IS NOT NULL)]) AS value FROM s LEFT JOIN a ON s.split = a.split GROUP BY s.split)
SELECT 'export.' || split || '.' || name AS key, value FROM n""",
)
def c14b(t):
    says = F.when(F.col("bi_rads").isin("4A", "4B", "4C", "5", "6"), "MALIGNANT2").when(F.col("bi_rads").isin("1", "2"), "BENIGN1")
    k = F.col("accession_number") % 6
    words = F.when(k == 0, "The breasts are almost entirely fatty").when(k == 1, "Scattered Fibroglandular tissue").when(k == 2, "heterogeneously dense").when(k == 3, "Extremely dense").when(k == 4, "not stated")
    return C.audit_breasts(t.exams.select("patient_id", "study_laterality", says.alias("left_diagnosis"), says.alias("right_diagnosis"), words.alias("density_desc")))


@query(
    "C14_audit_report",
    """SELECT 'modality.' || modality AS key, count(*) AS value FROM exams GROUP BY 1 UNION ALL SELECT 'side.' || study_laterality, count(*) FROM exams GROUP BY 1 UNION ALL SELECT 'scanner.' || scanner, count(*) FROM images GROUP BY 1
UNION ALL SELECT unnest(['images.groups', 'images.least', 'images.most']), unnest([count(*), min(n), max(n)]) FROM (SELECT count(*) AS n FROM images GROUP BY accession_number)
UNION ALL SELECT 'split.' || CASE WHEN u < 0.15 THEN 'test' WHEN u < 0.3 THEN 'val' ELSE 'train' END || '.' || side, count(*) FROM (SELECT """ + UNIT.format("patient_id") + """ AS u, study_laterality AS side FROM exams) GROUP BY 1
UNION ALL SELECT unnest(['images.first_year', 'images.last_year']), unnest([min(year(acquired)), max(year(acquired))]) FROM images""",
)
def c14(t):
    return C.audit_report(t.exams, t.images)


@query(
    "C15_dataset_stats",
    f"""SELECT 'funnel.' || step AS key, n AS value FROM (SELECT {RULE_SQL} AS step, count(*) AS n FROM images GROUP BY 1) WHERE step IS NOT NULL
UNION ALL SELECT 'split.' || CASE WHEN u < 0.15 THEN 'test' WHEN u < 0.3 THEN 'val' ELSE 'train' END, count(*) FROM (SELECT {UNIT.format('patient_id')} AS u FROM exams) GROUP BY 1
UNION ALL SELECT 'gold.' || split || '.' || kind, count(*) FROM (SELECT kind, CASE WHEN u < 0.15 THEN 'test' WHEN u < 0.3 THEN 'val' ELSE 'train' END AS split FROM (
  SELECT l.kind, {UNIT.format('e.patient_id')} AS u FROM lesions l JOIN (SELECT *, {RULE_SQL} AS step FROM images) i ON l.image_name = i.image_name JOIN exams e ON i.accession_number = e.accession_number WHERE step IS NULL)) GROUP BY 1""",
)
def c15(t):
    return C.dataset_stats(t.images, t.exams, image_rules(), t.lesions.select("image_name", "kind"))


@query(
    "C16_seed_annotations",
    """SELECT CAST(e.accession_number AS STRING) AS image_name, CASE WHEN n IS NULL THEN 'fallback' WHEN n = 1 THEN 'linked' ELSE 'skipped' END AS outcome FROM exams e
LEFT JOIN (SELECT accession_number AS k, count(DISTINCT (clock, distance_cm)) AS n FROM lesions WHERE clock IS NOT NULL GROUP BY 1) l ON e.accession_number = l.k""",
)
def c16(t):
    """An exam's lesions stand in one image: several places make several annotations, and its mask is skipped."""
    lesions = t.lesions.where("clock IS NOT NULL").withColumn("image_name", F.col("accession_number").cast("string"))
    return C.seed_annotations(lesions, t.exams.select(F.col("accession_number").cast("string").alias("image_name"))).select("image_name", "outcome")


@query(
    "C16_frame_views",
    """SELECT DISTINCT s.annotation, i.image_name AS frame_name FROM images i JOIN (SELECT accession_number, string_agg(DISTINCT image_name, ',' ORDER BY image_name) AS annotation, min(struct_pack(i := image_name, l := laterality)).l AS side FROM lesions
  WHERE clock IS NOT NULL GROUP BY accession_number, clock, distance_cm) s ON i.accession_number = s.accession_number AND (i.laterality IS NULL OR i.laterality = s.side)""",
)
def c16b(t):
    frames = t.images.select("accession_number", F.col("image_name").alias("frame_name"), "laterality")
    return C.seed_frame_views(frames, t.lesions.withColumnRenamed("image_name", "lesion_id"), names_hold_exam=True)


@query(
    "C17_extraction_queue",
    "SELECT md5(text) AS text_hash, min(doc_id) AS first_key, count(*) AS waiting FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) GROUP BY 1",
)
def c17(t):
    return C.extraction_queue(t.documents, "doc_id", "text", t.labels.select("doc_id"))


@query(
    "C17_backfill",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'old' ELSE r.value END AS value FROM documents d LEFT JOIN (SELECT md5(text) AS h, min(CAST(n_chars AS STRING)) AS value FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0) AND trim(text) <> '' GROUP BY 1) r ON md5(d.text) = r.h AND trim(d.text) <> ''""",
)
def c17b(t):
    rows = t.documents.select("doc_id", "text", F.when(F.col("doc_id") % 3 == 0, "old").alias("value"))
    done = t.documents.join(t.labels.select("doc_id", "toxic"), "doc_id").where(F.trim("text") != "")
    results = done.select(F.md5("text").alias("text_hash"), F.col("n_chars").cast("string").alias("value"), F.when(F.col("toxic") == 1, "failed").alias("error"))
    return C.backfill_extractions(rows, "doc_id", "text", "value", results).select("doc_id", "value")


@query("C17_claims", "SELECT md5(text) AS text_hash, CAST(min(n_chars) AS BIGINT) AS value FROM documents WHERE trim(text) <> '' GROUP BY 1")
def c17c(t):
    """Two workers share all texts; one is lost with what it has claimed, which the other then gets."""
    root = new_path(t.spark, "claims")
    texts = t.documents.where(F.trim("text") != "").groupBy(F.md5("text").alias("text_hash")).agg(F.min("n_chars").alias("n_chars"))
    Q.open_queue(texts, root, "text_hash", 8)
    Q.claim(t.spark, root, "lost", 60, many=3, now=0.0)
    for now in (1.0, 100.0):
        while tasks := Q.claim(t.spark, root, "other", 60, many=4, now=now):
            for task in tasks:
                Q.accept(Q.items(t.spark, root, [task]).select("text_hash", F.col("n_chars").cast("long").alias("value")), root, task)
    return Q.results(t.spark, root, "text_hash string, value long")


@query("C18_em_rates")
def c18(t):
    rows = t.lineitem.select("l_orderkey", "l_returnflag", (F.col("l_discount") > 0.05).cast("int").alias("found"))
    return C.em_rates(rows, "l_orderkey", "l_returnflag", "found").withColumn("rate", F.round("rate", 6))


@query(
    "C19_assign_top",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY r DESC, l_linenumber, l_partkey, l_suppkey) <= sum(CAST(l_discount > 0.05 AS INT)) OVER (PARTITION BY l_orderkey) AS assigned
FROM (SELECT *, CASE l_returnflag WHEN 'R' THEN 0.9 WHEN 'A' THEN 0.5 ELSE 0.1 END AS r FROM lineitem)""",
)
def c19(t):
    rate = F.when(F.col("l_returnflag") == "R", 0.9).when(F.col("l_returnflag") == "A", 0.5).otherwise(0.1)
    rows = t.lineitem.withColumns({"r": rate, "found": (F.col("l_discount") > 0.05).cast("int"), "key": F.struct("l_linenumber", "l_partkey", "l_suppkey")})
    return C.assign_top(rows, "l_orderkey", "key", "r", "found").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "assigned")


@query(
    "C20_annotation_sample",
    f"""SELECT image_name, split FROM (SELECT image_name, split, row_number() OVER (PARTITION BY split ORDER BY md5('4:' || image_name), image_name) AS k FROM (
  SELECT image_name, CASE WHEN {UNIT.format('accession_number')} < 0.15 THEN 'test' WHEN {UNIT.format('accession_number')} < 0.3 THEN 'val' ELSE 'train' END AS split FROM images
  WHERE image_name IN (SELECT image_name FROM lesions WHERE clock > 6) AND has_calipers = 0)) WHERE k <= 25""",
)
def c20(t):
    return C.annotation_sample(t.images, t.lesions.where("clock > 6"), t.images.where("has_calipers = 1").select("image_name"), 25, 4).select("image_name", "split")


@query(
    "C21_detector_table",
    """WITH f AS (SELECT i.image_name, i.has_calipers, i.scanner, EXISTS (SELECT 1 FROM lesions l WHERE l.image_name = i.image_name AND clock > 6) AS pos FROM images i),
c AS (SELECT *, row_number() OVER (PARTITION BY scanner ORDER BY md5('3:' || image_name), image_name) AS k, count(*) OVER (PARTITION BY scanner) AS n FROM f WHERE pos AND has_calipers = 1),
r AS (SELECT image_name, 1 AS positive FROM f WHERE pos AND has_calipers = 0 UNION ALL SELECT image_name, 1 FROM c WHERE k <= floor(n * 0.15 + 1e-9) UNION ALL SELECT image_name, 0 FROM f WHERE NOT pos)
SELECT image_name, positive, CASE WHEN row_number() OVER (PARTITION BY positive ORDER BY md5('3:' || image_name), image_name) <= round(count(*) OVER (PARTITION BY positive) * 0.2) THEN 'test' ELSE 'train' END AS split FROM r""",
)
def c21(t):
    # only what is asked for: rows are written on the way, so later choices of columns don't reach the scan
    images = t.images.select("image_name", "has_calipers", "scanner")
    return C.detector_table(images, t.lesions.where("clock > 6"), 0.15, 3).select("image_name", "positive", "split")
