"""Queries of filters and projections."""

from pyspark.sql import functions as F

from ..operators import predicates as P
from ..registry import query
from ..sources.spec import ExportSpec, build_predicate


def image_rules():
    return [
        ("axilla", F.col("area") == "AXILLA"),
        ("dark", F.col("darkness") > 80),
        ("no_laterality", F.col("laterality").isNull()),
        ("narrow", F.col("crop_w") / F.col("crop_h") < 0.75),
        ("calipers", F.col("has_calipers") == 1),
    ]


RULE_SQL = """CASE WHEN area = 'AXILLA' THEN 'axilla' WHEN darkness > 80 THEN 'dark' WHEN laterality IS NULL THEN 'no_laterality'
  WHEN crop_w / crop_h < 0.75 THEN 'narrow' WHEN has_calipers = 1 THEN 'calipers' END"""


@query("P1_contains_ci", "SELECT accession_number, description FROM exams WHERE description ILIKE '%urgent%'")
def p1(t):
    return t.exams.where(P.contains_ci(F.col("description"), "Urgent")).select("accession_number", "description")


@query("P2_drop_containing", "SELECT accession_number, description FROM exams WHERE description IS NULL OR description NOT LIKE '%OUTSIDE%'")
def p2(t):
    return P.drop_containing(t.exams, "description", "outside").select("accession_number", "description")


@query("P3_null_or_not_in", "SELECT accession_number, bi_rads FROM exams WHERE bi_rads IS NULL OR bi_rads NOT IN ('0', '6')")
def p3(t):
    return t.exams.where(P.null_or_not_in(F.col("bi_rads"), ["0", "6"])).select("accession_number", "bi_rads")


@query("P4_exclude_first", f"SELECT image_name, reason FROM (SELECT image_name, {RULE_SQL} AS reason FROM images) WHERE reason IS NOT NULL")
def p4(t):
    return P.exclude_first(t.images, image_rules())[1].select("image_name", "reason")


@query(
    "P5_exclusion_reasons",
    """SELECT image_name, nullif(concat_ws(';', CASE WHEN area = 'AXILLA' THEN 'axilla' END, CASE WHEN darkness > 80 THEN 'dark' END,
  CASE WHEN laterality IS NULL THEN 'no_laterality' END, CASE WHEN crop_w / crop_h < 0.75 THEN 'narrow' END,
  CASE WHEN has_calipers = 1 THEN 'calipers' END), '') AS reasons FROM images""",
)
def p5(t):
    return t.images.select("image_name", P.exclusion_reasons(image_rules()).alias("reasons"))


@query(
    "P6_build_predicate",
    """SELECT image_name FROM images WHERE (darkness IS NULL OR darkness <= 60) AND (has_calipers IS NULL OR has_calipers = 0)
  AND year(acquired) BETWEEN 1993 AND 1996 AND area IS NOT NULL AND scanner NOT IN ('Brand#11', 'Brand#12')""",
)
def p6(t):
    spec = ExportSpec(max_darkness=60, allow_calipers=False, min_year=1993, max_year=1996, required=["area"], deny_scanners=["Brand#11", "Brand#12"])
    return t.images.where(build_predicate(spec)).select("image_name")


@query("P7_list_filter", "SELECT accession_number FROM exams WHERE modality IN ('US', 'MR') UNION ALL SELECT -accession_number FROM exams WHERE modality <> 'MG'")
def p7(t):
    allowed = P.list_filter(t.exams, "modality", allow=["US", "MR"], deny=["US"]).select("accession_number")
    return allowed.unionAll(P.list_filter(t.exams, "modality", deny=["MG"]).select((-F.col("accession_number")).alias("accession_number")))


@query(
    "P8_keep_or_mask",
    "SELECT accession_number, modality, CASE WHEN modality = 'US' THEN bi_rads END AS bi_rads FROM exams WHERE description IS NOT NULL OR modality = 'US'",
)
def p8(t):
    return P.keep_or_mask(t.exams, ["description"], "modality", "us", ["bi_rads"]).select("accession_number", "modality", "bi_rads")


@query("P9_drop_unlabelled", "SELECT accession_number FROM exams WHERE NOT (bi_rads IS NULL AND description IS NULL AND is_biopsy = 'T')")
def p9(t):
    return P.drop_unlabelled(t.exams, ["bi_rads", "description"], F.col("is_biopsy") == "T").select("accession_number")


@query("P10_require", "SELECT image_name FROM images WHERE area IS NOT NULL AND laterality IS NOT NULL")
def p10(t):
    return P.require(t.images, ["area", "laterality"]).select("image_name")


@query("P11_project", "SELECT exam_ts AS ts, modality AS kind, accession_number, patient_id FROM exams")
def p11(t):
    slim = P.project(t.exams, {"exam_ts": "ts", "modality": "kind"}, ["study_laterality", "bi_rads", "is_biopsy", "description", "absent"], ["ts", "kind"])
    return slim


@query("P12_snake_case_columns", "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_id FROM nation")
def p12(t):
    return P.snake_case_columns(t.nation.toDF("NationKey", "NATION-NAME", "regionID"))


@query("P13_norm_id", "SELECT CAST(o_orderkey AS STRING) AS id FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL SELECT NULL FROM orders WHERE o_orderkey % 7 = 0")
def p13(t):
    raw = F.when(F.col("o_orderkey") % 7 == 0, F.lit(" nan ")).otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")))
    return t.orders.select(P.norm_id(raw).alias("id"))


@query("P14_coalesce_text", "SELECT image_name, coalesce(area, laterality, scanner) AS label FROM images")
def p14(t):
    return t.images.select("image_name", P.coalesce_text(F.col("area"), F.col("laterality"), F.col("scanner")).alias("label"))


LABEL_LIST = "concat_ws('; ', CASE WHEN l_quantity > 40 THEN 'mass' END, CASE WHEN l_tax > 0.05 THEN 'cyst' END, CASE WHEN l_discount > 0.08 THEN 'node' END)"


@query(
    "P15_label_flags",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity > 40 AS mass, l_tax > 0.05 AS cyst FROM lineitem WHERE l_quantity > 40 OR l_tax > 0.05",
)
def p15(t):
    rows = t.lineitem.withColumn("found", F.expr(LABEL_LIST))
    return P.label_flags(rows, "found", ["mass", "cyst"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "mass", "cyst")


@query("P16_none_of", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE NOT (l_quantity > 40 OR l_discount > 0.08)")
def p16(t):
    rows = t.lineitem.withColumn("found", F.expr(LABEL_LIST.replace("'; '", "', '")))
    return rows.where(P.none_of(F.col("found"), ["mass", "node"])).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
