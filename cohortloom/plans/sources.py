"""Queries of sources and sinks; files go to the shared checkpoint folder and are read back."""

from pyspark.sql import functions as F

from ..operators.predicates import exclude_first
from ..operators.lineage import new_path
from ..registry import query
from ..sources import io
from ..sources.spec import ExportSpec, build_predicate
from .predicates import image_rules


def folder(t, name):
    return new_path(t.spark, name)


@query("S1_read_tables", "SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def s1(t):
    x = io.read_tables(t.spark, t.sf_dir, ["nation", "region"])
    return x["nation"].join(x["region"], F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count("*").alias("n"))


@query("S2_restrict_to_keys", "SELECT accession_number FROM exams WHERE patient_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def s2(t):
    keys = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("patient_id"))
    return io.restrict_to_keys(t.exams, keys, "patient_id").select("accession_number")


@query("S3_S4_csv_round_trip", "SELECT lpad(CAST(accession_number AS STRING), 9, '0') AS id, modality, modality || ';' || is_biopsy AS tags, coalesce(description, '') AS description FROM exams")
def s34(t):
    path = folder(t, "csv")
    rows = t.exams.select(F.lpad(F.col("accession_number").cast("string"), 9, "0").alias("id"), "modality", F.array("modality", "is_biopsy").alias("tags"), F.coalesce("description", F.lit("")).alias("description"))
    io.write_csv(rows, path)
    return io.read_csv_typed(t.spark, path, "id string, modality string, tags string, description string").withColumn("description", F.coalesce("description", F.lit("")))


@query("S5_read_jsonl", "SELECT CASE WHEN event_id % 10 <> 0 THEN event_id END AS event_id, CASE WHEN event_id % 10 <> 0 THEN event_type END AS event_type, CASE WHEN event_id % 10 = 0 THEN 'broken ' || CAST(event_id AS STRING) END AS error FROM events")
def s5(t):
    path = folder(t, "jsonl")
    line = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("broken "), F.col("event_id").cast("string"))).otherwise(F.to_json(F.struct("event_id", "event_type")))
    t.events.select(line.alias("value")).write.text(path)
    return io.read_jsonl(t.spark, path, "event_id long, event_type string")


@query("S6_worklist", """SELECT '{"id":' || CAST(doc_id AS STRING) || ',"text":"' || lang || '-' || source || '"}' AS value FROM documents WHERE length(lang || '-' || source) >= 8""")
def s6(t):
    path = folder(t, "work")
    io.write_worklist(io.worklist(t.documents.select("doc_id", F.concat_ws("-", "lang", "source").alias("text")), "doc_id", "text", 8), path)
    return t.spark.read.text(path)


@query("S7_where_params", "SELECT accession_number FROM exams WHERE modality = 'US' AND patient_id > 100")
def s7(t):
    return io.where_params(t.spark, t.exams, "modality = :m AND patient_id > :p", m="US", p=100).select("accession_number")


@query("S8_snapshot", "SELECT modality, count(*) AS n FROM exams GROUP BY modality")
def s8(t):
    path = folder(t, "snapshot")
    io.snapshot(t.exams, path)
    again = io.snapshot(t.exams.limit(0), path)
    return again.groupBy("modality").agg(F.count("*").alias("n"))


@query("S8_snapshot_status", "SELECT DISTINCT modality AS name, modality = 'US' AS present FROM exams")
def s8c(t):
    paths = {r.modality: folder(t, r.modality) for r in t.exams.select("modality").distinct().collect()}
    if "US" in paths:
        io.snapshot(t.exams.where("modality = 'US'"), paths["US"])
    return io.snapshot_status(t.spark, paths)


@query("S8_snapshot_or_csv", "SELECT accession_number, modality, 'csv' AS source FROM exams UNION ALL SELECT accession_number, modality, 'snapshot' FROM exams")
def s8b(t):
    csv, path, schema = folder(t, "csv"), folder(t, "snapshot"), "accession_number long, modality string"
    exams = t.exams.select("modality", "accession_number")
    io.write_csv(exams, csv)
    before = io.snapshot_or_csv(t.spark, path, csv, schema).withColumn("source", F.lit("csv"))
    io.snapshot(exams, path)
    return before.unionByName(io.snapshot_or_csv(t.spark, path, csv, schema).withColumn("source", F.lit("snapshot")))


@query("S9_file_inventory", "SELECT 'modality=' || modality AS parent, 1 AS some FROM exams GROUP BY modality")
def s9(t):
    path = folder(t, "files")
    t.exams.write.partitionBy("modality").parquet(path)
    return io.file_inventory(t.spark, path, "*.parquet").groupBy("parent").agg(F.lit(1).alias("some"))


@query(
    "S10_write_manifest",
    "SELECT image_name, CASE area WHEN 'BREAST' THEN 1 WHEN 'AXILLA' THEN 2 END AS code, '/img/' || image_name || '.png' AS path FROM images WHERE image_name IN (SELECT image_name FROM lesions WHERE clock > 6)",
)
def s10(t):
    paths = t.lesions.where("clock > 6").select(F.concat(F.lit("/x/"), "image_name", F.lit(".png")).alias("path"))
    files = paths.select("path", *io.path_columns(F.col("path")))
    return io.write_manifest(t.images, files, "image_name", "area", {"BREAST": 1, "AXILLA": 2}, "/img/{}.png").select("image_name", "code", "path")


@query("S11_audit", "SELECT 'r1' AS run, 'images.rows' AS key, CAST(count(*) AS DOUBLE) AS value FROM images UNION ALL SELECT 'r1', 'images.calipers', CAST(sum(has_calipers) AS DOUBLE) FROM images UNION ALL SELECT 'r1', 'manual', 2.0")
def s11(t):
    audit = io.Audit("r1")
    audit.record("manual", 2)
    watched = audit.watch(t.images, "images", rows=F.count(F.lit(1)), calipers=F.sum("has_calipers"))
    watched.write.mode("overwrite").format("noop").save()
    return audit.table(t.spark)


@query("S12_spec_from_yaml", "SELECT image_name FROM images WHERE NOT darkness > 50 AND NOT has_calipers <> 0 AND area IS NOT NULL")
def s12(t):
    spec = ExportSpec.from_yaml("max_darkness: 50\nallow_calipers: false\nrequired: [area]\n")
    return t.images.where(build_predicate(spec)).select("image_name")


@query("S13_flatten_annotations", "SELECT CAST(accession_number AS STRING) AS key, 0 AS label, 'shape' AS feature, modality || '; oval' AS answers FROM exams WHERE is_biopsy = 'T' AND modality <> 'MR'")
def s13(t):
    answer = lambda v: F.struct(v.alias("name"), v.alias("value"))
    answers = F.array(answer(F.lit("oval")), answer(F.when(F.col("modality") == "MR", "disqualified").otherwise(F.col("modality"))))
    classes = F.array(F.struct(F.lit("shape").alias("name"), answers.alias("checklist_answers")))
    label = F.struct(F.struct(classes.alias("classifications")).alias("annotations"))
    project = F.struct(F.struct(F.when(F.col("is_biopsy") == "T", "IN_REVIEW").otherwise("DONE").alias("workflow_status")).alias("project_details"), F.array(label).alias("labels"))
    doc = F.struct(F.struct(F.col("accession_number").cast("string").alias("global_key")).alias("data_row"), F.create_map(F.lit("p1"), project).alias("projects"))
    return io.flatten_annotations(t.exams.select(F.to_json(doc).alias("doc")), "doc").withColumn("answers", F.when(F.col("answers").startswith("oval"), F.concat(F.split("answers", "; ")[1], F.lit("; oval"))).otherwise(F.col("answers")))


@query("S14_two_databases", "SELECT d.doc_id, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def s14(t):
    source, labels = io.read_tables(t.spark, t.sf_dir, ["documents"]), io.read_tables(t.spark, t.sf_dir, ["labels"])
    return source["documents"].join(labels["labels"], "doc_id").select("doc_id", "quality")


@query("S15_write_rejects", "SELECT 1 AS done, count(*) AS n FROM images WHERE darkness > 80 OR area = 'AXILLA' OR laterality IS NULL OR crop_w / crop_h < 0.75 OR has_calipers = 1")
def s15(t):
    path = folder(t, "rejects")
    exclude_first(t.images, image_rules())[1].write.partitionBy("reason").parquet(path)
    return t.spark.read.parquet(path).agg(F.lit(1).alias("done"), F.count("*").alias("n"))
