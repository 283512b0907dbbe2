"""Composed cohort jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as H
from ..functions import values as V
from ..operators import aggregates as A
from ..operators import changes as G
from ..operators import joins as J
from ..operators import predicates as P
from ..operators import sampling as K
from ..operators import timeline as W
from ..operators.lineage import cut
from ..sources.spec import ExportSpec, rules

BENIGN_MALIGNANT = ["MALIGNANT", "BENIGN"]
RANKS = ["0", "1", "2", "3", "4", "4A", "4B", "4C", "5", "6"]


def score_rank(c: Column) -> Column:
    """Ordinal of an assessment score; null for none."""
    return F.nullif(F.array_position(F.array(*map(F.lit, RANKS)), c), F.lit(0)).cast("int")


def clean_exams(raw: DataFrame) -> DataFrame:
    """Reports to exam rows. raw: patient_id, accession_number, exam_ts, modality, description, report, narrative.

    Fixed order: exclusions, text rules, per-patient windows; then exams without a final score and patients without any
    ultrasound exam go.
    """
    rows = P.drop_containing(P.drop_containing(raw, "description", "OUTSIDE"), "description", "AXILLA")
    # one exchange by patient before the text rules, so that their tasks follow the rows; a report takes long, so there are 65,536 to a task
    rows = W.dealt_by(rows, "patient_id", rows=4 * rows.count())
    rows = rows.withColumns(
        {
            "findings": H.findings(F.col("report"), F.col("narrative")),
            "impression": H.impression(F.col("report")),
            "density": H.section(F.col("report"), "DENSITY:"),
            "study_laterality": H.laterality(F.col("description"), F.lit(None).cast("string"), F.col("report")),
            "bi_rads": F.coalesce(H.score(F.col("report")), H.score(F.col("narrative"))),
            "is_biopsy": F.when(H.biopsy_flags(F.col("description"))["any"], "T").otherwise("F"),
            "concordance": H.yes_no_after(F.col("report"), "CONCORDANCE"),
            "addendum": F.coalesce(H.tail_from_first(F.col("report")), H.tail_from_first(F.col("narrative"))),
        }
    )
    rows = rows.withColumns({"guidance": H.guidance(F.col("description"), F.col("is_biopsy") == "T"), "rank": score_rank(F.col("bi_rads")), "features": H.lexicon_features(H.isolate_section(F.col("findings")))})
    rows = W.running_worst(rows, "patient_id", "exam_ts", "accession_number", "study_laterality", "rank", "accession_number")
    biopsy = F.col("is_biopsy") == "T"
    rows = W.days_to_event(rows, "patient_id", "exam_ts", biopsy).withColumnRenamed("days_to_event", "days_to_biopsy")
    rows = W.propagate_from_events(rows, "patient_id", "exam_ts", biopsy, "guidance", 30, 120)
    rows = W.prior_counts(rows, "patient_id", "exam_ts", "accession_number", biopsy, "study_laterality")
    has_us = F.max((F.col("modality") == "US").cast("int")).over(Window.partitionBy("patient_id")) == 1
    return rows.withColumn("_us", has_us).where(F.col("_us") & (F.coalesce(F.col("bi_rads"), F.lit("")) != "0")).drop("_us", "rank")


def clean_pathology(notes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Notes (key, note, ...) to one row per lettered part with side, category and cancer type."""
    first = W.first_by(notes, [key], order)
    older = F.lower(F.col(key).cast("string")).startswith("amml")
    rows = first.withColumns(
        {
            "final_diag": F.when(older, H.rtf_final(F.col("note"))).otherwise(H.final_diagnosis(F.col("note"))),
            "synoptic": F.when(older, H.synoptic(H.rtf_final(F.col("note")), "old")).otherwise(H.synoptic(F.col("note"))),
        }
    )
    parts = H.split_lettered_parts(rows, "final_diag", "lesion_diag")
    text = F.coalesce("lesion_diag", "final_diag")
    return parts.withColumns({"path_laterality": H.lesion_laterality(F.col("lesion_diag")), "path_interpretation": H.path_category(text), "cancer_type": H.first_unnegated(text)})


def link_timeline(exams: DataFrame, path: DataFrame) -> DataFrame:
    """Exam and pathology rows of a patient in one table; pathology near a biopsy gets the accession of the latest
    exam before it whose side fits, and rows of an accession share its first synoptic text.

    exams: patient_id, accession_number, exam_ts, study_laterality, bi_rads, is_biopsy, modality. path: patient_id,
    path_id, path_ts, path_laterality, path_interpretation; optionally accession_number (rows that have one keep it),
    lesion_diag (rows without one are not linked), synoptic and final_diag.
    """
    absent = {c: F.lit(None).cast("string") for c in ("synoptic", "final_diag") if c not in path.columns}
    if "accession_number" not in path.columns:
        absent["accession_number"] = F.lit(None).cast(exams.schema["accession_number"].dataType)
    path = path.withColumns(absent)
    open_rows = path.where(P.coalesce_text(F.col("accession_number").cast("string")).isNull() & F.col("path_laterality").isNotNull() & F.col("path_ts").isNotNull())
    open_rows = open_rows.where("lesion_diag IS NOT NULL") if "lesion_diag" in path.columns else open_rows
    biopsies = exams.where("is_biopsy = 'T'").selectExpr("patient_id", "accession_number AS event_id", "exam_ts AS event_ts")
    others = exams.where("study_laterality IS NOT NULL").selectExpr("patient_id", "accession_number AS exam_id", "exam_ts", "study_laterality AS exam_side")
    linked = J.link_events_asof(biopsies, open_rows.selectExpr("patient_id", "path_id", "path_ts", "path_laterality AS path_side"), others)
    best = linked.where("exam_id IS NOT NULL").groupBy("path_id").agg(F.max(F.struct("exam_ts", "exam_id"))["exam_id"].alias("_found"))
    named = path.join(best, "path_id", "left").withColumn("accession_number", F.coalesce("accession_number", "_found")).drop("_found").withColumnRenamed("path_ts", "ts")
    rows = G.union_all_by_name(exams.withColumnRenamed("exam_ts", "ts").withColumn("kind", F.lit("exam")), named.withColumn("kind", F.lit("path")))
    # the first row with a synoptic text lends it, with its diagnosis, to the rows of its accession that have none
    first = W.first_by(rows.where((F.col("synoptic") != "") & F.col("accession_number").isNotNull()), ["accession_number"], ["ts", "path_id"])
    lent = first.select("accession_number", F.col("synoptic").alias("_s"), F.col("final_diag").alias("_d"))
    blank = F.coalesce(F.col("synoptic"), F.lit("")) == ""
    filled = rows.join(lent, "accession_number", "left").withColumns({"final_diag": F.when(blank & F.col("_s").isNotNull(), F.col("_d")).otherwise(F.col("final_diag")), "synoptic": F.when(blank, F.coalesce("_s", "synoptic")).otherwise(F.col("synoptic"))})
    return filled.select(*rows.columns)


SIDES = ("LEFT", "RIGHT")


def diagnose(timeline: DataFrame, respect_discordance: bool = True) -> DataFrame:
    """C4: left and right diagnosis of every exam row with its evidence, by rules in fixed order.

    timeline: patient_id, ts, kind ('exam' or 'path'), encounter_id, study_laterality, path_laterality, bi_rads,
    is_biopsy, path_interpretation, concordance, a1_category, a2_category. Rules: same encounter (0), benign by
    follow-up (1), by follow-up after score 3 (3), score 6 with malignancy (1), next pathology (2), addendum (4, always
    writes). Rules 0, 1 and 3 fill an empty side; score 6 on one side and next pathology need both sides empty.
    All windows share one shuffle by patient (the encounter rule refines it), into as many tasks as the rows need. An
    absent score blocks nothing.
    """
    exam = F.col("kind") == "exam"
    side, score, interp = F.col("study_laterality"), F.col("bi_rads"), F.upper(F.col("path_interpretation"))
    rows = W.dealt_by(timeline, "patient_id").withColumn("us", W.micros(F.col("ts")))
    enc = Window.partitionBy("patient_id", "encounter_id")
    later = lambda days: Window.partitionBy("patient_id").orderBy("us").rangeBetween(1, days * W.DAY)
    around = Window.partitionBy("patient_id").orderBy("us").rangeBetween(-30 * W.DAY, 120 * W.DAY)
    everything = Window.partitionBy("patient_id").orderBy("us").rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = Window.partitionBy("patient_id").orderBy("us").rangeBetween(1, Window.unboundedFollowing)
    some = lambda cond, w: F.coalesce(F.max(F.coalesce(cond, F.lit(False)).cast("int")).over(w), F.lit(0)) == 1
    on = lambda s: F.col("path_laterality") == s
    unsided = ~F.coalesce(F.upper("path_laterality").isin(*SIDES), F.lit(False))
    marks: dict[str, Column] = {}
    for v in BENIGN_MALIGNANT:
        for s in SIDES:
            marks[f"enc_{v}_{s}"] = some((interp == v) & (F.upper("path_laterality") == s), enc)
            marks[f"next_{v}_{s}"] = some((interp == v) & on(s), later(240))
        marks[f"enc_{v}_X"] = some((interp == v) & unsided, enc)
    for s in SIDES:
        marks[f"ever_{s}"] = some(interp.contains("MALIGNANT") & on(s), everything)
    scored = exam & score.isNotNull() & (score != "")
    marks |= {
        "biopsy_near": some(F.col("is_biopsy") == "T", around),
        "biopsy_next": some(F.col("is_biopsy") == "T", later(240)),
        "malignant_450": some(interp.contains("MALIGNANT"), later(450)),
        "not_12_730": some(scored & ~score.isin("1", "2"), later(730)),
        "not_12_1095": some(exam & ~F.coalesce(score.isin("1", "2"), F.lit(False)), later(1095)),
        "not_123_1095": some(exam & ~F.coalesce(score.isin("1", "2", "3"), F.lit(False)), later(1095)),
        "far_1095": (F.max("us").over(later(1095)) - F.col("us")) >= 730 * W.DAY,
        "followed": (F.max("us").over(ahead) - F.col("us")) >= 180 * W.DAY,
    }
    rows = rows.withColumns(marks)
    here = lambda s: exam & side.isin(s, "BILATERAL")
    calm = F.coalesce(F.col("followed"), F.lit(False)) & ~F.col("biopsy_near") & ~F.col("malignant_450")
    stable = ~F.col("not_12_1095") | (~F.col("not_123_1095") & F.coalesce(F.col("far_1095"), F.lit(False)))
    trusted = F.coalesce(F.col("concordance") != "F", F.lit(True)) if respect_discordance else F.lit(True)

    def step(current: dict, found: dict[str, Column], source: str) -> dict:
        return {s: (F.coalesce(current[s][0], found[s]), F.when(current[s][0].isNull() & found[s].isNotNull(), F.lit(source)).otherwise(current[s][1])) for s in SIDES}

    none = F.lit(None).cast("string")
    state = {s: (none, none) for s in SIDES}
    encounter = {}
    for s in SIDES:
        bad, good = (F.col(f"enc_{v}_{s}") | ((side == s) & F.col(f"enc_{v}_X")) for v in BENIGN_MALIGNANT)
        encounter[s] = F.when(here(s) & F.col("encounter_id").isNotNull() & trusted, F.when(bad, "MALIGNANT0").when(good, "BENIGN0"))
    state = step(state, encounter, "encounter linked path")
    state = step(state, {s: F.when(here(s) & score.isin("1", "2") & calm & ~F.col("not_12_730"), "BENIGN1") for s in SIDES}, "assumed benign")
    state = step(state, {s: F.when(here(s) & (score == "3") & calm & stable, "BENIGN3") for s in SIDES}, "assumed benign - birads 3")
    # the columns so far are written out once, as the next rules look at both sides
    rows = rows.withColumns({f"d_{s}": state[s][0] for s in SIDES} | {f"e_{s}": state[s][1] for s in SIDES})
    state = {s: (F.col(f"d_{s}"), F.col(f"e_{s}")) for s in SIDES}
    empty = F.col("d_LEFT").isNull() & F.col("d_RIGHT").isNull()
    state = step(state, {s: F.when(here(s) & (score == "6") & F.col(f"ever_{s}") & ((side == "BILATERAL") | empty), "MALIGNANT1") for s in SIDES}, "birads 6 with malignancy")
    rows = rows.withColumns({f"f_{s}": state[s][0] for s in SIDES} | {f"g_{s}": state[s][1] for s in SIDES})
    empty = F.col("f_LEFT").isNull() & F.col("f_RIGHT").isNull()
    out = {}
    category = P.coalesce_text(F.col("a2_category"), F.col("a1_category"))
    by_addendum = F.when(category.isNotNull(), F.when(F.lower(category).rlike("malignant|invasive"), "MALIGNANT4").otherwise("BENIGN4"))
    from_a2 = F.coalesce(F.trim("a2_category") != "", F.lit(False))
    for s in SIDES:
        bad, good = F.col(f"next_MALIGNANT_{s}"), F.col(f"next_BENIGN_{s}")
        follow = F.when(
            here(s) & empty,
            F.when(bad & F.col("biopsy_next") & score.isin("4", "4A", "4B", "4C", "5", "6"), "MALIGNANT2").when(good & ~bad & score.isin("1", "2", "3", "4", "4A", "4B"), "BENIGN2"),
        )
        aimed = here(s) & ((side != "BILATERAL") | F.coalesce(F.col("path_laterality") == s, ~F.coalesce(F.col("path_laterality").isin(*SIDES), F.lit(False))))
        override = F.when(aimed, by_addendum)
        name = s.lower()
        out[f"{name}_prior"] = F.coalesce(F.col(f"f_{s}"), follow)
        out[f"{name}_diagnosis"] = F.coalesce(override, F.col(f"f_{s}"), follow)
        out[f"{name}_diagnosis_source"] = (
            F.when(override.isNotNull(), F.when(from_a2, "addendum A2").otherwise("addendum A1"))
            .when(F.col(f"f_{s}").isNotNull(), F.col(f"g_{s}"))
            .when(follow.startswith("MALIGNANT"), "malignant pathology")
            .when(follow.isNotNull(), "benign pathology")
        )
    return rows.withColumns(out).select(*timeline.columns, *out)


def override_audit(diagnosed: DataFrame) -> DataFrame:
    """What the addendum rule changed: filled, agreed or disagreed, by side."""
    per = []
    for s in ("left", "right"):
        old, new = F.col(f"{s}_prior"), F.col(f"{s}_diagnosis")
        kind = F.when(old.isNull(), "filled_empty").when(F.substring(old, 1, 3) == F.substring(new, 1, 3), "equivalent").otherwise("disagreement")
        per.append(F.struct(F.lit(s).alias("side"), kind.alias("change"), new.endswith("4").alias("by")))
    rows = diagnosed.select(F.explode(F.array(*per)).alias("x")).where("x.by")
    return rows.groupBy("x.side", "x.change").agg(F.count("*").alias("n"))


def override_disagreements(diagnosed: DataFrame) -> DataFrame:
    """The rows that the addendum rule changed from one class to the other, with side, prior, diagnosis and source."""
    per = [F.struct(F.lit(s).alias("side"), F.col(f"{s}_prior").alias("prior"), F.col(f"{s}_diagnosis").alias("diagnosis"), F.col(f"{s}_diagnosis_source").alias("source")) for s in ("left", "right")]
    gone = [f"{s}_{c}" for s in ("left", "right") for c in ("prior", "diagnosis", "diagnosis_source")]
    rows = diagnosed.withColumn("_x", F.explode(F.array(*per))).select(*[c for c in diagnosed.columns if c not in gone], "_x.*")
    return rows.where(F.col("diagnosis").endswith("4") & (F.substring("prior", 1, 3) != F.substring("diagnosis", 1, 3)))


def final_dataset(exams: DataFrame, path: DataFrame) -> DataFrame:
    """Linked, diagnosed, with prior positives; kept if diagnosed or ultrasound; duplicates resolved.

    Where exams have an ``endpoint``, it is cleared but for ultrasound, an ultrasound row without one goes, and
    ``study_id`` is its last part.
    """
    return final_tables(exams, path)["exams"]


def final_tables(exams: DataFrame, path: DataFrame) -> dict[str, DataFrame]:
    """``exams``, and ``lesions``: the pathology rows of the accessions that stay, with the cancer type that their
    ``lesion_diag`` names."""
    timeline = cut(link_timeline(exams, path))  # counted, diagnosed and, for the lesions, read again
    absent = {c: F.lit(None).cast("string") for c in ("encounter_id", "concordance", "a1_category", "a2_category") if c not in timeline.columns}
    rows = diagnose(timeline.withColumns(absent))
    positive = F.coalesce(F.greatest(*[F.coalesce(F.col(f"{s}_diagnosis").startswith("MALIGNANT"), F.lit(False)) for s in ("left", "right")]), F.lit(False))
    rows = W.prior_flag(rows, "patient_id", "ts", "accession_number", positive, "study_laterality").where("kind = 'exam'")
    rows = cut(rows)  # the diagnoses are long expressions, which the next filters would take over each
    placed = ["endpoint"] if "endpoint" in exams.columns else []
    kept = P.keep_or_mask(rows, ["left_diagnosis", "right_diagnosis"], "modality", "US", placed)
    kept = G.resolve_duplicates(W.dealt_by(kept, "accession_number"), "accession_number", "modality", ["ts"])
    if placed:
        kept = kept.where(~(P.holds(P.contains_ci(F.col("modality"), "US")) & F.col("endpoint").isNull())).withColumn("study_id", H.path_part(F.col("endpoint"), -1))
    kept = P.drop_unlabelled(kept, ["left_diagnosis", "right_diagnosis"], F.col("is_biopsy") == "T")
    out = {"exams": kept}
    if "lesion_diag" in path.columns:
        lesions = timeline.where((F.col("kind") == "path") & F.col("lesion_diag").isNotNull())
        out["lesions"] = J.semi(lesions, kept, "accession_number").withColumn("cancer_type", H.first_unnegated(F.col("lesion_diag")))
    return out


UNNUMBERED = "anon-" + "0" * 12


def _shape(c: Column) -> Column:
    """An id with zeros for its digits; ids without digits share one shape."""
    return F.when(c.rlike("[0-9]"), F.regexp_replace(c, "[0-9]", "0")).otherwise(F.lit(UNNUMBERED))


def pseudonym_table(ids: DataFrame, column: str, secret: str, known: DataFrame | None = None) -> DataFrame:
    """(id, pseudonym), one to one: the id with other digits, by the rank of its keyed hash; known ids keep theirs.

    Letters, hyphens and their places stay, as they make the id's shape; ranks are counted within a shape, which has no
    more ids than its digits have values. An id without digits becomes a number. Ranks come from range partitions, not
    from one sorted task.
    """
    new = ids.select(F.col(column).cast("string").alias("id")).where("id IS NOT NULL").distinct()
    if known is not None:
        new = new.join(known, "id", "left_anti")
    new = new.withColumns({"shape": _shape(F.col("id")), "h": F.sha2(F.concat(F.lit(secret), F.lit(":"), F.col("id")), 256)})
    ranked = W.with_row_id(new, ["shape", "h", "id"], "row")
    before = ranked.groupBy("shape").agg(F.min("row").alias("first")).withColumn("taken", F.lit(0).cast("long"))
    if known is not None:
        used = known.groupBy(_shape(F.col("pseudonym")).alias("shape")).agg(F.count("*").alias("taken"))
        before = before.drop("taken").join(used, "shape", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    parts = F.split("shape", "0", -1)
    number = F.lpad((F.col("row") - F.col("first") + F.col("taken")).cast("string"), F.size(parts) - 1, "0")
    # a digit after each part of the shape but the last
    filled = F.array_join(F.zip_with(parts, F.split(number, ""), lambda p, d: F.concat(p, F.coalesce(d, F.lit("")))), "")
    fresh = ranked.join(before, "shape").select("id", filled.alias("pseudonym"))
    return fresh if known is None else known.unionByName(fresh)


def pseudonymise(df: DataFrame, mapping: DataFrame, columns: Sequence[str], months: Sequence[str] = (), labels: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """Ids by the mapping, dates to months, evidence ranks off labels, other columns out."""
    out = df.drop(*drop)
    for c in columns:
        m = mapping.select(F.col("id").alias("_id"), F.col("pseudonym").alias("_p"))
        out = out.join(m, out[c].cast("string") == m["_id"], "left").withColumn(c, F.col("_p")).drop("_id", "_p")
    return out.withColumns({**{c: V.month_start(F.col(c).cast("string")) for c in months}, **{c: H.strip_evidence_rank(F.col(c)) for c in labels}})


def load_entities(studies: DataFrame, images: DataFrame, present: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Studies that have images and are not there yet, and the images of loaded or present studies."""
    fresh = J.anti(J.semi(studies, images, "accession_number"), present, "accession_number")
    keys = fresh.select("accession_number").unionByName(present.select("accession_number"))
    return fresh, J.semi(images, keys, "accession_number")


def load_job(studies: DataFrame, images: DataFrame, present: DataFrame, videos: DataFrame | None = None) -> tuple[DataFrame, ...]:
    """All studies of patients that have images or videos, flagged by what their diagnoses say, and the images of
    patients that are not there yet, of known studies only, with the side of their study where they have none; with
    ``videos`` (as images), those of the same patients and studies too.

    studies: patient_id, accession_number, study_laterality, left_diagnosis, right_diagnosis. images: patient_id,
    accession_number, image_name, laterality. present: patient_id, accession_number of what is loaded.
    """
    says = lambda word: F.coalesce(F.col("left_diagnosis").contains(word), F.lit(False)) | F.coalesce(F.col("right_diagnosis").contains(word), F.lit(False))
    files = [images] if videos is None else [images, videos]
    owners = files[0].select("patient_id") if videos is None else images.select("patient_id").unionByName(videos.select("patient_id"))
    kept = J.semi(studies, owners, "patient_id").withColumns({"has_malignant": says("MALIGNANT"), "has_benign": says("BENIGN")})
    known = kept.select("accession_number").unionByName(present.select("accession_number"))
    sides = studies.groupBy("accession_number").agg(F.min("study_laterality").alias("laterality"))
    fresh = lambda df: J.semi(J.anti(J.semi(df, studies, "patient_id"), present, "patient_id"), known, "accession_number")
    return kept, *[J.fill_null_from(fresh(df), sides, "accession_number", "laterality") for df in files]


def select_new_files(files: DataFrame, cohort: DataFrame, done: DataFrame) -> DataFrame:
    """Files (path, hash) once per hash, ids from the folder name, in the cohort, not done yet.

    What is done goes first, all files of its hash, so that it neither is sorted nor travels to the cohort.
    """
    once = W.first_by(J.anti(files, done, "hash"), ["hash"], ["path"])
    ids = F.split(H.path_part(F.col("path"), -2), "_")
    named = once.withColumns({"patient_id": F.try_element_at(ids, F.lit(1)), "accession_number": F.try_element_at(ids, F.lit(2))})
    return J.semi(named, cohort, ["patient_id", "accession_number"])


def image_attributes(images: DataFrame, caption: str, exams: DataFrame) -> DataFrame:
    """Caption attributes; the side of a one-sided exam overrides the caption's."""
    x = H.caption_attributes(F.col(caption))
    rows = images.withColumn("_x", x).join(exams.select("accession_number", "study_laterality"), "accession_number", "left")
    known = F.when(F.col("study_laterality").isin(*SIDES), F.lower("study_laterality"))
    return rows.withColumns({n: F.col(f"_x.{n}") for n in ("area", "orientation", "clock_pos", "nipple_dist")} | {"laterality": F.coalesce(known, F.col("_x.laterality"))}).drop("_x")


def image_quality_filters(images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C11: kept images and rejects with their first reason."""
    return P.exclude_first(
        images,
        [
            ("no_crop", F.col("crop_w").isNull() | F.col("crop_h").isNull()),
            ("dark", F.col("darkness") > 75),
            ("other_area", F.col("area") == "AXILLA"),
            ("unknown_side", F.col("laterality").isNull()),
            ("many_regions", F.col("region_count") > 1),
            ("aspect", ~F.coalesce(V.aspect(F.col("crop_w"), F.col("crop_h")).between(0.5, 4), F.lit(False))),
        ],
    )


def match_and_type_lesions(images: DataFrame, described: DataFrame) -> DataFrame:
    """Of each image the best described lesion with its type."""
    best = J.best_match(J.match_lesions(images, described.select("accession_number", "lesion_id", "d_clock", "d_distance")))
    return best.join(described.select("lesion_id", H.first_rule_label(F.col("description")).alias("lesion_type")), "lesion_id")


def export_dataset(images: DataFrame, exams: DataFrame, spec: ExportSpec) -> DataFrame:
    """One row per exam side with its images, exclusions applied, split by patient."""
    kept = images.withColumn("excluded", P.exclusion_reasons(rules(spec))).where("excluded IS NULL")
    gathered = kept.groupBy("accession_number").agg(F.array_join(F.sort_array(F.collect_list("image_name")), "|").alias("images"), F.count("*").alias("n_images"), F.mode("scanner", True).alias("scanner"))
    sided = G.split_sides_for_export(exams.withColumnRenamed("study_laterality", "laterality"), split=spec.split_bilateral, keep_unknown=spec.keep_unknown_side)
    out = sided.join(gathered, "accession_number")
    split = K.hash_split(F.col("patient_id"), spec.test_share, spec.validation_share)
    return out.withColumns({"split": split, "mini": K.mini_split(F.col("patient_id"), spec.mini_share, spec.seed)})


def export_tables(images: DataFrame, exams: DataFrame, lesions: DataFrame, path: DataFrame, spec: ExportSpec, videos: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of a release, cut to what the specification keeps: images, breasts (exam sides, with ``labelled``),
    lesions, pathology, and breasts_mini; every one has its patient's split. ``videos`` are released as they are."""
    split = K.hash_split(F.col("patient_id"), spec.test_share, spec.validation_share)
    patients = exams.select("accession_number", "patient_id", split.alias("split"))
    kept = images.withColumn("excluded", P.exclusion_reasons(rules(spec))).where("excluded IS NULL").drop("excluded")
    kept = J.attach(kept, patients, ["accession_number"], ["patient_id", "split"]).where("patient_id IS NOT NULL")
    breasts = export_dataset(images, exams, spec)
    labelled = path.where(F.col("path_interpretation").isin(*BENIGN_MALIGNANT)).select("patient_id", F.col("path_laterality").alias("laterality")).distinct().withColumn("labelled", F.lit(True))
    breasts = breasts.join(labelled, ["patient_id", "laterality"], "left").withColumn("labelled", F.coalesce("labelled", F.lit(False)))
    cases = breasts.select("patient_id", "split").distinct()
    return {
        "images": kept,
        "breasts": breasts,
        "lesions": lesions.join(kept.select("image_name", "split"), "image_name"),
        "pathology": path.join(cases, "patient_id"),
        "breasts_mini": breasts.where("mini"),
    } | ({} if videos is None else {"videos": videos})


def audit_report(exams: DataFrame, images: DataFrame) -> DataFrame:
    """C14: long table of counts: modalities, sides, scanners, images an exam, splits by side, device years."""
    n = lambda df, key, c: df.groupBy(F.concat(F.lit(key), F.coalesce(F.col(c).cast("string"), F.lit("none"))).alias("key")).agg(F.count("*").alias("value"))
    sizes = A.per_group_stats(images, "accession_number").select(F.expr("stack(3, 'images.groups', groups, 'images.least', least, 'images.most', most) AS (key, value)"))
    matrix = exams.groupBy(F.concat_ws(".", F.lit("split"), K.hash_split(F.col("patient_id")), F.coalesce("study_laterality", F.lit("none"))).alias("key")).agg(F.count("*").alias("value"))
    years = images.agg(F.min(F.year("acquired")).alias("a"), F.max(F.year("acquired")).alias("b")).select(F.expr("stack(2, 'images.first_year', CAST(a AS BIGINT), 'images.last_year', CAST(b AS BIGINT)) AS (key, value)"))
    out = n(exams, "modality.", "modality")
    for part in (n(exams, "side.", "study_laterality"), n(images, "scanner.", "scanner"), sizes, matrix, years):
        out = out.unionByName(part)
    return out


# Words of a density description by category, the first category wins.
DENSITIES = (("entirely_fatty", "entirely fatty"), ("fibroglandular", "fibroglandular"), ("heterogeneously", "heterogeneously"), ("extremely_dense", "extremely dense"))


def audit_breasts(exams: DataFrame) -> DataFrame:
    """C14: one-sided exams with a malignant or benign diagnosis of their side, by split, and exams by split and density.

    exams: patient_id, study_laterality, left_diagnosis, right_diagnosis, density_desc. Zero counts are rows too.
    """
    category = F.lit("unknown")
    for name, word in reversed(DENSITIES):
        category = F.when(F.lower("density_desc").contains(word), name).otherwise(category)
    rows = exams.select(K.hash_split(F.col("patient_id")).alias("split"), "study_laterality", "left_diagnosis", "right_diagnosis", F.coalesce(category, F.lit("unknown")).alias("density"))
    has = lambda s, d: (F.col("study_laterality") == s) & F.col(f"{s.lower()}_diagnosis").contains(d)
    counted = {f"{s.lower()}_{d.lower()}": F.count_if(has(s, d)) for s in reversed(SIDES) for d in BENIGN_MALIGNANT}
    counted |= {f"density_{c}": F.count_if(F.col("density") == c) for c in [*[n for n, _ in DENSITIES], "unknown"]}
    splits = exams.sparkSession.createDataFrame([("train",), ("val",), ("test",)], "split string")
    per = splits.join(rows.groupBy("split").agg(*[c.alias(n) for n, c in counted.items()]), "split", "left").fillna(0)
    long = per.unpivot(["split"], list(counted), "name", "value")
    return long.select(F.concat_ws(".", F.lit("export"), "split", "name").alias("key"), "value")


def dataset_stats(images: DataFrame, exams: DataFrame, steps: P.Rules, gold: DataFrame | None = None) -> DataFrame:
    """The funnel of the images, the sizes of the splits and, of each split, the gold labels (image_name, kind)."""
    funnel = A.funnel(images, steps).select(F.concat(F.lit("funnel."), "step").alias("key"), F.col("removed").alias("value"))
    splits = exams.groupBy(F.concat(F.lit("split."), K.hash_split(F.col("patient_id"))).alias("key")).agg(F.count("*").alias("value"))
    out = funnel.unionByName(splits)
    if gold is None:
        return out
    kept = images.withColumn("_x", P.exclusion_reasons(steps)).where("_x IS NULL").select("image_name", "accession_number")
    labels = gold.join(kept, "image_name").join(exams.select("accession_number", K.hash_split(F.col("patient_id")).alias("split")), "accession_number")
    return out.unionByName(labels.groupBy(F.concat_ws(".", F.lit("gold"), "split", "kind").alias("key")).agg(F.count("*").alias("value")))


def seed_annotations(lesions: DataFrame, masks: DataFrame) -> DataFrame:
    """What becomes of each mask (image_name): linked to the one annotation of its image's lesions, a fallback row
    without any, skipped with several."""
    skeletons = A.lesion_skeletons(lesions.withColumnRenamed("image_name", "lesion_id"))
    # an image's lesions of one place are one annotation, those of several places several
    views = skeletons.select(F.explode(F.split("source_ids", ",")).alias("image_name"), F.col("source_ids").alias("annotation"))
    found = views.groupBy("image_name").agg(F.count("*").alias("n"), F.min("annotation").alias("annotation"))
    joined = masks.join(found, "image_name", "left")
    outcome = F.when(F.col("n").isNull(), "fallback").when(F.col("n") == 1, "linked").otherwise("skipped")
    return joined.select("image_name", outcome.alias("outcome"), F.when(F.col("n") == 1, F.col("annotation")).alias("annotation"))


def seed_frame_views(frames: DataFrame, lesions: DataFrame, names_hold_exam: bool = False) -> DataFrame:
    """A view of each lesion annotation for every frame of the videos of its exam and side (null: both sides).

    frames: accession_number, frame_name, laterality. lesions as for ``lesion_skeletons``. An exam's pairs are made once each
    where its frames and lesions meet. ``names_hold_exam``: no frame name and no lesion id stands in two exams, so pairs with
    a name are not compared across exams; without it all pairs travel once more.
    """
    exam = "accession_number"
    skeletons = A.lesion_skeletons(lesions.repartition(exam)).where("NOT unplaced").select(exam, F.col("source_ids").alias("annotation"), "laterality")
    left = _sides(frames.where(F.col(exam).isNotNull()).repartition(exam), exam, "frame_name")
    right = _sides(skeletons, exam, "annotation").withColumnRenamed("_sides", "_of")
    same = F.col("_sides").isNull() | F.col("_of").isNull() | F.arrays_overlap("_sides", "_of")
    pairs = left.join(right, exam).where(same).select("annotation", "frame_name")
    if not names_hold_exam:
        return pairs.distinct()
    nameless = F.col("frame_name").isNull() & (F.col("annotation") == "")
    return pairs.where(~nameless).union(pairs.where(nameless).distinct())


def _sides(rows: DataFrame, *keys: str) -> DataFrame:
    """Each of the keys once, with its sides; null if a row of it has none, as that stands for all of them."""
    group = Window.partitionBy(*keys)
    sides = F.when(F.count("*").over(group) == F.count("laterality").over(group), F.collect_set("laterality").over(group))
    return rows.select(*keys, F.row_number().over(group.orderBy("laterality")).alias("_k"), sides.alias("_sides")).where("_k = 1").drop("_k")


def backfill_extractions(rows: DataFrame, key: str, text: str, column: str, results: DataFrame) -> DataFrame:
    """C17: rows that wait for ``column`` get the finished result of their text; an error fills nothing.

    results: text_hash, value, error.
    """
    good = results.where("error IS NULL").groupBy("text_hash").agg(F.min("value").alias("_value"))
    hashed = rows.withColumn("_hash", F.when(F.trim(text) != "", F.md5(text)))
    return hashed.join(good, hashed["_hash"] == good["text_hash"], "left").withColumn(column, F.coalesce(column, "_value")).select(*rows.columns)


def extraction_queue(rows: DataFrame, key: str, text: str, done: DataFrame) -> DataFrame:
    """C17: distinct texts that no row done so far has, with the number of rows that wait for each."""
    hashed = rows.where(F.trim(text) != "").withColumn("text_hash", F.md5(text))
    finished = J.semi(hashed, done, key).select("text_hash").distinct()
    return J.anti(hashed, finished, "text_hash").groupBy("text_hash").agg(F.min(key).alias("first_key"), F.count("*").alias("waiting"))


MAX_CLASSES = 1000


def em_rates(rows: DataFrame, group: str, cls: str, found: str, iterations: int = 100, tolerance: float = 1e-6) -> DataFrame:
    """Rate of each class from the totals of groups: share each group's total by the rates, sum by class, repeat.

    rows: one per instance with its group, class and 0/1 ``found``. The counts by (group, class) are made once and
    checkpointed; the rates are one row per class, of at most ``MAX_CLASSES``.
    """
    counts = rows.groupBy(group, cls).agg(F.count("*").alias("k"), F.sum(found).alias("f"))
    counts = counts.withColumn("total", F.sum("f").over(Window.partitionBy(group))).select(group, cls, "k", "total")
    # groups of the same composition and total act alike
    shape = counts.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(cls, "k"))).alias("mix"), F.max("total").alias("total"))
    shapes = shape.groupBy("mix", "total").agg(F.count("*").alias("weight")).withColumn("shape", F.struct("mix", "total"))
    cells = shapes.select("shape", "total", "weight", F.inline("mix"))
    cells = cut(cells)
    classes = cells.groupBy(cls).agg(F.sum(F.col("k") * F.col("weight")).alias("n"))
    sizes = {r[cls]: r.n for r in classes.limit(MAX_CLASSES + 1).collect()}
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"{cls} has more than {MAX_CLASSES} classes")
    rates = {c: 0.5 for c in sizes}
    for _ in range(iterations):
        pairs = F.create_map(*[F.lit(x) for kv in sorted(rates.items()) for x in kv])
        expected = cells.withColumn("e", F.col("k") * pairs[F.col(cls)])
        shared = expected.withColumn("share", F.col("e") * F.try_divide(F.col("total"), F.sum("e").over(Window.partitionBy("shape"))) * F.col("weight"))
        sums = {r[cls]: r.s or 0.0 for r in shared.groupBy(cls).agg(F.sum("share").alias("s")).collect()}
        new = {c: min(1.0, max(0.0, sums.get(c, 0.0) / sizes[c])) for c in sizes}
        gap = max((abs(new[c] - rates[c]) for c in new), default=0.0)
        rates = new
        if gap < tolerance:
            break
    return rows.sparkSession.createDataFrame([(c, float(r), int(sizes[c])) for c, r in rates.items()], [cls, "rate", "n"])


def assign_top(rows: DataFrame, group: str, key: str, rate: str, found: str) -> DataFrame:
    """The group's number of detections goes to its instances of the highest rate."""
    w = Window.partitionBy(group)
    rank = F.row_number().over(w.orderBy(F.col(rate).desc(), key))
    return rows.withColumn("assigned", rank <= F.sum(found).over(w))


def annotation_sample(images: DataFrame, masks: DataFrame, done: DataFrame, per_split: int, seed: int) -> DataFrame:
    """C20: images with a mask that are not annotated yet, some of each split."""
    free = J.anti(J.semi(images, masks, "image_name"), done, "image_name").withColumn("split", K.hash_split(F.col("accession_number")))
    return K.sample_per_class(free, "split", "image_name", per_split, seed)


def detector_table(images: DataFrame, lesions: DataFrame, share_with_calipers: float, seed: int) -> DataFrame:
    """Positives (images with lesions, some of those with calipers) and negatives, split at random by class."""
    positive = J.semi(images, lesions, "image_name").withColumn("positive", F.lit(1))
    marked = K.choose_fraction(positive.where("has_calipers = 1"), "scanner", "image_name", share_with_calipers, seed).where("chosen").drop("chosen")
    negative = J.anti(images, lesions, "image_name").withColumn("positive", F.lit(0))
    rows = G.union_all_by_name(positive.where("has_calipers = 0"), marked, negative)
    return K.random_split(rows, "image_name", 0.2, seed, ["positive"])
