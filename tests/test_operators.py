"""Operators on literal rows: edges, wrong-answer cases of the past, and plain loops where SQL has no twin."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import text as H
from cohortloom.operators import buckets as B
from cohortloom.operators import changes as G
from cohortloom.operators import joins as J
from cohortloom.operators import sampling as K
from cohortloom.operators import timeline as W
from cohortloom.operators import versions as V
from cohortloom.operators.lineage import new_path
from cohortloom.plans import cohort as C
from cohortloom.plans import evaluate as E
from cohortloom.sources import io
from cohortloom.streaming import streams as M


def one(spark, texts, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in rows.select("i", column(F.col("t")).alias("x")).orderBy("i").collect()]


CATEGORY = [
    ("Invasive ductal carcinoma", "MALIGNANT"),
    ("NEGATIVE" + " " * 6 + "FOR CARCINOMA", "BENIGN"),
    ("negative\n\n   for\tmalignancy", "BENIGN"),
    ("no   evidence      of residual tumor", "BENIGN"),
    ("free" + " " * 30 + "of carcinoma", "BENIGN"),
    ("absence        of DCIS", "BENIGN"),
    ("not        diagnostic for carcinoma; gross only as described", "BENIGN"),
    ("no carcinoma; " + "x" * 60 + " dcis", "MALIGNANT"),
    ("negative for carcinoma" + " " * 60 + "carcinoma", "MALIGNANT"),
    ("negative" + " " * 45 + "for x carcinoma", "MALIGNANT"),
    ("lobular carcinoma in situ", "BENIGN"),
    ("lobular       carcinoma in - situ", "BENIGN"),
    ("lobular carcinoma", "MALIGNANT"),
    ("ductal carcinoma in situ", "MALIGNANT"),
    ("fat  necrosis", "BENIGN"),
    ("skin", "UNKNOWN"),
    (None, "UNKNOWN"),
    ("", "UNKNOWN"),
]


def test_path_category(spark):
    assert one(spark, [t for t, _ in CATEGORY], H.path_category) == [x for _, x in CATEGORY]


TYPES = [
    ("invasive grade 2 ductal carcinoma", "INVASIVE DUCTAL CARCINOMA"),
    ("no" + " " * 12 + "evidence of carcinoma", "BENIGN"),
    ("ruled" + " " * 9 + "out: carcinoma. sarcoma", "UNKNOWN"),
    ("ruled out: carcinoma." + " " * 100 + "sarcoma", "OTHER"),
    ("metastatic carcinoma", "METASTATIC CARCINOMA"),
    ("metastatic adenocarcinoma", "ADENOCARCINOMA"),
    ("squamous cell carcinoma", "CARCINOMA"),
    ("carcinosarcoma", "OTHER"),
    ("melanoma", "OTHER"),
    ("LCIS", "LOBULAR CARCINOMA IN SITU"),
    ("negative margin", "BENIGN"),
    ("skin", "UNKNOWN"),
    (None, "UNKNOWN"),
]


def test_cancer_types(spark):
    assert one(spark, [t for t, _ in TYPES], H.first_unnegated) == [x for _, x in TYPES]


def test_every_cancer_type_and_negation(spark):
    """Each rule's own wording has its type unless an earlier rule has it; each negation before it takes it away."""
    words = {p: re.sub(r"\(\?:([^|()]*)\|?[^()]*\)", r"\1", p).replace(r"\s+", " ").replace(r"\b", "").replace("S?", "S").replace("GRADE \\d+.*?", "") for p, _ in H.CANCER_TYPES}
    words[H.CANCER_TYPES[0][0]] = "INVASIVE DUCTAL CARCINOMA"
    first = lambda t: next(n for p, n in H.CANCER_TYPES if re.search(p, t))
    texts = list(words.values())
    assert one(spark, texts, H.first_unnegated) == [first(t) for t in texts]
    negations = ["NEGATIVE FOR ", "NO EVIDENCE OF ", "FREE OF ", "ABSENCE OF ", "NO ", "WITHOUT ", "RULED OUT ", "EXCLUDE "]
    negated = [f"{n.replace(' ', '       ')}{t}" for n in negations for t in ("SARCOMA", "MUCINOUS CARCINOMA")]
    assert set(one(spark, negated, H.first_unnegated)) <= {"UNKNOWN", "BENIGN"}


def test_lexicon_negations_over_blanks(spark):
    texts = ["not      seen: spiculated mass", "free        of oval mass", "negative\n\n\n\n for round mass", "not seen. spiculated mass", "a spiculated oval mass"]
    got = one(spark, texts, H.lexicon_features)
    assert [(x.margin, x.shape) for x in got] == [(None, None), (None, None), (None, None), ("spiculated", None), ("spiculated", "oval")]


def test_scrubber_goes_step_by_step(spark):
    texts = ["ok Electronically signed by A", "ok Electronically signed A", "Seen. Signed by B", "at 10:11:12 on March 3 or 1/2/2003 in 1999", None]
    want = ["ok Electronically [SIGNATURE SECTION REMOVED]", "ok [SIGNATURE SECTION REMOVED]", "Seen. [SIGNATURE SECTION REMOVED]", "at [TIME REMOVED] on [DATE REMOVED] or [DATE REMOVED] in [YEAR REMOVED]", None]
    assert one(spark, texts, H.scrub_text) == want
    assert len(H.SCRUB) == 22


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text('B,A,more\n007,"x, y",1\n,"say ""hi""",2\n')
    rows = io.read_csv_typed(spark, str(tmp_path / "x.csv"), "a string, b string").collect()
    assert [(r.a, r.b) for r in rows] == [("x, y", "007"), ('say "hi"', None)]
    assert [r.b for r in io.read_csv_typed(spark, str(tmp_path / "x.csv"), "b int").collect()] == [7, None]
    with pytest.raises(ValueError, match="no column c"):
        io.read_csv_typed(spark, str(tmp_path / "x.csv"), "a string, c int")


def test_pseudonyms_are_one_to_one(spark):
    rng = random.Random(1)
    ids = {"A1B", "A2B", "abc", "abd", "12-34", "IDMPROD30048230", "0", "00", "7", "", "anon-000000000001", "ä9ß"}
    ids |= {f"{rng.randrange(10)}-{rng.randrange(10)}" for _ in range(90)} | {f"P{rng.randrange(200):03d}" for _ in range(150)} | {str(x) for x in range(10)}
    ids = sorted(ids)
    table = spark.createDataFrame([(x,) for x in [*ids, None, *ids[:5]]], "id string")
    first = C.pseudonym_table(table.where("length(id) < 4"), "id", "secret")
    got = {r.id: r.pseudonym for r in C.pseudonym_table(table, "id", "secret", first).collect()}
    assert sorted(got) == ids and len(set(got.values())) == len(ids)
    assert {r.id: r.pseudonym for r in first.collect()}.items() <= got.items()
    for i, p in got.items():
        if re.search("[0-9]", i):
            assert re.sub("[0-9]", "0", p) == re.sub("[0-9]", "0", i)
        else:
            assert p != i and p.startswith("anon-")


def test_publish_is_a_compare_and_swap(spark):
    root = new_path(spark, "versions")
    assert G.current_version(spark, root) == 0
    df = spark.range(3)
    assert G.publish(df, root, 0) == 1
    with pytest.raises(V.StaleVersion):
        G.publish(df, root, 0)
    with pytest.raises(V.StaleVersion):  # another writer came between look and write
        V.add_entry(spark, root, 1, {"folder": "elsewhere"})
    assert G.publish(df.limit(1), root, 1) == 2
    assert G.read_version(spark, root).count() == 1 and G.read_version(spark, root, 1).count() == 3


def test_late_older_rows_do_not_displace_newer_ones(spark):
    root, path = new_path(spark, "table"), new_path(spark, "stream")
    for k, rows in enumerate(([(1, 5, "new"), (2, 1, "a")], [(1, 3, "late"), (2, 2, "b"), (3, 1, "c")])):
        spark.createDataFrame(rows, "id long, at long, v string").coalesce(1).write.mode("append").parquet(path)
        M.stream_upsert(M.arrivals(spark, path, "id long, at long, v string"), root, ["id"], "at", f"{root}-chk").awaitTermination()
    assert {r.id: r.v for r in B.read(spark, root).collect()} == {1: "new", 2: "b", 3: "c"}


def test_dedupe_within_watermark_and_link_with_late_rows(spark):
    ts = lambda d: datetime(2024, 1, d)
    path = new_path(spark, "stream")
    for rows in ([(1, ts(1)), (1, ts(1)), (2, ts(20))], [(1, ts(1)), (3, ts(21))]):
        spark.createDataFrame(rows, "id long, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    stream = M.arrivals(spark, path, "id long, ts timestamp")
    out = M.run_to_table(M.stream_dedupe(stream, ["id"], "ts"), new_path(spark, "out"), new_path(spark, "chk"))
    assert sorted(r.id for r in out.collect()) == [1, 2, 3]


def test_running_totals_and_samples(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(7)
    got = {r.k: r for r in W.running_totals(df, ["g"], [F.col("v").desc(), "k"], {"s": F.col("v"), "n": F.lit(1)}).collect()}
    for g in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        total = 0
        for n, r in enumerate(own, 1):
            total += r[2]
            assert (got[r[1]].s, got[r[1]].n, got[r[1]].n_all, got[r[1]].s_all) == (total, n, len(own), sum(x[2] for x in own))
    again = {r.k for r in K.sample_per_class(df.repartition(3), "g", "k", 20, 9).collect()}
    assert again == {r.k for r in K.sample_per_class(df, "g", "k", 20, 9).collect()} and len(again) == 60
    split = K.random_split(df, "k", 0.2, 1, ["g"])
    assert {r.k: r.split for r in split.collect()} == {r.k: r.split for r in K.random_split(df.orderBy("v"), "k", 0.2, 1, ["g"]).collect()}
    under = K.rebalance(df.where("g IS NOT NULL"), "g", "k", "under", 4).groupBy("g").count().collect()
    assert len({r["count"] for r in under}) == 1


def test_links_by_stretches_equal_loops(spark):
    rng = random.Random(3)
    exams = [(rng.randrange(6), i, datetime.fromordinal(738000 + rng.randrange(1500)), rng.choice(["LEFT", "RIGHT", "BILATERAL", None])) for i in range(120)]
    path = [(rng.randrange(6), 1000 + i // 2, datetime.fromordinal(738000 + rng.randrange(1500)), rng.choice(["LEFT", "RIGHT", None])) for i in range(120)]
    e = spark.createDataFrame(exams, "patient_id long, accession_number long, exam_ts timestamp, study_laterality string")
    p = spark.createDataFrame(path, "patient_id long, path_accession long, path_ts timestamp, path_laterality string")

    def match(a, b):
        return "same_side" if a and a == b else "bilateral_exam" if a == "BILATERAL" else "unknown_side" if a is None or b is None else "other_side"

    want = {}
    for q, i, ts, side in exams:
        for r, j, pts, pside in path:
            if q == r and 0 <= (pts - ts).days <= 240:
                new = ((pts - ts).days, match(side, pside))
                want[i, j] = min(want.get((i, j), new), new)
    got = {(r.accession_number, r.path_accession): (r.days, r.match) for r in J.link_all_in_window(e, p, 240).collect()}
    assert got == want and len(want) > 50
    ev = e.select("patient_id", F.col("accession_number").alias("event_id"), F.col("exam_ts").alias("event_ts"))
    pt = spark.createDataFrame([(a, k, c, d) for k, (a, _, c, d) in enumerate(path)], "patient_id long, path_id long, path_ts timestamp, path_side string")
    linked = J.link_events_asof(ev, pt, e.toDF("patient_id", "exam_id", "exam_ts", "exam_side")).collect()
    want = {}
    for q, i, ts, _ in exams:
        for k, (r, _, pts, side) in enumerate(path):
            if q == r and -1 <= (pts - ts).days <= 180:
                before = [(x[2], x[1]) for x in exams if x[0] == q and x[2] < ts and side is not None and x[3] in (side, "BILATERAL")]
                want[i, k] = max(before)[1] if before else None
    assert {(r.event_id, r.path_id): r.exam_id for r in linked} == want and len(linked) == len(want)
    assert any(x is not None for x in want.values())


def test_load_backfill_and_frame_views(spark):
    studies = spark.createDataFrame([(1, 10, "LEFT", "MALIGNANT1", None), (1, 11, None, None, "BENIGN2"), (2, 20, "RIGHT", None, None), (3, 30, "LEFT", None, None)], "patient_id long, accession_number long, study_laterality string, left_diagnosis string, right_diagnosis string")
    images = spark.createDataFrame([(1, 10, "a", None), (1, 99, "b", "LEFT"), (2, 20, "c", "LEFT"), (9, 90, "d", None)], "patient_id long, accession_number long, image_name string, laterality string")
    present = spark.createDataFrame([(2, 20)], "patient_id long, accession_number long")
    kept, new = C.load_job(studies, images, present)
    assert sorted((r.accession_number, r.has_malignant, r.has_benign) for r in kept.collect()) == [(10, True, False), (11, False, True), (20, False, False)]
    assert [(r.image_name, r.laterality) for r in new.collect()] == [("a", "LEFT")]
    rows = spark.createDataFrame([(1, "x", None), (2, "x", "own"), (3, "y", None), (4, " ", None), (5, None, None)], "id long, text string, value string")
    results = spark.createDataFrame([("x", "done", None), ("y", "half", "failed"), (" ", "blank", None)], "text string, value string, error string").select(F.md5("text").alias("text_hash"), "value", "error")
    assert {r.id: r.value for r in C.backfill_extractions(rows, "id", "text", "value", results).collect()} == {1: "done", 2: "own", 3: None, 4: None, 5: None}
    lesions = spark.createDataFrame([(1, 3, 2.0, "LEFT", 1.0, "p"), (1, 3, 2.0, "LEFT", 2.0, "q"), (1, 9, 2.0, None, 1.0, "r"), (1, None, 2.0, "LEFT", 1.0, "s")], "accession_number long, clock long, distance_cm double, laterality string, size_cm double, lesion_id string")
    frames = spark.createDataFrame([(1, "f1", "LEFT"), (1, "f2", "RIGHT"), (1, "f3", None), (2, "f4", None)], "accession_number long, frame_name string, laterality string")
    assert sorted(map(tuple, C.seed_frame_views(frames, lesions).collect())) == [("p,q", "f1"), ("p,q", "f3"), ("r", "f1"), ("r", "f2"), ("r", "f3")]


def boxes(rng, n, image):
    out = []
    for i in range(n):
        x, y = rng.randrange(20), rng.randrange(20)
        out.append((image, f"{image}_{i}", float(x), float(y), float(x + rng.randint(5, 20)), float(y + rng.randint(5, 20)), rng.randrange(10) / 10))
    return out


def overlap(a, b):
    w, h = max(0, min(a[4], b[4]) - max(a[2], b[2])), max(0, min(a[5], b[5]) - max(a[3], b[3]))
    return round(w * h / ((a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - w * h), 6)


def brute_greedy(pred, truth, least):
    keep, used = [], set()
    for p in sorted(pred, key=lambda p: (-p[6], p[1])):
        options = sorted((-overlap(p, t), t[1]) for t in truth if t[0] == p[0] and t[1] not in used and overlap(p, t) >= least)
        if options:
            used.add(options[0][1])
            keep.append((p[1], options[0][1]))
    return set(keep)


def test_detection_matches_equal_loops(spark):
    rng = random.Random(4)
    pred, truth = ([b for image in range(25) for b in boxes(rng, rng.randrange(0, 9), image)] for _ in range(2))
    schema = "image_id long, box_id string, x1 double, y1 double, x2 double, y2 double, score double"
    p, t = spark.createDataFrame(pred, schema), spark.createDataFrame([(i, f"t{b}", *rest) for i, b, *rest in truth], schema)
    truth = [(i, f"t{b}", *rest) for i, b, *rest in truth]
    limits = [0.3, 0.5]
    got = E.greedy_matches(p, t, limits).collect()
    want = {x: brute_greedy(pred, truth, x) for x in limits}
    assert {x: {(r.box_id, r.gt_id) for r in got if r.limit == x} for x in limits} == want and want[0.5]
    m = E.detection_metrics(p, t, 0.5).first()
    tp = len(want[0.5])
    assert (m.tp, m.fp, m.fn) == (tp, len(pred) - tp, len(truth) - tp)
    assert m.precision == round(tp / len(pred), 6) and m.recall == round(tp / len(truth), 6)
    aps = {}
    for x in limits:
        hits = {b for b, _ in want[x]}
        curve, tp = [], 0
        for n, b in enumerate(sorted(pred, key=lambda b: (-b[6], b[1])), 1):
            tp += b[1] in hits
            curve.append((tp / len(truth), tp / n))
        aps[x] = round(sum(max((pr for re_, pr in curve if re_ >= i / 10), default=0) for i in range(11)) / 11, 6)
    found = {r.limit: r.ap for r in E.mean_average_precision(p, t, limits).collect()}
    assert {x: found[x] for x in limits} == aps and abs(found[None] - sum(aps.values()) / 2) < 1e-5


def test_em_rates_equal_loops(spark):
    rng = random.Random(5)
    rows = [(g, rng.choice("abc"), int(rng.random() < 0.4)) for g in range(80) for _ in range(rng.randint(1, 5))]
    got = {r.c: (r.rate, r.n) for r in C.em_rates(spark.createDataFrame(rows, "g long, c string, f int"), "g", "c", "f").collect()}
    totals, rates = {}, {c: 0.5 for c in "abc"}
    for g, _, f in rows:
        totals[g] = totals.get(g, 0) + f
    for _ in range(100):
        weight, sums = {}, {c: 0.0 for c in "abc"}
        for g, c, _ in rows:
            weight[g] = weight.get(g, 0) + rates[c]
        for g, c, _ in rows:
            sums[c] += rates[c] * totals[g] / weight[g] if weight[g] else 0
        new = {c: min(1, max(0, sums[c] / sum(x == c for _, x, _ in rows))) for c in "abc"}
        gap = max(abs(new[c] - rates[c]) for c in new)
        rates = new
        if gap < 1e-6:
            break
    assert {c: n for c, (_, n) in got.items()} == {c: sum(x == c for _, x, _ in rows) for c in "abc"}
    assert all(abs(got[c][0] - rates[c]) < 1e-9 for c in rates)


def test_override_audit_equals_loops(spark):
    rng = random.Random(6)
    values = [None, "BENIGN1", "MALIGNANT0", "MALIGNANT2"]
    rows = []
    for _ in range(200):
        row = []
        for _ in range(2):
            prior = rng.choice(values)
            row += [prior, rng.choice(["BENIGN4", "MALIGNANT4"]) if rng.random() < 0.4 else prior]
        rows.append(tuple(row))
    want = {}
    for left_prior, left, right_prior, right in rows:
        for side, old, new in (("left", left_prior, left), ("right", right_prior, right)):
            if new and new.endswith("4"):
                change = "filled_empty" if old is None else "equivalent" if old[:3] == new[:3] else "disagreement"
                want[side, change] = want.get((side, change), 0) + 1
    found = C.override_audit(spark.createDataFrame(rows, "left_prior string, left_diagnosis string, right_prior string, right_diagnosis string"))
    assert {(r.side, r.change): r.n for r in found.collect()} == want and len(want) == 6


def test_final_dataset_on_literal_rows(spark):
    """Links, rules, prior positives, duplicates and unlabelled biopsies in one small cohort."""
    day = lambda y, d: datetime.fromordinal(datetime(y, 1, 1).toordinal() + d)
    exams = [
        (1, 10, day(2020, 0), "LEFT", "4A", "F", "US"),
        (1, 11, day(2020, 10), "LEFT", None, "T", "US"),
        (1, 12, day(2021, 0), "LEFT", "2", "F", "US"),
        (2, 20, day(2020, 0), "RIGHT", "1", "F", "US"),
        (2, 21, day(2021, 0), "RIGHT", "1", "F", "MG"),
        (3, 30, day(2020, 0), "LEFT", None, "T", "MG"),
        (4, 40, day(2020, 0), "LEFT", "0", "F", "MG"),
    ]
    path = [(1, 900, day(2020, 12), "LEFT", "MALIGNANT")]
    e = spark.createDataFrame(exams, "patient_id long, accession_number long, exam_ts timestamp, study_laterality string, bi_rads string, is_biopsy string, modality string")
    p = spark.createDataFrame(path, "patient_id long, path_id long, path_ts timestamp, path_laterality string, path_interpretation string")
    linked = {(r.kind, r.path_id): r.accession_number for r in C.link_timeline(e, p).where("kind = 'path'").collect()}
    assert linked == {("path", 900): 10}
    got = {r.accession_number: r for r in C.final_dataset(e, p).collect()}
    assert got[10].left_diagnosis == "MALIGNANT2" and got[10].right_diagnosis is None
    assert not got[10].prior_positive and got[12].prior_positive
    assert got[20].right_diagnosis == "BENIGN1"
    assert 30 not in got and 40 not in got


def test_confusion_and_image_metrics_equal_loops(spark):
    rng = random.Random(14)
    pred, truth = ([(*b, rng.choice("xyz")) for image in range(30) for b in boxes(rng, rng.randrange(0, 6), image)] for _ in range(2))
    truth = [(i, f"t{b}", *rest) for i, b, *rest in truth]
    schema = "image_id long, box_id string, x1 double, y1 double, x2 double, y2 double, score double, cls string"
    p, t = spark.createDataFrame(pred, schema), spark.createDataFrame(truth, schema)
    hits = brute_greedy(pred, truth, 0.4)
    cls = {b[1]: b[7] for b in pred + truth}
    want = {}
    for pair in [(cls[g], cls[b]) for b, g in hits] + [("background", b[7]) for b in pred if b[1] not in dict(hits)] + [(b[7], "background") for b in truth if b[1] not in {g for _, g in hits}]:
        want[pair] = want.get(pair, 0) + 1
    assert {(r.true_class, r.pred_class): r.n for r in E.confusion_matrix(p, t, 0.4).collect()} == want and len(want) > 10
    per = {i: [sum(b[0] == i for b in truth), sum(b[0] == i for b in pred), sum(b.startswith(f"{i}_") for b, _ in hits)] for i in range(32)}
    got = E.image_metrics(spark.range(32).withColumnRenamed("id", "image_id"), p, t, 0.4).first()
    fp = sum(n - k > 0 for _, n, k in per.values())
    assert (got.images, got.with_gt, got.with_pred, got.with_fp) == (32, sum(g > 0 for g, _, _ in per.values()), sum(n > 0 for _, n, _ in per.values()), fp)
    assert got.with_fn == sum(g - k > 0 for g, _, k in per.values()) and got.true_negative == sum(g == n == 0 for g, n, _ in per.values())
    assert got.fpr_image == round(fp / (32 - got.with_gt), 6) and got.gt_per_image == round(len(truth) / 32, 6)


def test_final_tables_have_study_ids_and_cancer_types(spark):
    day = lambda d: datetime.fromordinal(datetime(2020, 1, 1).toordinal() + d)
    exams = [
        (1, 10, day(0), "LEFT", "4A", "F", "US", "https://a/studies/s10"),
        (1, 11, day(10), "LEFT", None, "T", "US", "https://a/studies/s11"),
        (2, 20, day(0), "RIGHT", "1", "F", "US", None),  # ultrasound without an endpoint goes
        (3, 30, day(0), "LEFT", "4A", "F", "MG", "https://a/studies/s30"),  # diagnosed, its endpoint is cleared
        (3, 31, day(5), "LEFT", None, "T", "MG", None),
    ]
    path = [(1, 900, day(12), "LEFT", "MALIGNANT", "A. invasive lobular carcinoma"), (3, 901, day(7), "LEFT", "BENIGN", "A. fibroadenoma"), (9, 902, day(7), "LEFT", "BENIGN", "A. cyst")]
    e = spark.createDataFrame(exams, "patient_id long, accession_number long, exam_ts timestamp, study_laterality string, bi_rads string, is_biopsy string, modality string, endpoint string")
    p = spark.createDataFrame(path, "patient_id long, path_id long, path_ts timestamp, path_laterality string, path_interpretation string, lesion_diag string")
    found = C.final_tables(e, p)
    got = {r.accession_number: r for r in found["exams"].collect()}
    assert got[10].study_id == "s10" and 20 not in got and got[30].endpoint is None and got[30].study_id is None and got[30].left_diagnosis == "BENIGN2"
    lesions = {r.path_id: (r.accession_number, r.cancer_type) for r in found["lesions"].collect()}
    assert lesions[900][0] == 10 and "LOBULAR" in lesions[900][1].upper() and lesions[901][0] == 30 and 902 not in lesions


def test_clean_exam_windows_equal_loops(spark):
    """Worst earlier scores, days to biopsies, guidance from biopsies near, and prior biopsies, patient by patient."""
    from cohortloom.plans.jobs import raw_reports
    from cohortloom.registry import Tables

    rows = C.clean_exams(raw_reports(Tables(spark, "/root/testdata/sf0.001"))).collect()
    ranks = {s: i for i, s in enumerate(C.RANKS)}
    day = lambda a, b: (a - b).days
    patients, seen = {}, set()
    for r in rows:
        patients.setdefault(r.patient_id, []).append(r)
    for own in patients.values():
        own.sort(key=lambda r: (r.exam_ts, r.accession_number))
        biopsies = [r for r in own if r.is_biopsy == "T"]
        for i, r in enumerate(own):
            worst = {}
            for side in ("LEFT", "RIGHT"):
                scored = [(ranks[e.bi_rads], -k, e.accession_number) for k, e in enumerate(own[:i]) if e.bi_rads is not None and e.study_laterality in (side, "BILATERAL")]
                worst[side] = max(scored) if scored else None
                prior = sum(e.is_biopsy == "T" and e.study_laterality in (side, "BILATERAL") for e in own[:i])
                assert prior == (r.prior_left if side == "LEFT" else r.prior_right)
            left, right = worst["LEFT"], worst["RIGHT"]
            best = {"LEFT": left, "RIGHT": right}.get(r.study_laterality, right if left is None or (right and right[0] > left[0]) else left)
            assert (r.worst_rank, r.worst_source) == ((best[0] + 1, best[2]) if best else (None, None))
            ahead, behind = [b.exam_ts for b in biopsies if b.exam_ts > r.exam_ts], [b.exam_ts for b in biopsies if b.exam_ts < r.exam_ts]
            here = any(b.exam_ts == r.exam_ts for b in biopsies)
            assert r.days_to_biopsy == (0 if here else day(min(ahead), r.exam_ts) if ahead else -day(r.exam_ts, max(behind)) if behind else None)
            near = [b for b in biopsies if -30 <= day(b.exam_ts, r.exam_ts) <= 120]
            want = "US" if r.description.startswith("US GUIDED") else "US" if near else None
            assert r.guidance == want
            seen |= {("worst", best is None), ("days", (r.days_to_biopsy or 0) > 0), ("guidance", want), ("prior", r.prior_right > 0)}
    assert len(seen) == 8


def test_a_polygon_s_centre_is_worked_out_once(spark):
    from cohortloom.functions import values

    df = spark.createDataFrame([([(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (0.0, 2.0)],), ([],), (None,)], "p array<struct<x:double,y:double>>").select(values.shrink(F.col("p"), 0.5).alias("s"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") <= 2
    assert [r.s and [tuple(p) for p in r.s] for r in df.collect()] == [[(1.0, 0.5), (3.0, 0.5), (3.0, 1.5), (1.0, 1.5)], [], None]


def test_matches_are_made_once_for_merging(spark):
    matched = spark.createDataFrame([("i", "d1", 1.0), ("i", "d1", 1.2), ("i", "d2", 9.0), ("j", "d3", 1.0), ("k", "d4", None), (None, "d5", 1.0)], "image_name string, description_id string, sizing_cm double")
    existing = spark.createDataFrame([("l2", "i", 1.1), ("l1", "i", 1.5), ("l3", "k", 1.0), ("l4", None, 1.0)], "lesion_id string, image_name string, measured_cm double")
    df = J.merge_lesions(existing, matched)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
    got = {(r.image_name, r.description_id): (r.action, r.lesion_id) for r in df.collect()}
    assert got == {("i", "d1"): ("update", "l1"), ("i", "d2"): ("create", None), ("j", "d3"): ("create", None), ("k", "d4"): ("create", None), (None, "d5"): ("create", None)}


def test_average_precision_orders_a_prediction_once_for_all_limits(spark, monkeypatch):
    box = lambda image, i, x, score: (image, f"b{i}", float(x), 0.0, x + 10.0, 10.0, score)
    schema = "image_id long, box_id string, x1 double, y1 double, x2 double, y2 double, score double"
    pred = spark.createDataFrame([box(i % 5, i, i % 7, i / 40) for i in range(40)], schema)
    truth = spark.createDataFrame([box(i, 100 + i, 2 + i, 0.0) for i in range(5)], schema)
    sizes, totals = [], W.running_totals
    monkeypatch.setattr(W, "running_totals", lambda df, *rest: sizes.append(df.count()) or totals(df, *rest))
    assert E.mean_average_precision(pred, truth, [0.3, 0.5, 0.7]).count() == 4
    assert sizes == [40]
    assert E.mean_average_precision(pred.where("false"), truth, [0.3, 0.5]).collect() == [(None, None)]


def test_ranges_of_running_totals_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(W, "PART_ROWS", 50, raising=False)
    df = spark.range(2000).select((F.col("id") % 2).alias("g"), "id")
    out = W.running_totals(df, ["g"], ["id"], {"n": F.lit(1)})
    assert max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()) <= 500
    assert out.where(F.col("n") != F.floor(F.col("id") / 2) + 1).isEmpty()


def test_done_files_go_before_the_others_are_sorted(spark):
    files = spark.createDataFrame([("/a/1_10/x.dcm", "x"), ("/b/1_10/x.dcm", "x"), ("/a/1_10/y.dcm", "y"), ("/b/2_20/z.dcm", "z"), ("/c/9_90/w.dcm", "w"), ("/a/1_10/n.dcm", None)], "path string, hash string")
    cohort = spark.createDataFrame([("1", "10"), ("2", "20")], "patient_id string, accession_number string")
    out = C.select_new_files(files, cohort, spark.createDataFrame([("y",)], "hash string"))
    assert sorted(map(tuple, out.select("path", "accession_number").collect())) == [("/a/1_10/n.dcm", "10"), ("/a/1_10/x.dcm", "10"), ("/b/2_20/z.dcm", "20")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("Window") < plan.index("LeftAnti")


def test_the_detector_table_carries_no_other_columns(spark, monkeypatch):
    from cohortloom.operators import sampling
    from cohortloom.plans import jobs
    from cohortloom.registry import Tables
    from conftest import SMALL

    seen, totals = [], sampling.running_totals
    monkeypatch.setattr(sampling, "running_totals", lambda df, *rest: seen.append(set(df.columns)) or totals(df, *rest))
    assert jobs.c21(Tables(spark, SMALL)).columns == ["image_name", "positive", "split"]
    assert seen and all(s <= {"image_name", "has_calipers", "scanner", "positive", "_h"} for s in seen)


def frame_views(frames, lesions):
    """By plain loops: a place's lesion ids in order, the side of the least id, and every frame of the exam and side."""
    places, out = {}, set()
    for exam, clock, distance, side, _, i in lesions:
        if None not in (exam, clock, distance):
            places.setdefault((exam, clock, distance), []).append((i, side))
    for (exam, _, _), rows in places.items():
        ids = ",".join(sorted({i for i, _ in rows if i is not None}))
        side = min(((i is not None, i or "", s) for i, s in rows if s is not None), default=(0, "", None))[2]
        out |= {(ids, name) for e, name, s in frames if e == exam and (s is None or side is None or s == side)}
    return out


@pytest.mark.parametrize("held", [True, False])
def test_frame_views_equal_loops(spark, held):
    rng = random.Random(5)
    sides = ["LEFT", "RIGHT", "BILATERAL", None]
    name = lambda e, kind: None if rng.random() < 0.2 else f"{e if held else 0}_{kind}{rng.randrange(4)}"
    exams = [rng.choice([*range(25), None]) for _ in range(300)]
    frames = [(e, name(e, "f"), rng.choice(sides)) for e in exams]
    lesions = [(e, rng.choice([3, 9, None]), rng.choice([1.0, 2.0, None]), rng.choice(sides[:2]), 1.0, name(e, "l")) for e in exams]
    # alike in all exams: one frame and one annotation without a name each, one of both sides' rows
    frames += [(e, None, None) for e in range(30, 33)] + [(40, "40_f", s) for s in ("LEFT", "RIGHT", "LEFT")]
    lesions += [(e, 3, 1.0, "LEFT", 1.0, None) for e in range(30, 33)] + [(40, c, 1.0, s, 1.0, "40_l") for c, s in ((1, "LEFT"), (2, "RIGHT"), (3, None))]
    df = C.seed_frame_views(
        spark.createDataFrame(frames, "accession_number long, frame_name string, laterality string"),
        spark.createDataFrame(lesions, "accession_number long, clock long, distance_cm double, laterality string, size_cm double, lesion_id string"),
        names_hold_exam=held,
    )
    got, want = [tuple(r) for r in df.collect()], frame_views(frames, lesions)
    assert len(got) == len(set(got)) and set(got) == want
    assert {("", None), ("40_l", "40_f")} <= want


def test_frame_views_are_not_dealt_by_pairs(spark):
    from cohortloom.plans import jobs
    from cohortloom.registry import Tables
    from conftest import SMALL

    df = jobs.c16b(Tables(spark, SMALL))
    assert len(df.collect()) > 10000
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert set(re.findall(r"hashpartitioning\((\w+)#", plan)) == {"accession_number"}
