from datetime import datetime, timedelta
import random

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import timeline as W
from cohortloom.operators import versions as V
from cohortloom.operators.lineage import new_path
from cohortloom.streaming import streams as M

START = datetime(2024, 1, 1)
EXAMS = "event_id long, patient_id long, ts timestamp, side string, score int, is_event boolean"


@pytest.fixture()
def rocks(spark):
    before = spark.conf.get(M.STATE_STORE)
    spark.conf.set(M.STATE_STORE, M.ROCKS)
    yield
    spark.conf.set(M.STATE_STORE, before)


def exam(i, patient, hours, side="LEFT", score=None, flagged=False):
    return (i, patient, START + timedelta(hours=hours), side, score, flagged)


def history(spark, batches, ttl=None):
    path, out, chk = (new_path(spark, x) for x in ("stream", "out", "chk"))
    seen, states = [], []
    for rows in batches:
        spark.createDataFrame(rows, EXAMS).repartition(2).write.mode("append").parquet(path)
        q = M.stream_patient_history(M.arrivals(spark, path, EXAMS, 1000), ttl).writeStream.format("parquet").option("checkpointLocation", chk).trigger(availableNow=True).start(out)
        q.awaitTermination()
        states.append(sum(s.numRowsTotal for s in q.lastProgress.stateOperators))
        seen.append({tuple(r) for r in spark.read.schema(M.HISTORY).parquet(out).collect()})
    return seen, states


def test_history_of_each_exam_equals_windows_over_all(spark, rocks):
    rng = random.Random(1)
    rows = [exam(i, rng.randrange(9), rng.randrange(24 * 40), rng.choice(["LEFT", "RIGHT", "BILATERAL", "OTHER", None]), rng.choice([None, 1, 2, 3, 4]), rng.random() < 0.4) for i in range(400)]
    arrives = sorted(rows, key=lambda r: r[2] + timedelta(hours=rng.uniform(0, 22)))  # never later than a day
    batches = [arrives[i : i + 60] for i in range(0, 400, 60)] + [[exam(-1, -1, 24 * 4000)]]
    seen, _ = history(spark, batches)
    df = spark.createDataFrame(rows, EXAMS)
    both = W.prior_counts(W.running_worst(df, "patient_id", "ts", "event_id", "side", "score", "event_id"), "patient_id", "ts", "event_id", F.col("is_event"), "side")
    want = {tuple(r) for r in both.select("event_id", "patient_id", "prior_left", "prior_right", "worst_rank", "worst_source").collect()}
    assert seen[-1] == want and len(want) == 400
    assert len(seen[3]) > 60 and all(a <= b for a, b in zip(seen, seen[1:]))  # exams come out while others still arrive, once each


def test_rows_later_than_the_watermark_are_left_out(spark, rocks):
    seen, _ = history(spark, [[exam(1, 1, 0, score=3, flagged=True), exam(2, 1, 100)], [exam(3, 1, 1, score=4, flagged=True)], [exam(4, 2, 900)]])
    assert seen[-1] == {(1, 1, 0, 0, None, None), (2, 1, 1, 0, 3, 1)}


def test_idle_state_goes(spark, rocks):
    batches = [[exam(i, i, 0, score=2) for i in range(50)], [exam(100, 99, 24 * 5)], [exam(101, 99, 24 * 20)], [exam(102, 99, 24 * 60)], [exam(103, 3, 24 * 61), exam(104, 99, 24 * 90)], [exam(105, 99, 24 * 120)]]
    seen, states = history(spark, batches, ttl=10)
    assert max(states) >= 150 and states[3] < 20  # after 60 days only patient 99 is left
    assert (103, 3, 0, 0, None, None) in seen[-1]  # began anew
    kept, full = history(spark, batches)
    assert full[3] > 100 and (103, 3, 0, 0, 2, 3) in kept[-1]


def test_history_makes_few_calls_to_the_state_store():
    """Each call is a message to another process: seven for a patient's rows of a batch and their release."""
    calls = []

    class State:
        def __init__(self):
            self.held = []

        def __getattr__(self, name):
            def call(*args):
                calls.append(name)
                if name == "appendList":
                    self.held += args[0]
                if name == "clear":
                    self.held = []
                return iter(self.held) if name in ("get", "iterator") else None

            return call

    p, times = M.PatientHistory(None), type("T", (), {"getCurrentWatermarkInMs": lambda self: 10**15})()
    p.handle, p.waiting, p.sides, p.last = State(), State(), State(), State()
    rows = [{"us": 1000 * i, "event_id": i, "side": "LEFT", "score": i, "is_event": True} for i in (2, 1, 3)]
    assert list(p.handleInputRows((7,), iter(rows), times)) == []
    out = list(p.handleExpiredTimer((7,), times, None))
    assert [tuple(r) for r in out] == [(1, 7, 0, 0, None, None), (2, 7, 1, 0, 1, 1), (3, 7, 2, 0, 2, 2)]
    assert sorted(calls) == sorted(["appendList", "registerTimer", "get", "iterator", "updateValue", "updateValue", "clear"])


def test_the_state_store_must_be_set(spark):
    with pytest.raises(ValueError):
        M.stream_patient_history(spark.readStream.format("rate").load())


COUNTERS = {"rows": "count(*)", "flagged": "count_if(is_event)", "scores": "sum(score)"}


def test_counters_of_repeated_batches_count_once(spark):
    path, out, chk, root = (new_path(spark, x) for x in ("stream", "out", "chk", "counters"))
    parts = [[exam(i, 1, i, score=i % 3, flagged=i % 2 == 0) for i in range(a, a + 10)] for a in (0, 10, 20)]
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, EXAMS).coalesce(1).write.mode("append").parquet(path)
        M.run_counted(M.count_stages(M.arrivals(spark, path, EXAMS, 1), COUNTERS), out, chk, root)
        if k == 1:  # the driver is lost after the sink has the batch, before the batch is marked as done: it runs again
            commits = V._files(spark, f"{chk}/commits/{k}")
            assert commits[0].delete(commits[1], False)
            M.run_counted(M.count_stages(M.arrivals(spark, path, EXAMS, 1), COUNTERS), out, chk, root)
    flat = [r for p in parts for r in p]
    assert {r.counter: r.n for r in M.stage_counters(spark, root).collect()} == {"rows": 30, "flagged": 15, "scores": sum(r[4] for r in flat)}
    assert [V.entry(spark, root, v)["counters"]["rows"] for v in V.versions(spark, root)] == [10, 10, 10]


def test_unmatched_exams_leave_and_late_rows_stay_out(spark):
    a, b, out, chk = (new_path(spark, x) for x in ("exams", "path", "out", "chk"))
    day = lambda d: START + timedelta(days=d)
    exams = [[(1, 1, day(0)), (2, 2, day(1))], [(3, 1, day(30))], [(4, 3, day(2)), (5, 3, day(80))], [(6, 9, day(400))], [(7, 9, day(900))]]
    paths = [[(10, 1, day(5))], [(11, 2, day(40))], [(12, 3, day(85)), (13, 1, day(3))], [(14, 8, day(400))], [(15, 8, day(900))]]
    want, watermark, seen_e, seen_p, states = set(), None, [], [], []
    for e, p in zip(exams, paths):
        spark.createDataFrame(e, "accession_number long, patient_id long, exam_ts timestamp").coalesce(1).write.mode("append").parquet(a)
        spark.createDataFrame(p, "path_accession long, path_patient long, path_ts timestamp").coalesce(1).write.mode("append").parquet(b)
        left, right = M.arrivals(spark, a, "accession_number long, patient_id long, exam_ts timestamp", 100), M.arrivals(spark, b, "path_accession long, path_patient long, path_ts timestamp", 100)
        linked = M.stream_window_link(left, right, 60, how="left_outer").select("accession_number", "path_accession")
        q = linked.writeStream.format("parquet").option("checkpointLocation", chk).trigger(availableNow=True).start(out)
        q.awaitTermination()
        states.append(sum(s.numRowsTotal for s in q.lastProgress.stateOperators))
        # a loop over arrivals: rows up to the watermark are too late
        seen_e += [x for x in e if watermark is None or x[2] > watermark]
        seen_p += [x for x in p if watermark is None or x[2] > watermark]
        watermark = min(max(x[2] for x in seen_e), max(x[2] for x in seen_p)) - timedelta(days=1)
        pairs = {(x[0], y[0]) for x in seen_e for y in seen_p if x[1] == y[1] and timedelta(0) <= y[2] - x[2] <= timedelta(days=60)}
        matched = {x for x, _ in pairs}
        want |= pairs | {(x[0], None) for x in seen_e if x[0] not in matched and x[2] + timedelta(days=60) < watermark}
        assert {tuple(r) for r in spark.read.schema("accession_number long, path_accession long").parquet(out).collect()} == want
    assert (4, None) not in want and (2, 11) in want and (3, None) in want and states[-1] < max(states)
