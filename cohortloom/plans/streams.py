"""Queries of streams: tables are staged as files, run with availableNow and read back."""

from pyspark.sql import functions as F

from ..operators import buckets as B
from ..registry import query
from ..streaming import streams as M
from .sources import folder

EVENTS = "event_id long, patient_id long, ts timestamp, event_type string, is_event boolean, score int"


def staged(t, rows, schema, per_trigger=1):
    path = folder(t, "stream")
    rows.write.parquet(path)
    return M.arrivals(t.spark, path, schema, per_trigger)


def timeline(t):
    return t.timeline.select("event_id", "patient_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "is_event", "score")


@query("M1_stream_dedupe", "SELECT event_id FROM events")
def m1(t):
    rows = timeline(t)
    stream = staged(t, rows.unionByName(rows), EVENTS, 10_000)
    return M.run_to_table(M.stream_dedupe(stream, ["event_id"], "ts"), folder(t, "out"), folder(t, "chk")).select("event_id")


@query("M2_stream_skip_existing", "SELECT event_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def m2(t):
    done = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("patient_id"))
    return M.run_to_table(M.stream_skip_existing(staged(t, timeline(t), EVENTS), done, "patient_id"), folder(t, "out"), folder(t, "chk")).select("event_id")


@query("M3_stream_upsert", "SELECT patient_id, max(event_id) AS event_id FROM timeline GROUP BY patient_id")
def m3(t):
    root, path = folder(t, "table"), folder(t, "stream")
    # files in order of the events, so that later ones replace earlier ones
    timeline(t).repartitionByRange(4, "event_id").write.parquet(path)
    for _ in range(2):  # the second run finds nothing new
        M.stream_upsert(M.arrivals(t.spark, path, EVENTS, 1), root, ["patient_id"], "event_id", f"{root}-chk", compact_every=3).awaitTermination()
    return B.read(t.spark, root).select("patient_id", "event_id")


@query("M4_stream_audit", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def m4(t):
    rows = timeline(t)
    last = F.lit(rows.agg(F.date_trunc("day", F.max("ts"))).first()[0])
    # a row far ahead closes the windows before it, and its own stays open
    closing = rows.limit(1).withColumn("ts", last + F.expr("INTERVAL 4000 DAYS"))
    first, second = folder(t, "stream"), folder(t, "out")
    rows.write.parquet(first)
    closing.write.mode("append").parquet(first)
    out = M.run_to_table(M.stream_audit(M.arrivals(t.spark, first, EVENTS, 10_000), "ts", ["event_type"]), second, folder(t, "chk"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def turns(rows, ts, n, hours=20):
    """``rows`` in n parts as they arrive: up to so many hours after their time, by their hash."""
    at = F.unix_micros(F.col(ts).cast("timestamp")) + F.pmod(F.xxhash64(*rows.columns), F.lit(hours * 3_600_000_000))
    lo, hi = rows.agg(F.min(at), F.max(at)).first()
    if lo is None:
        return [rows] * n
    turn = F.floor((at - lo) / F.lit(hi - lo + 1) * n)
    return [rows.where(turn == i) for i in range(n)]


def far_ahead(rows, ts, **values):
    """One row long after all others: the watermark passes these."""
    row = rows.limit(1).withColumns({c: F.lit(v).cast(rows.schema[c].dataType) for c, v in values.items()})
    last = F.lit(rows.agg(F.max(ts)).first()[0])
    return row.withColumn(ts, last + F.expr("INTERVAL 4000 DAYS"))


COUNTERS = {"rows": "count(*)", "events": "count_if(is_event)", "scored": "count(score)", "worst": "count_if(score = 4)"}


@query(
    "M4_stream_counters",
    """SELECT 'rows' AS counter, count(*) AS n FROM timeline UNION ALL SELECT 'events', count(*) FILTER (WHERE is_event) FROM timeline
UNION ALL SELECT 'scored', count(score) FROM timeline UNION ALL SELECT 'worst', count(*) FILTER (WHERE score = 4) FROM timeline""",
)
def m4_counters(t):
    path, out, chk, root = (folder(t, x) for x in ("stream", "out", "chk", "counters"))
    for part in turns(timeline(t), "ts", 3):  # the stream is started anew for each part
        part.write.mode("append").parquet(path)
        M.run_counted(M.count_stages(M.arrivals(t.spark, path, EVENTS, 10_000), COUNTERS), out, chk, root)
    return M.stage_counters(t.spark, root)


@query(
    "M5_stream_patient_history",
    """WITH s AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY ts, event_id) AS seq FROM timeline),
e AS (SELECT *, CASE WHEN side IN ('LEFT', 'BILATERAL') AND score IS NOT NULL THEN score * 1000000 - seq END AS le, CASE WHEN side IN ('RIGHT', 'BILATERAL') AND score IS NOT NULL THEN score * 1000000 - seq END AS re,
  CAST(is_event AND side IN ('LEFT', 'BILATERAL') AS INT) AS lf, CAST(is_event AND side IN ('RIGHT', 'BILATERAL') AS INT) AS rf FROM s),
m AS (SELECT *, max(le) OVER w AS lm, max(re) OVER w AS rm, CAST(coalesce(sum(lf) OVER w, 0) AS BIGINT) AS prior_left, CAST(coalesce(sum(rf) OVER w, 0) AS BIGINT) AS prior_right
  FROM e WINDOW w AS (PARTITION BY patient_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, CASE side WHEN 'LEFT' THEN lm WHEN 'RIGHT' THEN rm ELSE CASE WHEN lm IS NULL THEN rm WHEN rm IS NULL THEN lm
  WHEN (rm + 999999) // 1000000 > (lm + 999999) // 1000000 THEN rm ELSE lm END END AS best FROM m)
SELECT c.event_id, c.patient_id, c.prior_left, c.prior_right, CAST((c.best + 999999) // 1000000 AS INTEGER) AS worst_rank, w.event_id AS worst_source FROM c
LEFT JOIN s w ON w.patient_id = c.patient_id AND w.seq = ((c.best + 999999) // 1000000) * 1000000 - c.best""",
)
def m5(t):
    rows = t.timeline.select("event_id", "patient_id", F.col("ts").cast("timestamp").alias("ts"), "side", "score", "is_event")
    path, out, chk = (folder(t, x) for x in ("stream", "out", "chk"))
    schema = "event_id long, patient_id long, ts timestamp, side string, score int, is_event boolean"
    before = t.spark.conf.get(M.STATE_STORE)
    t.spark.conf.set(M.STATE_STORE, M.ROCKS)
    try:
        for part in [*turns(rows, "ts", 3), far_ahead(rows, "ts", event_id=-1, patient_id=-1)]:
            part.write.mode("append").parquet(path)
            found = M.run_to_table(M.stream_patient_history(M.arrivals(t.spark, path, schema, 10_000)), out, chk)
    finally:
        t.spark.conf.set(M.STATE_STORE, before)
    return found


@query("M6_stream_window_link", "SELECT e.accession_number, p.path_accession, p.path_part, p.path_lab FROM exams e JOIN path p ON e.patient_id = p.patient_id AND path_ts BETWEEN exam_ts AND exam_ts + INTERVAL 60 DAY WHERE is_biopsy = 'T'")
def m6(t):
    exams = t.exams.where("is_biopsy = 'T'").select("accession_number", "patient_id", F.col("exam_ts").cast("timestamp").alias("exam_ts"))
    path = t.path.select("path_accession", "path_part", "path_lab", F.col("patient_id").alias("path_patient"), F.col("path_ts").cast("timestamp").alias("path_ts"))
    a = staged(t, exams, "accession_number long, patient_id long, exam_ts timestamp", 10_000)
    b = staged(t, path, "path_accession long, path_part long, path_lab long, path_patient long, path_ts timestamp", 10_000)
    linked = M.stream_window_link(a, b, 60)
    return M.run_to_table(linked.select("accession_number", "path_accession", "path_part", "path_lab"), folder(t, "out"), folder(t, "chk"))


@query(
    "M6_stream_unmatched",
    """SELECT e.accession_number, p.path_accession, p.path_part, p.path_lab FROM exams e LEFT JOIN path p ON e.patient_id = p.patient_id AND path_ts BETWEEN exam_ts AND exam_ts + INTERVAL 60 DAY WHERE is_biopsy = 'T'""",
)
def m6_unmatched(t):
    exams = t.exams.where("is_biopsy = 'T'").select("accession_number", "patient_id", F.col("exam_ts").cast("timestamp").alias("exam_ts"))
    path = t.path.select("path_accession", "path_part", "path_lab", F.col("patient_id").alias("path_patient"), F.col("path_ts").cast("timestamp").alias("path_ts"))
    a, b, out, chk = (folder(t, x) for x in ("exams", "path", "out", "chk"))
    # both streams bring the same stretch of time in each part, else the other one's rows would come too late
    both = exams.select(F.col("exam_ts").alias("ts")).union(path.select("path_ts"))
    lo, hi = both.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    part = lambda rows, ts, i: rows.where(F.floor((F.unix_micros(ts) - lo) / F.lit(hi - lo + 1) * 3) == i)
    parts = [(part(exams, "exam_ts", i), part(path, "path_ts", i)) for i in range(3)]
    parts.append((far_ahead(exams, "exam_ts", accession_number=-1, patient_id=-1), far_ahead(path, "path_ts", path_patient=-2)))
    for x, y in parts:
        x.write.mode("append").parquet(a)
        y.write.mode("append").parquet(b)
        left = M.arrivals(t.spark, a, "accession_number long, patient_id long, exam_ts timestamp", 10_000)
        right = M.arrivals(t.spark, b, "path_accession long, path_part long, path_lab long, path_patient long, path_ts timestamp", 10_000)
        linked = M.stream_window_link(left, right, 60, how="left_outer").select("accession_number", "path_accession", "path_part", "path_lab")
        found = M.run_to_table(linked, out, chk)
    return found.where("accession_number >= 0")
