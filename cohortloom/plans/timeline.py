"""Queries of per-patient timelines."""

from pyspark.sql import functions as F

from ..operators import timeline as W
from ..registry import query

US = "epoch_us(ts)"


@query("W1_dedupe_prefer", "SELECT patient_id, accession_number, bi_rads FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY bi_rads IS NULL, accession_number) AS k FROM exams) WHERE k = 1")
def w1(t):
    return W.dedupe_prefer(t.exams, "patient_id", "bi_rads", "accession_number").select("patient_id", "accession_number", "bi_rads")


@query(
    "W2_running_worst",
    """WITH s AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY ts, event_id) AS seq FROM timeline),
e AS (SELECT *, CASE WHEN side IN ('LEFT', 'BILATERAL') AND score IS NOT NULL THEN score * 1000000 - seq END AS le,
  CASE WHEN side IN ('RIGHT', 'BILATERAL') AND score IS NOT NULL THEN score * 1000000 - seq END AS re FROM s),
m AS (SELECT *, max(le) OVER w AS lm, max(re) OVER w AS rm FROM e WINDOW w AS (PARTITION BY patient_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, CASE side WHEN 'LEFT' THEN lm WHEN 'RIGHT' THEN rm ELSE CASE WHEN lm IS NULL THEN rm WHEN rm IS NULL THEN lm
  WHEN (rm + 999999) // 1000000 > (lm + 999999) // 1000000 THEN rm ELSE lm END END AS best FROM m)
SELECT c.event_id, CAST((c.best + 999999) // 1000000 AS INTEGER) AS worst_rank, w.event_id AS worst_source FROM c
LEFT JOIN s w ON w.patient_id = c.patient_id AND w.seq = ((c.best + 999999) // 1000000) * 1000000 - c.best""",
)
def w2(t):
    return W.running_worst(t.timeline, "patient_id", "ts", "event_id", "side", "score", "event_id").select("event_id", "worst_rank", "worst_source")


@query(
    "W3_days_to_event",
    f"""WITH x AS (SELECT *, {US} AS us FROM timeline)
SELECT event_id, CAST(CASE WHEN here IS NOT NULL THEN 0 WHEN ahead IS NOT NULL THEN floor((ahead - us) / 86400000000) ELSE -floor((us - behind) / 86400000000) END AS BIGINT) AS days_to_event
FROM (SELECT *, max(CASE WHEN is_event THEN us END) OVER (PARTITION BY patient_id, us) AS here,
  min(CASE WHEN is_event THEN us END) OVER (PARTITION BY patient_id ORDER BY us RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ahead,
  max(CASE WHEN is_event THEN us END) OVER (PARTITION BY patient_id ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS behind FROM x)""",
)
def w3(t):
    return W.days_to_event(t.timeline, "patient_id", "ts", F.col("is_event")).select("event_id", "days_to_event")


@query(
    "W4_propagate_from_events",
    f"""WITH x AS (SELECT *, {US} AS us, CASE WHEN is_event THEN side END AS v FROM timeline)
SELECT event_id, coalesce(v, substr(min(CASE WHEN is_event THEN printf('%020d', us) || v END) OVER (PARTITION BY patient_id ORDER BY us
  RANGE BETWEEN 2592000000000 PRECEDING AND 10454399999999 FOLLOWING), 21)) AS own_side FROM x""",
)
def w4(t):
    rows = t.timeline.withColumn("own_side", F.when(F.col("is_event"), F.col("side")))
    return W.propagate_from_events(rows, "patient_id", "ts", F.col("is_event"), "own_side", 30, 120).select("event_id", "own_side")


ROWS = "OVER (PARTITION BY patient_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query(
    "W5_prior_counts",
    f"""SELECT event_id, CAST(coalesce(sum(CAST(is_event AND side IN ('LEFT', 'BILATERAL') AS INT)) {ROWS}, 0) AS BIGINT) AS prior_left,
  CAST(coalesce(sum(CAST(is_event AND side IN ('RIGHT', 'BILATERAL') AS INT)) {ROWS}, 0) AS BIGINT) AS prior_right FROM timeline""",
)
def w5(t):
    return W.prior_counts(t.timeline, "patient_id", "ts", "event_id", F.col("is_event"), "side").select("event_id", "prior_left", "prior_right")


@query(
    "W6_prior_flag",
    f"""SELECT event_id, CASE side WHEN 'LEFT' THEN l WHEN 'RIGHT' THEN r ELSE l OR r END AS prior_positive FROM (SELECT event_id, side,
  coalesce(bool_or(is_event AND side IN ('LEFT', 'BILATERAL')) {ROWS}, false) AS l, coalesce(bool_or(is_event AND side IN ('RIGHT', 'BILATERAL')) {ROWS}, false) AS r FROM timeline)""",
)
def w6(t):
    return W.prior_flag(t.timeline, "patient_id", "ts", "event_id", F.col("is_event"), "side").select("event_id", "prior_positive")


@query(
    "W7_exists_in_range",
    f"""SELECT event_id, bool_or(is_event) OVER (PARTITION BY patient_id ORDER BY us RANGE BETWEEN 172800000000 PRECEDING AND 432000000000 FOLLOWING) AS near_event
FROM (SELECT *, {US} AS us FROM timeline)""",
)
def w7(t):
    return W.exists_in_range(t.timeline, "patient_id", "ts", F.col("is_event"), 2, 5).select("event_id", "near_event")


@query(
    "W8_followup_stats",
    f"""SELECT event_id, count(*) OVER w AS followups, coalesce(min(CAST(coalesce(score <= 2, false) AS INT)) OVER w, 0) = 1 AS all_good,
  CAST(floor((max(us) OVER w - us) / 86400000000) AS BIGINT) AS last_days
FROM (SELECT *, {US} AS us FROM timeline) WINDOW w AS (PARTITION BY patient_id ORDER BY us RANGE BETWEEN 1 FOLLOWING AND 1728000000000 FOLLOWING)""",
)
def w8(t):
    return W.followup_stats(t.timeline, "patient_id", "ts", F.col("score") <= 2, 20).select("event_id", "followups", "all_good", "last_days")


def _future(side, value):
    return f"coalesce(bool_or(side IN ('{side}', 'BILATERAL') AND event_type = '{value}') OVER w, false) AS {value}_{side.lower()}"


@query(
    "W9_future_labels",
    f"""SELECT event_id, {', '.join(_future(s, v) for s in ('LEFT', 'RIGHT') for v in ('purchase', 'error'))}
FROM (SELECT *, {US} AS us FROM timeline) WINDOW w AS (PARTITION BY patient_id ORDER BY us RANGE BETWEEN 1 FOLLOWING AND 864000000000 FOLLOWING)""",
)
def w9(t):
    cols = [f"{v}_{s}" for s in ("left", "right") for v in ("purchase", "error")]
    return W.future_labels(t.timeline, "patient_id", "ts", "event_type", "side", ["purchase", "error"], 10).select("event_id", *cols)


@query(
    "W10_event_gaps",
    f"""SELECT event_id, CAST(gap AS BIGINT) AS gap_days, NOT gap BETWEEN 0 AND 14 AS outside FROM (SELECT event_id, floor((us - max(us) OVER (PARTITION BY patient_id
  ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) / 86400000000) AS gap FROM (SELECT *, {US} AS us FROM timeline))""",
)
def w10(t):
    return W.event_gaps(t.timeline, "patient_id", "ts", 14).select("event_id", "gap_days", "outside")


@query("W11_with_row_id", "SELECT image_name, row_number() OVER (ORDER BY image_name) AS row_id FROM images")
def w11(t):
    return W.with_row_id(t.images.select("image_name"), ["image_name"])


@query("W12_running_remaining", "SELECT c_mktsegment, CAST(sum(n) OVER () - sum(n) OVER (ORDER BY n DESC, c_mktsegment) AS BIGINT) AS remaining FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)")
def w12(t):
    from ..operators.aggregates import funnel

    steps = [(r, F.col("c_mktsegment") == r) for r in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")]
    return funnel(t.customer, steps).select(F.col("step").alias("c_mktsegment"), "remaining")


@query("W13_first_by", "SELECT patient_id, accession_number FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY exam_ts, accession_number) AS k FROM exams) WHERE k = 1")
def w13(t):
    return W.first_by(t.exams, ["patient_id"], ["exam_ts", "accession_number"]).select("patient_id", "accession_number")


@query("W13_is_duplicated", "SELECT accession_number, count(*) OVER (PARTITION BY patient_id, modality) > 1 AS duplicated FROM exams")
def w13b(t):
    return W.is_duplicated(t.exams, ["patient_id", "modality"]).select("accession_number", "duplicated")


@query(
    "W14_average_precision",
    f"""WITH c AS (SELECT l_returnflag, sum(CAST(l_tax < 0.03 AS INT)) OVER w / count(*) OVER w AS p, sum(CAST(l_tax < 0.03 AS INT)) OVER w / 100 AS r FROM lineitem WHERE l_orderkey < 400
  WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_discount DESC, l_orderkey * 10000000 + l_partkey * 100 + l_linenumber, l_suppkey ROWS UNBOUNDED PRECEDING))
SELECT l_returnflag, round(({' + '.join(f'coalesce(max(CASE WHEN r >= {i / 10} THEN p END), 0)' for i in range(11))}) / 11, 6) AS ap FROM c GROUP BY l_returnflag""".replace(" WHERE l_orderkey < 400", ""),
)
def w14(t):
    rows = t.lineitem.withColumn("tie", F.struct(F.expr("l_orderkey * 10000000 + l_partkey * 100 + l_linenumber"), F.col("l_suppkey")))
    curve = W.precision_recall(rows, ["l_returnflag"], "l_discount", "tie", F.col("l_tax") < 0.03, F.lit(100))
    return W.average_precision(curve, ["l_returnflag"])
