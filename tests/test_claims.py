import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import claims as Q
from cohortloom.operators import sketches as S
from cohortloom.operators.lineage import new_path

RESULT = "text string, value long"


def queue(spark, n, tasks):
    root = new_path(spark, "claims")
    Q.open_queue(spark.createDataFrame([(f"t{i}", i) for i in range(n)], RESULT), root, "text", tasks)
    return root


def test_two_claimers_at_once_get_disjoint_work(spark):
    root, got = queue(spark, 200, 24), {1: [], 2: []}

    def work(who):
        while tasks := Q.claim(spark, root, f"w{who}", 1000, many=2):
            got[who] += tasks
            for task in tasks:
                assert Q.accept(Q.items(spark, root, [task]), root, task)

    threads = [threading.Thread(target=work, args=(w,)) for w in got]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got[1] + got[2]) == sorted(set(got[1] + got[2])) and len(got[1] + got[2]) == 24
    assert {(r.text, r.value) for r in Q.results(spark, root, RESULT).collect()} == {(f"t{i}", i) for i in range(200)}
    assert Q.results(spark, root, RESULT).count() == 200 and Q.is_finished(spark, root)


def test_a_lost_claim_comes_back_and_a_result_counts_once(spark):
    root = queue(spark, 30, 4)
    lost = Q.claim(spark, root, "lost", 60, many=3, now=0)
    assert len(lost) == 3 and len(Q.claim(spark, root, "other", 60, many=9, now=59)) == 1
    assert Q.claim(spark, root, "other", 60, now=59.5) == []
    again = Q.claim(spark, root, "other", 60, many=9, now=61)
    assert sorted(again) == sorted(lost)
    task = again[0]
    mine = Q.items(spark, root, [task])
    assert Q.accept(mine.withColumn("value", F.lit(1).cast("long")), root, task)
    assert not Q.accept(mine.withColumn("value", F.lit(2).cast("long")), root, task)  # the lost worker comes late
    assert {r.value for r in Q.results(spark, root, RESULT).collect()} == {1}
    assert not Q.is_finished(spark, root)
    assert task not in Q.claim(spark, root, "third", 60, many=9, now=10_000)


def test_empty_queues_and_bounds(spark):
    root = queue(spark, 0, 4)
    assert Q.claim(spark, root, "w", 60) == [] and Q.results(spark, root, RESULT).count() == 0 and Q.is_finished(spark, root)
    with pytest.raises(ValueError):
        queue(spark, 1, 0)
    with pytest.raises(ValueError):
        Q.claim(spark, new_path(spark, "none"), "w", 60)


def test_sketches_add_up_and_repeated_days_change_nothing(spark):
    root = new_path(spark, "sketches")
    day = lambda i: datetime(2024, 1, 1) + timedelta(hours=i)
    rows = spark.range(40_000).select((F.col("id") * 7 % 9000).alias("patient"), (F.lit(day(0)) + F.expr("make_interval(0, 0, 0, 0, id % 240)")).alias("ts"))
    rows = rows.unionByName(spark.createDataFrame([(1, None), (None, day(5)), (None, day(24 * 20))], "patient long, ts timestamp"))
    early = rows.where(F.col("ts") < F.lit(day(120)))
    first = S.add_days(early, root, "ts", "patient")
    assert S.add_days(early, root, "ts", "patient") == first
    S.add_days(rows, root, "ts", "patient")  # brings the other days only
    for lo, hi in ((None, None), (3, 6), (0, 0), (20, 25), (30, 40)):
        bounds = [None if d is None else day(24 * d).date() for d in (lo, hi)]
        exact = rows.where(F.col("ts").isNotNull())
        for b, op in zip(bounds, (">=", "<=")):
            exact = exact if b is None else exact.where(F.expr(f"to_date(ts) {op} DATE'{b}'"))
        n = exact.select("patient").where("patient IS NOT NULL").distinct().count()
        got = S.distinct_in(spark, root, *bounds).first()
        assert abs(got.n_unique - n) <= 4 * S.ERROR * n + 1
        assert got.days == exact.select(F.to_date("ts")).distinct().count()
