import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import space as S
from cohortloom.plans import evaluate as E


def boxes(rng, n, image=1, side=None, big=0):
    """n boxes on a square whose side grows with the root of n, so that as many overlap each; some are far larger."""
    side = side or 4.0 * n**0.5
    out = []
    for i in range(n):
        w, h = (rng.uniform(1, 6) for _ in "wh") if i >= big else (side / 3, side / 4)
        x, y = rng.uniform(-side / 2, side / 2), rng.uniform(-side / 2, side / 2)
        out.append((image, i, x, y, x + w, y + h, rng.random()))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "image_id long, box_id long, x1 double, y1 double, x2 double, y2 double, score double")


def brute(pred, truth, least):
    out = {}
    for p in pred:
        for t in truth:
            if p[0] == t[0]:
                w, h = min(p[4], t[4]) - max(p[2], t[2]), min(p[5], t[5]) - max(p[3], t[3])
                inter = max(w, 0) * max(h, 0)
                v = round(inter / ((p[4] - p[2]) * (p[5] - p[3]) + (t[4] - t[2]) * (t[5] - t[3]) - inter), 6)
                if v >= least:
                    out[p[1], t[1]] = v
    return out


@pytest.mark.parametrize("crowded", [0, 64, 10**9])
def test_overlaps_equal_all_pairs(spark, crowded):
    rng = random.Random(1)
    pred, truth = boxes(rng, 150, big=3) + boxes(rng, 30, 2), boxes(rng, 200, big=2) + boxes(rng, 20, 2, side=5)
    pred = [(*p[:1], 1000 * p[0] + p[1], *p[2:]) for p in pred]
    truth = [(*t[:1], 1000 * t[0] + t[1], *t[2:]) for t in truth] + [(1, 5000, *pred[7][2:])]  # touching corners on the grid
    got = S.iou_join(frame(spark, pred), frame(spark, truth), 0.2, crowded).collect()
    want = brute(pred, truth, 0.2)
    assert len(got) == len(want) and {(r.box_id, r.gt_id): r.iou for r in got} == pytest.approx(want)
    assert S.iou_join(frame(spark, pred).limit(0), frame(spark, truth), 0.2, crowded).count() == 0


def test_pairs_looked_at_follow_the_boxes(spark):
    looked = []
    for n in (4_000, 50_000):  # 100,000 boxes on one image
        rng = random.Random(n)
        pred, truth = frame(spark, boxes(rng, n)), frame(spark, boxes(rng, n))
        looked.append(S.box_pairs(pred, truth).count() / n)
    assert looked[1] < 1.2 * looked[0] and looked[1] < 40


def test_cells_a_box_touches_do_not_depend_on_sizes(spark):
    rng = random.Random(5)
    rows = [(1, i, 0.0, 0.0, w, h, 0.0) for i in range(3000) for w, h in [(rng.paretovariate(0.7), rng.paretovariate(0.7))]]
    sizes = frame(spark, rows).groupBy("image_id").agg(F.sqrt(F.avg("x2") * 0 + F.avg(F.col("x2") * F.col("x2"))).alias("cell_w"), F.sqrt(F.avg(F.col("y2") * F.col("y2"))).alias("cell_h"))
    assert S._on_grid(frame(spark, rows), sizes).count() <= 4 * len(rows)


def test_rounds_choose_what_the_fold_chooses(spark):
    rng = random.Random(2)
    pred, truth = boxes(rng, 150, side=25), boxes(rng, 150, side=25)
    pred = [(*p[:6], round(p[6], 1)) for p in pred]  # many equal scores
    p, t = frame(spark, pred), frame(spark, truth)
    key = lambda df: sorted(map(tuple, df.collect()))
    fold, rounds = (key(E.greedy_matches(p, t, [0.1, 0.4], crowded=c)) for c in (10**9, 0))
    assert fold == rounds and len(fold) > 50


def nearest(rows):
    """rows: (block, key, vector, flag)"""
    out = {}
    for block in {r[0] for r in rows if r[0] is not None}:
        own = sorted((r for r in rows if r[0] == block), key=lambda r: r[1])
        if len(own) < 2 or not any(r[3] for r in own):
            continue
        v = np.array([r[2] for r in own])
        for i in range(len(own)):
            d = np.round(np.abs(v - v[i]).mean(axis=1), 6)
            d[i] = np.inf
            j = int(np.argmin(d))
            out[own[i][1]] = (float(d[j]), own[j][1], own[j][3])
    return out


def vectors(rng, block, start, n, dim=6, centres=12):
    c = rng.normal(0, 5, (centres, dim))
    v = c[rng.integers(0, centres, n)] + rng.normal(0, 0.3, (n, dim))
    return [(block, start + i, [float(x) for x in np.round(v[i], 3)], bool(rng.random() < 0.3)) for i in range(n)]


SCHEMA = "block string, key long, v array<double>, flag boolean"


def found(spark, rows, **options):
    return {r.key: (r.distance, r.near_key, r.near_flag) for r in S.nearest_in_block(spark.createDataFrame(rows, SCHEMA).repartition(4), ["block"], "key", "v", "flag", **options).collect()}


@pytest.mark.parametrize("crowded", [1, 64])
def test_nearest_equals_brute_force_on_blocks_of_any_size(spark, crowded):
    rng = np.random.default_rng(3)
    rows, start = [], 0
    for b, n in enumerate([1, 2, 3, 40, 65, 300, 900]):
        rows += vectors(rng, f"b{b}", start, n)
        start += n
    rows += [("same", 90_000 + i, [1.0] * 6, i == 0) for i in range(200)] + [("unflagged", 99_000 + i, [float(i)] * 6, False) for i in range(80)]
    rows += [("b5", 91_000 + i, r[2], True) for i, r in enumerate(rows[120:160])] + [(None, 1, [0.0] * 6, True), (None, 2, [0.0] * 6, True)]
    rows += [("grid", 80_000 + i, [float(i % 30), float(i // 30)] + [0.0] * 4, True) for i in range(900)]  # ties everywhere
    want = nearest(rows)
    got = found(spark, rows, crowded=crowded)
    assert got.keys() == want.keys()
    for k, (d, near, flag) in want.items():
        assert got[k][0] == pytest.approx(d, abs=2e-6) and got[k][1:] == (near, flag), (k, got[k], want[k])


def test_comparisons_in_a_block_of_20000(spark):
    rng = np.random.default_rng(4)
    rows = vectors(rng, "b", 0, 20_000, dim=4, centres=40)
    want = nearest(rows)
    got = found(spark, rows)
    assert sum(got[k][1] == want[k][1] for k in want) >= len(want) - 3  # equal to six digits or nearly so
    assert all(abs(got[k][0] - want[k][0]) <= 2e-6 for k in want)
    df = spark.createDataFrame(rows, SCHEMA).select(F.col("block").alias("b0"), F.col("key").alias("k"), "v", F.col("flag").alias("f"))
    looked = S.ring_pairs(S._first_two(df, ["b0"]), ["b0"]).count()
    assert looked < 0.02 * 20_000**2


def test_long_vectors_meet_in_tiles(spark):
    rng = np.random.default_rng(7)
    v = np.round(rng.normal(0, 0.13, (700, 64)).astype("float32"), 3)
    rows = [(f"b{i % 2}", i, [float(x) for x in v[i]], True) for i in range(700)]
    rows += [("b0", 1000 + i, [float(i % 5 == d) for d in range(64)], i % 2 == 0) for i in range(10)]  # shared vectors, ties
    want = nearest(rows)
    got = found(spark, rows)
    assert got.keys() == want.keys()
    assert all(got[k][0] == pytest.approx(want[k][0], abs=2e-6) for k in want)
    assert sum(got[k][1:] == want[k][1:] for k in want) >= len(want) - 2  # equal to six digits or nearly so
    df = spark.createDataFrame(rows[:700], SCHEMA).select(F.col("block").alias("b0"), F.col("key").alias("k"), "v", F.col("flag").alias("f"))
    points = S._first_two(df, ["b0"])
    tiles = S.tile_nearest(points, ["b0"], 100)
    assert tiles.count() <= 700 * 4  # a row for each vector and tile, no row for a pair
    least = {r.k1: r.m.near for r in tiles.groupBy("k1").agg(F.min(F.struct("distance", "near")).alias("m")).collect()}
    assert least == {k: x[1] for k, x in found(spark, rows[:700]).items()}


def test_distances_are_rounded_as_spark_rounds_them(spark):
    values = [0.0000005, 0.1234565, 1.0000015, 2.5e-6, 0.0000015, 123456.7890125, 3e9 + 0.25, 7.0, 0.30000049999, float("inf")]
    want = [r.x for r in spark.createDataFrame([(x,) for x in values], "x double").select(F.round("x", 6).alias("x")).collect()]
    assert list(S._rounded(np.array(values)) / 1e6) == want
