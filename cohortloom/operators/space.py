"""Joins by place: overlapping boxes by a grid, nearest vectors by rings around pivots or by tiles.

Small groups (images or blocks of at most ``CROWDED`` rows) are joined as they are. Larger ones are cut into cells first, so
that the pairs looked at follow the rows and a hot group's work is spread over its cells. Either way gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

CROWDED = 64
PIVOTS = 8
#: Neighbours, on either side in the orders by the distances to the first ``ORDERS`` pivots, that give a first bound.
LOOK, ORDERS = 3, 3
#: Rings leave out next to nothing among vectors of many dimensions, whose distances are all alike: longer ones meet in tiles
#: of about ``TILE`` vectors.
MAX_RING_DIMS, TILE = 16, 4096
#: Distances are compared after rounding to six digits.
EPS = 1e-6
BOX = ("x1", "y1", "x2", "y2")


def iou(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) -> Column:
    w = F.greatest(F.least(ax2, bx2) - F.greatest(ax1, bx1), F.lit(0.0))
    h = F.greatest(F.least(ay2, by2) - F.greatest(ay1, by1), F.lit(0.0))
    inter = w * h
    return F.coalesce(F.try_divide(inter, (ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - inter), F.lit(0.0))


def _on_grid(boxes: DataFrame, cells: DataFrame) -> DataFrame:
    """Each box once for every cell (gx, gy) it touches; images without a grid have one cell."""
    at = lambda c, side: F.floor(F.col(c) / F.col(side))
    along = lambda lo, hi, side: F.explode(F.when(F.col(side).isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(at(lo, side), at(hi, side))))
    placed = boxes.join(cells, "image_id", "left")
    return placed.withColumn("gx", along("x1", "x2", "cell_w")).withColumn("gy", along("y1", "y2", "cell_h"))


def box_pairs(pred: DataFrame, truth: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Pairs of a predicted and a true box of one image that touch the same cell, each once: pred's columns, gt_id, t_x1, ...

    A crowded image's cells are as large as its boxes are in the root mean square, by which boxes touch four cells on
    average at most, however their sizes are distributed. A pair belongs to the cell of the lower corner of its overlap.
    Boxes of images that are not crowded meet all others of their image.
    """
    names = [c for c in pred.columns if c not in ("cell_w", "cell_h", "gx", "gy")]
    t = truth.select("image_id", F.col("box_id").alias("gt_id"), *[F.col(c).cast("double").alias(f"t_{c}") for c in BOX])
    both = pred.select("image_id", *BOX).unionByName(truth.select("image_id", *BOX))
    rms = lambda a, b: F.sqrt(F.avg((F.col(b) - F.col(a)) * (F.col(b) - F.col(a))))
    sizes = both.groupBy("image_id").agg(F.count("*").alias("n"), rms("x1", "x2").alias("cell_w"), rms("y1", "y2").alias("cell_h"))
    cells = sizes.where((F.col("n") > crowded) & (F.col("cell_w") > 0) & (F.col("cell_h") > 0)).drop("n")
    a = _on_grid(pred.select(*names), cells)
    b = _on_grid(t.select("image_id", "gt_id", *[F.col(f"t_{c}").alias(c) for c in BOX]), cells.withColumnsRenamed({"cell_w": "w", "cell_h": "h"}).select("image_id", F.col("w").alias("cell_w"), F.col("h").alias("cell_h")))
    b = b.select("image_id", "gt_id", *[F.col(c).alias(f"t_{c}") for c in BOX], "gx", "gy")
    corner = (F.floor(F.greatest("x1", "t_x1") / F.col("cell_w")) == F.col("gx")) & (F.floor(F.greatest("y1", "t_y1") / F.col("cell_h")) == F.col("gy"))
    pairs = a.join(b, ["image_id", "gx", "gy"]).where(F.col("cell_w").isNull() | corner)
    return pairs.select(*names, "gt_id", *[f"t_{c}" for c in BOX])


def iou_join(pred: DataFrame, truth: DataFrame, least: float, crowded: int = CROWDED) -> DataFrame:
    """Boxes of the same image that overlap by at least ``least`` (over 0); both have image_id, box_id, x1, y1, x2, y2."""
    box = lambda p: [F.col(f"{p}{c}") for c in BOX]
    return box_pairs(pred, truth, crowded).withColumn("iou", F.round(iou(*box(""), *box("t_")), 6)).where(F.col("iou") >= least)


def mean_l1(a: Column, b: Column) -> Column:
    total = F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y).cast("double")), F.lit(0.0), lambda s, x: s + x)
    return total / F.size(a)


def _first_two(rows: DataFrame, by: list[str]) -> DataFrame:
    """Each distinct vector v of a block once: k1, f1 (the least key with its flag), k2, f2 (the next one or null)."""
    order = Window.partitionBy(*by, "v").orderBy("k")
    two = rows.withColumn("r", F.row_number().over(order)).where("r <= 2")
    of = lambda c, r: F.max(F.when(F.col("r") == r, F.col(c)))
    return two.groupBy(*by, "v").agg(of("k", 1).alias("k1"), of("f", 1).alias("f1"), of("k", 2).alias("k2"), of("f", 2).alias("f2"))


def ring_pairs(points: DataFrame, by: list[str]) -> DataFrame:
    """Pairs of distinct vectors of a block whose distance must be looked at to find the nearest of k1: by, k1, v, k2, f2, w.

    The distance to a pivot differs by no more than the distance itself, so a vector with a neighbour at distance u is
    nearest to one whose pivot distances all differ by u at most. The first pivot's distances, cut into rings as wide as u
    is on average, are the join key.
    """
    sample = points.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64("k1"), "k1"))).where(F.col("r") <= PIVOTS)
    pivots = sample.groupBy(*by).agg(F.collect_list("v").alias("pivots"))
    far = points.join(pivots, by).withColumn("ds", F.transform("pivots", lambda p: mean_l1(F.col("v"), p))).drop("pivots")
    bounded = far.withColumn("u", F.lit(None).cast("double"))
    for pivot in reversed(range(ORDERS)):
        # neighbours in order of a pivot's distance, within the parts of a range partitioning
        dealt = bounded.withColumn("d", F.get("ds", F.lit(pivot))).repartitionByRange(*by, "d").withColumn("part", F.spark_partition_id())
        order = Window.partitionBy("part", *by).orderBy("d", "k1")
        near = [mean_l1(F.col("v"), side("v", i).over(order)) for i in range(1, LOOK + 1) for side in (F.lag, F.lead)]
        bounded = cut(dealt.withColumn("u", F.least("u", *near)).drop("part"))
    scale = bounded.groupBy(*by).agg(
        F.min("d").alias("d_min"), F.max("d").alias("d_max"), F.greatest(F.avg("u"), (F.max("d") - F.min("d")) / F.count("*"), F.lit(EPS)).alias("width")
    )
    placed = bounded.join(scale, by).withColumn("u", F.coalesce(F.col("u"), F.lit(float("inf"))) + EPS)
    ring = lambda d: F.floor(F.least(F.greatest(d, F.col("d_min")), F.col("d_max")) / F.col("width"))
    # a vector that others share has a neighbour at distance zero already
    a = placed.where("k2 IS NULL").select(*by, "k1", "v", "ds", "u", F.explode(F.sequence(ring(F.col("d") - F.col("u")), ring(F.col("d") + F.col("u")))).alias("ring"))
    b = placed.select(*by, F.col("k1").alias("near"), F.col("f1").alias("near_f"), F.col("v").alias("w"), F.col("ds").alias("es"), ring(F.col("d")).alias("ring"))
    apart = F.array_max(F.zip_with("ds", "es", lambda x, y: F.abs(x - y)))
    return a.join(b, [*by, "ring"]).where((F.col("k1") != F.col("near")) & (apart <= F.col("u"))).select(*by, "k1", "v", "near", "near_f", "w")


def _rounded(d: np.ndarray) -> np.ndarray:
    """Distances in millionths, rounded half up as Spark's round() does: by their decimal digits where these decide."""
    scaled = d * 1e6
    out = np.floor(scaled + 0.5)
    finite = np.isfinite(d)
    scaled = np.where(finite, scaled, 0.0)
    close = finite & ((np.abs(scaled - np.floor(scaled) - 0.5) < 1e-3) | (d > 1e6))
    if close.any():
        values, back = np.unique(d[close], return_inverse=True)
        out[close] = np.array([float(Decimal(repr(float(x))).quantize(Decimal("1e-6"), ROUND_HALF_UP) * 1_000_000) for x in values])[back]
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as the rows of a matrix of their own type; absent entries are NaN."""
    lists = column.combine_chunks()
    flat = lists.flatten()
    flat = flat if pa.types.is_floating(flat.type) else flat.cast(pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _tile_nearest(a: pa.Table, b: pa.Table) -> pa.Table:
    """For each vector of tile a the nearest of tile b with another key, and its distance; ties by key.

    Entries are added one dimension after the other, as ``mean_l1`` adds them, so the sums are the same to the last bit.
    """
    by = [c for c in a.column_names if c.startswith("b")]
    if not a.num_rows or not b.num_rows:
        return pa.table({**{c: b[c].slice(0, 0) for c in by}, "k1": b["near"].slice(0, 0), "distance": pa.array([], pa.float64()), "near": b["near"].slice(0, 0), "near_f": b["near_f"].slice(0, 0)})
    b = b.take(pc.sort_indices(b["near"]))
    v, w = _matrix(a["v"]), np.ascontiguousarray(_matrix(b["w"]).T)
    at = pc.index_in(a["k1"], b["near"].combine_chunks()).cast(pa.float64()).to_numpy()
    best, chosen = np.full(len(v), np.nan), np.full(len(v), -1)
    step = max(1, 131_072 // max(1, w.shape[1]))
    for lo in range(0, len(v), step):
        some = v[lo : lo + step]
        sums = np.zeros((len(some), w.shape[1]))
        gap = np.empty(sums.shape, np.result_type(v, w))
        for d in range(len(w)):
            np.subtract(some[:, d, None], w[d], out=gap)
            sums += np.abs(gap, out=gap)
        sums /= len(w)
        sums[np.isnan(sums)] = np.inf
        own = at[lo : lo + step]
        own = np.where(np.isnan(own), -1, own).astype(int)
        with_own = np.flatnonzero(own >= 0)
        sums[with_own, own[with_own]] = np.inf
        least = sums.min(axis=1)
        # all that may round to the least distance, which for large ones is apart by the steps of a double
        row, col = np.nonzero(sums <= (least + 1.1e-6 + 4 * np.spacing(np.where(np.isfinite(least), least, 0.0)))[:, None])
        other = col != own[row]
        row, col = row[other], col[other]
        if not len(row):
            continue
        rounded = _rounded(sums[row, col])
        order = np.lexsort((col, rounded, row))
        first = order[np.r_[True, np.diff(row[order]) > 0]]
        best[lo + row[first]], chosen[lo + row[first]] = rounded[first] / 1e6, col[first]
    has = np.flatnonzero(chosen >= 0)
    near = b.select(["near", "near_f"]).take(pa.array(chosen[has]))
    got = a.select([*by, "k1"]).take(pa.array(has))
    return pa.table({**{c: got[c] for c in got.column_names}, "distance": pa.array(best[has]), "near": near["near"], "near_f": near["near_f"]})


def tile_nearest(points: DataFrame, by: list[str], tile: int = TILE) -> DataFrame:
    """The nearest other vector in each tile of the block, for vectors of many dimensions: by, k1, distance, near, near_f.

    All pairs of a block are looked at, by tiles: a block of n vectors is dealt out by hash into n / ``tile`` tiles, and each
    pair of them is a group of its own, so that what travels is the block once for each of its tiles and a task holds two
    tiles. Groups give one row for each vector of their first tile.
    """
    sizes = points.groupBy(*by).agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    dealt = cut(points.where("k1 IS NOT NULL").join(sizes, by).withColumn("tile", F.pmod(F.xxhash64("k1"), "tiles").cast("int")))
    others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    # a vector that others share has a neighbour at distance zero already
    a = dealt.where("k2 IS NULL").select(*by, F.col("tile").alias("i"), others.alias("j"), "k1", "v")
    b = dealt.select(*by, others.alias("i"), F.col("tile").alias("j"), F.col("k1").alias("near"), F.col("f1").alias("near_f"), F.col("v").alias("w"))
    key = [*by, "i", "j"]
    shape = points.select(*by, "k1", F.lit(0.0).alias("distance"), F.col("k1").alias("near"), F.col("f1").alias("near_f")).schema
    return a.groupBy(*key).cogroup(b.groupBy(*key)).applyInArrow(_tile_nearest, shape)


def nearest_in_block(df: DataFrame, block: Sequence[str], key: str, vector: str, flag: str, crowded: int = CROWDED) -> DataFrame:
    """The nearest other row by mean absolute difference within the block, for blocks with a flagged row; ties by key.

    Keys are unique; rows of a null block or without a vector have no neighbour. All vectors of a block have one length.
    """
    by = [f"b{i}" for i in range(len(block))]
    rows = df.where(F.col(vector).isNotNull()).select(*[F.col(c).alias(b) for b, c in zip(by, block)], F.col(key).alias("k"), F.col(vector).alias("v"), F.col(flag).alias("f"))
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n"), F.max(F.col("f").cast("int")).alias("any")).where((F.col("any") == 1) & (F.col("n") > 1))
    marked = rows.join(sizes.drop("any"), by)
    small, large = (marked.where(F.col("n") <= crowded).drop("n"), marked.where(F.col("n") > crowded).drop("n"))
    long = F.size("v") > MAX_RING_DIMS

    least = lambda d, k, f: F.min(F.struct(F.round(d, 6).alias("distance"), k.alias("near_key"), f.alias("near_flag"))).alias("m")
    other = small.select(*by, F.col("k").alias("near"), F.col("v").alias("w"), F.col("f").alias("near_f"))
    found = [small.join(other, by).where(F.col("k") != F.col("near")).groupBy("k", "f").agg(least(mean_l1(F.col("v"), F.col("w")), F.col("near"), F.col("near_f")))]
    if not sizes.where(F.col("n") > crowded).isEmpty():
        points = cut(_first_two(large, by))
        # the distance is worked out before pairs are sorted for their least one, so that no vectors are sorted
        by_rings = lambda p: ring_pairs(p, by).select(*by, "k1", mean_l1(F.col("v"), F.col("w")).alias("distance"), "near", "near_f")
        parts = [f(p) for f, p in ((by_rings, points.where(~long)), (lambda p: tile_nearest(p, by), points.where(long))) if not p.isEmpty()]
        near = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        best = near.groupBy(*by, "k1").agg(least(F.col("distance"), F.col("near"), F.col("near_f")))
        found.append(best.join(points.select(*by, "k1", "f1"), [*by, "k1"]).select(F.col("k1").alias("k"), F.col("f1").alias("f"), "m"))
        shared = large.join(points.where("k2 IS NOT NULL"), [*by, "v"])
        first = F.col("k") == F.col("k1")
        pick = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
        found.append(shared.select("k", "f", F.struct(F.lit(0.0).alias("distance"), pick("k2", "k1").alias("near_key"), pick("f2", "f1").alias("near_flag")).alias("m")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(F.col("k").alias(key), F.col("f").alias(flag), "m.distance", "m.near_key", "m.near_flag")
