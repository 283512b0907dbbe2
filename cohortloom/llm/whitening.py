"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

Vectors are taken on a grid of ``1 / SCALE`` (entry c counts as floor(SCALE * c) steps), and the fit list is each distinct
grid vector once, so that copies of a vector, however many, weigh as one. Spark finds the distinct vectors (partial runs
are put together before the shuffle) and sums them. The scatter is summed in whole numbers: entries are centred by the
rounded mean before they are multiplied, and what the rounding leaves is subtracted as an exact fraction. The sums, and so
the components, do not depend on partitions, order or repeated tasks.

The driver sees the count, the sums and the scatter, dimension by dimension, and nothing that grows with the rows
(``MAX_DIM`` bounds the dimension). It factors the scatter as P L L' P' with the largest remaining diagonal entry as the
next pivot and rotates the columns of L in pairs until all are orthogonal: their squared norms are the eigenvalues, the
columns at length one are the components. No covariance is squared or inverted, so small eigenvalues keep their digits.

Nulls and edges: a null vector, or one with a null or non-finite entry, is dropped; a null id is kept; repeated rows are
each returned; vectors that are all equal, and empty vectors or tables, have no components and give no rows; a scatter of
rank r gives r components at most. Vectors of several lengths, more than ``MAX_DIM`` entries, an entry beyond
``MAX_STEPS`` steps or a deviation beyond 64 bits are refused with a ValueError. Input columns named as a result column
are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fields_of, map_arrow, row_of, stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
MAX_DIM = 2048
MAX_STEPS = 1 << 40
#: Column pairs count as orthogonal at this cosine.
ORTHOGONAL = 1e-15
SWEEPS = 60


@dataclass
class Whitening:
    """n distinct vectors, the exact sums of their steps by dimension (without the offset), and the components."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray  # one in each column, by falling eigenvalue
    trace: float


def usable(vector: Column) -> Column:
    """Not null, and all entries are finite numbers."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))


def steps(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * scale))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and np.abs(flat).max() > MAX_STEPS:
        raise ValueError(f"an entry of more than {MAX_STEPS} steps")
    return flat.reshape(len(column), dim)


def _summed(rows: DataFrame, dim: int, cells: int, product) -> list[int]:
    """Exact sums over all rows of the whole numbers that ``product`` makes from a block of grid vectors."""

    def run(batches):
        total = np.zeros(cells, np.int64).astype(object)
        for b in batches:
            if b.num_rows:
                total = total + product(_matrix(b.column(0), dim)).reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(cells), pa.int32()), pa.array([str(int(v)) for v in total], pa.string())], names=["cell", "value"]
        )

    parts = map_arrow(rows.select("x"), run, "cell int, value string")
    sums = parts.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out = [0] * cells
    for r in sums.toLocalIterator():
        out[r.cell] = int(r.value)
    return out


def _exact_product(z: np.ndarray) -> np.ndarray:
    """z'z of whole numbers, in doubles as long as these hold every partial sum, else in Python's numbers."""
    top = int(np.abs(z).max()) if z.size else 0
    if top * top * len(z) < 1 << 53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = z.astype(object)
    return o.T @ o


def _exact_sums(x: np.ndarray) -> np.ndarray:
    # MAX_STEPS bounds the entries, so that 64 bits hold the sums of any batch
    return x.sum(0).astype(object)


def pivoted_cholesky(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (columns as many as the rank) and the order of the rows: c[order][:, order] = L L'."""
    a, d = c.astype(np.float64).copy(), len(c)
    order, low = np.arange(d), np.zeros((d, d))
    least = np.finfo(float).eps * 8 * d * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if not a[p, p] > least:
            return low[:, :k], order
        for m in (a, a.T, low):
            m[[k, p]] = m[[p, k]]
        order[[k, p]] = order[[p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1 :, k] = a[k + 1 :, k] / low[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
    return low, order


def one_sided_jacobi(low: np.ndarray) -> np.ndarray:
    """The columns of ``low`` after plane rotations that leave every two of them orthogonal."""
    g = low.copy()
    r = g.shape[1]
    players = [*range(r), *[-1] * (r % 2)]
    for _ in range(SWEEPS):
        turned = False
        for _ in range(max(len(players) - 1, 0)):  # each two columns meet once a sweep, disjoint pairs at a time
            half = len(players) // 2
            pairs = np.array([(p, q) for p, q in zip(players[:half], reversed(players[half:])) if p >= 0 and q >= 0]).reshape(-1, 2)
            players = [players[0], players[-1], *players[1:-1]]
            u, v = g[:, pairs[:, 0]], g[:, pairs[:, 1]]
            alpha, beta, gamma = (u * u).sum(0), (v * v).sum(0), (u * v).sum(0)
            turn = np.abs(gamma) > ORTHOGONAL * np.sqrt(alpha * beta)
            if not turn.any():
                continue
            turned = True
            zeta = (beta - alpha)[turn] / (2 * gamma[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, t)
            sin = cos * t
            i, j = pairs[turn, 0], pairs[turn, 1]
            g[:, i], g[:, j] = cos * u[:, turn] - sin * v[:, turn], sin * u[:, turn] + cos * v[:, turn]
        if not turned:
            break
    return g


def decompose(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a scatter matrix, as many as its rank."""
    low, order = pivoted_cholesky(scatter)
    g = one_sided_jacobi(low)
    norms = np.sqrt((g * g).sum(0))
    by = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(g)
    vectors[order] = g[:, by] / norms[by]
    return norms[by] ** 2, vectors


def fit_list(df: DataFrame, vector_col: str, scale: int = SCALE) -> DataFrame:
    """Each distinct grid vector ``x`` once, as a table in the shared folder."""
    v = F.col(f"`{vector_col}`")
    return stored(df.where(usable(v)).select(steps(v, scale).alias("x")).distinct(), "fit-list")


def fit(distinct: DataFrame) -> Whitening:
    """Count, sums and components of the vectors ``x``."""
    n, least, most = distinct.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n or not most:
        return Whitening(n, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    if least != most:
        raise ValueError(f"vectors of {least} to {most} entries")
    if most > MAX_DIM:
        raise ValueError(f"vectors of {most} entries; at most {MAX_DIM} are taken")
    sums = _summed(distinct, most, most, _exact_sums)
    centre = [round(Fraction(s, n)) for s in sums]
    shift, upper = np.array(centre, np.int64), np.triu_indices(most)
    raw = _summed(distinct, most, len(upper[0]), lambda x: _exact_product(x - shift)[upper])
    rest = [s - n * c for s, c in zip(sums, centre)]  # the sums of the entries as centred
    scatter = np.zeros((most, most))
    scatter[upper] = [float(Fraction(v * n - rest[i] * rest[j], n)) for v, i, j in zip(raw, *upper)]
    scatter += np.triu(scatter, 1).T
    values, vectors = decompose(scatter)
    return Whitening(n, sums, values / n, vectors, float(np.trace(scatter) / n))


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - sums, in whole numbers."""
    top = int(np.abs(x).max(initial=0)) * model.n + max(map(abs, model.sums), default=0)
    kind = np.int64 if top < 1 << 62 else object
    return x.astype(kind) * model.n - np.array(model.sums, kind)


def _whitened(y: np.ndarray, model: Whitening, k: int) -> np.ndarray:
    return (y / model.n).astype(np.float64) @ (model.components[:, :k] / np.sqrt(model.eigenvalues[:k]))


def _deviation(y: np.ndarray) -> list[int]:
    top = int(np.abs(y).max(initial=0))
    if top * top * max(y.shape[1], 1) >= 1 << 63:
        y = y.astype(object)
    out = [int(v) for v in (y * y).sum(1)]
    if max(out, default=0) >= 1 << 63:
        raise ValueError("a deviation beyond 64 bits")
    return out


def identity_error(distinct: DataFrame, model: Whitening, components: int = COMPONENTS) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, from the vectors themselves."""
    k = min(components, len(model.eigenvalues))
    if not k:
        return 0.0
    dim = len(model.sums)

    def run(batches):
        total, products = np.zeros(k), np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                w = _whitened(_centred(_matrix(b.column(0), dim), model), model, k)
                total, products = total + w.sum(0), products + w.T @ w
        flat = np.concatenate([total, products.reshape(-1)])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], names=["cell", "value"])

    sums = map_arrow(distinct.select("x"), run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    flat = np.zeros(k + k * k)
    for r in sums.toLocalIterator():
        flat[r.cell] = r.value / model.n
    mean = flat[:k]
    return float(np.abs(flat[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """The usable rows of ``df`` with ``deviation`` and ``whitened`` (an array, by component), in one narrow step."""
    k, dim = min(components, len(model.eigenvalues)), len(model.sums)
    kept = [c for c in df.columns if c.lower() not in ("deviation", "whitened")]
    v = F.col(f"`{vector_col}`")
    source = df.where(usable(v)).select(row_of(df, kept).alias("row"), steps(v, scale).alias("x"))
    schema = T.StructType([source.schema["row"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            y = _centred(_matrix(b.column(1), dim), model)
            w = _whitened(y, model, k)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(w) + 1) * k, k) if k else np.zeros(len(w) + 1), pa.int32()), pa.array(w.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_deviation(y), pa.int64()), lists], names=["row", "deviation", "whitened"])

    return map_arrow(source, run, schema).select(*fields_of("row", kept), "deviation", "whitened")


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """One row for each usable vector and component; all sums are over the distinct grid vectors of the whole table."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    distinct = fit_list(rows, "embedding")
    model = fit(distinct)
    error = identity_error(distinct, model)
    share = [float(e / model.trace) for e in model.eigenvalues[:COMPONENTS]]
    each = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    explained = F.element_at(F.array(*map(F.lit, share or [0.0])), F.col("k") + 1)
    return each.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error")
    )
