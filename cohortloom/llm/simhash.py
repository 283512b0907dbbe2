"""Near-duplicate groups by SimHash and a segment-popcount embedding.

The fingerprint of a document is the bitwise majority of the XXH64 (seed 42) of its word shingles. The embedding counts
the set bits of each two-bit segment; its Manhattan distance is never more than the Hamming distance. Segments form
``max_bits + 3`` bands: two points within Manhattan distance ``max_bits`` agree in at least three bands, so they share
one of the grid cells that three bands name. Within a cell the join keeps pairs within the Manhattan bound and then
verifies the Hamming distance exactly.

Equal fingerprints are one point (copies never meet). The points of a crowded cell (more than ``HOT_CELL``) are dealt out
again: the segments that its three bands leave form ``max_bits + 3`` finer bands, of which two near points again agree in
at least three. What is still crowded then is a dense cloud of fingerprints, as a very large group of near copies makes
it, whose links are as many as its pairs. Its points are joined without pairs: two points differ in at most k bits just
if one flips floor(k/2) bits and the other ceil(k/2) to meet, so each point visits the values near it, and all visitors
of a value are linked to the least of them that needs the fewer flips. That is linear in the points and loses no link.

Links are closed to components by alternating stars; fingerprints, links and components stay on the executors.

Nulls and edges: a null or empty text has fingerprint zero and links like any other; fewer words than a shingle make one
shingle; a null id counts as larger than any other; repeated rows fall into one component; an empty table gives an
empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, documents, fields_of, map_batches, row_of, text_or_empty
from .components import components

WORDS = 5
MAX_BITS = 3
HOT_CELL = 64
LEVELS = 2
SLICE = 1 << 15
LOW_BITS = 0x5555555555555555


def fingerprint(text: str | None, words: int) -> int:
    """Signed 64-bit fingerprint; A-Z count as a-z, words are parted by ASCII white space."""
    import xxhash

    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for a in range(0, n, SLICE):
        first = starts[a : min(n, a + SLICE)].tolist()
        last = ends[min(words, len(parts)) - 1 :][a : a + SLICE].tolist()
        raw = b"".join([digest(line[i:j], 42) for i, j in zip(first, last)])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """id, a hash of the whole text and the fingerprint of each document, checkpointed."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(F.col(f"`{text_col}`").cast("string")).alias("text"))

    def run(batches):
        for texts, _ in batches:
            yield [pa.array([fingerprint(t, words) for t in texts], pa.int64())]

    schema = T.StructType([T.StructField("fp", T.LongType())])
    return cut_lineage(map_batches(source.withColumn("th", F.xxhash64("text")), "text", run, schema, keep=["id", "th"]))


def embed(fp: Column) -> Column:
    """The popcounts of the 32 two-bit segments as the two-bit digits of one number."""
    up, low = F.shiftrightunsigned(fp, 1), F.lit(LOW_BITS)
    return fp.bitwiseXOR(up).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(up).bitwiseAND(low), 1))


def manhattan(a: Column, b: Column) -> Column:
    """Sum of the differences of digits 0, 1, 2: a difference of two shows as 0 against 2 only."""
    x = a.bitwiseXOR(b)
    low, high = x.bitwiseAND(F.lit(LOW_BITS)), F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(LOW_BITS))
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def _choices(segments: list[int], max_bits: int) -> list[list[int]]:
    """The segments of each choice of three among ``max_bits + 3`` bands."""
    n = max_bits + 3
    cuts = [len(segments) * i // n for i in range(n + 1)]
    bands = [segments[a:b] for a, b in zip(cuts, cuts[1:])]
    return [sorted(sum(chosen, [])) for chosen in combinations(bands, 3)]


def _mask(segments: list[int]) -> int:
    """The digits of these segments, as a signed number."""
    m = sum(3 << (2 * s) for s in segments)
    return m - (1 << 64) if m >> 63 else m


def links(points: DataFrame, max_bits: int, hot_cell: int = HOT_CELL) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``fp``; they connect just what pairs within ``max_bits`` connect."""
    chosen = _choices(list(range(32)), max_bits)
    grid = points.select("fp", embed(F.col("fp")).alias("e"))
    named = F.array(*[F.struct(F.lit(i).alias("c"), F.col("e").bitwiseAND(F.lit(_mask(x))).alias("cell")) for i, x in enumerate(chosen)])
    cells, near = grid.select("fp", "e", F.inline(named)), None
    for level in range(LEVELS):
        crowded = cut_lineage(cells.groupBy("c", "cell").agg(F.count("*").alias("n")).where(F.col("n") > hot_cell).select("c", "cell"))
        a, b = (cells.join(crowded, ["c", "cell"], "left_anti").alias(x) for x in "ab")
        found = a.join(
            b,
            (F.col("a.c") == F.col("b.c"))
            & (F.col("a.cell") == F.col("b.cell"))
            & (F.col("a.fp") < F.col("b.fp"))
            & (manhattan(F.col("a.e"), F.col("b.e")) <= max_bits)
            & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits),
        ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
        near = found if near is None else near.union(found)
        cells = cells.join(crowded, ["c", "cell"], "left_semi")
        if level + 1 == LEVELS or crowded.isEmpty():
            break
        finer = [[x + y for y in _choices([s for s in range(32) if s not in x], max_bits)] for x in chosen]
        masks = F.array(*[F.array(*[F.lit(_mask(x)) for x in xs]) for xs in finer])
        cells = cells.select("fp", "e", "c", F.posexplode(masks[F.col("c")]).alias("j", "m"))
        cells = cells.select("fp", "e", (F.col("c") * len(finer[0]) + F.col("j")).alias("c"), F.col("e").bitwiseAND(F.col("m")).alias("cell"))
        chosen = sum(finer, [])
    if crowded.isEmpty():
        return near.distinct()

    few, many = max_bits // 2, max_bits - max_bits // 2
    visits = cells.select("fp").distinct()
    visits = visits.withColumns({"value": F.col("fp"), "flips": F.lit(0)})
    for _ in range(many):  # at each step flip one more bit, above the last one, or none
        at = F.col("at") if "at" in visits.columns else F.lit(-1)
        visits = visits.withColumn("next", F.explode(F.sequence(F.least(at + 1, F.lit(64)), F.lit(64))))
        flip = F.when(F.col("next") < 64, F.expr("shiftleft(1L, next)")).otherwise(F.lit(0).cast("long"))
        visits = visits.select("fp", F.col("value").bitwiseXOR(flip).alias("value"), (F.col("flips") + (F.col("next") < 64).cast("int")).alias("flips"), F.col("next").alias("at"))
    anchor = F.min(F.when(F.col("flips") <= few, F.col("fp"))).alias("a")
    # no more visitors than there are values within that many flips
    met = visits.groupBy("value").agg(anchor, F.collect_set("fp").alias("all")).where("a IS NOT NULL AND size(all) > 1")
    stars = met.select("a", F.explode("all").alias("b")).where("a <> b")
    return near.union(stars).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, max_bits: int = MAX_BITS, hot_cell: int = HOT_CELL) -> DataFrame:
    """id, th (XXH64 of the whole text), fp, and rep: the least row (is_null, id, th) of its component."""
    rows = fingerprints(docs, id_col, text_col, words)
    row = F.struct(F.col("id").isNull().alias("is_null"), F.col("id"), F.col("th"))
    points = cut_lineage(rows.groupBy("fp").agg(F.min(row).alias("rep")))
    roots = cut_lineage(components(links(points.select("fp"), max_bits, hot_cell)))
    linked = points.join(roots, points.fp == roots.node).select("fp", "root", "rep")
    best = cut_lineage(linked.groupBy("root").agg(F.min("rep").alias("best")))
    moved = cut_lineage(roots.join(best, "root").select(F.col("node").alias("fp"), "best"))
    named = cut_lineage(points.join(moved, "fp", "left").select("fp", F.coalesce("best", "rep").alias("rep")))
    return rows.join(named, "fp").select(F.col("id"), "th", "fp", "rep")


def representatives(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents that ``reps`` (id, th: XXH64 of the text) names, one row for each, with all their columns."""
    # nulls as a column of their own: the join and the search for repeated rows then share one exchange of the texts
    zero = F.lit(0).cast(docs.schema[id_col].dataType)
    key = ["is_null", "id", "th"]
    named = lambda i: [i.isNull().alias("is_null"), F.coalesce(i, zero).alias("id")]
    wanted = cut_lineage(reps.select(*named(F.col("id")), "th").distinct())
    text = text_or_empty(F.col(f"`{text_col}`").cast("string"))
    kept = docs.select(*named(F.col(f"`{id_col}`")), F.xxhash64(text).alias("th"), row_of(docs).alias("row")).join(wanted, key, "left_semi")
    return kept.dropDuplicates(key).select(*fields_of("row", docs.columns))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component, the one with the least id, with all its columns."""
    return representatives(docs, near_groups(docs, id_col, text_col, **options).select("rep.id", "rep.th"), id_col, text_col)


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_groups(documents(spark, sf_dir), words=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("rep.id").alias("component_id"))
