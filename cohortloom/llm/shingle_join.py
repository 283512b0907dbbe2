"""Groups of documents whose sets of word shingles have a Jaccard similarity of at least 4/5, every pair verified.

Candidates come from two searches. The SimHash grid (``simhash.links``) names fingerprints within a few bits; it is
cheap and linear in large groups, but misses most pairs of similarity 0.8 to 0.95. The prefix filter misses none: in any
one order of all shingles, two sets of similarity t share a shingle among the first n - ceil(t n) + 1 of each. The order
puts shingles last that are frequent in a block of texts, so a passage that many documents hold rarely is in a prefix;
which shingles those are changes the work, not the result.

Prefix shingles name cells. First every set of a cell is compared with the cell's hub, a set that it has in common with as
many others as possible, and fingerprints with their links; verified pairs close to components. Then, in cells that still hold several components, all pairs of
different components are compared, so a large group of near copies costs no pair of its own members. A crowded one of these
is dealt out first: sets alike that share a shingle of their prefixes share a second one, once a shingle longer, and so on, so
cells are named by two and then three shingles (``SPLITS``).

Two bounds spare exact comparisons and never drop a pair that belongs: sizes, and the parities of the shingles in each of
as many hash classes as a set has shingles (rounded up to a power of two, folded to the smaller of both sets). Two sets
differ in at least as many shingles as parities, and may differ in (n + m) / 9 of them.

Most prefix shingles stand in one text alone. They are counted by hash alone; a bitmap of the counted ones that recur
then thins the (shingle, set) rows before these are shuffled. When the bitmap is full, more rows travel, to no effect.

Shingles are compared by their XXH64 (seed 42), sets are named by the XXH64 of their sorted shingles. Full sets are
made only of documents in a pair that the bounds leave. Bitmaps have 8 MB at most (``common.BITMAPS``), whatever the corpus.

Nulls and edges: texts without words have the empty set and are alike; fewer words than a shingle make one shingle;
a null id counts as larger than any other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bitmap, compact, cut_lineage, in_bitmap, map_arrow, place, stored, text_or_empty
from .components import components
from .simhash import HOT_CELL, MAX_BITS, WORDS, links, representatives

#: the least similarity, as a fraction
OVER, UNDER = 4, 5
#: shingles of a block of texts are frequent from so many texts on; at most FREQUENT of them are ordered apart
BLOCK, OFTEN, FREQUENT = 1 << 19, 3, 1 << 17
#: rows whose shingles a worker returns at once
ROWS = 512
#: open cells of more sets are named by one more shingle, so many times
CROWDED, SPLITS = 1024, 2


def shingle_bytes(text: str, words: int) -> np.ndarray:
    """A row of eight bytes, the big-endian XXH64, for each shingle of the text."""
    import xxhash

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros((0, 8), np.uint8)
    line, n, digest = b" ".join(parts), max(1, len(parts) - words + 1), xxhash.xxh64_digest
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    raw = b"".join([digest(line[i:j], 42) for i, j in zip(starts, ends[min(words, len(parts)) - 1 :].tolist())])
    return np.frombuffer(raw, np.uint8).reshape(-1, 8)


def sliced(batches):
    """Parts of the batches: a row's shingles take several times the room of its text."""
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            yield b.slice(i, ROWS)


def shingle_set(raw: np.ndarray) -> np.ndarray:
    return np.unique(raw.reshape(-1).view(">i8").astype(np.int64))


def set_key(shingles: np.ndarray) -> int:
    import xxhash

    key = xxhash.xxh64_intdigest(shingles.tobytes(), 42)
    return key - (1 << 64) if key >> 63 else key


def alike(inter: Column, a: Column, b: Column) -> Column:
    return inter * UNDER >= (a + b - inter) * OVER


def sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * UNDER >= F.greatest(a, b) * OVER


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether the shingles of each hash class are odd in number, 64 classes in a signed number; n to 2 n classes."""
    classes = max(64, 1 << max(0, len(shingles) - 1).bit_length())
    odd = np.bincount(shingles & (classes - 1), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def parities_apart(a: Column, b: Column) -> Column:
    """Number of classes whose parities differ, once the finer of both is folded."""

    def folded(x: Column, y: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(y), F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))).otherwise(x)

    apart = F.zip_with(folded(a, b), folded(b, a), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(apart, F.lit(0), lambda n, v: n + v)


def _signatures(source: DataFrame, words: int) -> DataFrame:
    """id, th, fp, key, n and marks (parities) of each row of ``source`` (id, th, text); and rows (h, c): texts c of a block hold shingle h."""
    kind = source.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), *[T.StructField(c, T.LongType()) for c in ("th", "fp", "key", "n")], T.StructField("marks", T.ArrayType(T.LongType())), *[T.StructField(c, T.LongType()) for c in ("h", "c")]])
    types = [pa.list_(pa.int64()) if f.name == "marks" else pa.int64() for f in schema[2:]]

    def frequent(block, like):
        found, n = np.unique(np.concatenate(block), return_counts=True)
        found, n = found[n >= OFTEN], n[n >= OFTEN]
        none = [pa.nulls(len(found), t) for t in [like.type, pa.int64(), *types[:-2]]]
        return pa.RecordBatch.from_arrays([*none, pa.array(found), pa.array(n)], names=schema.names)

    def run(batches):
        block, held, like = [], 0, None
        for b in sliced(batches):
            out, like = [], b.column(0)
            for text in b.column(2).to_pylist():
                raw = shingle_bytes(text, words)
                shingles = shingle_set(raw)
                ones = np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
                fp = int.from_bytes(np.packbits(2 * ones > len(raw)).tobytes(), "big", signed=True)
                out.append((fp, set_key(shingles), len(shingles), parities(shingles)))
                block.append(shingles)
                held += len(shingles)
                if held >= BLOCK:
                    yield frequent(block, like)
                    block, held = [], 0
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, types)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns, *[pa.nulls(len(out), pa.int64())] * 2], names=schema.names)
        if block:
            yield frequent(block, like)

    return map_arrow(source, run, schema)


def _prefixes(source: DataFrame, words: int, order) -> DataFrame:
    """key, p and prefix of the texts: its first p shingles name cells, up to ``SPLITS`` more split them. Of equal sets a
    task returns the first alone, as far as it can remember them."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("p", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType()))])

    def run(batches):
        often, level = order.value
        seen: set[int] = set()
        for b in sliced(batches):
            out = []
            for text in b.column(0).to_pylist():
                shingles = shingle_set(shingle_bytes(text, words))
                n, key = len(shingles), set_key(shingles)
                if not n or key in seen:
                    continue
                if len(seen) < FREQUENT:
                    seen.add(key)
                rank = np.zeros(n, np.int64)
                if len(often):
                    at = np.minimum(np.searchsorted(often, shingles), len(often) - 1)
                    rank = np.where(often[at] == shingles, level[at], 0)
                p = n + (-OVER * n // UNDER) + 1
                out.append((key, p, shingles[np.lexsort((shingles, rank))[: p + SPLITS]]))
            columns = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.int64())))], names=schema.names)

    return map_arrow(source.select("text"), run, schema)


def _recurring(prefixes: DataFrame) -> DataFrame:
    """Rows (h, key) of the prefix shingles that several sets have, with ``hub``, one of those sets; stored."""
    prefixes = prefixes.select("key", F.slice("prefix", F.lit(1), F.col("p").cast("int")).alias("prefix"))
    counted = prefixes.select(F.explode("prefix").alias("h")).groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    counted = stored(counted.select("h"), "recurring")
    held = prefixes.sparkSession.sparkContext.broadcast(bitmap(counted.select(place(F.col("h")).alias("p"))))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("h", T.LongType())])

    def run(batches):
        table = held.value
        for b in batches:
            lists = b.column(1)
            h = np.asarray(lists.flatten(), dtype=np.int64)
            keys = np.repeat(np.asarray(b.column(0), dtype=np.int64), np.diff(np.asarray(lists.offsets)))
            keep = in_bitmap(table, h)
            yield pa.RecordBatch.from_arrays([pa.array(keys[keep]), pa.array(h[keep])], names=schema.names)

    rows = stored(map_arrow(prefixes.select("key", "prefix"), run, schema).join(counted, "h").distinct(), "rows")
    sizes = compact(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    # the hub of a cell is its set with the largest cells: a group of near copies then has few hubs, whatever its size
    weight = rows.join(sizes, "h").groupBy("key").agg(F.sum("n").alias("w"))
    hubs = rows.join(weight, "key").groupBy("h").agg(F.max(F.struct("w", "key"))["key"].alias("hub"))
    return stored(rows.join(compact(hubs.join(sizes, "h").select("h", "hub")), "h"), "cells")


def _sets(source: DataFrame, words: int, needed: DataFrame) -> DataFrame:
    """key and set of the texts whose hash ``needed`` (th) names, and of a few more that fall on the same bit."""
    held = source.sparkSession.sparkContext.broadcast(bitmap(needed.select(place(F.col("th")).alias("p"))))
    marked = source.select("text", "th")
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("set", T.ArrayType(T.LongType()))])

    def run(batches):
        wanted, seen = held.value, set()
        for b in sliced(batches):
            texts = b.column(0).filter(pa.array(in_bitmap(wanted, np.asarray(b.column(1), dtype=np.int64))))
            out = []
            for text in texts.to_pylist():
                shingles = shingle_set(shingle_bytes(text, words))
                key = set_key(shingles)
                if key not in seen:
                    out.append((key, shingles))
                    if len(seen) < FREQUENT:
                        seen.add(key)
            columns = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.list_(pa.int64())))], names=schema.names)

    return map_arrow(marked, run, schema)


def _may_be_alike(n: Column, marks: Column, m: Column, others: Column) -> Column:
    """Neither sizes nor parities rule the pair out."""
    apart = parities_apart(marks, others)
    # with d shingles in one set alone, (n + m - d) / (n + m + d) is the similarity
    return sizes_allow(n, m) & ((n + m - apart) * UNDER >= (n + m + apart) * OVER)


def _bounds(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """n and marks of each set that ``keys`` names; stored."""
    found = rows.join(keys.distinct(), "key", "left_semi").groupBy("key").agg(F.min("n").alias("n"), F.min("marks").alias("marks"))
    return stored(found, "bounds")


def _possible(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys that neither sizes nor parities rule out."""
    bounds = _bounds(rows, pairs.select(F.col("a").alias("key")).union(pairs.select("b")))
    one = pairs.join(bounds.toDF("a", "a_n", "a_marks"), "a")
    both = one.join(bounds.toDF("b", "b_n", "b_marks"), "b")
    return compact(both.where(_may_be_alike(F.col("a_n"), F.col("a_marks"), F.col("b_n"), F.col("b_marks"))).select("a", "b"))


def _verified(pairs: DataFrame, rows: DataFrame, source: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) of keys whose sets are alike."""
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    needed = rows.join(keys, "key", "left_semi").groupBy("key").agg(F.min("th").alias("th"))
    sets = _sets(source, words, needed).join(keys, "key", "left_semi").dropDuplicates(["key"])
    sets = stored(sets, "sets")
    one = pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("s")), "a")
    both = one.join(sets.select(F.col("key").alias("b"), F.col("set").alias("t")), "b")
    common = F.size(F.array_intersect("s", "t"))
    return both.where(alike(common, F.size("s"), F.size("t"))).select("a", "b")


def _dealt_out(left: DataFrame, prefixes: DataFrame, crowded: int) -> DataFrame:
    """The rows (h, key, root) of open cells; crowded cells are dealt out to cells of one more shingle where that leaves
    fewer pairs (sets that are near in truth share most of theirs, so they stay where they are)."""
    cells, done = left.select("h", "key", "root", F.array("h").alias("used")), None
    for level in range(SPLITS + 1):
        several = F.min("root") != F.max("root")
        sizes = cells.groupBy("h").agg(F.count("*").alias("c"), several.alias("open")).where("open").drop("open")
        cells = compact(cells.join(sizes, "h"))
        many = cells.where(F.col("c") > crowded)
        if level == SPLITS or many.isEmpty():
            break
        longer = F.explode(F.slice("prefix", F.lit(1), F.col("p").cast("int") + level + 1)).alias("g")
        finer = many.join(prefixes.dropDuplicates(["key"]), "key").select("h", "c", "key", "root", "used", longer).where(~F.array_contains("used", F.col("g")))
        finer = compact(finer.select(F.col("h").alias("from"), "c", "key", "root", F.array_sort(F.concat("used", F.array("g"))).alias("used")).withColumn("h", F.xxhash64("used")))
        pairs = finer.groupBy("from", "h").agg(F.count("*").alias("n"), F.any_value("c").alias("c"), several.alias("open"))
        cost = pairs.groupBy("from").agg(F.sum(F.when(F.col("open"), F.col("n") * F.col("n")).otherwise(0)).alias("n"), F.max("c").alias("c"))
        worth = compact(cost.where(F.col("n") < F.col("c") * F.col("c")).select("from"))
        stay = cells.join(worth, F.col("h") == F.col("from"), "left_anti").select("h", "key", "root")
        done = stay if done is None else done.union(stay)
        cells = finer.join(worth, "from", "left_semi").select("h", "key", "root", "used").distinct()
    rest = cells.select("h", "key", "root")
    return rest if done is None else done.union(rest)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, max_bits: int = MAX_BITS, hot_cell: int = HOT_CELL, crowded: int = CROWDED) -> DataFrame:
    """id, th (XXH64 of the whole text), key of the set, and rep: the least row (is_null, id, th) of its component."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(F.col(f"`{text_col}`").cast("string")).alias("text"))
    source = source.select("id", F.xxhash64("text").alias("th"), "text")
    found = cut_lineage(_signatures(source, words))
    rows = found.where("h IS NULL").drop("h", "c")
    often = found.where("h IS NOT NULL").groupBy("h").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "h").limit(FREQUENT).orderBy("h").toArrow()
    order = docs.sparkSession.sparkContext.broadcast(tuple(often.column(c).to_numpy() for c in ("h", "c")))

    row = F.struct(F.col("id").isNull().alias("is_null"), F.col("id"), F.col("th"))
    points = compact(rows.groupBy("key").agg(F.min("fp").alias("fp"), F.min("n").alias("n"), F.min(row).alias("rep")))
    # of each fingerprint the least set stands for it; the others are compared with that one
    heads = compact(points.groupBy("fp").agg(F.min("key").alias("head")))
    linked = links(heads.select("fp"), max_bits, hot_cell)
    linked = linked.join(heads.toDF("a", "u"), "a").join(heads.toDF("b", "v"), "b").select("u", "v")
    near = points.join(heads, "fp").where("key <> head").select("key", "head").union(linked)

    prefixes = stored(_prefixes(source, words, order), "prefixes")
    cells = _recurring(prefixes)
    stars = cells.where("key <> hub").select("key", "hub")

    pairs = near.union(stars).toDF("x", "y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    pairs = compact(pairs.distinct())
    first = compact(_verified(_possible(pairs, rows), rows, source, words))
    roots = components(first)

    placed = cells.join(roots, cells.key == roots.node, "left").select("h", "key", F.coalesce("root", "key").alias("root"))
    left = compact(_dealt_out(placed, prefixes, crowded))
    left = left.join(_bounds(rows, left.select("key")), "key")
    x, y = left.alias("x"), left.alias("y")
    # what the bounds rule out is not even a row of the join
    alike_maybe = _may_be_alike(F.col("x.n"), F.col("x.marks"), F.col("y.n"), F.col("y.marks"))
    rest = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.key") < F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & alike_maybe)
    rest = rest.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()
    rest = compact(rest.join(pairs, ["a", "b"], "left_anti"))
    roots = components(first.union(_verified(rest, rows, source, words)))

    best = points.join(roots, points.key == roots.node).groupBy("root").agg(F.min("rep").alias("best"))
    moved = roots.join(best, "root").select(F.col("node").alias("key"), "best")
    named = compact(points.join(moved, "key", "left").select("key", F.coalesce("best", "rep").alias("rep")))
    return rows.join(named, "key").select("id", "th", "key", "rep")


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group, the one with the least id, with all its columns."""
    return representatives(docs, similar_groups(docs, id_col, text_col, **options).select("rep.id", "rep.th"), id_col, text_col)
