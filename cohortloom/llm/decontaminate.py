"""Benchmark decontamination with one Aho-Corasick automaton over all normalised benchmark windows.

Benchmark texts (questions and answers) and documents are normalised alike: A-Z lower-cased, words are runs of digits,
letters a-z and characters beyond ASCII. Each run of ``window`` benchmark words (the whole item if it is shorter) is one
pattern over the numbers of the benchmark's words; words that no item holds are number zero. A document is scanned once;
a match is mapped back to word positions and to code-point offsets of the original.

The benchmark is broadcast and each worker builds the automaton, about 110 MB for each MB of benchmark text (measured on
random words, no two windows alike). A benchmark of more than ``max_bytes`` is dealt out to blocks of about that size by the
hash of the item; each block has its automaton and its pass over the texts, and a document's marks of all blocks are
joined. The result is the same.

Nulls and edges: a null or empty text has no words; benchmark items without words match nothing; repeated items all
count; an empty benchmark leaves every document clean; null item ids are reported as ``null``, as is an item of that name;
input columns named like a result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, fields_of, map_batches, row_of, stored

WINDOW = 10
#: Bytes of benchmark text in one automaton, which takes about 110 MB a worker for each MB.
MAX_BYTES = 2 << 20
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)

# word bytes stay (A-Z as a-z), every other ASCII byte becomes a space; bytes of characters beyond ASCII stay
_WORD_BYTES = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


@lru_cache(maxsize=2)
def _automaton(items: tuple[tuple[str, str], ...], window: int):
    """(number of each benchmark word, automaton over numbers, words of the shortest pattern); a pattern's value is its words and items."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], list[int]] = {}
    for k, (_, text) in enumerate(items):
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            own = owners.setdefault(tuple(ids[i : i + window]), [])
            if not own or own[-1] != k:
                own.append(k)
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for pattern, ks in owners.items():
        machine.add_word(pattern, (len(pattern), ks))
    if owners:
        machine.make_automaton()
    return numbers, machine if owners else None, min(map(len, owners), default=0)


def _scan(text: str | None, numbers: dict[bytes, int], machine, least: int) -> tuple[int, list[tuple[int, int, list[int]]]]:
    """Number of words, and (first word, words, items) of every occurrence."""
    words = words_of(text)
    if not words or machine is None:
        return len(words), []
    get = numbers.get
    ids = [get(w, 0) for w in words]
    # a match lies within a stretch of benchmark words: elsewhere the automaton would stay at its root
    hits = []
    for stretch in re.finditer(rb"\x01{%d,}" % least, bytes(map(bool, ids))):
        first, last = stretch.span()
        hits += [(first + end - n + 1, n, ks) for end, (n, ks) in machine.iter(tuple(ids[first:last]))]
    return len(words), hits


def _offsets(text: str, hit: np.ndarray) -> list[list[int]]:
    """Code-point [start, end) of each run of hit words."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_TABLE), np.uint8)
    is_word = np.concatenate(([0], (raw != 0x20).astype(np.int8), [0]))
    edge = np.diff(is_word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) & 0xC0) != 0x80)))
    run = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return [[int(points[starts[a]]), int(points[ends[b - 1]])] for a, b in zip(np.flatnonzero(run == 1), np.flatnonzero(run == -1))]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, max_bytes: int) -> tuple[int, Callable[[int], tuple[tuple[str, str], ...]]]:
    """Number of blocks of about ``max_bytes`` of text (a larger item is a block of its own size), and the items of each."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("item"), text.alias("text"))
    size = benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-size // max_bytes))

    def of(k: int) -> tuple[tuple[str, str], ...]:
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        return tuple(sorted(map(tuple, own.collect())))

    return blocks, of


def _marks(texts: list[str | None], items: tuple[tuple[str, str], ...], window: int) -> Iterator[tuple[int, np.ndarray | None, list[str]]]:
    """Number of words, which of them are hit (None: none), and the names of the items, for each text."""
    built = _automaton(items, window)
    for text in texts:
        n, hits = _scan(text, *built)
        hit = None
        if hits:
            hit = np.zeros(n, bool)
            for a, k, _ in hits:
                hit[a : a + k] = True
        yield n, hit, sorted({items[k][0] for _, _, ks in hits for k in ks})


def _result(texts: list[str | None], marks: list[tuple[int, np.ndarray | None, list[str]]]) -> list[pa.Array]:
    return [
        pa.array([n for n, _, _ in marks], pa.int64()),
        pa.array([0 if hit is None else int(hit.sum()) for _, hit, _ in marks], pa.int64()),
        pa.array([names for _, _, names in marks], pa.list_(pa.string())),
        pa.array([[] if hit is None else _offsets(text, hit) for text, (_, hit, _) in zip(texts, marks)], pa.list_(pa.list_(pa.int64()))),
    ]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_bytes: int = MAX_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside any benchmark window), item_ids (sorted strings) and hit_spans.

    ``hit_spans`` are code-point [start, end) ranges of the original text.
    """
    blocks, items_of = _blocks(benchmark, item_col, item_text_col, max_bytes)
    if blocks > 1:
        return _by_blocks(docs, blocks, items_of, text_col, window, keep)
    shared = docs.sparkSession.sparkContext.broadcast(items_of(0))

    def run(batches):
        for texts, _ in batches:
            yield _result(texts, list(_marks(texts, shared.value, window)))

    return map_batches(docs, text_col, run, RESULT, keep)


def _by_blocks(docs: DataFrame, blocks: int, items_of: Callable, text_col: str, window: int, keep: list[str] | None) -> DataFrame:
    """The same with one pass over the texts for each block of the benchmark; the ranges of hit words are kept in between."""
    spark, taken = docs.sparkSession, {f.name for f in RESULT}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    row = row_of(docs, kept) if kept else F.lit(True)
    table = docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"), F.array().cast("array<array<bigint>>").alias("ranges"), F.array().cast("array<string>").alias("names"))
    new = T.StructType([T.StructField("new_ranges", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("new_names", T.ArrayType(T.StringType()))])
    for k in range(blocks):
        shared = spark.sparkContext.broadcast(items_of(k))

        def scan(batches, shared=shared):
            for texts, _ in batches:
                ranges, names = [], []
                for _, hit, own in _marks(texts, shared.value, window):
                    edge = np.zeros(0, np.int64) if hit is None else np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                    ranges.append(edge.reshape(-1, 2).tolist())
                    names.append(own)
                yield [pa.array(ranges, pa.list_(pa.list_(pa.int64()))), pa.array(names, pa.list_(pa.string()))]

        seen = map_batches(table, "text", scan, new, keep=["row", "text", "ranges", "names"])
        table = stored(seen.select("row", "text", F.concat("ranges", "new_ranges").alias("ranges"), F.array_union("names", "new_names").alias("names")), "block")

    def finish(batches):
        for texts, batch in batches:
            marks = []
            for text, ranges, names in zip(texts, batch.column(0).field(1).to_pylist(), batch.column(0).field(2).to_pylist()):
                n, hit = len(words_of(text)), None
                if ranges:
                    hit = np.zeros(n, bool)
                    for a, b in ranges:
                        hit[a:b] = True
                marks.append((n, hit, sorted(names)))
            yield _result(texts, marks)

    done = map_batches(table, "text", finish, RESULT, keep=["row", "ranges", "names"])
    return done.select(*fields_of("row", kept), *[f.name for f in RESULT])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without any benchmark window, with the columns they had."""
    packed = docs.select(row_of(docs).alias("row"), F.col(f"`{text_col}`").alias("text"))
    marked = decontaminate(packed, benchmark, "text", keep=["row"], **options)
    return marked.where("n_hit = 0").select(*fields_of("row", docs.columns))


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
