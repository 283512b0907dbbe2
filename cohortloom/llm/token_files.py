"""Token ids in a compressed binary format: static range asymmetric numeral systems (rANS).

Documents are range-partitioned and sorted by id; each partition is a shard, so shards in order are the corpus in order.
A shard is cut into segments of up to ``SEGMENT`` tokens. The frequencies of all tokens of a segment make one table that
its blocks share. A block holds whole documents (at least ``BLOCK`` tokens, or the rest of the segment; a document of any
length is in one block) and stands alone: up to ``LANES`` interleaved coder states and, for every ``CHECKPOINT`` steps, a
part with the states at its beginning, the words that are read from there on, and CRC-32 checksums of both and of the ids.
A reader can start at any part: ``read_token_files`` decodes part by part, on request spread over tasks by block, and
``read_token_range`` decodes the parts that hold a range of the corpus, each of them in any task.

A file is a Parquet table of segments (table and blocks in one row, so reading needs no join), because its committer
survives lost executors and repeated tasks; the format proper is in the binary values. All numbers are little-endian.

Nulls and edges: a null or empty text is its end token alone; documents with a null id come first, those with equal ids
follow each other by text; ids that are no integers are refused; a text may have any length; an empty table writes and
reads as empty.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import documents, map_arrow, shared_path, text_or_empty
from .tokens import encoder, load_spec

SEGMENT = 1 << 22
BLOCK = 1 << 20
LANES = 4096
CHECKPOINT = 64
BITS = 20
LOW = 1 << 31
#: of each document of a block: whether its id is null, the id, its tokens
HEAD = "<?qI"
SEGMENT_SCHEMA = (
    "shard long, segment long, start long, n_tokens long, freq binary, freq_crc32 long, "
    "blocks array<struct<start: long, n_docs: long, n_tokens: long, lanes: long, heads: binary, heads_crc32: long, "
    "parts: array<struct<start: long, n_tokens: long, states: binary, words: binary, crc32: long, ids_crc32: long>>>>"
)


def quantise(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least 1 for every token that occurs."""
    total = 1 << bits
    present = np.flatnonzero(counts)
    if not len(present):
        return np.zeros(len(counts), np.int64)
    if len(present) > total:
        raise ValueError("more tokens than slots")
    own = counts[present].astype(np.float64)
    freq = np.maximum(1, np.floor(own / own.sum() * (total - len(present)))).astype(np.int64)
    gap = total - int(freq.sum())
    if gap >= 0:
        freq[int(own.argmax())] += gap
    else:
        for k in np.argsort(-freq, kind="stable"):
            cut = min(-gap, int(freq[k]) - 1)
            freq[k] -= cut
            gap += cut
            if not gap:
                break
    out = np.zeros(len(counts), np.int64)
    out[present] = freq
    return out


def encode_block(ids: np.ndarray, freq: np.ndarray, start: np.ndarray, bits: int = BITS) -> tuple[int, list[dict]]:
    """Lanes, and the parts in reading order: tokens, states at the beginning, words."""
    n = len(ids)
    lanes = max(1, min(LANES, n))
    if not n:
        return lanes, []
    f64, shift, word = freq.astype(np.uint64), np.uint64(bits), np.uint64(32)
    f, s, limit = f64[ids], start.astype(np.uint64)[ids], (f64 << np.uint64(63 - bits))[ids]
    rest = np.uint64(1 << bits) - f
    state = np.full(lanes, LOW, np.uint64)
    words, parts, end = [], [], n
    for step in range((n - 1) // lanes, -1, -1):
        a, b = step * lanes, min(n, step * lanes + lanes)
        x = state[: b - a]
        over = x >= limit[a:b]
        words.append(x[over].astype(np.uint32))
        np.right_shift(x, word, out=x, where=over)
        high = x // f[a:b]
        high *= rest[a:b]
        x += high
        x += s[a:b]
        if step % CHECKPOINT == 0:
            parts.append({"n_tokens": end - a, "states": state.tobytes(), "words": np.concatenate(words[::-1]).tobytes()})
            words, end = [], a
    return lanes, parts[::-1]


def decode_part(part: dict, lanes: int, freq: np.ndarray, start: np.ndarray, symbol: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The ids of one part."""
    n = part["n_tokens"]
    out = np.empty(n, np.uint32)
    state, stream, at = np.frombuffer(part["states"], np.uint64).copy(), np.frombuffer(part["words"], np.uint32), 0
    shift, word, mask = np.uint64(bits), np.uint64(32), np.uint64((1 << bits) - 1)
    for a in range(0, n, lanes):
        b = min(n, a + lanes)
        x = state[: b - a]
        slot = x & mask
        got = symbol[slot.view(np.int64)]
        out[a:b] = got
        x >>= shift
        x *= freq[got]
        x += slot
        x -= start[got]
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = (x[low] << word) | stream[at : at + len(low)]
            at += len(low)
    return out


def tables(freq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start = np.concatenate(([0], np.cumsum(freq)[:-1]))
    return freq.astype(np.uint64), start.astype(np.uint64), np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def _table_payload(freq: np.ndarray) -> bytes:
    at = np.flatnonzero(freq).astype(np.uint32)
    return zlib.compress(struct.pack("<II", len(freq), len(at)) + np.diff(at, prepend=0).astype(np.uint32).tobytes() + freq[at].astype(np.uint32).tobytes(), 6)


def _read_table(payload: bytes) -> np.ndarray:
    raw = zlib.decompress(payload)
    size, n = struct.unpack_from("<II", raw)
    freq = np.zeros(size, np.int64)
    freq[np.cumsum(np.frombuffer(raw, np.uint32, n, 8))] = np.frombuffer(raw, np.uint32, n, 8 + 4 * n)
    return freq


class _Shard:
    """Segments of one shard as rows of SEGMENT_SCHEMA."""

    def __init__(self, shard: int):
        self.shard, self.segment, self.start = shard, 0, 0
        self.ids, self.docs, self.lengths = [], [], []
        self.tokens = 0

    def add(self, doc: int | None, ids: bytes):
        self.ids.append(ids)
        self.docs.append(doc)
        self.lengths.append(len(ids) // 4)
        self.tokens += len(ids) // 4
        if self.tokens >= SEGMENT:
            yield self.flush()

    def flush(self) -> dict:
        ids = np.frombuffer(b"".join(self.ids), np.uint32)
        freq = quantise(np.bincount(ids))
        first = np.concatenate(([0], np.cumsum(freq)[:-1]))
        table = _table_payload(freq)
        row = {"shard": self.shard, "segment": self.segment, "start": self.start, "n_tokens": len(ids), "freq": table, "freq_crc32": zlib.crc32(table), "blocks": []}
        ends = np.cumsum(self.lengths)
        doc = at = 0
        while doc < len(self.docs):
            last = min(len(self.docs) - 1, int(np.searchsorted(ends, at + BLOCK)))
            part = ids[at : int(ends[last])]
            heads = b"".join([struct.pack(HEAD, i is None, i or 0, n) for i, n in zip(self.docs[doc : last + 1], self.lengths[doc : last + 1])])
            lanes, parts = encode_block(part, freq, first)
            cut = 0
            for p in parts:
                own = part[cut : cut + p["n_tokens"]]
                p |= {"start": self.start + at + cut, "crc32": zlib.crc32(p["words"], zlib.crc32(p["states"])), "ids_crc32": zlib.crc32(own)}
                cut += len(own)
            row["blocks"].append({"start": self.start + at, "n_docs": last + 1 - doc, "n_tokens": len(part), "lanes": lanes, "heads": heads, "heads_crc32": zlib.crc32(heads), "parts": parts})
            doc, at = last + 1, int(ends[last])
        self.start += len(ids)
        self.segment += 1
        self.ids, self.docs, self.lengths, self.tokens = [], [], [], 0
        return row


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all documents, in ascending order of their (integer) ids, as blocks under ``path``."""
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} is no integer column: token files are ordered by integer ids")
    shared = docs.sparkSession.sparkContext.broadcast(load_spec(tokenizer_path))
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(F.col(f"`{text_col}`").cast("string")).alias("text"))
    # a hash of the text splits an id that many rows share
    tie = F.xxhash64("text")
    ordered = source.repartitionByRange(F.col("id"), tie).sortWithinPartitions(F.col("id"), tie, F.col("text"))
    end = np.array([end_id], np.uint32).tobytes()
    schema = to_arrow_schema(T.StructType.fromDDL(SEGMENT_SCHEMA))

    def run(batches):
        encode = encoder(shared.value).encode
        shard = _Shard(TaskContext.get().partitionId())
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    for row in shard.add(doc, ids + end):
                        yield pa.RecordBatch.from_pylist([row], schema)
        if shard.docs:
            yield pa.RecordBatch.from_pylist([shard.flush()], schema)

    # ids are compressed already
    map_arrow(ordered, run, SEGMENT_SCHEMA).write.option("compression", "none").parquet(path)


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame, object]:
    """One row for each part (freq, heads, lanes, part and where it stands), and the broadcast starts of the shards."""
    rows = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # one number a shard: there are no more of them than partitions
    sums = {r.shard: r.n for r in rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    before, at = {}, 0
    for shard in sorted(sums):
        before[shard], at = at, at + sums[shard]
    blocks = rows.select("shard", "segment", "freq", "freq_crc32", F.posexplode("blocks").alias("block", "b"))
    held = ["shard", "segment", "block", "freq", "freq_crc32", *[F.col(f"b.{c}").alias(c) for c in ("start", "lanes", "heads", "heads_crc32")]]
    return blocks.select(*held, F.posexplode("b.parts").alias("no", "part")), spark.sparkContext.broadcast(before)


def _intact(raw: bytes, crc: int, row: dict, more: bytes = b"") -> bytes:
    if zlib.crc32(more, zlib.crc32(raw)) != crc:
        raise ValueError(f"segment {row['segment']} of shard {row['shard']} is damaged")
    return raw


class _Decoder:
    """Decodes parts; keeps the tables of the last segment."""

    def __init__(self):
        self.segment, self.tables = None, None

    def ids(self, row: dict) -> bytes:
        if self.segment != (row["shard"], row["segment"]):
            self.tables = tables(_read_table(_intact(row["freq"], row["freq_crc32"], row)))
            self.segment = row["shard"], row["segment"]
        part = row["part"]
        _intact(part["states"], part["crc32"], row, part["words"])
        return _intact(decode_part(part, row["lanes"], *self.tables).tobytes(), part["ids_crc32"], row)


def _each(batches):
    return (r for batch in batches for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist())


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", spread: int | None = None) -> DataFrame:
    """One row per document: id, start (ids of all documents before it), ids; every checksum is verified.

    Blocks are decoded part by part where they are read, or dealt over ``spread`` tasks first (worth it where the files
    are few and large).
    """
    parts, before = _parts(spark, path)
    if spread:
        where = ["shard", "segment", "block"]
        parts = parts.repartition(spread, *where).sortWithinPartitions(*where, "no")
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        decoder, start, block = _Decoder(), 0, None
        for row in _each(batches):
            if block != (here := (row["shard"], row["segment"], row["block"])):
                heads = list(struct.iter_unpack(HEAD, _intact(row["heads"], row["heads_crc32"], row)))
                block, doc, held = here, 0, b""
                start = before.value[row["shard"]] + row["start"]
            raw = held + decoder.ids(row)
            a, docs, starts, ids = 0, [], [], []
            while doc < len(heads) and a + 4 * heads[doc][2] <= len(raw):
                null, name, length = heads[doc]
                docs.append(None if null else name)
                starts.append(start)
                ids.append(raw[a : a + 4 * length])
                a, start, doc = a + 4 * length, start + length, doc + 1
            held = raw[a:]
            if docs:
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], names=schema.names)

    return map_arrow(parts, run, schema)


def read_token_range(spark: SparkSession, path: str, first: int = 0, last: int | None = None, spread: int | None = None) -> DataFrame:
    """Rows (start, ids) that hold the ids at [first, last) of the corpus: one for each part that the range meets.

    A part starts from the coder states of its own checkpoint, so parts are decoded in any task and in any order.
    """
    parts, before = _parts(spark, path)
    shards = F.broadcast(spark.createDataFrame(sorted(before.value.items()), "shard long, before long"))
    parts = parts.join(shards, "shard").withColumn("at", F.col("before") + F.col("part.start"))
    parts = parts.where(F.col("at") + F.col("part.n_tokens") > first).drop("heads", "heads_crc32")
    if last is not None:
        parts = parts.where(F.col("at") < last)
    if spread:
        parts = parts.repartition(spread)
    schema = T.StructType([T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        decoder = _Decoder()
        for row in _each(batches):
            ids, at = decoder.ids(row), row["at"]
            ids = ids[4 * max(0, first - at) : None if last is None else 4 * (last - at)]
            yield pa.RecordBatch.from_arrays([pa.array([max(at, first)], pa.int64()), pa.array([ids], pa.binary())], names=schema.names)

    return map_arrow(parts, run, schema)


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_path(spark, "tokens")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
