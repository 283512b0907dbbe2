"""Substring deduplication by super-k-mer partitioning over words.

A window is ``window`` consecutive words. Its minimiser is the m-mer of words with the least hash among those it holds;
equal windows have equal minimisers. Consecutive windows that share one travel together, as one packed string of words,
to the minimiser's bucket, equal strings of a batch once and with their number. There all windows are sorted by a hash
and equal neighbours are compared word for word, which counts them exactly.

A bucket returns the strings that hold windows which start more than once, by a 128-bit hash, with the words these cover.
Where the strings stand is not sent to the buckets, so a passage that a third of the documents hold is as small there as
any other: the documents are cut into strings once more, and an ordinary join, whose large partitions Spark can split,
gives each place its words. A bitmap of the returned hashes (8 MB) lets only strings that may be among them travel.

Minimisers that are frequent in a sample of the documents (a common line stands in a third of them) rank behind all
others, so the windows around such a line spread over the buckets of their other m-mers; what lies wholly within repeated
text is packed once a batch. The sample only spreads the work: any ranking gives the same result.

Nulls and edges: a null or blank text has no words; a text shorter than a window loses nothing; windows never cross from
one document into another; repeated rows are further places of their windows; ids may have any type, be null or repeat (rows are told
apart by id and a hash of the text, and equal rows lose the same words); an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import bitmap, cut_lineage, documents, fields_of, in_bitmap, map_arrow, map_batches, place, row_of, stored, text_or_empty

WINDOW = 35
MINIMISER = 4
BUCKET_BYTES = 3 << 20
CHUNK_BYTES = 4 << 20
HELD_BYTES = 96 << 20
SAMPLE = 0.02
HOT_SHARE = 1000
RESULT = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(line: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of ``line`` from prefix sums of a polynomial; it ranks and groups, it decides nothing."""
    raw = np.frombuffer(line, np.uint8).astype(np.uint64)
    raw += np.uint64(1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(raw * _powers(_BASE, len(raw)), dtype=np.uint64)))
    return _mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(raw) + 1)[starts])


def _rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` values."""
    n = len(hashes) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD1342543DE82EF95) + hashes[k : k + n]
    return _mix(out)


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every run of ``size`` values, by doubling."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _plain(text: str | None) -> bytes:
    """The words of a text, joined by single spaces."""
    return b" ".join(text.encode("utf-8", "surrogatepass").split()) if text else b""


def _layout(parts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(all parts joined by spaces, start of each word, its end, words of each part)."""
    lengths = np.fromiter((p.count(b" ") + 1 if p else 0 for p in parts), np.int64, len(parts))
    line = b" ".join([p for p in parts if p])
    ends = np.append(np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20), len(line)) if line else np.zeros(0, np.int64)
    starts = np.concatenate((np.zeros(min(1, len(ends)), np.int64), ends[:-1] + 1))
    return line, starts, ends, lengths


def _super_kmers(texts: list[str | None], window: int, m: int, hot: np.ndarray) -> tuple:
    """(line, word starts, word ends, first window of each run, one past its last, document, minimiser, words of each)."""
    line, starts, ends, lengths = _layout([_plain(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    n = len(starts) - window + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return line, starts, ends, empty, empty, empty, np.zeros(0, np.uint64), lengths
    mers = _rolling(word_hashes(line, starts, ends), m) >> np.uint64(1)
    if len(hot):
        mers[np.isin(mers, hot)] |= np.uint64(1 << 63)
    least = _least(mers, window - m + 1)
    whole = owner[:n] == owner[window - 1 :]
    change = np.ones(n, bool)
    change[1:] = (least[1:] != least[:-1]) | (owner[1:n] != owner[: n - 1])
    run = np.flatnonzero(change)
    last = np.append(run[1:], n)
    # a document's last windows - 1 words start no window of it
    doc = owner[run]
    limit = np.cumsum(lengths)[doc] - window + 1
    last = np.minimum(last, limit)
    good = whole[run] & (last > run)
    return line, starts, ends, run[good], last[good], doc[good], least[run][good], lengths


def _chunks(batches, columns: int) -> Iterator[tuple[list[list], list[str | None]]]:
    """Rows in chunks of bounded text size: (key columns, texts)."""
    for batch in batches:
        texts = batch.column(columns).to_pylist()
        keys = [batch.column(i).to_pylist() for i in range(columns)]
        a = size = 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= CHUNK_BYTES or i + 1 == len(texts):
                yield [k[a : i + 1] for k in keys], texts[a : i + 1]
                a, size = i + 1, 0


def _pack(strings: dict[bytes, int]) -> bytes:
    """Strings and how often each stands in the batch, compressed."""
    lengths, times = (np.fromiter(x, np.uint32, len(strings)).tobytes() for x in (map(len, strings), strings.values()))
    return zstandard.ZstdCompressor(level=3).compress(b"".join([struct.pack("<I", len(strings)), lengths, times, *strings]))


def _unpack(blob: bytes) -> tuple[list[bytes], list[int]]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = struct.unpack_from("<I", raw)
    lengths, times = np.frombuffer(raw, np.uint32, n, 4), np.frombuffer(raw, np.uint32, n, 4 + 4 * n)
    cuts = (4 + 8 * n + np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))).tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])], times.tolist()


def string_keys(strings: Iterable[bytes]) -> np.ndarray:
    """Two signed numbers for each string, its XXH3 of 128 bits."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(s) for s in strings]), np.int64).reshape(-1, 2)


def repeated_windows(strings: list[bytes], times: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(flag of each word of all strings, words of each string): a flagged word starts a window that starts more than
    once among all strings, each taken ``times`` times."""
    line, starts, ends, lengths = _layout(strings)
    owner = np.repeat(np.arange(len(strings)), lengths)
    n = len(owner) - window + 1
    flags = np.zeros(len(owner), bool)
    at = np.flatnonzero(owner[:n] == owner[window - 1 :]) if n > 0 else np.zeros(0, np.int64)
    if not len(at):
        return flags, lengths
    hashes = _rolling(word_hashes(line, starts, ends), window)[at]
    order = np.argsort(hashes, kind="stable")
    at, hashes = at[order], hashes[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    size = np.diff(np.append(first, len(at)))
    hit = np.repeat(np.add.reduceat(times[owner[at]], first) > 1, size)
    # equal hashes: compare neighbours in full; unequal ones are counted apart
    text = lambda k: line[starts[k] : ends[k + window - 1]]
    for g in np.flatnonzero(size > 1).tolist():
        a, b = int(first[g]), int(first[g] + size[g])
        windows = [text(k) for k in at[a:b].tolist()]
        if windows.count(windows[0]) < len(windows):
            count: dict[bytes, int] = {}
            for w, k in zip(windows, at[a:b].tolist()):
                count[w] = count.get(w, 0) + int(times[owner[k]])
            hit[a:b] = [count[w] > 1 for w in windows]
    flags[at[hit]] = True
    return flags, lengths


def covered_ranges(docs: DataFrame, window: int = WINDOW, m: int = MINIMISER, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, th, ranges): word ranges [a, b) of each row of (id, th, text) that repeated windows cover."""
    hot, total = _survey(docs, window, m)
    n_buckets = max(64, total // bucket_bytes)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(hot)

    def scatter(batches):
        held: dict[int, dict[bytes, int]] = {}
        size = 0

        def packed():
            blobs = [_pack(x) for x in held.values()]
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])
            held.clear()
            return out

        for _, texts in _chunks(batches, 0):
            line, starts, ends, first, last, _, least, _ = _super_kmers(texts, window, m, shared.value)
            if not len(first):
                continue
            where = (starts[first], ends[last + window - 2], _mix(least) % np.uint64(n_buckets))
            for a, b, bucket in zip(*(w.tolist() for w in where)):
                strings, s = held.setdefault(bucket, {}), line[a:b]
                strings[s] = strings.get(s, 0) + 1
                size += b - a
            if size >= HELD_BYTES:
                yield packed()
                size = 0
        if held:
            yield packed()

    def gather(table: pa.Table) -> pa.Table:
        count: dict[bytes, int] = {}
        for blob in table.column("blob").to_pylist():
            for s, n in zip(*_unpack(blob)):
                count[s] = count.get(s, 0) + n
        strings = list(count)
        flags, lengths = repeated_windows(strings, np.fromiter(count.values(), np.int64, len(count)), window)
        begin = np.cumsum(lengths) - lengths
        hit = np.unique(np.searchsorted(begin, np.flatnonzero(flags), side="right") - 1).tolist()
        runs: tuple[list, list] = ([], [])
        for i in hit:
            edge = np.diff(np.concatenate(([0], flags[begin[i] : begin[i] + lengths[i]].astype(np.int8), [0])))
            runs[0].append(np.flatnonzero(edge == 1))
            runs[1].append(np.flatnonzero(edge == -1) + window - 1)
        keys = string_keys(strings[i] for i in hit)
        return pa.table([pa.array(keys[:, 0]), pa.array(keys[:, 1]), *[pa.array(r, pa.list_(pa.int64())) for r in runs]], names=["k1", "k2", "a", "b"])

    packets = map_arrow(docs.select("text"), scatter, "bucket long, blob binary")
    repeated = packets.groupBy("bucket").applyInArrow(gather, "k1 long, k2 long, a array<long>, b array<long>")
    repeated = stored(repeated, "repeated")
    wanted = context.broadcast(bitmap(repeated.select(place(F.col("k1")).alias("p"))))

    def places(batches):
        for (ids, ths), texts in _chunks(batches, 2):
            line, starts, ends, first, last, doc, _, lengths = _super_kmers(texts, window, m, shared.value)
            if not len(first):
                continue
            keys = string_keys(line[a:b] for a, b in zip(starts[first].tolist(), ends[last + window - 2].tolist()))
            good = np.flatnonzero(in_bitmap(wanted.value, keys[:, 0]))
            at = (first - (np.cumsum(lengths) - lengths)[doc])[good]
            own = doc[good].tolist()
            columns = [pa.array(keys[good, 0]), pa.array(keys[good, 1]), pa.array([ids[d] for d in own], id_type), pa.array([ths[d] for d in own], pa.int64()), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "id", "th", "at"])

    id_type, of = to_arrow_type(docs.schema["id"].dataType), T.StructField
    schema = T.StructType([of("k1", T.LongType()), of("k2", T.LongType()), of("id", docs.schema["id"].dataType), of("th", T.LongType()), of("at", T.LongType())])
    stand = map_arrow(docs.select("id", "th", "text"), places, schema)
    found = stand.join(repeated, ["k1", "k2"])
    ranges = F.transform(F.arrays_zip("a", "b"), lambda r: F.struct((F.col("at") + r["a"]).alias("a"), (F.col("at") + r["b"]).alias("b")))
    return found.select("id", "th", F.explode(ranges).alias("r")).groupBy("id", "th").agg(F.collect_set("r").alias("ranges"))


def _survey(docs: DataFrame, window: int, m: int) -> tuple[np.ndarray, int]:
    """(minimisers that are frequent in a sample, estimated bytes of all packed strings)."""

    def count(batches):
        for _, texts in _chunks(batches, 0):
            _, starts, ends, first, last, _, least, _ = _super_kmers(texts, window, m, np.zeros(0, np.uint64))
            size = int((ends[last + window - 2] - starts[first]).sum()) if len(first) else 0
            keys, n = np.unique(least, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n, pa.int64()), pa.array([size] + [0] * (len(keys) - 1) if len(keys) else [], pa.int64())], names=["k", "n", "bytes"])

    sample = map_arrow(docs.select("text").sample(SAMPLE, seed=7), count, "k long, n long, bytes long")
    counted = cut_lineage(sample.groupBy("k").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")))
    total = counted.agg(F.sum("n"), F.sum("bytes")).first()
    # fewer than HOT_SHARE minimisers can have more than that share
    hot = counted.where(F.col("n") > max(8, (total[0] or 0) // HOT_SHARE)).select("k").collect()
    return np.array([r.k for r in hot], np.int64).astype(np.uint64), int((total[1] or 0) / SAMPLE)


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, m: int = MINIMISER, bucket_bytes: int = BUCKET_BYTES, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (words no repeated window covers, joined by one space)."""
    text = text_or_empty(F.col(f"`{text_col}`").cast("string"))
    names = [f.name for f in RESULT]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    row = row_of(docs, kept) if kept else F.lit(True)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"), row.alias("row"))
    ranges = covered_ranges(rows.select("id", "th", "text"), window, m, bucket_bytes).toDF("r_id", "r_th", "ranges")
    joined = rows.join(ranges, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("th") == F.col("r_th")), "left").select("row", "text", "ranges")

    def run(batches):
        for texts, batch in batches:
            cut = batch.column(0).field(1).to_pylist()
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(texts, cut):
                line = _plain(text)
                n = line.count(b" ") + 1 if line else 0
                n_words.append(n)
                if spans:
                    gone = np.zeros(n + 1, np.int64)
                    np.add.at(gone, [s["a"] for s in spans], 1)
                    np.add.at(gone, [s["b"] for s in spans], -1)
                    stay = np.cumsum(gone)[:-1] == 0
                    line = b" ".join([w for w, s in zip(line.split(b" "), stay.tolist()) if s])
                    n_removed.append(int(n - stay.sum()))
                else:
                    n_removed.append(0)
                kept.append(line)
            yield [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string())]

    return map_batches(joined, "text", run, RESULT, keep=["row", "ranges"]).select(*fields_of("row", kept), *names)


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = remove_repeated_passages(documents(spark, sf_dir), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
