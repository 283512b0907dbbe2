"""Sequence packing by Karmarkar-Karp multiway differencing.

Each task tokenises its documents, gives every full stretch of ``capacity`` tokens a sequence of its own, and cuts what
remains of a document into pieces of at most ``max_piece`` tokens. Pieces wait until about ``group_tokens`` tokens are
there; then multiway differencing merges the two partial partitions with the largest imbalance, the heavy windows of one
onto the light ones of the other, until one partition into near-equal windows is left. If its largest window exceeds the
capacity, the number of windows rises by one and the group is partitioned again.

The last group of a task gives its overhang to sequences whose length is a power of two, which need no padding. Nothing is
shuffled: groups are formed where the documents are read, and a task holds one group at a time. A task that is run again
gives the same sequences if it reads the same rows in the same order, as from a written table; after a shuffle, write the
documents first.

Nulls and edges: a null or empty text is its end token alone; ids may be null or repeat; a text may have any length; an
empty table gives no piece.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, map_arrow
from .tokens import encoder, load_spec

CAPACITY = 4096
MAX_PIECE = 1024
GROUP_TOKENS = 1 << 20
LEAST_TAIL = 64


def difference(sizes: list[int], k: int) -> tuple[np.ndarray, int]:
    """(window of each item, largest window's sum) of a partition into ``k`` near-equal windows."""
    if k == 1 or not sizes:
        return np.zeros(len(sizes), np.int64), sum(sizes)
    nodes: list[tuple] = [(i,) for i in range(len(sizes))]
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = size
        heap.append((-size, i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        both = left + right[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        both -= both[-1]
        nodes.append((a, b, order))
        heapq.heappush(heap, (-int(both[0]), len(nodes) - 1, both))
    spread = heap[0][2]
    window = np.zeros(len(sizes), np.int64)
    labels = {len(nodes) - 1: np.arange(k)}
    for n in range(len(nodes) - 1, -1, -1):
        own = labels.pop(n)
        if len(nodes[n]) == 1:
            window[n] = own[0]
        else:
            a, b, order = nodes[n]
            labels[a], labels[b] = np.empty(k, np.int64), np.empty(k, np.int64)
            labels[a][order] = own
            labels[b][k - 1 - order] = own
    return window, (sum(sizes) - int(spread.sum())) // k + int(spread[0])


def partition(sizes: list[int], capacity: int) -> np.ndarray:
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        window, largest = difference(sizes, k)
        if largest <= capacity:
            return window
        k += 1


class _Packer:
    """Pieces of one task: (document, start, ids, tokens of the document)."""

    def __init__(self, task: int, capacity: int, max_piece: int, group_tokens: int):
        self.next, self.capacity, self.max_piece, self.group_tokens = task << 40, capacity, max_piece, group_tokens
        self.pending: list[tuple] = []
        self.tokens = 0
        self.out: list[tuple] = []

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids) // 4, ids, total, self.next, offset))
            offset += len(ids) // 4
        self.next += 1

    def add(self, doc, ids: bytes) -> None:
        total = len(ids) // 4
        full = total // self.capacity * self.capacity
        for start in range(0, full, self.capacity):
            self._sequence([(doc, start, ids[4 * start : 4 * (start + self.capacity)], total)])
        rest = total - full
        n = -(-rest // self.max_piece)
        for i in range(n):
            a, b = full + rest * i // n, full + rest * (i + 1) // n
            self.pending.append((doc, a, ids[4 * a : 4 * b], total))
        self.tokens += rest
        room = -self.tokens % self.capacity
        # a group ends where little room is left over, at twice the size at the latest
        if self.tokens >= 2 * self.group_tokens or self.tokens >= self.group_tokens and self.capacity // 16 <= room <= self.capacity // 4:
            self.flush()

    def flush(self) -> None:
        window = partition([len(p[2]) // 4 for p in self.pending], self.capacity)
        order = np.argsort(window, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(window[order])) + 1):
            self._sequence([self.pending[i] for i in part])
        self.pending, self.tokens = [], 0

    def finish(self) -> None:
        """The overhang of the last group goes to sequences of a power of two; the rest keeps a little room."""
        if not self.pending:
            return
        windows, over = divmod(self.tokens, self.capacity)
        over = min(self.tokens, -(-(over + 16 * windows) // LEAST_TAIL) * LEAST_TAIL)
        if over < self.capacity * 3 // 4:
            for bit in reversed(range(self.capacity.bit_length())):
                if over & (1 << bit):
                    self._sequence(self._take(1 << bit))
        if self.pending:
            self.flush()

    def _take(self, want: int) -> list[tuple]:
        """Pieces of exactly ``want`` tokens in all, from the end; the last one is cut."""
        taken = []
        while want:
            doc, start, ids, total = self.pending.pop()
            n = min(want, len(ids) // 4)
            taken.append((doc, start, ids[: 4 * n], total))
            if 4 * n < len(ids):
                self.pending.append((doc, start + n, ids[4 * n :], total))
            want -= n
            self.tokens -= n
        return taken


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    max_piece: int = MAX_PIECE,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    shared = docs.sparkSession.sparkContext.broadcast(load_spec(tokenizer_path))
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField(id_col, source.schema["id"].dataType)])
    for name in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset"):
        schema.add(name, T.BinaryType() if name == "ids" else T.LongType())
    end = np.array([end_id], np.uint32).tobytes()

    def run(batches):
        encode = encoder(shared.value).encode
        packer = _Packer(TaskContext.get().partitionId(), capacity, max_piece, group_tokens)
        id_type = None

        def rows():
            columns = list(zip(*packer.out))
            packer.out = []
            types = [id_type, *[pa.binary() if n == "ids" else pa.int64() for n in schema.names[1:]]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    packer.add(doc, ids + end)
                    if len(packer.out) >= 2000:
                        yield rows()
        packer.finish()
        if packer.out:
            yield rows()

    return map_arrow(source, run, schema)


def fill_rate(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, tokens, slots after padding (none at a power of two) and their ratio."""
    per = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    slots = F.when(F.expr("n & (n - 1)") == 0, F.col("n")).otherwise(F.lit(capacity))
    total = per.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.sum(slots).alias("slots"))
    return total.withColumn("fill", F.col("tokens") / F.col("slots"))


def op3_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
