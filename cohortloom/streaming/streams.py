"""Incremental ingestion with Structured Streaming: the batch rules on arriving rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from ..operators import buckets as B
from ..operators import versions as V

LATE = "1 day"


def arrivals(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_dedupe(stream: DataFrame, key: Sequence[str], ts: str, late: str = LATE) -> DataFrame:
    """M1: each key once within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(key))


def stream_skip_existing(stream: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """M2: rows whose key is not in a static table."""
    return stream.join(done.select(key).distinct(), key, "left_anti")


def stream_upsert(stream: DataFrame, root: str, key: Sequence[str], order: str, checkpoint: str, buckets: int = B.BUCKETS, compact_every: int = 32):
    """M3: every batch is merged by key into the bucketed table under ``root`` and rewrites the buckets that its keys touch:
    the row with the largest ``order`` stays (ties: the least in its other columns), so a late older row does not displace a
    newer one and a repeated batch gives the same state. Every so many batches the table's files are put together."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version, content = V.latest(spark, root)
        if not version:
            B.create(spark, root, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema), key, buckets)
        elif content.get("marks") == {"stream": checkpoint, "batch": number}:
            return  # the batch's own version is there
        B.merge(batch, root, [order], marks={"stream": checkpoint, "batch": number})
        if number % compact_every == compact_every - 1:
            B.compact(spark, root)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_audit(stream: DataFrame, ts: str, by: Sequence[str], window: str = "1 day", late: str = LATE) -> DataFrame:
    """M4: counts in tumbling windows."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


class StageCounters(StreamingQueryListener):
    """M4: writes a stream's observed counters to a log under ``root``, an entry for each batch.

    Entries are added only if absent, so a batch that is run again after a lost driver counts once. ``watch`` starts it.
    """

    NAME = "stage_counters"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.query = spark, root, None

    def add(self, progress) -> None:
        seen = progress.observedMetrics.get(self.NAME)
        if seen is not None and progress.numInputRows:
            try:
                V.add_entry(self.spark, self.root, progress.batchId + 1, {"batch": progress.batchId, "counters": seen.asDict()})
            except V.StaleVersion:
                pass

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.query is None or event.progress.id == self.query:
            self.add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def count_stages(stream: DataFrame, counters: dict[str, str]) -> DataFrame:
    """M4: the stream with counters (aggregates in SQL by name) that ``run_counted`` reports for each batch."""
    return stream.observe(StageCounters.NAME, *[F.expr(c).alias(name) for name, c in counters.items()])


def run_counted(counted: DataFrame, path: str, checkpoint: str, root: str) -> None:
    """M4: run a counted stream over all that is there into Parquet files, its counters into the log under ``root``."""
    spark = counted.sparkSession
    listener = StageCounters(spark, root)
    writer = counted.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    spark.streams.addListener(listener)
    try:
        q = writer.start(path)
        listener.query = q.id
        q.awaitTermination()
        for progress in q.recentProgress:  # reports that have not come yet
            listener.add(progress)
    finally:
        spark.streams.removeListener(listener)


def stage_counters(spark: SparkSession, root: str) -> DataFrame:
    """M4: counter and its total over all batches."""
    rows = [(name, int(n or 0)) for v in V.versions(spark, root) for name, n in V.entry(spark, root, v)["counters"].items()]
    return spark.createDataFrame(rows, "counter string, n long").groupBy("counter").agg(F.sum("n").alias("n"))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HISTORY = "event_id long, patient_id long, prior_left long, prior_right long, worst_rank int, worst_source long"
HISTORY_ROW = Row(*[c.split()[0] for c in HISTORY.split(", ")])
DAY_MS = 86_400_000


class PatientHistory(StatefulProcessor):
    """M5: holds a patient's rows until the watermark has passed them, then gives each its history, in order of time and id.

    State: the waiting rows, and for each side the flagged rows so far and the earliest of the worst scores. A patient
    without rows for ``ttl_days`` (by the watermark) is forgotten and begins anew.
    """

    def __init__(self, ttl_days: int | None):
        self.ttl = ttl_days and ttl_days * DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, event_id long, side string, score int, is_event boolean")
        self.sides = handle.getMapState("sides", "side string", "flagged long, rank int, source long")
        self.last = handle.getValueState("last", "us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r["us"], r["event_id"], r["side"], r["score"], r["is_event"]) for r in rows]
        self.waiting.appendList(new)
        self.handle.registerTimer(min(r[0] for r in new) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        # each call to the state store is a message to another process: none is made twice, and none that changes nothing
        held = sorted(self.waiting.get(), key=lambda r: r[:2])
        due = [r for r in held if r[0] <= now * 1000]
        if due:
            yield from self._released(key[0], due)
            rest = held[len(due) :]
            if rest:
                self.waiting.put(rest)
                self.handle.registerTimer(rest[0][0] // 1000 + 1)
            else:
                self.waiting.clear()
            if self.ttl:
                self.last.update((due[-1][0],))
                self.handle.registerTimer(due[-1][0] // 1000 + 1 + self.ttl)
        elif self.ttl and not held:
            last = self.last.get()
            if last and last[0] // 1000 + 1 + self.ttl <= now:
                self.sides.clear()
                self.last.clear()

    def _released(self, patient, due: list) -> Iterator[Row]:
        before = {s[0]: v for s, v in self.sides.iterator()}
        sides = {s: before.get(s, (0, None, None)) for s in ("LEFT", "RIGHT")}
        for _, event, side, score, flagged in due:
            (left, left_rank, left_source), (right, right_rank, right_source) = sides["LEFT"], sides["RIGHT"]
            on_right = side == "RIGHT" or side == "BILATERAL" and (left_rank is None or (right_rank is not None and right_rank > left_rank))
            worst = (right_rank, right_source) if on_right else (left_rank, left_source) if side in ("LEFT", "BILATERAL") else (None, None)
            yield HISTORY_ROW(event, patient, left, right, *worst)
            for s in sides:
                if side in (s, "BILATERAL"):
                    n, rank, source = sides[s]
                    sides[s] = (n + flagged, score, event) if score is not None and (rank is None or score > rank) else (n + flagged, rank, source)
        for s, v in sides.items():
            if before.get(s) != v:
                self.sides.updateValue((s,), v)

    def close(self) -> None:
        pass


def stream_patient_history(stream: DataFrame, ttl_days: int | None = None, late: str = LATE) -> DataFrame:
    """M5: event_id, patient_id, ts, side, score, is_event, in any order within ``late`` -> each row once, with the flagged
    earlier rows on each side and the worst earlier score on its side(s) with its row. Needs the RocksDB state store."""
    if stream.sparkSession.conf.get(STATE_STORE) != ROCKS:
        raise ValueError(f"set {STATE_STORE} to {ROCKS}")
    rows = stream.withWatermark("ts", late).select("event_id", "patient_id", "ts", F.unix_micros("ts").alias("us"), "side", "score", F.coalesce("is_event", F.lit(False)).alias("is_event"))
    return rows.groupBy("patient_id").transformWithState(PatientHistory(ttl_days), HISTORY, "Append", "EventTime")


def stream_window_link(exams: DataFrame, path: DataFrame, days: int, late: str = LATE, how: str = "inner") -> DataFrame:
    """M6: pathology of the same patient within ``days`` after an exam, both arriving; state is bounded by watermarks.

    With ``left_outer`` an exam that nothing follows comes out once both watermarks have passed its days. Rows that come
    after their watermark are left out.
    """
    a, b = exams.withWatermark("exam_ts", late), path.withWatermark("path_ts", late)
    near = F.expr(f"path_ts >= exam_ts AND path_ts <= exam_ts + INTERVAL {days} DAYS")
    return a.join(b, (a["patient_id"] == b["path_patient"]) & near, how)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run over all that is there, into Parquet files, and read them."""
    q = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    q.awaitTermination()
    return stream.sparkSession.read.parquet(path)
