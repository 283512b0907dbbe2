"""Work shared out to several workers: tasks are claimed for a time, and each is accepted once.

A queue of texts is stored once, dealt out to numbered tasks by the hash of the key. Who has which task until when, and
whose results count, is an entry of a version log (``operators.versions``); every claim and every acceptance adds one, and
of two at once one fails and looks again. So claims never overlap, a lost worker's tasks are free again once their time is
over, and the first result of a task stands, whoever brings it.

An entry holds the claims that are open and the folder of each accepted task, so a queue has ``MAX_TASKS`` at most; a task
may hold any number of texts. Null keys are dealt out like others; an empty queue has no tasks.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions as V

MAX_TASKS = 10_000


def open_queue(queue: DataFrame, root: str, key: str, tasks: int) -> None:
    """Store the queue under ``root`` in so many tasks; those without a row are never claimed."""
    if not 0 < tasks <= MAX_TASKS:
        raise ValueError(f"1 to {MAX_TASKS} tasks, not {tasks}")
    spark, items = queue.sparkSession, V.new_folder(root, "items")
    dealt = queue.withColumn("task", F.pmod(F.xxhash64(key), F.lit(tasks)).cast("int"))
    dealt.repartition("task").write.partitionBy("task").parquet(items)
    there = [r.task for r in spark.read.schema(dealt.schema).parquet(items).select("task").distinct().orderBy("task").toLocalIterator()]
    V.add_entry(spark, root, 1, {"items": items, "tasks": there, "claims": {}, "done": {}})


def _changed(spark: SparkSession, root: str, change):
    """Apply ``change(content)`` to the latest entry until it is added; None from it leaves things as they are."""
    while True:
        following = V.next_version(spark, root)
        version, content = V.latest(spark, root)
        if not version:
            raise ValueError(f"no queue under {root}")
        result = change(content)
        if result is None:
            return None
        try:
            V.add_entry(spark, root, following, content)
            return result
        except V.StaleVersion:
            continue


def claim(spark: SparkSession, root: str, worker: str, seconds: float, many: int = 1, now: float | None = None) -> list[int]:
    """Up to so many tasks that are neither done nor claimed by anybody whose time is not over; [] if there are none."""

    def change(content: dict):
        at = time.time() if now is None else now
        content["claims"] = {t: c for t, c in content["claims"].items() if c[1] > at}
        taken = {int(t) for t in (*content["claims"], *content["done"])}
        free = [t for t in content["tasks"] if t not in taken][:many]
        content["claims"] |= {str(t): [worker, at + seconds] for t in free}
        return free or None

    return _changed(spark, root, change) or []


def items(spark: SparkSession, root: str, tasks: list[int]) -> DataFrame:
    """The rows of some tasks; only their folders are read."""
    content = V.latest(spark, root)[1]
    return spark.read.parquet(content["items"]).where(F.col("task").isin(tasks)).drop("task")


def accept(results: DataFrame, root: str, task: int) -> bool:
    """Take the results of a task; False, and nothing changes, if it has some already."""
    spark = results.sparkSession
    if str(task) in V.latest(spark, root)[1]["done"]:
        return False
    folder = V.new_folder(root, f"results-{task}")
    results.write.parquet(folder)

    def change(content: dict):
        if str(task) in content["done"]:
            return None
        content["done"][str(task)] = folder
        content["claims"].pop(str(task), None)
        return True

    return bool(_changed(spark, root, change))


def results(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All accepted results."""
    folders = list(V.latest(spark, root)[1]["done"].values())
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def is_finished(spark: SparkSession, root: str) -> bool:
    content = V.latest(spark, root)[1]
    return len(content["done"]) == len(content["tasks"])
