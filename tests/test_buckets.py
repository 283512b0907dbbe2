import random
import threading

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import buckets as B
from cohortloom.operators import changes as G
from cohortloom.operators import versions as V
from cohortloom.operators.lineage import new_path

SCHEMA = "id long, at long, v string"


def files(spark, root, version=None):
    return {(r.bucket, r.path): r.rows for r in B.manifest(spark, root, version).collect()}


def state(spark, root, version=None):
    rows = B.read(spark, root, version).collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: (r.at, r.v) for r in rows}


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark):
    root, rng = new_path(spark, "table"), random.Random(1)
    B.create(spark, root, SCHEMA, ["id"], 32)
    assert state(spark, root) == {}
    want = {i: (0, f"v{i}") for i in range(2000)}
    B.merge(spark.createDataFrame([(i, *r) for i, r in want.items()], SCHEMA), root, ["at"])
    assert state(spark, root) == want and len(files(spark, root)) == 32
    for k in (1, 3, 8):
        before, base = files(spark, root), V.latest(spark, root)[0]
        keys = rng.sample(range(2000), k)
        version = B.merge(spark.createDataFrame([(i, k, "new") for i in keys] + [(keys[0], k - 5, "older")], SCHEMA), root, ["at"])
        after = files(spark, root)
        assert 1 <= len(set(before) - set(after)) <= k and 1 <= len(set(after) - set(before)) <= k
        old = state(spark, root, base)
        assert old == want  # a reader of the version before sees it whole
        want |= {i: (k, "new") for i in keys}
        assert state(spark, root, version) == want
    assert sum(files(spark, root).values()) == 2000


def test_new_keys_are_added_without_a_rewrite_and_compacted(spark):
    root = new_path(spark, "table")
    B.create(spark, root, SCHEMA, ["id"], 4)
    for k in range(3):
        B.merge(spark.createDataFrame([(100 * k + i, k, None) for i in range(100)], SCHEMA), root, ["at"])
    assert len(files(spark, root)) == 12  # no key could be there: three files a bucket, none read again
    want = state(spark, root)
    B.compact(spark, root)
    assert len(files(spark, root)) == 4 and state(spark, root) == want
    B.compact(spark, root, bucket_rows=20)
    assert len(files(spark, root)) == 16 and state(spark, root) == want
    version = V.latest(spark, root)[0]
    assert B.compact(spark, root, bucket_rows=20) == version
    assert B.merge(spark.createDataFrame([], SCHEMA), root, ["at"]) == version


def test_filters_know_every_key(spark):
    keys = spark.range(5000).select(F.col("id"), F.lit("f").alias("path"))
    filters = B._filters(keys, ["id"])
    row = filters.first()
    assert row.rows == 5000
    hit = lambda df: df.select(*[p.alias(f"p{i}") for i, p in enumerate(B._probes(["id"]))]).crossJoin(filters).where(" AND ".join("true" for _ in range(1))).where(B._has_bit(F.col("filter"), F.col("p0")) & B._has_bit(F.col("filter"), F.col("p1")) & B._has_bit(F.col("filter"), F.col("p2"))).count()
    assert hit(keys) == 5000
    assert hit(spark.range(10**6, 10**6 + 5000)) < 1000


def test_ties_nulls_and_repeated_batches(spark):
    root = new_path(spark, "table")
    B.create(spark, root, SCHEMA, ["id"], 3)
    rows = [(1, 5, "b"), (1, 5, "a"), (1, None, "z"), (None, 1, "n"), (None, 2, "m"), (2, 1, None), (2, 1, "x")]
    for order in (rows, rows[::-1], rows):
        B.merge(spark.createDataFrame(order, SCHEMA).repartition(3), root, ["at"])
        assert state(spark, root) == {1: (5, "a"), None: (2, "m"), 2: (1, None)}


def test_upsert_of_some_columns(spark):
    root = new_path(spark, "table")
    B.create(spark, root, SCHEMA, ["id"], 4)
    B.merge(spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], SCHEMA), root, ["at"])
    B.merge(spark.createDataFrame([(2, "c"), (9, "d")], "id long, v string"), root, [], rule=G.upsert)
    assert state(spark, root) == {1: (1, "a"), 2: (2, "c"), 9: (None, "d")}


def test_two_writers_at_once_lose_nothing(spark):
    root, failed = new_path(spark, "table"), []
    B.create(spark, root, SCHEMA, ["id"], 4)

    def write(who):
        try:
            for k in range(3):
                B.merge(spark.createDataFrame([(10 * who + k, 1, str(who))], SCHEMA), root, ["at"])
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(w,)) for w in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and set(state(spark, root)) == {10, 11, 12, 20, 21, 22}


def test_a_lost_merge_leaves_the_version_before(spark, monkeypatch):
    root = new_path(spark, "table")
    B.create(spark, root, SCHEMA, ["id"], 4)
    one = spark.createDataFrame([(1, 1, "a")], SCHEMA)
    B.merge(one, root, ["at"])
    with monkeypatch.context() as m:
        m.setattr(V, "publish_prepared", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            B.merge(spark.createDataFrame([(1, 2, "b")], SCHEMA), root, ["at"])
    assert state(spark, root) == {1: (1, "a")}
    B.merge(spark.createDataFrame([(1, 2, "b")], SCHEMA), root, ["at"])
    assert state(spark, root) == {1: (2, "b")}
