import os
import threading
from urllib.parse import urlparse

import pytest

from cohortloom.operators import changes as G
from cohortloom.operators import versions as V
from cohortloom.operators.lineage import new_path


def path(root, name):
    return os.path.join(urlparse(root).path, "_log", name)


def test_of_racing_writers_one_succeeds(spark):
    root = new_path(spark, "race")
    for version in range(1, 41):
        ready, done = threading.Barrier(3), []

        def write(who):
            name = V.prepare(spark, root, version, {"by": who})
            ready.wait()
            try:
                V.publish_prepared(spark, root, version, name)
                done.append(who)
            except V.StaleVersion:
                pass

        threads = [threading.Thread(target=write, args=(i,)) for i in range(3)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(done) == 1 and V.entry(spark, root, version) == {"by": done[0]}
    assert V.versions(spark, root) == list(range(1, 41)) and V.latest(spark, root, 7)[0] == 7
    assert not [f for f in os.listdir(path(root, "")) if V.PRIVATE in f]


class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["data", "prepare", "publish", "clean"])
def test_a_writer_lost_after_each_step(spark, monkeypatch, step):
    root = new_path(spark, "lost")
    G.publish(spark.range(3), root, 0)

    def die(*_):
        raise Lost

    prepare, publish = V.prepare, V.publish_prepared
    if step == "data":  # before anything of the entry is there
        monkeypatch.setattr(V, "prepare", die)
    elif step == "prepare":  # the private entry is there
        monkeypatch.setattr(V, "publish_prepared", die)
    elif step == "publish":  # half a private entry
        monkeypatch.setattr(V, "prepare", lambda *a: (open(path(root, V.PRIVATE + "2-x"), "w").write("{"), die()))
    else:  # published, but the caller never heard of it
        monkeypatch.setattr(V, "publish_prepared", lambda *a: (publish(*a), die()))
    with pytest.raises(Lost):
        G.publish(spark.range(5), root, 1)
    monkeypatch.setattr(V, "prepare", prepare)
    monkeypatch.setattr(V, "publish_prepared", publish)
    seen = 2 if step == "clean" else 1
    assert G.current_version(spark, root) == seen and G.read_version(spark, root).count() == (5 if step == "clean" else 3)
    assert G.publish(spark.range(7), root, seen) == seen + 1
    assert G.read_version(spark, root).count() == 7
    V.sweep(spark, root, older_than=-60)
    assert not [f for f in os.listdir(path(root, "")) if V.PRIVATE in f and not f.endswith(".crc")]


@pytest.mark.parametrize("content", ["", "{", "null", "[1]", '{"folder": "x"}', '{"version": 9, "content": {"folder": "x"}}', "\x00\xff"])
def test_torn_and_foreign_entries_stand_for_nothing(spark, content):
    root = new_path(spark, "torn")
    G.publish(spark.range(3), root, 0)
    with open(path(root, f"{2:020d}"), "w") as f:
        f.write(content)
    assert V.versions(spark, root) == [1] and V.latest(spark, root)[0] == 1
    assert G.read_version(spark, root).count() == 3
    with pytest.raises(ValueError):
        V.entry(spark, root, 2)
    assert G.publish(spark.range(4), root, 1) == 3
    assert G.read_version(spark, root).count() == 4 and V.versions(spark, root) == [1, 3]


def test_nothing_is_there_yet(spark):
    root = new_path(spark, "none")
    assert V.latest(spark, root) == (0, {}) and V.versions(spark, root) == [] and V.sweep(spark, root) == 0
    with pytest.raises(ValueError):
        G.read_version(spark, root)
