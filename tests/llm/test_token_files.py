import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm import token_files as tf
from cohortloom.llm.common import shared_path
from conftest import SMALL
from test_packing import ODD, PATH, direct


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=3000), st.integers(1, 64), st.integers(1, 5))
def test_block_round_trip(values, lanes, every):
    ids = np.array(values, np.uint32)
    freq = tf.quantise(np.bincount(ids, minlength=301))
    assert not len(ids) or freq.sum() == 1 << tf.BITS
    old = tf.LANES, tf.CHECKPOINT
    tf.LANES, tf.CHECKPOINT = lanes, every
    try:
        lanes, parts = tf.encode_block(ids, freq, np.cumsum(freq) - freq)
        t = tf.tables(freq)
        # every part stands alone
        back = [tf.decode_part(p, lanes, *t) for p in reversed(parts)][::-1]
        assert [len(x) for x in back] == [p["n_tokens"] for p in parts]
        assert (np.concatenate([*back, ids[:0]]) == ids).all()
    finally:
        tf.LANES, tf.CHECKPOINT = old


def test_query_equals_direct_encoding(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)
    want, start = {}, 0
    for r, ids in zip(docs, direct([r.text for r in docs])):
        ids += np.array([1], np.uint32).tobytes()
        want[r.doc_id] = (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert {r.doc_id: tuple(r)[1:] for r in tf.op6_token_files(spark, SMALL).collect()} == want


def test_edges_and_damage(spark, monkeypatch):
    rows = [*enumerate(ODD), (None, "a b"), (3, "z"), (3, "z"), (99, "word " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS ids")
    path = shared_path(spark, "tokens")
    tf.write_token_files(docs, path, PATH, end_id=1)
    found = sorted(tf.read_token_files(spark, path).collect(), key=lambda r: r.start)
    want = sorted(zip([r[0] for r in rows], direct([r[1] for r in rows])), key=lambda x: (-1 if x[0] is None else x[0]))
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in found) == sorted((str(i), x + b"\1\0\0\0") for i, x in want)
    assert [r.doc_id for r in found] == [i for i, _ in want]
    at = 0
    for r in found:
        assert r.start == at
        at += len(r.ids) // 4
    again = tf.read_token_files(spark, path, spread=3)
    assert sorted((r.start, bytes(r.ids)) for r in again.collect()) == sorted((r.start, bytes(r.ids)) for r in found)
    with pytest.raises(TypeError, match="integer"):
        tf.write_token_files(docs.selectExpr("string(doc_id) AS doc_id", "text"), path, PATH, end_id=1)
    none = shared_path(spark, "tokens")
    tf.write_token_files(docs.limit(0), none, PATH, end_id=1)
    assert tf.read_token_files(spark, none).count() == 0
    bad = shared_path(spark, "tokens")
    spark.read.parquet(path).selectExpr("* EXCEPT (freq)", "concat(freq, X'00') AS freq").write.parquet(bad)
    with pytest.raises(Exception, match="damaged"):
        tf.read_token_files(spark, bad).collect()
    assert public_tokenizers.path("word_bpe_49k.json") == PATH


def test_long_blocks_and_ranges(spark, monkeypatch):
    """Documents over many parts and blocks; a range of the corpus from the parts that it meets."""
    rows = [(i, " ".join(f"word{(i * j) % 97} and" for j in range(3000 if i % 7 == 0 else 20))) for i in range(60)]
    path = shared_path(spark, "tokens")
    monkeypatch.setattr(tf, "SEGMENT", 40_000)
    monkeypatch.setattr(tf, "BLOCK", 10_000)
    monkeypatch.setattr(tf, "LANES", 64)
    monkeypatch.setattr(tf, "CHECKPOINT", 16)
    # one shard written in this process, as a task writes it
    shard, out = tf._Shard(0), []
    corpus = [ids + np.array([1], np.uint32).tobytes() for ids in direct([r[1] for r in rows])]
    for (i, _), ids in zip(rows, corpus):
        out += list(shard.add(i, ids))
    out += [shard.flush()]
    assert len(out) > 2 and any(len(r["blocks"]) > 1 for r in out) and any(len(b["parts"]) > 3 for r in out for b in r["blocks"])
    spark.createDataFrame(out, tf.SEGMENT_SCHEMA).write.parquet(path)
    whole = b"".join(corpus)
    for spread in (None, 5):
        found = sorted(tf.read_token_files(spark, path, spread=spread).collect(), key=lambda r: r.start)
        assert [(r.doc_id, bytes(r.ids)) for r in found] == [(i, x) for (i, _), x in zip(rows, corpus)]
        for first, last in ((0, None), (1, 2), (5_000, 45_017), (len(whole) // 4 - 3, None), (7, 7)):
            got = sorted(tf.read_token_range(spark, path, first, last, spread).collect(), key=lambda r: r.start)
            assert b"".join(bytes(r.ids) for r in got) == whole[4 * first : None if last is None else 4 * last]
            assert [r.start for r in got] == [first + sum(len(x.ids) // 4 for x in got[:k]) for k in range(len(got))]
