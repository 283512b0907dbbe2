import random

import corpus_pipeline
import pytest
from cohortloom.llm.shingle_join import drop_similar, shingle_bytes, similar_groups
from test_simhash import brute_fingerprint

from conftest import SMALL


def shingles(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_groups(docs, k=5):
    """docs: {id: text}; the least id that each can reach over pairs of Jaccard similarity >= 0.8."""
    sets, root = {i: shingles(t, k) for i, t in docs.items()}, {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    far = 0
    for a in sorted(docs):
        for b in (b for b in docs if b < a):
            n = len(sets[a] & sets[b])
            if 5 * n >= 4 * len(sets[a] | sets[b]):
                far += (brute_fingerprint(docs[a], k) ^ brute_fingerprint(docs[b], k)).bit_count() > 3
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in docs}, far


def planted():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    prose = lambda n: rng.choices(vocabulary, k=n)
    passage, texts = prose(60), []
    for _ in range(15):
        words = prose(rng.randint(40, 200))
        texts.append(words)
        for edits in (1, 1, 2, 3, 4, 6):  # on both sides of 0.8, also chains of copies of copies
            words = list(words if rng.random() < 0.4 else texts[-1])
            for at in rng.sample(range(len(words)), edits):
                words[at] = rng.choice(vocabulary)
            texts.append(words)
    texts += [prose(rng.randint(5, 80)) + passage for _ in range(40)]
    base = prose(80)
    for _ in range(60):  # one large group of near copies
        words = list(base)
        for at in rng.sample(range(80), 1):
            words[at] = rng.choice(vocabulary)
        texts.append(words)
    return {i: " ".join(t) for i, t in enumerate([*texts, [], [], ["two", "words"], ["Two", " words"]])}


@pytest.mark.parametrize("hot,crowded", [(64, 128), (1, 1)])
def test_groups_equal_brute_force_jaccard(spark, hot, crowded):
    docs = planted()
    want, far = brute_groups(docs)
    assert far > 20  # pairs that three bits do not link
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    got = similar_groups(table, hot_cell=hot, crowded=crowded).collect()
    assert {r.id: r.rep.id for r in got} == want and len(got) == len(docs)


def test_pipeline_stage_drops_near_copies_that_bits_miss(spark):
    docs = planted()
    want, _ = brute_groups(docs)
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    left = corpus_pipeline.near_duplicate_stage(spark, table, SMALL)
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))


def test_small_table_equals_brute_force_jaccard(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    want, far = brute_groups({r.doc_id: r.text for r in table.collect()})
    assert far
    assert {r.id: r.rep.id for r in similar_groups(table).collect()} == want


def test_edges(spark):
    rows = [(None, "a b c d e f"), (3, "A b  c d\te f"), (4, None), (5, ""), (5, ""), (6, "x")]
    docs = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "'z' AS rep")
    left = drop_similar(docs, "id")
    assert left.columns == docs.columns
    assert sorted(r.id for r in left.collect()) == [3, 4, 6]
    nulls = docs.where("id IS NULL")
    assert [r.id for r in drop_similar(nulls.union(nulls), "id").collect()] == [None]
    assert drop_similar(docs.limit(0), "id").count() == 0
    assert len(shingle_bytes("", 5)) == 0 and len(shingle_bytes("a b", 5)) == 1
