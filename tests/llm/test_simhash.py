import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from cohortloom.llm.components import components
from cohortloom.llm.simhash import drop_near_duplicates, embed, links, manhattan, near_groups, op10_simhash
from conftest import SMALL


def brute_fingerprint(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64(s.encode("utf-8", "surrogatepass"), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    """fps: {key: fingerprint}; the least key that each can reach."""
    root = {k: k for k in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    fps = {r.doc_id: brute_fingerprint(r.text, 3) for r in docs}
    roots = brute_components(fps, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op10_simhash(spark, SMALL).collect()}
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in fps}
    assert any(i != r for i, r in roots.items())


@pytest.mark.parametrize("bits", [2, 3])
@pytest.mark.parametrize("hot", [64, 4, 1])
def test_links_connect_what_pairs_connect(spark, bits, hot):
    rng = random.Random(bits)
    values = set()
    for _ in range(12):  # chains and clouds of near values
        x = rng.getrandbits(64)
        for _ in range(12):
            values.add(x)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
    points = spark.createDataFrame([(signed(x),) for x in values], "fp long")
    want = brute_components({signed(x): x for x in values}, bits)
    edges = links(points, bits, hot)
    for r in edges.collect():
        assert want[r.a] == want[r.b]
    got = {r.node: r.root for r in components(edges).collect()}
    assert {x: got.get(x, x) for x in want} == want


@pytest.mark.parametrize("one_task", [0, 1 << 20])
def test_components_either_way(spark, one_task):
    rng = random.Random(9)
    nodes = [signed(rng.getrandbits(64)) for _ in range(300)]
    edges = [tuple(rng.sample(nodes[i : i + 30], 2)) for i in range(0, 270, 30) for _ in range(40)] + list(zip(nodes[200:280], nodes[201:281])) + [(nodes[299], nodes[299])]
    near = {x: {x} for e in edges for x in e}
    for a, b in edges:
        if near[a] is not near[b]:
            near[a] |= near[b]
            for x in near[b]:
                near[x] = near[a]
    want = {x: min(g) for x, g in near.items() if len(g) > 1}
    got = components(spark.createDataFrame(edges, "a long, b long"), one_task).collect()
    assert {r.node: r.root for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long"), one_task).count() == 0


def test_manhattan_is_a_lower_bound(spark):
    rng = random.Random(5)
    rows = [(signed(a), signed(a ^ (1 << rng.randrange(64)) ^ rng.choice([0, 1 << rng.randrange(64)]))) for a in (rng.getrandbits(64) for _ in range(200))]
    df = spark.createDataFrame(rows, "a long, b long").select("a", "b", manhattan(embed(F.col("a")), embed(F.col("b"))).alias("m"))
    for r in df.collect():
        a, b = r.a & (1 << 64) - 1, r.b & (1 << 64) - 1
        want = sum(abs((a >> 2 * s & 3).bit_count() - (b >> 2 * s & 3).bit_count()) for s in range(32))
        assert r.m == want <= (a ^ b).bit_count()


def test_edges(spark):
    long = " ".join(str(i) for i in range(60_000))
    rows = [(5, "Alpha beta gamma delta"), (2, "alpha  BETA\tgamma\ndelta"), (None, "alpha beta gamma delta"), (7, None), (8, ""), (8, ""), (9, "two words"), (3, long), (4, long + " x")]
    docs = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "'z' AS fp", "'y' AS rep", "'h' AS th", "'n' AS __n", "'t' AS __th", "'r' AS row", "'i' AS is_null")
    found = near_groups(docs, "id", words=3, max_bits=2).collect()
    assert len(found) == len(rows)
    assert {(r.id, r.rep.id) for r in found} == {(5, 2), (2, 2), (None, 2), (7, 7), (8, 7), (9, 9), (3, 3), (4, 3)}
    left = drop_near_duplicates(docs, "id")
    assert left.columns == docs.columns
    got = left.collect()
    assert sorted(r.id for r in got) == [2, 3, 7, 9]
    assert {(r.fp, r.rep, r.th, r["__n"], r["__th"], r.row, r.is_null) for r in got} == {("z", "y", "h", "n", "t", "r", "i")}
    assert near_groups(docs.limit(0), "id").count() == 0
    nulls = docs.where("id IS NULL")
    assert drop_near_duplicates(nulls.union(nulls), "id").count() == 1
