import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import turns
from cohortloom.llm.turns import Survivors, audits, op12_turn_repair, repair
from conftest import SMALL

SHAPE = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """rows: (role, text) in order -> the first fault of each."""
    seen, out = set(), []
    for role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_repair(rows):
    """All repairs with at most two inserts in a gap, by trying them all: the least (cost, audit), and the text left."""
    kinds, best = faults(rows), None
    gaps = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    ways = []
    for (role, text), fault in zip(rows, kinds):
        stay = fault == "truncated"
        ways.append([("D", 3, None)] + ([] if fault in ("blank", "duplicate") else [("K", 0 + stay, (role, text)), ("R", 2 + stay, ("user", text)), ("R", 2 + stay, ("assistant", text))]))
    for edits in itertools.product(*ways):
        for holes in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, left = 0, "", []
            for k, hole in enumerate(holes):
                cost, audit, left = cost + 2 * len(hole), audit + "I" * len(hole), left + [(r, "") for r in hole]
                if k < len(rows):
                    letter, more, row = edits[k]
                    cost, audit, left = cost + more, audit + letter, left + ([row] if row else [])
            if (best is None or (cost, audit) <= best[:2]) and SHAPE.fullmatch("".join(r[:1] or "?" for r, _ in left)):
                if best and (cost, audit) == best[:2]:
                    assert left == best[2]
                best = cost, audit, left
    return best


def by_strings(rows):
    """The same by shortest paths over (turns taken, state) with whole strings."""
    kinds, infinite = faults(rows), (10**9, "~", None)
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    now = {0: (0, "", [])}
    for i in range(len(rows) + 1):
        for _ in range(3):
            for s, (cost, audit, left) in list(now.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    if initial in step[s]:
                        way = (cost + 2, audit + "I", [*left, (role, "")])
                        now[step[s][initial]] = min(now.get(step[s][initial], infinite), way, key=lambda w: w[:2])
        if i == len(rows):
            return min((now[s] for s in (0, 3) if s in now), key=lambda w: w[:2])
        role, text = rows[i]
        after = {}
        for s, (cost, audit, left) in now.items():
            ways = [(s, (cost + 3, audit + "D", left))]
            if kinds[i] not in ("blank", "duplicate"):
                more = kinds[i] == "truncated"
                if role[:1] in step[s]:
                    ways.append((step[s][role[:1]], (cost + more, audit + "K", [*left, (role, text)])))
                for initial, name in (("u", "user"), ("a", "assistant")):
                    if initial in step[s]:
                        ways.append((step[s][initial], (cost + 2 + more, audit + "R", [*left, (name, text)])))
            for t, way in ways:
                after[t] = min(after.get(t, infinite), way, key=lambda w: w[:2])
        now = after


def searched(rows):
    search, edits, most = Survivors(), [], 0
    for (role, text), fault in zip(rows, faults(rows)):
        edits += search.take(None, role, text, fault in ("blank", "duplicate"), fault == "truncated")
        most = max(most, search.unresolved)
    cost, rest = search.end()
    edits += rest
    return (cost, "".join(e[0] for e in edits), [(r, x) for letter, _, r, x in edits if letter != "D"]), most


def random_rows(rng, n):
    return [(rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b!", "c", " ", "d?", "e", "f."])) for _ in range(n)]


def test_equals_trying_every_repair():
    rng = random.Random(1)
    for n in [0, 1, 1, 2, 2, 2, 3, 3, 3]:
        for _ in range(12 if n == 3 else 40):
            rows = random_rows(rng, n)
            assert searched(rows)[0] == every_repair(rows) == by_strings(rows), rows


def test_equals_whole_strings_on_longer_conversations():
    rng = random.Random(2)
    for n in (4, 7, 12, 40, 150):
        for _ in range(150 if n < 20 else 15):
            rows = random_rows(rng, n)
            assert searched(rows)[0] == by_strings(rows), rows


def test_edits_leave_early_and_memory_stays_small():
    rng = random.Random(3)
    rows = [(r, f"{i}.") for i, r in enumerate(rng.choices(["user", "assistant", "system"], [8, 8, 1], k=20_000))]
    assert searched(rows)[1] < 200
    tools = [("tool", f"{i}.") for i in range(301)]  # the end decides the parity of the whole run
    (cost, audit, left), most = searched(tools)
    assert most >= 300 and (cost, audit, left) == by_strings(tools)


def damaged(rows):
    """rows: (conv, turn, role, text) -> {conv: rows after damage, in order}"""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        out[conv] += []
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out[conv] += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {c: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, rs in out.items()}


def audited(conv, rows):
    said = [r[1:] for r in rows]
    kinds, known = faults(said), [t for t, _, _ in rows if t is not None]
    cost, audit, left = by_strings(said)
    initials = [r[:1] for r, _ in said]
    return (
        conv,
        max(known) - min(known) + 1 - len(set(known)) if known else 0,
        *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{x}" for r, x in left).encode()).hexdigest(),
    )


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("sf_dir", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op12_turn_repair(spark, sf_dir)
    assert got.columns == COLUMNS
    assert {tuple(r) for r in got.collect()} == {audited(c, rs) for c, rs in damaged(rows).items()}
    assert got.count() == len({r[0] for r in rows})


def test_edges(spark, tmp_path):
    rng = random.Random(4)
    rows = [(1, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(60)] * 2
    rows += [(2, t, None, None) for t in range(9)] + [(None, t, "user", "x.") for t in (None, None, 0, 3)] + [(3, None, "assistant", "a" * 200_000 + "!")]
    rows += [(4, t, *r) for t, r in enumerate(random_rows(rng, 300))] + [(5, 7, "user", "a."), (5, 7, "assistant", "b."), (5, 7, "user", "a."), (6, 0, "", "")]
    rows += [(100 + i, t, "user", "Same.") for i in range(40) for t in range(3)]
    rows.append((next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0), 0, "user", "All of it is lost."))
    want = {audited(c, rs) for c, rs in damaged(rows).items()}
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, repeated int, dropped string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    assert {tuple(r) for r in op12_turn_repair(spark, str(tmp_path)).collect()} == want
    assert any(len(w[7]) == 0 for w in want)
    df.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert op12_turn_repair(spark, f"{tmp_path}/none").collect() == []


def test_repair_gives_the_turns_behind_the_audit(spark):
    rng = random.Random(5)
    rows = [(f"c{c}", t, *r) for c in range(30) for t, r in enumerate(random_rows(rng, c))]
    df = spark.createDataFrame(rows, "id string, no int, who string, said string").withColumn("conv", F.lit(1))
    of = {"conv": "id", "turn": "no", "role": "who", "text": "said"}
    edits = repair(df, **of)
    assert edits.columns == ["id", "step", "edit", "no", "who", "said"]
    found = defaultdict(list)
    for r in sorted(edits.collect(), key=lambda r: (r.id, r.step)):
        found[r.id].append(r)
    for r in audits(df, **of).collect():
        assert "".join(e.edit[0] for e in found[r.id]) == r.audit
        left = [f"{e.who}:{e.said}" for e in found[r.id] if e.edit != "Delete"]
        assert hashlib.sha256("\n".join(left).encode()).hexdigest() == r.repaired_sha256
        assert all((e.no is None) == (e.edit == "Insert") for e in found[r.id])
    assert repair(df.limit(0), **of).count() == 0


def test_a_conversation_is_one_exchange(spark):
    plan = op12_turn_repair(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and turns.DELETE == 3
