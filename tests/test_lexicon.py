"""Lexicon decisions against a loop written from the rules."""

import random
import re

from cohortloom.functions import text as H


def decisions(text, reach=150):
    out, low = [], text.lower()
    for feature, terms in H.LEXICON.items():
        for pattern, value in terms:
            for m in re.finditer(pattern, low):
                before = low[max(0, m.start() - reach) : m.start()]
                ends = [t.end() for p in H.TERMINATORS for t in re.finditer(p, before)]
                before = before[max(ends, default=0) :]
                behind = low[m.end() : m.end() + reach]
                negated = any(re.search(p, before) for p in H.PRE_NEGATIONS) or any(re.search(p, behind) for p in H.POST_NEGATIONS)
                out.append((feature, value, negated, m.start(), m.end()))
    return out


WORDS = (
    "oval ovoid round irregular circumscribed macro microlobulated indistinct angular spiculated spiculation parallel antiparallel anechoic hypoechogenicity complex heterogenous "
    "enhancement shadowing mass cyst area casino and with the é no without absent denies not seen present identified free of ack negative for evidence longer is are was were has have resolved ruled out "
    "but however although showing demonstrates . . abrupt interface echogenic halo architectural distortion posterior features acoustic"
).split()


def texts():
    rng = random.Random(11)
    out = [" ".join(rng.choices(WORDS, k=rng.randint(3, 90))) for _ in range(1500)]
    blanks = lambda t: re.sub(" ", lambda _: rng.choice([" ", "  ", "\n", "\t "]), t)
    fixed = ["not present. oval mass", "mass not present oval", "no " + "x" * 140 + " oval", "no " + "x" * 146 + " oval", "oval " + "x" * 140 + " is absent", "casino oval", "representno oval", "", "Oval OVAL no oval", "not parallel and not  parallel"]
    fixed += ["y" * 120 + "represent" + " no " + "z" * pad + " round" for pad in range(130, 150)] + ["round " + "z" * pad + " is absentee" for pad in range(130, 150)]
    return [*fixed, *out, *map(blanks, out[:500])]


def test_decisions_equal_the_loop(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "i int, t string").repartition(4)
    got = {r.i: [tuple(d) for d in r.d or []] for r in df.select("i", H.lexicon_decisions(df.t).alias("d")).collect()}
    several = 0
    for i, t in rows:
        want = decisions(t)
        assert got[i] == want, t
        several += any(sum(d[:2] == e[:2] for e in want) > 1 for d in want)
    assert several > 300


def test_features_are_what_stands(spark):
    rows = texts()[:400]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
    for r in df.select("i", H.lexicon_features(df.t).alias("x")).collect():
        want = decisions(rows[r.i])
        for feature in ("shape", "orientation", "posterior", "boundary"):
            values = sorted({v for f, v, negated, *_ in want if f == feature and not negated})
            assert r.x[feature] == (", ".join(values) or None)


def test_nulls_and_spans(spark):
    df = spark.createDataFrame([(None,), ("xx",), ("aéa a",)], "t string")
    assert [r[0] for r in df.select(H.lexicon_decisions(df.t)).collect()] == [None, None, None]
    assert [[tuple(s) for s in r[0] or []] for r in df.select(H.spans(df.t, "a|é")).collect()] == [[], [], [(0, 1), (1, 2), (2, 3), (4, 5)]]


def test_lists_are_whole_and_in_order():
    assert len(H.PRE_NEGATIONS) == 10 and len(H.POST_NEGATIONS) == 5 and len(H.TERMINATORS) == 7
    assert [len(p) for _, p in H.LESION_TYPES] == [3, 29, 2]
