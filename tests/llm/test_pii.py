import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortloom.llm.boosting import fit, scores, threshold
from cohortloom.llm.pii import KINDS, as_text, base_spans, find_personal_data, op7_personal_data, redact, running_sum
from conftest import SMALL

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    found = [(m.start(), KINDS.index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op7_personal_data(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x.startswith(k) for x in want.split(",")) for k in KINDS]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
    assert any(r.spans for r in rows)


TEXTS = [
    None, "", "äö a@b.c_d@e.f g@@h.i x@y@z.w", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.1 1.2.3", "4111 1111-1111 1111, 4111-1111-1111-1112", "+1 (918) 555-4124) +1 2 +12345678901234567",
    "a" * 50_000, "7" * 5_000, "1.1" * 9_000, "a@b.c " * 700, "._%+-@-.- 💥 a@b.de +49(0)123.456-7", "12 34\n5678901234 567", "4222222222222 4222222222222",
]


def test_base_spans_on_odd_texts(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    rows = docs.select("text", as_text(base_spans(F.coalesce("text", F.lit("")))).alias("got")).collect()
    for r in rows:
        assert r.got == brute(r.text), r.text[:80]


@settings(max_examples=1, deadline=None)
@given(st.just(0))
def test_running_sum(_):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    values = list(range(1000))
    got = spark.range(1).select(running_sum(F.array(*map(F.lit, values))).alias("x")).first().x
    assert got == np.cumsum(values).tolist()


def test_boosting_learns_an_interaction():
    x = np.array([[a, b] for a in range(3) for b in range(3)])
    total = np.full(9, 100.0)
    good = np.where((x[:, 0] > 1) & (x[:, 1] > 0), 99.0, 2.0)
    model = fit(x, good, total)
    s = scores(model, x)
    assert s[(x[:, 0] > 1) & (x[:, 1] > 0)].min() > s[~((x[:, 0] > 1) & (x[:, 1] > 0))].max()
    t = threshold(s, good, total, 0.95)
    assert ((s >= t) == (good == 99)).all()
    assert threshold(s, good * 0, total, 0.95) == float("inf")


def card(rng):
    digits = [4, *(rng.randrange(10) for _ in range(14))]
    odd = sum(sum(divmod(d * (2 - i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return "".join(map(str, [*digits, -odd % 10]))


def planted(rng, n):
    """Texts of the small corpus' prose with base spans, disguised ones (their places are returned) and decoys."""
    prose = "the sample holds many words and some numbers of the year and then it goes on".split()
    texts, places = [], []
    for i in range(n):
        name, host = rng.choice("bob ann joe eve kim lee".split()) + str(i), rng.choice(["example.org", "mail.example.com", "post.example.net"])
        number = card(rng)
        quads = [number[k : k + 4] for k in range(0, 16, 4)]
        area, a, b = rng.randrange(200, 999), rng.randrange(200, 999), f"{rng.randrange(10000):04d}"
        kind = i % 10
        what, hidden = [
            (f"mail {name}@{host}", False), (f"card {' '.join(quads)}", False), (f"call +1 ({area}) {a}-{b}", False),
            (f"mail {name}{rng.choice([' [at] ', '(at)', ' @ '])}{host}", True), (f"card {rng.choice(['.', '/', '  ']).join(quads)}", True),
            (f"call {rng.choice([f'({area}) {a}-{b}', f'0{area} {a} {b}', f'{area}-{a}-{b}'])}", True),
            (f"thanks @{name}. We saw {rng.randrange(9)}.{rng.randrange(99)} and {rng.randrange(99)}.{rng.randrange(99)} of it", None),
            (f"from 20{rng.randrange(10, 25)} 20{rng.randrange(10, 25)} 20{rng.randrange(10, 25)}", None),
            (f"home (at) {rng.randrange(9)}. Then on 20{rng.randrange(10, 25)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}", None),
            (f"rows {rng.randrange(100)} {rng.randrange(100)} {rng.randrange(100)}", None),
        ][kind]
        lead = " ".join(rng.choices(prose, k=rng.randint(3, 12)))
        text = f"{lead} {what} {' '.join(rng.choices(prose, k=5))}"
        at = len(lead) + 1
        start = at + what.index(" ") + 1
        texts.append(text)
        places.append((start, at + len(what)) if hidden is not None else None)
        places[-1] = places[-1] and (*places[-1], hidden)
    return texts, places


def test_trees_add_planted_variants(spark):
    """Disguised data are found with a precision and recall of at least 0.95; base spans stay as they are."""
    texts, places = planted(random.Random(3), 3000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in find_personal_data(docs).collect()}
    right = added = hidden = 0
    for i, (text, place) in enumerate(zip(texts, places)):
        assert as_words(rows[i].base) == brute(text)
        new = [s for s in rows[i].spans if s not in rows[i].base]
        assert [s for s in rows[i].spans if s in rows[i].base] == rows[i].base
        added += len(new)
        if place and place[2]:
            hidden += 1
            right += any((s.start, s.end) == place[:2] for s in new)
    assert hidden == 900
    assert right / hidden >= 0.95, (right, hidden)
    assert right / added >= 0.95, (right, added)


def as_words(spans):
    return ",".join(f"{KINDS[s.k]}:{s.start}:{s.end}" for s in spans)


def test_small_corpora_and_large_ones_agree(spark):
    """A disguised address or number is found alone, too: the fixed examples decide where the corpus teaches nothing."""
    one = [("mail bob [at] example.org now", "email"), ("tel. (555) 123-4567 please", "phone"), ("card 4111.1111.1111.1111 ok", "card"), ("thanks @alice. See you", None), ("in 2019 2020 2021", None), ("no 12.5 13.5 14.5", None)]
    for text, kind in one:
        found = find_personal_data(spark.createDataFrame([(text,)], "text string")).first()
        assert not found.base and [KINDS[s.k] for s in found.spans] == ([kind] if kind else []), text


def test_redaction_and_columns(spark):
    rows = [(f"mail bob{i}@mail{i}.example.com now", "k") for i in range(60)]
    rows += [(f"mail bob{i} [at] mail{i}.example.com now", None) for i in range(60)]
    rows += [(None, "k"), ("nothing 12 here", "k")]
    taken = ["spans", "base", "picked", "row", "found", "half", "candidates", "disguised", "Base2"]
    docs = spark.createDataFrame(rows, "text string, spans string").selectExpr("*", *[f"'{c}' AS {c}" for c in taken[1:]])
    found = find_personal_data(docs)
    assert found.columns == ["text", *[c for c in taken if c not in ("spans", "base")], "base", "spans"]
    for r in found.collect():
        if r.text and "[at]" in r.text:
            assert not r.base and [(s.start, s.end) for s in r.spans] == [(5, r.text.index(" now"))]
        elif r.text and "@" in r.text:
            assert len(r.base) == 1 == len(r.spans)
        else:
            assert not r.spans
        assert r.picked == "picked" and r.candidates == "candidates"
    clean = redact(docs)
    assert clean.columns == docs.columns
    got = clean.collect()
    assert {r.text for r in got} == {"mail [email] now", None, "nothing 12 here"}
    assert all(r[c] == c for r in got for c in taken[1:]) and {r.spans for r in got} == {"k", None}
    assert find_personal_data(docs.limit(0)).count() == 0


def amex(rng):
    digits = [3, 7, *(rng.randrange(10) for _ in range(12))]
    odd = sum(sum(divmod(d * (2 - i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return "".join(map(str, [*digits, -odd % 10]))


def unseen(rng):
    """One text of each template, none of which is in the operator: (text, span or None, kind). The wrong ones pass the content check."""
    name, host, word, top = rng.choice(["maria", "j.doe", "o_brien", "x12"]), rng.choice(["corp.co.uk", "uni-bonn.de", "shop.io"]), rng.choice(["acme", "orbit", "blue-sky"]), rng.choice(["net", "fr", "info"])
    d = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))
    n1 = lambda k: str(rng.randrange(2, 10)) + d(k - 1)
    c, x = card(rng), amex(rng)
    q = [c[i : i + 4] for i in range(0, 16, 4)]
    o = [str(rng.randrange(1, 255)) for _ in range(4)]
    right = [
        ("Drop us a line, {} any day", f"{name} (AT) {host}", "email"), ("you get me under {} most days", f"{name} at {word} dot {top}", "email"), ("my e-mail is {}", f"{name} <at> {host}", "email"),
        ("{} is where replies go", f"{name}[at]{word}[dot]{top}", "email"), ("Questions? Contact {} today", f"{name} at {host}", "email"), ("ask {} about it", f"{name}{{at}}{word}{{dot}}{top}", "email"),
        ("please charge {} for it", ".".join(q), "card"), ("my Mastercard reads {} so far", " / ".join(q).replace(" / ", " /"), "card"), ("the Amex was {} I think", f"{x[:4]}.{x[4:10]}.{x[10:]}", "card"), ("billed to visa no. {} then", "_".join(q), "card"),
        ("give her a ring on {} soon", f"07{d(3)} {n1(6)}", "phone"), ("my cell is {} now", n1(10), "phone"), ("dial {} after six", f"030/{n1(8)}", "phone"), ("our fax: {}", f"{n1(2)} {d(2)} {d(2)} {d(2)} {d(2)}", "phone"), ("an SMS to {} will do", f"0171 {n1(7)}", "phone"), ("Telephone {} (day)", f"({n1(3)}) {n1(3)}.{d(4)}", "phone"),
        ("we saw client {} again", "[.]".join(o), "ip"), ("ping {} first", " [dot] ".join(o), "ip"), ("the address was {} today", " . ".join(o), "ip"),
    ]
    wrong = [
        ("purchase order {} is late", f"{n1(3)} {n1(3)} {d(4)}"), ("invoice {} was paid", f"0049 20{d(2)} {d(4)}"), ("the shipment {} left", n1(10)), ("lot {} passed", f"{n1(3)}-{n1(3)}-{d(4)}"), ("a serial of {} on it", ".".join(q)), ("parcel {} came", f"0171 {n1(7)}"),
        ("dinner at the {} was good", f"inn at {word}.{top}"), ("you can look at {} for that", f"{word}.{top}"), ("batch no. {} went out", "/".join(q)), ("membership {} ends", f"07{d(3)} {n1(6)}"), ("chapter {} says so", " . ".join(o)), ("counts were {} that day", f"{n1(2)} {d(2)} {d(2)} {d(2)} {d(2)}"),
        ("model {} is out", f"{x[:4]}.{x[4:10]}.{x[10:]}"), ("patent {} was filed", n1(10)), ("in build {} it works", "[.]".join(o)),
    ]
    lead, tail = rng.choice(["It was late. ", "", "As they said, "]), rng.choice(["", " and more words follow", "."])
    out = []
    for template, value, kind in right:
        at = len(lead) + template.index("{}")
        out.append((lead + template.format(value) + tail, (at, at + len(value)), kind))
    return out + [(lead + template.format(value) + tail, None, None) for template, value in wrong]


def test_unseen_templates(spark):
    """Precision and recall of at least 0.9 on templates that were not taught, alone and within a corpus of base spans."""
    rng = random.Random(8)
    cases = [x for _ in range(40) for x in unseen(rng)]
    corpus = [(len(cases) + i, t) for i, t in enumerate(planted(random.Random(3), 600)[0])]
    for more in ([], corpus):
        docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)] + more, "doc_id long, text string").repartition(4)
        rows = {r.doc_id: r for r in find_personal_data(docs).where(F.col("doc_id") < len(cases)).collect()}
        added = right = wanted = 0
        missed, false = set(), set()
        for i, (text, span, kind) in enumerate(cases):
            base = {(s.start, s.end) for s in rows[i].base}
            new = [(s.start, s.end, KINDS[s.k]) for s in rows[i].spans if (s.start, s.end) not in base]
            wanted, added = wanted + (span is not None), added + len(new)
            hit = span is not None and any((a, b, k) == (*span, kind) for a, b, k in new)
            right += hit
            if span and not hit:
                missed.add(text)
            false |= {(text, n) for n in new if not (hit and n[:2] == span)}
        print(*[f"MISS {x}" for x in sorted(missed)], *[f"FALSE {x}" for x in sorted(false)], right / wanted, right / max(added, 1), sep="\n")
        assert right / wanted >= 0.9 and right / added >= 0.9, (right, wanted, added)
