"""Personal data: base patterns, and further spans by boosted trees over generated candidates; DataFrame functions only.

Base kinds are leftmost matches of fixed patterns that pass a check (octets, Luhn, digit counts). High-recall generators
propose more, overlapping spans: e-mail and ip addresses with spaced, bracketed or written-out signs, digits as cards or
telephone numbers with any separators or none. Format and context of a candidate (length, separators, grouping, words before
it that speak for or against it, its neighbours) make a small cell of features.

The trees learn from labels that neither the base patterns nor the features give:

* right: base spans of the corpus in their own context, rewritten as people disguise them (``[at]``, `` @ ``, other
  separators, national telephone numbers), as far as a generator proposes the new form;
* wrong: proposals that no base span meets and whose content fails a check (no top-level domain or a new sentence after
  the dot; Luhn; too few or too many digits, a date, an ip address);
* fixed lessons of both (``LESSONS``): forms in contexts, wrong ones among them that pass the content check (order and part
  numbers of the same shape). What the corpus teaches weighs no more than these, so that a small corpus is judged like a large one.

All other proposals teach nothing. Spark counts the lessons of every cell; the trees are fitted to those of one half of
the texts (by a hash) and a threshold for each generator is calibrated to ``PRECISION`` on the other half. A proposal
becomes a span if its score reaches the threshold, its content passes the check and no base span meets it. Base spans
always stay. The texts are searched once: base spans and candidates are checkpointed, the trees run on those.

Patterns start at word edges and never give back what they took, so they stay linear on long runs of one character.
Offsets come from the lengths of the pieces between matches, summed in blocks, so many matches in one text stay cheap.

Nulls and edges: a null text counts as empty; texts may have any length; ids may be null or repeat (nothing is keyed by
them); without candidates the trees add nothing; an empty table gives an empty result; input columns may have any name
(one called as a result, ``base`` or ``spans``, is replaced by ``find_personal_data`` and kept by ``redact``).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import fit, scores, threshold, to_column
from .common import cut_lineage, documents, text_or_empty

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.97
BLOCK = 128

# The base patterns. Possessive quantifiers and the look-behind (or the end of the last match) leave the
# matches as they are.
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# generators: (kind, pattern, what a text must hold for it). Each step of a number is one digit, so none can match in two ways.
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT = rf"(?:\x20?@\x20?|\x20?{_OPEN}\x20?(?:[aA][tT]|@)\x20?{_CLOSE}\x20?|\x20[aA][tT]\x20)"
_DOT = rf"(?:\x20?\.\x20?|\x20?{_OPEN}\x20?(?:[dD][oO][tT]|\.)\x20?{_CLOSE}\x20?|\x20[dD][oO][tT]\x20)"
EMAIL_LIKE = rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+{_AT}{_LABEL}{{1,63}}+(?:{_DOT}{_LABEL}{{1,63}}+){{1,4}}"
CARD_LIKE = r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}[0-9]){11,18}(?![0-9])"
PHONE_LIKE = r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20./()-]{0,2}[0-9]){8,14}(?![0-9A-Za-z])"
_IP_DOT = rf"(?:\x20?{_OPEN}(?:[dD][oO][tT]|\.){_CLOSE}\x20?|\x20(?:[dD][oO][tT]|\.)\x20)"
IP_LIKE = rf"(?<![0-9A-Za-z])[0-9]{{1,3}}+(?:{_IP_DOT}[0-9]{{1,3}}+){{3}}(?![0-9A-Za-z])"
GENERATORS = (
    ("email", EMAIL_LIKE, r"@|[\[({<\x20][aA][tT][\])}>\x20]"),
    ("card", CARD_LIKE, "[0-9][\\x20./_-]?[0-9]"),
    ("phone", PHONE_LIKE, "[0-9][\\x20./()-]{0,2}[0-9]"),
    ("ip", IP_LIKE, rf"[0-9]{_IP_DOT}[0-9]"),
)
# words before a proposal that speak for its kind, and words for numbers and places that belong to nobody
KEY_WORDS = {
    "email": "e-?mail|contact|write|reach|address|reply|send|inbox",
    "card": "card|visa|credit|debit|payment|amex|mastercard|charged?|karte",
    "phone": "phone|tel|telephone|call|fax|mobile|cell|ring|dial|sms|whatsapp|contact|handy",
    "ip": "ip|host|server|address|client|ping|login|from",
}
OTHER_WORDS = "order|invoice|lot|part|serial|isbn|item|ref|reference|version|case|ticket|batch|sku|article|model|page|room|release|build|tracking|section|chapter|rows?|log|parcel|permit|voucher|patent|docket|look|found|meet|sale|open|see"
DATE = r"^\(?(?:[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2,4})"
# how a base span is written otherwise: (pattern, replacement) in turn, by a hash of the span
DISGUISES = {
    "email": [("@", " [at] "), ("@", "(at)"), ("@", " @ "), (r"@([^.]*)\.", " [at] $1 [dot] "), (r"@([^.]*)\.", "(at)$1(dot)"), (r"@([^.]*)\.", " at $1 dot ")],
    "card": [("([0-9]{4})[\\x20-]?(?=[0-9])", "$1."), ("([0-9]{4})[\\x20-]?(?=[0-9])", "$1/"), ("([0-9]{4})[\\x20-]?(?=[0-9])", "$1  ")],
    "phone": [(r"^\+[0-9]{1,3}[\x20.-]?", ""), (r"^\+[0-9]{1,3}[\x20.-]?\(?", "(0"), (r"^\+", "00"), (r"^\+[0-9]{1,3}[\x20.-]?\(?([0-9]+)\)?", "0$1")],
    "ip": [(r"\.", "[.]"), (r"\.", " . "), (r"\.", "(dot)"), (r"\.", " [dot] ")],
}
# fixed lessons: (generator, contexts, proposals, right)
_CARDS = ("4111.1111.1111.1111", "4111/1111/1111/1111", "5500  0000  0000  0004", "4012_8888_8888_1881", "3782.822463.10005", "3714/496353/98431", "4111 /1111 /1111 /1111", "6011.0009.9013.9424")
_PHONES = ("(555) 123-4567", "555-123-4567", "030 1234 5678", "(030) 123 4567", "0049 30 123 4567", "555.123.4567", "030/12345678", "07911 123456", "01 23 45 67 89", "5551234567", "020 7946 0018", "0171/234 56 78", "555 123 4567")
_IPS = ("192[.]168[.]10[.]5", "10 . 0 . 0 . 12", "172(dot)16(dot)1(dot)9", "8 dot 8 dot 4 dot 4", "203 [dot] 0 [dot] 113 [dot] 7")
LESSONS = [
    (0, ("mail ", "contact me: ", "write to ", "and ", ""), ("bob [at] example.org", "ann.lee (at) mail.example.com", "joe[at]example[dot]net", "eve @ example.com", "kim at example dot com", "lee AT example DOT org", "joe {at} example.com", "max <at> example <dot> com", "pat(at)example(dot)co(dot)uk", "sam [at] example [dot] com"), 1),
    (0, ("mail ", "contact ", "send it to "), ("bob at example.com", "ann.lee at mail.example.org"), 1),
    (0, ("", "see ", "we "), ("thanks @alice. see", "home (at) 5. the", "sold @ 3. 50", "it @ noon. then", "a @ b. c", "look at example.com", "meet at home.then", "sale at shop.net", "and at www.example.org", "stay at inn.net"), 0),
    (1, ("card ", "visa: ", "credit card no. ", "paid by amex ", "and ", ""), _CARDS, 1),
    (1, ("order ", "serial no. ", "part ", "tracking: ", "batch ", "ref. "), _CARDS, 0),
    (1, ("", "= ", "and "), ("12.5 13.5 14.5 15.5 16.5", "1/2/3/4/5/6/7/8/9/10/11/12", "2019.2020.2021.2022", "10.000.000.000.000", "100 200 300 400 500", "12 34 56 78 90 12 34"), 0),
    (2, ("call ", "tel. ", "phone: ", "mobile ", "ring ", "fax no. "), _PHONES, 1),
    (2, ("", "and ", "or "), ("(555) 123-4567", "555-123-4567", "(030) 123 4567", "(0171) 234567"), 1),
    (2, ("order ", "invoice ", "lot ", "isbn ", "ref. ", "part number ", "version "), _PHONES, 0),
    (2, ("", "in ", "= ", "and ", "rows "), ("2019 2020 2021", "12.50 13.75 100", "10 20 30 40 50", "1.25 3.50 2.75", "100/200/300 400", "0049 2021 5566", "5551234567", "123456789", "01 23 45 67 89", "555 123 4567", "030 1234 5678"), 0),
    (3, ("ip ", "host ", "server ", "login from ", "and "), _IPS, 1),
    (3, ("",), ("192[.]168[.]10[.]5", "172(dot)16(dot)1(dot)9"), 1),
    (3, ("version ", "section ", "release "), _IPS, 0),
    (3, ("", "and "), ("3 . 4 . 5 . 6", "1 . 2 . 3 . 4"), 0),
]
#: Weight of each fixed lesson; those of the corpus weigh as much as the fixed ones of their generator at most, in sum.
LESSON_WEIGHT = 4.0
#: More kinds of proposals than this many cells are refused (their features' ranges allow for no more in practice).
MAX_CELLS = 200_000


def running_sum(values: Column) -> Column:
    """Inclusive running sums of an array, in blocks so that the cost stays near linear."""

    def sums(x: Column) -> Column:
        all_sums = F.aggregate(x, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
        return F.slice(all_sums, 2, F.greatest(F.size(all_sums) - 1, F.lit(0)))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda b: sums(F.slice(values, b * BLOCK + 1, BLOCK)))
    ends = F.transform(blocks, lambda x: F.element_at(x, -1))
    before = F.aggregate(ends, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
    return F.flatten(F.transform(F.filter(F.arrays_zip(blocks.alias("x"), before.alias("y")), lambda z: z["x"].isNotNull()), lambda z: F.transform(z["x"], lambda v: v + z["y"])))


_NONE = "array<struct<start:int,end:int,s:string,before:string,after:string>>"


def matches(text: Column, pattern: str, gate: Column) -> Column:
    """start, end (code points), s, the 30 characters before and the one after, of all matches, leftmost first."""
    pieces = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    n = F.size(hits)
    rows = F.arrays_zip(hits.alias("s"), F.slice(pieces, F.lit(1), n).alias("p"), F.slice(pieces, F.lit(2), n).alias("q"))
    units = F.transform(rows, lambda r: F.length(r["p"]) + F.length(r["s"]))
    placed = F.transform(
        F.arrays_zip(rows.alias("r"), running_sum(units).alias("e")),
        lambda z: F.struct(
            (z["e"] - F.length(z["r"]["s"])).alias("start"),
            z["e"].alias("end"),
            z["r"]["s"].alias("s"),
            F.substring(z["r"]["p"], -30, 30).alias("before"),
            F.substring(z["r"]["q"], 1, 1).alias("after"),
        ),
    )
    return F.when(gate & (n > 0), placed).otherwise(F.array().cast(_NONE))


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Doubling every second digit from the right, the digits' sum ends in zero."""
    values = F.transform(
        F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def valid(kind: str, s: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        def octet(p: Column) -> Column:
            q = F.ltrim(p, F.lit("0"))
            return (F.length(q) < 3) | ((F.length(q) == 3) & (q <= F.lit("255")))

        return F.forall(F.split(s, r"\."), octet)
    n = F.length(digits_of(s))
    return F.when(n.between(12, 19), luhn(digits_of(s))).otherwise(F.lit(False)) if kind == "card" else n.between(9, 15)


def _base_matches(text: Column) -> Column:
    """array<struct<start, k, end, s, before, after>> of the base kinds, in order of start and kind."""
    gates = {"email": F.instr(text, "@") > 0, "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20-]?[0-9]"), "phone": text.rlike(r"\+[0-9]")}

    def of(k: int, kind: str, pattern: str) -> Column:
        good = F.filter(matches(text, pattern, gates[kind]), lambda m: valid(kind, m["s"]))
        return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("k"), m["end"].alias("end"), *[m[c].alias(c) for c in ("s", "before", "after")]))

    return F.array_sort(F.concat(*[of(k, kind, p) for k, (kind, p) in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE)))]))


def _places(found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(*[m[c].alias(c) for c in ("start", "k", "end")]))


def base_spans(text: Column) -> Column:
    """array<struct<start, k, end>> of the base kinds, in order of start and kind."""
    return _places(_base_matches(text))


def _plain_email(s: Column) -> Column:
    """Written-out signs as signs, without blanks."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, _AT, "@"), _DOT, "."), r"\x20", "")


def _content_passes(kind: str, s: Column) -> Column:
    """The check of a proposal's content, whatever its format and context."""
    digits = F.length(digits_of(s))
    if kind == "email":
        sentence = s.rlike(r"\.\x20[A-Z]")
        return _plain_email(s).rlike(rf"^{_LOCAL}+@{_LABEL}+(\.{_LABEL}+)*\.[A-Za-z]{{2,}}$") & ~sentence
    if kind == "card":
        return F.coalesce(digits.between(12, 19) & luhn(digits_of(s)), F.lit(False))
    if kind == "ip":
        return F.forall(F.regexp_extract_all(s, F.lit("[0-9]+"), F.lit(0)), lambda p: p.cast("int") <= 255)
    octets = s.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    return digits.between(9, 15) & ~s.rlike(DATE) & ~octets


def _features(g: int, kind: str, m: Column) -> list[Column]:
    """Small integers from the format of a proposal and its neighbours; no check of its content."""
    s, before, after = m["s"], m["before"], m["after"]
    flag = lambda c: c.cast("int")
    parts = F.split(F.ltrim(s, F.lit("+(")), "[^0-9A-Za-z]+")
    # the last word that speaks decides
    for_it = before.rlike(rf"(?i)\b(?:{KEY_WORDS[kind]})\b(?:(?!\b(?:{OTHER_WORDS})\b)[^\n]){{0,20}}$")
    against = before.rlike(rf"(?i)\b(?:{OTHER_WORDS})\b[^\n]{{0,20}}$")
    sized = lambda p: F.least(F.length(p), F.lit(5))
    return [
        F.lit(g).alias("f0"),
        F.least(F.floor(F.length(s) / 4), F.lit(7)).cast("int").alias("f1"),
        F.when(s.rlike(rf"(?i){_OPEN}\x20?(?:dot|\.)\x20?{_CLOSE}"), 7)
        .when(s.rlike(rf"(?i){_OPEN}\x20?(?:at|@)\x20?{_CLOSE}"), 6)
        .when(s.rlike(r"(?i)\x20(?:at|dot)\x20"), F.when(s.rlike(r"(?i)\x20dot\x20"), 5).otherwise(4))
        .when(s.rlike(r"\.\x20|\x20\."), 3)
        .when(s.rlike("[./]|\x20@"), 2)
        .when(s.rlike(r"[\x20_-]"), 1)
        .otherwise(0)
        .alias("f2"),
        F.least(F.size(parts), F.lit(5)).alias("f3"),
        F.when(for_it, 2).when(against, 0).otherwise(1).alias("f4"),
        (flag(before.rlike(r"[0-9A-Za-z=\"'#$]\z")) + 2 * flag(after.rlike(r"[0-9A-Za-z\"'#$%]"))).alias("f5"),
        (flag(s.contains("(") & s.rlike("[0-9]\\)")) + 2 * flag(s.startswith("0")) + 4 * flag(s.contains("-"))).alias("f6"),
        sized(F.try_element_at(parts, F.lit(1))).alias("f7"),
        sized(F.try_element_at(parts, F.lit(-1))).alias("f8"),
    ]


FEATURES = [f"f{i}" for i in range(9)]


def candidates(text: Column) -> Column:
    """array<struct<start, k, end, passes, f0..f8>> of all generators; the spans overlap."""

    def of(g: int, kind: str, pattern: str, gate: str) -> Column:
        place = lambda m: [m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("k"), m["end"].alias("end")]
        return F.transform(matches(text, pattern, text.rlike(gate)), lambda m: F.struct(*place(m), _content_passes(kind, m["s"]).alias("passes"), *_features(g, kind, m)))

    return F.concat(*[of(g, *generator) for g, generator in enumerate(GENERATORS)])


def disguised(found: Column) -> Column:
    """array<struct<f0..f8>>: base matches in other spellings that a generator proposes as a whole."""

    def of(g: int, kind: str, pattern: str) -> Column:
        own = F.filter(found, lambda m: m["k"] == KINDS.index(kind))
        ways = DISGUISES[kind]

        def rewrite(m: Column) -> Column:
            out = m["s"]
            for i, (what, by) in enumerate(ways):
                out = F.when(F.pmod(F.xxhash64(m["s"]), F.lit(len(ways))) == i, F.regexp_replace(m["s"], what, by)).otherwise(out)
            return F.struct(out.alias("s"), m["before"].alias("before"), m["after"].alias("after"))

        new = F.filter(F.transform(own, rewrite), lambda m: m["s"].rlike(rf"^(?:{pattern})$"))
        return F.transform(new, lambda m: F.struct(*_features(g, kind, m)))

    return F.concat(*[of(g, kind, pattern) for g, (kind, pattern, _) in enumerate(GENERATORS)])


def meets(c: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (c["start"] < b["end"]) & (b["start"] < c["end"]))


def search(docs: DataFrame, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """row (the input columns, or ``keep``), half (0 or 1 by a hash of the text), base, candidates and disguised; checkpointed."""
    text = text_or_empty(F.col(f"`{text_col}`").cast("string"))
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    found = docs.select(row.alias("row"), text.alias("text")).withColumn("found", _base_matches(F.col("text")))
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half")
    return cut_lineage(found.select("row", half, _places(F.col("found")).alias("base"), candidates(F.col("text")).alias("candidates"), disguised(F.col("found")).alias("disguised")))


def _examples(spark) -> DataFrame:
    rows = [(g, b, s, a, good) for g, contexts, proposals, good in LESSONS for b in contexts for s in proposals for a in ("", " ")]
    table = spark.createDataFrame(rows, "g int, before string, s string, after string, good int")
    m = F.struct("s", "before", "after")
    per = [table.where(F.col("g") == g).withColumn("m", m).select("good", *_features(g, kind, F.col("m"))) for g, (kind, _, _) in enumerate(GENERATORS)]
    return reduce(DataFrame.union, per)


def fit_selector(found: DataFrame, precision: float = PRECISION):
    """(trees of each generator, thresholds) from the lessons of ``search``; the other half calibrates."""
    right = found.select("half", F.lit(1).alias("good"), F.explode("disguised").alias("c"))
    wrong = F.filter("candidates", lambda c: ~c["passes"] & ~meets(c, F.col("base")))
    lessons = right.select("half", "good", "c.*").union(found.select("half", F.lit(0).alias("good"), F.explode(wrong).alias("c")).select("half", "good", *[F.col(f"c.{f}") for f in FEATURES]))
    # the cells are no more than the product of the features' ranges, whatever the corpus
    cells = sorted(lessons.groupBy("half", *FEATURES).agg(F.sum("good").alias("good"), F.count("*").alias("n")).limit(MAX_CELLS + 1).collect())
    if len(cells) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} kinds of proposals")
    taught = [(half, *[r[f] for f in FEATURES], r.good, 1) for half in (0, 1) for r in _examples(found.sparkSession).collect()]
    half, *rest = (np.array(c) for c in zip(*taught, *map(tuple, cells)))
    x, good, n = np.stack(rest[:-2], axis=1), rest[-2].astype(float), rest[-1].astype(float)
    weight = np.full(len(n), LESSON_WEIGHT)
    for g in range(len(GENERATORS)):
        for h in (0, 1):
            own = (x[:, 0] == g) & (half == h)
            fixed = own & (np.arange(len(n)) < len(taught))
            # right and wrong lessons of the corpus each weigh as much as the fixed ones at most
            for part in (good > 0, good == 0):
                of = own & ~fixed & part
                weight[of] = min(1.0, LESSON_WEIGHT * fixed.sum() / max(n[of].sum(), 1.0))
    good, n = good * weight, n * weight
    fitting, held = half == 0, half == 1
    models, score = [], np.zeros(len(n))
    for g in range(len(GENERATORS)):  # trees of its own for each generator
        own = x[:, 0] == g
        models.append(fit(x[fitting & own], good[fitting & own], n[fitting & own], depth=4))
        score[own] = scores(models[g], x[own])
    limits = {}
    for g in range(len(GENERATORS)):
        own = held & (x[:, 0] == g)
        # never below even odds
        limits[g] = max(0.0, threshold(score[own], good[own], n[own], precision))
    return models, limits


def _find(docs: DataFrame, text_col: str, precision: float, keep: list[str] | None = None) -> DataFrame:
    """row, base and spans."""
    found = search(docs, text_col, keep)
    models, limits = fit_selector(found, precision)

    def chosen(c: Column) -> Column:
        enough = F.lit(False)
        for g, t in limits.items():
            if t < float("inf"):
                enough = F.when(c["f0"] == g, to_column(models[g], [c[f] for f in FEATURES]) >= F.lit(t - 1e-9)).otherwise(enough)
        return c["passes"] & ~meets(c, F.col("base")) & enough

    def within(c: Column, others: Column) -> Column:
        return F.exists(others, lambda o: (o["start"] <= c["start"]) & (c["end"] <= o["end"]) & (o["end"] - o["start"] > c["end"] - c["start"]))

    added = F.transform(F.filter("candidates", chosen), lambda c: F.struct(*[c[f].alias(f) for f in ("start", "k", "end")]))
    found = found.select("row", "base", F.array_distinct(added).alias("added"))
    # a part of a longer one (the digits of a card as a telephone number) is none of its own
    whole = F.filter("added", lambda c: ~within(c, F.col("added")))
    return found.select("row", "base", F.array_sort(F.concat("base", whole)).alias("spans"))


def find_personal_data(docs: DataFrame, text_col: str = "text", precision: float = PRECISION, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with base (spans of the base patterns) and spans (these and what the trees add): start, k, end."""
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("base", "spans")]
    return _find(docs, text_col, precision, keep).select(*[F.col("row").getField(c).alias(c) for c in names], "base", "spans")


def redact(docs: DataFrame, text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans merge, the first one names them."""
    field = F.col("row").getField
    found = _find(docs, text_col, precision).select("row", "spans", field(text_col).cast("string").alias("text"))
    text = F.col("text")
    spot = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, s: F.when(s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(
        F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.element_at(F.array(*map(F.lit, KINDS)), s["k"] + 1), F.lit("]")).alias("out"), s["end"].alias("at"))
    )
    rest = F.aggregate(F.col("spans"), spot, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    clean = F.when(F.size("spans") == 0, text).otherwise(rest)
    return found.select(*[(clean if c == text_col else field(c)).alias(c) for c in docs.columns])


def as_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["start"], s["end"])), ",")


def op7_personal_data(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir), keep=["doc_id"])

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = [count(k) for k in range(len(KINDS))]
    return found.select("doc_id", *counts, F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))
