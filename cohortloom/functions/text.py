"""Text rules as Column expressions: patterns are data, each rule is one expression over Java regular expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER = "[A-Z]{2,}:"


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without a match or with an empty group."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def bind(value: Column, f) -> Column:
    """f(value) with the value worked out once, however often f names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def any_of(c: Column, patterns: Sequence[str]) -> Column:
    return c.rlike("|".join(f"(?:{p})" for p in patterns))


def words_of(pattern: str) -> tuple[str, ...]:
    """The runs of letters that every match of a pattern holds: those outside groups, classes and what may be absent."""
    bare = re.sub(r"\\.(?:[*+?]|\{[^}]*\})?", "~", pattern)
    bare = re.sub(r"\[[^\]]*\](?:[*+?]|\{[^}]*\})?", "~", bare)
    while (less := re.sub(r"\([^()]*\)(?:[*+?]|\{[^}]*\})?", "~", bare)) != bare:
        bare = less
    if "|" in bare:
        return ()
    return tuple(dict.fromkeys(re.findall("[A-Za-z]{2,}", re.sub(r".(?:[*?]|\{[^}]*\})", "~", bare))))


def holds(c: Column, words: Sequence[str]) -> Column:
    out = c.contains(words[0])
    for w in words[1:]:
        out = out & c.contains(w)
    return out


def some_of(c: Column, patterns: Sequence[str], search: Sequence[str] | None = None) -> Column:
    """As ``any_of``, for patterns that respect case: what each pattern needs is looked for by plain words first, and a text is
    only searched for those patterns whose words it has. ``search`` are the patterns to search by instead, one for each."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for p, q in zip(patterns, search or patterns):
        groups.setdefault(words_of(p), []).append(q)
    out = None
    for words, own in groups.items():
        plain = len(words) == 1 and own == list(words)
        test = holds(c, words) if plain else holds(c, words) & any_of(c, own) if words else any_of(c, own)
        out = test if out is None else out | test
    return out


def could(c: Column, patterns: Sequence[str]) -> Column:
    """Whether the plain words of some pattern are there: no text without them matches any of the patterns."""
    out = None
    for words in dict.fromkeys(map(words_of, patterns)):
        test = holds(c, words) if words else F.lit(True)
        out = test if out is None else out | test
    return out


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def section(c: Column, header: str, next_header: str = HEADER) -> Column:
    """H1: the text after a header, up to the next header."""
    body = F.regexp_extract(c, rf"(?s){header}\s*(.*?)\s*(?:(?={next_header})|\z)", 1)
    return F.when(c.rlike(header), body)


FINDINGS_HEADERS = ("FINDINGS", "Ultrasound Findings", "Findings:")


def findings(*sources: Column) -> Column:
    """H2: of the first source with a findings header the text after it, up to the impression."""

    def of(c: Column) -> Column:
        out = F.lit(None).cast("string")
        for h in reversed(FINDINGS_HEADERS):
            out = F.when(c.contains(h), F.regexp_extract(c, rf"(?s){re.escape(h)}[\s:\-]*(.*?)\s*(?:IMPRESSION|\z)", 1)).otherwise(out)
        return out

    return F.coalesce(*map(of, sources))


def impression(c: Column) -> Column:
    """H1: the impression; without a colon after the header, colons among its first 50 characters do not count."""
    loose = F.regexp_extract(c, r"(?s)IMPRESSION\s*(.*)", 1)
    loose = F.concat(F.replace(F.substring(loose, 1, 50), F.lit(":"), F.lit("")), F.substring(loose, 51, 1_000_000_000))
    cut = F.regexp_extract(loose, rf"(?s)^(.*?)\s*(?:(?={HEADER})|\z)", 1)
    return F.when(c.contains("IMPRESSION:"), section(c, "IMPRESSION:")).when(c.contains("IMPRESSION"), cut)


def final_diagnosis(c: Column) -> Column:
    """H3: the final diagnosis up to the next capital heading, with a letter before its first part."""
    lettered = lambda body: F.when(body.startswith("A.") | body.startswith("A)"), body).otherwise(F.concat(F.lit("A. "), body))
    cut = lambda body: F.regexp_extract(lettered(body), r"(?s)^(.*?)\s*(?:\s(?:[A-Z]{4,}:|\b[A-Z][A-Z\s]{3,}\s-)|\z)", 1)
    return bind(c, lambda t: F.when(t.contains("FINAL DIAGNOSIS"), bind(strip(F.regexp_extract(t, r"(?s)FINAL DIAGNOSIS:?(.*)", 1)), cut)))


def synoptic(c: Column, dialect: str = "new") -> Column:
    """H4: the text after the synoptic heading of either dialect."""
    pattern = r"(?s)SYNOPTIC REPORT:?\s*(.*?)\s*\z" if dialect == "new" else r"(?s)Synoptic Report\s*:\s*(.*?)\s*\z"
    return F.when(c.rlike("SYNOPTIC REPORT" if dialect == "new" else r"Synoptic Report\s*:"), F.regexp_extract(c, pattern, 1))


# Markup of the older reports, in the order in which it is taken away, with what a text must hold for it.
RTF_STEPS = (
    (r"(?s)^.*?\\plain\\f\d+\\fs\d+\s?", "", "\\plain\\f"),
    (r"\\par\b", "\n", "\\par"),
    (r"\\tab\b", " ", "\\tab"),
    (r"\\'[0-9a-fA-F]{2}", " ", "\\'"),
    (r"\\[a-zA-Z]+-?\d*\s?", "", "\\"),
    (r"\\[^a-zA-Z]", "", "\\"),
    (r"[{}]", "", ""),
    (r"\t[ \t]*| [ \t]+", " ", ""),
    (r" ?\n ?", "\n", "\n"),
    (r"\n{3,}", "\n\n", "\n\n\n"),
)


def strip_rtf(c: Column) -> Column:
    def step(pattern: str, new: str, held: str):
        return lambda t: F.when(t.contains(held), F.regexp_replace(t, pattern, new)).otherwise(t)

    for pattern, new, held in RTF_STEPS:
        c = bind(c, step(pattern, new, held)) if held else F.regexp_replace(c, pattern, new)
    return strip(c)


def classify_blob(text: Column) -> Column:
    """Kind of one document of a joined note."""
    organ = text.rlike(r"(?:^|\n)A\.\s+(?:Breast|Lymph nodes?|Skin|Nipple)[^:\n]{0,80}:")
    markers = text.startswith("Source:") | (text.contains("Estrogen:") & text.contains("Progesterone:") & text.contains("HER2"))
    frozen = text.contains("Frozen section histologic interpretation") | text.contains("HOLDOVER") | text.contains("HOLD OVER")
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "OTHER")
        .when(text.contains("Received fresh"), "GROSS")
        .when(markers & ~organ, "MARKERS")
        .when(frozen, "FROZEN")
        .when((F.length(text) < 200) | text.startswith("Stains for"), "ADDENDUM")
        .when(organ, "FINAL")
        .otherwise("OTHER")
    )


def rtf_final(c: Column) -> Column:
    """H5: of the documents in a note the final diagnosis: with a synoptic part if there is one, then the longest."""
    blobs = F.transform(F.filter(F.split(c, r"(?=\{\\rtf1)"), lambda b: F.ltrim(b).startswith("{\\rtf1")), strip_rtf)
    finals = F.filter(blobs, lambda b: classify_blob(b) == "FINAL")
    ranked = F.transform(finals, lambda b, i: F.struct(b.rlike("(?i)Synoptic Report").alias("s"), F.length(b).alias("n"), (-i).alias("k"), b.alias("b")))
    return F.array_max(ranked)["b"]


def labelled_value(c: Column, label: str) -> Column:
    """H6: the value after a label, up to the next label."""
    return found(F.upper(c), rf"{label}:\s*([^:]+?)(?=\s+\w+:|\s*\z)")


# Forms of the assessment, with description (score, description, or the other way round) and without.
_N = r"(?:0|1|2|3|4[abc]?|5|6)"
SCORED = (
    (rf"\bCategory\s*(?:number|#|no\.)?[:\s]*\(?({_N})\)?(?::\s*|\s+|,\s*|\s*-\s*|\s*/\s*)([^.]+)", 1, 2),
    (rf"\bCategory\s*(?:number|#|no\.)?[:\s]*\(?({_N})\)?\s+\(([^)]+)\)", 1, 2),
    (rf"\bCategory\s+({_N})\s*\(([^)]+)\)", 1, 2),
    (r"ACR\s+code:?\s+(\d+[a-z]?)\s+([^.]+)", 1, 2),
    (r"BI-?RADS:?\s+ASSESSMENT:\s*CODE:\s*(\d+[a-z]?)-([^.\s]+)", 1, 2),
    (r"BI-?RADS:?\s*Code\s*(\d+[a-z]?),\s*([^.\s]+)", 1, 2),
    (r"(?:Ultrasound|US)\s+BI-?RADS:\s*\(?(\d+[a-z]?)\)?\s+([^\s.]+)", 1, 2),
    (
        r"(?:BI-?RADS\s*(?:ASSESSMENT|Category|code|Final\s+Assessment)?|ASSESSMENT:\s*BI-?RADS|OVERALL\s*STUDY\s*BI-?RADS)(?:\s*CATEGORY)?:?\s*\(?(\d+[a-z]?)\)?(?::\s*|\s+|,\s*|\s*-\s*)([^.]+)",
        1,
        2,
    ),
    (r"(?:IMPRESSION:|ASSESSMENT:)?\s*BI-?RADS\s*\(?(\d+[a-z]?)\)?\s*(?:-|,)\s*([^.]+)", 1, 2),
    (r"BI-?RADS:\s*([^(]+)\s*\((\d+[a-z]?)\)", 2, 1),
    (r"Final\s+Assessment:\s*\(?(\d+[a-z]?)\)?\s*(?:-|,)?\s*([^.]+)", 1, 2),
    (r"BI-?RADS(?:®\s*ATLAS)?\s*category\s*\(?overall\)?:\s*\(?(\d+[a-z]?)\)?\s+([^.]+)", 1, 2),
    (r"BI-?RADS®\s*Category:\s*(\d+[a-z]?)\s*-\s*([^.]+)", 1, 2),
)
PLAIN_SCORES = (
    r"(?:Ultrasound|US)\s+BI-?RADS:\s*\(?(\d+[a-z]?)\)?",
    r"BI-?RADS(?:\s*(?:Category|code))?(?::|:?\s+CATEGORY)?\s*\(?(\d+[a-z]?)\)?",
    r"OVERALL\s*STUDY\s*BI-?RADS:\s*\(?(\d+[a-z]?)\)?",
    r"BI-?RADS\s+Category\s+No\.\s*(\d+[a-z]?)",
    rf"\bCategory\s*(?:number|#|no\.)?[:\s]*\(?({_N})\)?",
    rf"\bCategory\s+({_N})\b",
)
END_WORDS = ("benign", "malignant", "malignancy", "suspicious", "negative", "positive", "cancer", "indeterminate", "incomplete")


def score_words(pattern: str) -> list[str]:
    """Words in capitals, with a colon where there must be one, that every text of a form of the score holds."""
    bare = "~".join(re.split(r"\\[bds](?:[*+?])?", pattern))
    if bare.startswith("(?:BI-?RADS"):
        return ["RADS"]
    bare = re.sub(r"\[[^\]]*\](?:[*+?])?", "~", bare.replace(r"\(", "~").replace(r"\)", "~"))
    while (less := re.sub(r"\([^()]*\)(?:[*+?])?", "~", bare)) != bare:
        bare = less
    return list(dict.fromkeys(re.findall("[A-Z]{2,}:?", re.sub(r".[*?]", "~", bare).upper())))


def score(c: Column) -> Column:
    """H7: the score alone; a form is searched for once, and only in texts that have its words."""

    def first(up: Column) -> Column:
        forms = [*((p, k) for p, k, _ in SCORED), *((p, 1) for p in PLAIN_SCORES)]
        return F.coalesce(*[F.when(holds(up, score_words(p)), found(c, f"(?i){p}", k)) for p, k in forms])

    return F.upper(bind(F.upper(c), first))


def ordinal_score(c: Column) -> Column:
    """H7: struct<score, description> by the first form that occurs; the description ends with its first key word."""
    end = rf"(?is)^(.*?\b(?:{'|'.join(END_WORDS)}))(?:\W.*|\z)"
    out = F.struct(F.lit(None).cast("string").alias("score"), F.lit(None).cast("string").alias("description"))
    # a word that every text of the form holds is looked for before the form is
    word = lambda p: F.upper(c).contains("CATEGORY" if p.startswith(r"\bCategory") else "ACR" if p.startswith("ACR") else "ASSESSMENT" if p.startswith("Final") else "RADS")
    for p in reversed(PLAIN_SCORES):
        out = F.when(word(p) & c.rlike(f"(?i){p}"), F.struct(F.upper(F.regexp_extract(c, f"(?i){p}", 1)).alias("score"), F.lit(None).cast("string").alias("description"))).otherwise(out)
    for p, score, text in reversed(SCORED):
        gate = word(p)
        p = f"(?i){p}"
        description = strip(F.regexp_extract(c, p, text))
        short = F.when(description.rlike(end), F.regexp_extract(description, end, 1)).otherwise(F.nullif(description, F.lit("")))
        out = F.when(gate & c.rlike(p), F.struct(F.upper(F.regexp_extract(c, p, score)).alias("score"), short.alias("description"))).otherwise(out)
    return out


# Tokens of a side by source, the description first.
SIDE_TOKENS = (
    (("RIGHT", "R BI", " RT", "RT "), ("LEFT", "L BI", " LT", "LT ")),
    (("RIGHT", "R BI"), ("LEFT", "L BI")),
    (("RIGHT", "R BI"), ("LEFT", "L BI")),
)


def laterality(*columns: Column, tokens=SIDE_TOKENS) -> Column:
    """H8: BILATERAL, RIGHT or LEFT by the first column that has a token."""

    def of(c: Column, right, left) -> Column:
        has = lambda words: any_of(F.upper(c), [re.escape(w) for w in words])
        return F.when(has(("BILAT", "BOTH")), "BILATERAL").when(has(right), "RIGHT").when(has(left), "LEFT")

    return F.coalesce(*[of(c, *t) for c, t in zip(columns, tokens)])


def lesion_laterality(c: Column) -> Column:
    """H8: side of one part; both or none is UNKNOWN."""
    text = F.replace(F.upper(F.coalesce(c, F.lit(""))), F.lit(" "), F.lit(""))
    right, left = text.contains("RIGHT"), text.contains("LEFT")
    return F.when(right & ~left, "RIGHT").when(left & ~right, "LEFT").otherwise("UNKNOWN")


def biopsy_flags(*columns: Column) -> Column:
    """H9: struct<any, us>; an ultrasound biopsy needs both words in the same column."""
    biopsy = lambda c: F.coalesce(F.upper(c).rlike("BIOPSY|BX|ASP|SPECIMEN"), F.lit(False))
    us = lambda c: biopsy(c) & F.coalesce(F.upper(c).rlike(r"US|ULTRASOUND|\bUL\b"), F.lit(False))
    some = lambda f: F.array_contains(F.array(*map(f, columns)), True)
    return F.struct(some(biopsy).alias("any"), some(us).alias("us"))


GUIDANCE = {"ULTRASOUND": "US", "US": "US", "MAMMO": "MAMMO", "TOMO": "TOMO", "STEREOTACTIC": "STEREOTACTIC", "STEREO": "STEREOTACTIC", "MR": "MR"}


def guidance(c: Column, is_biopsy: Column, codes: dict[str, str] = GUIDANCE) -> Column:
    """The code of the nearest known word before ' GUID'; OTHER for a biopsy without one."""
    words = F.split(F.trim(F.substring_index(F.upper(c), " GUID", 1)), r"\s+")
    pairs = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    known = F.filter(F.transform(words, lambda w: F.try_element_at(pairs, w)), lambda x: x.isNotNull())
    return F.when(F.upper(c).contains(" GUID"), F.coalesce(F.try_element_at(known, F.lit(-1)), F.when(is_biopsy, F.lit("OTHER"))))


def tail_from_first(c: Column, terms: Sequence[str] = ("ADDENDUM", "AMENDMENT", "APPENDED")) -> Column:
    """The text from the earliest of the terms on."""
    return F.when(any_of(F.upper(c), terms), strip(F.regexp_extract(c, rf"(?is)(?:{'|'.join(terms)}).*", 0)))


def yes_no_after(c: Column, label: str) -> Column:
    """T or F by the answer after a label."""
    answer = F.upper(F.regexp_extract(c, rf"(?i){label}\s*:[\s\W]*(YES|NO)\b", 1))
    return F.when(answer == "YES", "T").when(answer == "NO", "F")


# What ends a lettered part.
BOILERPLATE = ("COMMENT", "REPORT", "CLINICAL HISTORY", "CASE NUMBER")


def split_lettered_parts(df: DataFrame, column: str, part: str = "part") -> DataFrame:
    """A row for each lettered part ('A. text'), cut at boilerplate; a row without any part stays, with a null part."""
    text = F.upper(F.col(column))
    raw = F.regexp_extract_all(text, F.lit(r"(?s)(?:^|\n)([A-Z][.)]\s+[^\n]*+(?:\n(?![A-Z][.)]\s)[^\n]*+)*+)"), F.lit(1))
    cut = lambda p: strip(F.regexp_extract(p, rf"(?s)^[A-Z][.)]\s+(.*?)(?:{'|'.join(BOILERPLATE)}|\z)", 1))
    parts = F.filter(F.transform(raw, lambda p: F.struct(F.substring(p, 1, 1).alias("letter"), cut(p).alias("body"))), lambda p: p["body"] != "")
    return df.withColumn(part, F.explode_outer(F.transform(parts, lambda p: F.concat(p["letter"], F.lit(". "), p["body"]))))


def unnegated(term: str, negations: Sequence[tuple[str, int]], reach: int) -> str:
    """A pattern for a term without a negation (pattern, its least length) that begins in the ``reach`` characters before it.

    The negation is looked ahead for from each of these places, so its blanks may be as many as they like.
    """
    before = "".join(rf"(?<!(?={n})[\s\S]{{{size},{reach}}})" for n, size in negations)
    return f"(?={term}){before}(?:{term})"


# Pathology wording. Negations come with the least length of their match.
CATEGORY_NEGATIONS = (
    (r"NEGATIVE\s+FOR", 12),
    (r"NO\s+EVIDENCE\s+OF", 14),
    (r"FREE\s+OF", 7),
    (r"ABSENCE\s+OF", 10),
    (r"NOT\s+DIAGNOSTIC", 14),
    (r"\bNO\s", 3),
)
MALIGNANT = (
    r"INVASIVE\s+DUCTAL\s+CARCINOMA", r"DUCTAL\s+CARCINOMA\s+IN\s+SITU", r"\bDCIS\b", r"METASTATIC\s+CARCINOMA", r"INVASIVE\s+CARCINOMA", "CARCINOMA",
    r"\bMALIGNAN(?:T|CY)\b", r"\bTUMOR\s+CELLS\b", "METASTATIC", r"\bMELANOMA\b",
)
NEGATED = (
    r"NEGATIVE\s+FOR\s+(?:MALIGNAN[CT]|CARCINOMA|INVASIVE|DCIS|ATYPIA|TUMOR|NEOPLASM|METASTATIC)",
    r"NO\s+EVIDENCE\s+OF\s+(?:RESIDUAL\s+)?(?:MALIGNAN[CT]|CARCINOMA|INVASIVE|DCIS|TUMOR|NEOPLASM|ATYPIA)",
    r"ABSENCE\s+OF\s+(?:MALIGNAN[CT]|CARCINOMA|INVASIVE|DCIS|TUMOR|NEOPLASM)",
    r"FREE\s+OF\s+(?:MALIGNAN[CT]|CARCINOMA|INVASIVE|TUMOR|NEOPLASM)",
    r"NO\s+(?:MALIGNAN[CT]|CARCINOMA|INVASIVE|TUMOR|NEOPLASM)\s+SEEN",
    r"NEGATIVE\s+LYMPH",
    r"NO\s+MALIGNANCY\s+PRESENT",
    r"NO\s+RESIDUAL\s+(?:INVASIVE|CARCINOMA|DCIS|TUMOR|DISEASE|MALIGNAN[CT])",
    r"NO\s+LYMPH\s+NODE\s+TISSUE",
    r"WITHOUT\s+(?:HISTOLOGIC(?:AL)?\s+|SIGNIFICANT\s+)?ABNORMALITY",
    r"NO\s+HISTOLOGIC(?:AL)?\s+ABNORMALITY",
)
BENIGN = (
    r"\bBENIGN\b", "FIBROCYSTIC", "FIBROADENOMA", r"NORMAL\s+BREAST\s+TISSUE", r"INTRADUCTAL\s+PAPILLOMA", r"DUCT\s+ECTASIA", r"PERIDUCTAL\s+FIBROSIS",
    r"SCLEROSING\s+ADENOSIS", r"APOCRINE\s+METAPLASIA", r"USUAL\s+DUCTAL\s+HYPERPLASIA", r"ATYPICAL\s+DUCTAL\s+HYPERPLASIA", r"COLUMNAR\s+CELL\s+CHANGE",
    r"RADIAL\s+SCAR", "FIBROSIS", r"BREAST\s+IMPLANT", r"RUPTURED\s+IMPLANT", r"IMPLANT\s+CAPSULE", r"GROSS\s+ONLY\s+AS\s+DESCRIBED", r"FAT\s+NECROSIS",
    "UNREMARKABLE", "ESTROGEN", r"DYSTROPHIC\s+CALCIFICATIONS?", "NEGATIVE", "SCAR", "FIBROTIC ", r"BREAST\s+CAPSULE", r"FIBROMUSCULAR\s+TISSUE",
    r"FIBROADIPOSE\s+TISSUE", r"FIBROUS\s+TISSUE", r"BIOPSY\s+SITE\s+CHANGES?", "NEUROFIBROMA", r"\bNEVUS\b", "PSEUDOANGIOMATOUS", r"\bNODULAR\s+FASCIITIS\b",
    r"\bLCIS\b", r"LOBULAR\s+CARCINOMA\s+IN[\s\-]+SITU", r"ATYPICAL\s+LOBULAR\s+HYPERPLASIA", r"\bALH\b", r"LOBULAR\s+NEOPLASIA",
)


def path_category(c: Column) -> Column:
    """MALIGNANT if a malignant term stands without a negation in the 50 characters before it (lobular carcinoma in
    situ is none), else BENIGN by a negation or a benign term, else UNKNOWN."""
    situ = r"(?![\s,\-]*IN[\s\-]+SITU)"
    # the word is looked for in the 50 characters before the term, as the negations are, and only where the term stands
    hits = [f"(?={m})" + unnegated(rf"(?:(?<!\bLOBULAR\s{{0,43}})(?:{m})|(?:{m}){situ})", CATEGORY_NEGATIONS, 50) for m in MALIGNANT]
    judge = lambda t: F.when(some_of(t, MALIGNANT, hits), "MALIGNANT").when(some_of(t, BENIGN + NEGATED), "BENIGN").otherwise("UNKNOWN")
    return bind(F.upper(F.coalesce(c, F.lit(""))), judge)


# Negations, cancer types in order of precedence, and benign wording.
TYPE_NEGATIONS = (*CATEGORY_NEGATIONS[:4], (r"\bNO\s", 3), ("WITHOUT", 7), (r"RULED\s+OUT", 9), ("EXCLUDE", 7))
CANCER_TYPES = (
    (r"INVASIVE\s+(?:GRADE\s+\d+.*?)?DUCTAL\s+CARCINOMA", "INVASIVE DUCTAL CARCINOMA"),
    (r"DUCTAL\s+CARCINOMA\s+IN\s+SITU", "DUCTAL CARCINOMA IN SITU"),
    (r"LOBULAR\s+CARCINOMA\s+IN\s+SITU", "LOBULAR CARCINOMA IN SITU"),
    (r"INVASIVE\s+MAMMARY\s+CARCINOMA", "INVASIVE MAMMARY CARCINOMA"),
    (r"\bDCIS\b", "DUCTAL CARCINOMA IN SITU"),
    (r"\bLCIS\b", "LOBULAR CARCINOMA IN SITU"),
    (r"ADENOID\s+CYSTIC\s+CARCINOMA", "ADENOID CYSTIC CARCINOMA"),
    ("ADENOCARCINOMA", "ADENOCARCINOMA"),
    (r"INFLAMMATORY\s+CARCINOMA", "INFLAMMATORY CARCINOMA"),
    (r"MUCINOUS\s+CARCINOMA", "MUCINOUS CARCINOMA"),
    (r"TUBULAR\s+CARCINOMA", "TUBULAR CARCINOMA"),
    (r"MEDULLARY\s+CARCINOMA", "MEDULLARY CARCINOMA"),
    (r"PAPILLARY\s+CARCINOMA", "PAPILLARY CARCINOMA"),
    (r"METASTATIC\s+CARCINOMA", "METASTATIC CARCINOMA"),
    (r"METASTATIC\s+ADENOCARCINOMA", "METASTATIC ADENOCARCINOMA"),
    ("MICROMETASTASIS", "MICROMETASTASIS"),
    (r"ISOLATED\s+TUMOR\s+CELLS?", "ISOLATED TUMOR CELLS"),
    (r"MULTIFOCAL\s+ATYPICAL\s+DUCTAL\s+HYPERPLASIA", "MULTIFOCAL ATYPICAL DUCTAL HYPERPLASIA"),
    (r"ATYPICAL\s+DUCTAL\s+HYPERPLASIA", "ATYPICAL DUCTAL HYPERPLASIA"),
    (r"ATYPICAL\s+LOBULAR\s+HYPERPLASIA", "ATYPICAL LOBULAR HYPERPLASIA"),
    (r"\bADH\b", "ATYPICAL DUCTAL HYPERPLASIA"),
    (r"\bALH\b", "ATYPICAL LOBULAR HYPERPLASIA"),
    (r"(?:INVASIVE|INFILTRATIVE)\s+LOBULAR\s+CARCINOMA", "INVASIVE LOBULAR CARCINOMA"),
    (r"(?:INVASIVE|INFILTRATIVE)\s+CARCINOMA", "INVASIVE CARCINOMA"),
    (r"\bCARCINOMA\b", "CARCINOMA"),
    ("SARCOMA", "OTHER"),
    ("LYMPHOMA", "OTHER"),
    ("CARCINOSARCOMA", "OTHER"),
    ("MELANOMA", "OTHER"),
    (r"SQUAMOUS\s+CELL\s+CARCINOMA", "OTHER"),
)
TYPE_BENIGN = (
    r"NEGATIVE\s+FOR\s+(?:MALIGNAN[CT]|CARCINOMA|INVASIVE|DCIS|TUMOR|METASTATIC|METASTASIS)",
    r"NO\s+EVIDENCE\s+OF\s+(?:MALIGNAN[CT]|CARCINOMA|INVASIVE|DCIS|TUMOR|NEOPLASM|ATYPIA)",
    r"ABSENCE\s+OF\s+(?:MALIGNAN[CT]|CARCINOMA|INVASIVE|DCIS|TUMOR|NEOPLASM)",
    r"\bBENIGN\b", "FIBROCYSTIC", "FIBROADENOMA", r"NORMAL\s+BREAST\s+TISSUE", r"SCLEROSING\s+ADENOSIS", r"USUAL\s+DUCTAL\s+HYPERPLASIA", r"\bPASH\b",
    r"NEGATIVE\s+MARGIN", r"NO\s+SIGNIFICANT\s+HISTOPATHOLOGY",
)


def first_unnegated(c: Column, rules: Sequence[tuple[str, str]] = CANCER_TYPES, benign: Sequence[str] = TYPE_BENIGN, reach: int = 100) -> Column:
    """The first rule of the list with a term that is not negated in the ``reach`` characters before it."""

    def judge(text: Column) -> Column:
        out = F.when(some_of(text, benign), "BENIGN").otherwise("UNKNOWN")
        for pattern, name in reversed(rules):
            out = F.when(some_of(text, [pattern], [unnegated(pattern, TYPE_NEGATIONS, reach)]), name).otherwise(out)
        return out

    return bind(F.upper(F.coalesce(c, F.lit(""))), judge)


# The finding lexicon, its negations and what ends a negation's scope.
LEXICON = {
    "margin": (
        (r"\bcircumscribed\b", "circumscribed"), (r"\b(?:macro|macrolobulated)\b", "macrolobulated"), (r"\b(?:micro|microlobulated)\b", "microlobulated"),
        (r"\bindistinct\b", "indistinct"), (r"\bangular\b", "angular"), (r"\bspiculat(?:ed|ion)\b", "spiculated"),
    ),
    "shape": ((r"\b(?:oval|ovoid)\b", "oval"), (r"\bround\b", "round"), (r"\birregular\b", "irregular")),
    "orientation": ((r"\bparallel\b", "parallel"), (r"\bnot\s+parallel\b", "not parallel"), (r"\bantiparallel\b", "not parallel")),
    "echo": (
        (r"\banecho(?:ic|genicity)\b", "anechoic"), (r"\bhypoecho(?:ic|genicity)\b", "hypoechoic"), (r"\bisoecho(?:ic|genicity)\b", "isoechoic"),
        (r"\bhyperecho(?:ic|genicity)\b", "hyperechoic"), (r"\bcomplex\b", "complex"), (r"\bheterogene?ous\b", "heterogeneous"),
    ),
    "posterior": ((r"\benhancement\b", "enhancement"), (r"\bshadowing\b", "shadowing"), (r"\bno\s+posterior\s+(?:acoustic\s+)?features?\b", "no posterior features")),
    "boundary": ((r"\babrupt\s+interface\b", "abrupt interface"), (r"\bechogenic\s+halo\b", "echogenic halo"), (r"\barchitectural\s+distortion\b", "architectural distortion")),
}
PRE_NEGATIONS = (
    r"\bno\b", r"\bwithout\b", r"\babsent\b", r"\bdenies\b", r"\bnot\s+(?:seen|present|identified|appreciated|visible)\b", r"\bfree\s+of\b", r"\backs?\b", r"\bnegative\s+for\b",
    r"\bno\s+evidence\s+of\b", r"\bno\s+longer\s+(?:seen|visible|present|identified)\b",
)
POST_NEGATIONS = (
    r"\b(?:is|are|was|were)\s+no\s+longer\s+(?:seen|visible|present|identified|appreciated)\b", r"\b(?:is|are|was|were)\s+not\s+(?:seen|visible|present|identified|appreciated)\b",
    r"\b(?:has|have)\s+resolved\b", r"\b(?:is|are)\s+absent\b", r"\b(?:was|were)\s+ruled\s+out\b",
)
TERMINATORS = (r"\.", r"\bbut\b", r"\bhowever\b", r"\balthough\b", r"\bshowing\b", r"\bdemonstrat(?:es|ing)\b", r"\bpresent\b")


def either(patterns: Sequence[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def spans(text: Column, pattern: str) -> Column:
    """array<struct<begins, ends>>: where a pattern's matches lie, in code points; the end is exclusive."""
    # what lies between the matches tells their places
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begins:int,ends:int>>").alias("found"))

    def after(x: Column, p: Column) -> Column:
        begins = x["at"] + F.length(p["gap"])
        ends = begins + F.coalesce(F.length(p["hit"]), F.lit(0))
        hit = F.struct(begins.alias("begins"), ends.alias("ends"))
        return F.struct(ends.alias("at"), F.when(p["hit"].isNotNull(), F.array_append(x["found"], hit)).otherwise(x["found"]).alias("found"))

    return F.aggregate(pieces, start, after, lambda x: x["found"])


def lexicon_decisions(c: Column, lexicon=LEXICON, reach: int = 150) -> Column:
    """array<struct<feature, value, negated, begins, ends>> of all places of all terms, in the order of the lexicon; the
    places are in the text as it is.

    A place is negated if a negation lies in the ``reach`` characters before it, behind the last terminator there (so the
    'present' of 'not present' ends a scope and its 'not' is out of reach), or in as many characters after it.
    """
    last = rf"^[\s\S]*(?:{either(TERMINATORS)})"

    def negated(text: Column, p: Column) -> Column:
        first = F.greatest(p["begins"] - reach, F.lit(0))
        before, behind = F.substring(text, first + 1, p["begins"] - first), F.substring(text, p["ends"] + 1, F.lit(reach))
        # plain words first: most places have none of a negation
        ahead = bind(before, lambda t: could(t, PRE_NEGATIONS) & F.regexp_replace(t, last, "").rlike(either(PRE_NEGATIONS)))
        return ahead | bind(behind, lambda t: could(t, POST_NEGATIONS) & t.rlike(either(POST_NEGATIONS)))

    def places(text: Column, feature: str, pattern: str, value: str) -> Column:
        decide = lambda p: F.struct(F.lit(feature).alias("feature"), F.lit(value).alias("value"), negated(text, p).alias("negated"), p["begins"].alias("begins"), p["ends"].alias("ends"))
        return F.when(some_of(text, [pattern]), F.transform(spans(text, pattern), decide))

    terms = [(f, p, v) for f, own in lexicon.items() for p, v in own]
    every = bind(F.lower(c), lambda text: F.flatten(F.array_compact(F.array(*[places(text, *t) for t in terms]))))
    return bind(every, lambda x: F.when(F.size(x) > 0, x))


def lexicon_features(c: Column, lexicon=LEXICON, reach: int = 150) -> Column:
    """Struct of each feature's values (sorted, joined) that some place has without negation; margins and echo patterns
    are consolidated."""

    def values(x: Column, f: str) -> Column:
        own = F.array_sort(F.array_distinct(F.transform(F.filter(x, lambda d: (d["feature"] == f) & ~d["negated"]), lambda d: d["value"])))
        return bind(F.array_join(bind(own, lambda v: consolidate(f, v)), ", "), lambda t: F.when(t != "", t))

    return bind(lexicon_decisions(c, lexicon, reach), lambda x: F.struct(*[values(x, f).alias(f) for f in lexicon]))


def consolidate(feature: str, values: Column) -> Column:
    """Other margins displace 'circumscribed'; complex before heterogeneous before one echo pattern; several are heterogeneous."""
    only = lambda v: F.array(F.lit(v))
    if feature == "margin":
        return F.when(F.size(values) > 1, F.array_remove(values, "circumscribed")).otherwise(values)
    if feature == "echo":
        return F.when(F.array_contains(values, "complex"), only("complex")).when(F.size(values) > 1, only("heterogeneous")).otherwise(values)
    return values


def isolate_section(c: Column, keep: str = "ULTRASOUND|SONO", other: str = "MAMMO", exempt: Sequence[str] = ("DUE", "CORRELAT")) -> Column:
    """Of a text about two examinations the part from ``keep`` on; null if it is about the other one only. Mentions
    of the other one in a sentence with an exempt word before them do not count."""
    up = F.upper(c)
    real = rf"(?:^|\.)(?:(?!{'|'.join(exempt)})[^.])*?\b{other}"
    has_keep = up.rlike(rf"\b(?:{keep})\b")
    part = strip(F.regexp_extract(c, rf"(?is)\b(?:{keep})\b.*", 0))
    return F.when(~up.rlike(rf"\b{other}"), c).when(has_keep, part).when(~up.rlike(real), c)


# What is taken out of a report, step by step in order.
_MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec|January|February|March|April|May|June|July|August|September|October|November|December"
SCRUB = (
    (r"(?s)\b[A-Z][a-z]+\s+[A-Z]\..*", "[NAME AND SUBSEQUENT TEXT REMOVED]"),
    (r"(?is)Dictated (?:on|by).*", "[DICTATION SECTION REMOVED]"),
    (r"(?is)Interpreted by.*", "[INTERPRETATION SECTION REMOVED]"),
    (r"(?is)Transcribed by.*", "[TRANSCRIPTION SECTION REMOVED]"),
    (r"(?is)Signed by.*", "[SIGNATURE SECTION REMOVED]"),
    (r"(?is)Assisted by.*", "[ASSISTANT INFO REMOVED]"),
    (r"(?is)Electronically signed by.*", "[SIGNATURE SECTION REMOVED]"),
    (r"(?is)electronically signed.*", "[SIGNATURE SECTION REMOVED]"),
    (r"(?is)Imaging Technologist:.*", "[TECHNOLOGIST INFO REMOVED]"),
    (r".{10}M\.D\.", "[NAME REMOVED]"),
    (r".{10}M\.\s?D\.", "[NAME REMOVED]"),
    (r"\b[A-Z][a-z]+\s+[A-Z]\.\s+[A-Z][a-z]+\s+(?:M\.D\.|MD|M\. D\.|D\.O\.|DO|Ph\.D\.|PhD)\b", "[NAME REMOVED]"),
    (r"\b[A-Z][a-z]+\s+[A-Z][a-z]+\s+(?:M\.D\.|MD|M\. D\.|D\.O\.|DO|Ph\.D\.|PhD)\b", "[NAME REMOVED]"),
    (r"\b[A-Z][a-z]+,\s+[A-Z][a-z]+\s+(?:M\.D\.|MD|M\. D\.|D\.O\.|DO|Ph\.D\.|PhD)\b", "[NAME REMOVED]"),
    (r"\b[A-Z]\.\s?[A-Z]\.\s+[A-Z][a-z]+,?\s+(?:MD|DO|PA|NP|RN|DDS|DMD|PhD|MBBS|M\.D\.|D\.O\.)\b", "[NAME REMOVED]"),
    (r"\b[A-Z][a-z]+\s+[A-Z][a-z]+,?\s+(?:MD|DO|PA|NP|RN|DDS|DMD|PhD|MBBS|M\.D\.|D\.O\.)\b", "[NAME REMOVED]"),
    (r"\bDr\.\s+[A-Z][A-Za-z.\s]+\b", "[NAME REMOVED]"),
    (r"\b[A-Z]\.\s+[A-Z][a-z]+,?\s+(?:MD|DO|PA|NP|RN|DDS|DMD|PhD|MBBS|M\.D\.|D\.O\.)\b", "[NAME REMOVED]"),
    (r"\b\d{1,2}:\d{2}:\d{2}\b", "[TIME REMOVED]"),
    (rf"(?i)\b(?:{_MONTHS})\s+\d{{1,2}}\b", "[DATE REMOVED]"),
    (r"\b\d{1,2}/\d{1,2}/\d{2,4}\b", "[DATE REMOVED]"),
    (r"\b\d{4}\b", "[YEAR REMOVED]"),
)


def scrub_text(c: Column, steps=SCRUB) -> Column:
    """Names, signatures, times, dates and years out of a report."""
    for pattern, new in steps:
        c = F.regexp_replace(c, pattern, new)
    return c


# Caption words by attribute, in order of precedence; cut-off letters come from character recognition.
CAPTION_WORDS = {
    "area": {"axilla": ("ax",), "breast": ("breast",), "supraclavicular": ("superclavicular", "supraclavicular"), "subclavicular": ("subclavicular", "subclavcular")},
    "laterality": {"left": ("lt", "left", "eft", "ft"), "right": ("rt", "right", "ight", "ght", "ht")},
    "orientation": {"long": ("long", "lon", "ong"), "trans": ("trans", "tran", "tra", "ans"), "anti-radial": ("anti-rad", "anti-radial"), "radial": ("radial",), "oblique": ("oblique",)},
}
# Quadrants of a caption, in order of precedence.
QUADRANTS = ("uoq", "uiq", "liq", "loq")


def caption_attributes(c: Column, words=CAPTION_WORDS) -> Column:
    """struct<area, laterality, orientation, clock_pos, nipple_dist> of an image's caption."""

    def attribute(plain: Column, levels: dict) -> Column:
        out = F.lit("unknown")
        for name, tokens in reversed(levels.items()):
            has = plain.contains(tokens[0])
            for t in tokens[1:]:
                has = has | plain.contains(t)
            out = F.when(has, name).otherwise(out)
        return out

    # blanks and dollar signs are mended once for all words
    plain = F.translate(F.lower(c), "$ ", "s")
    named = bind(plain, lambda t: F.struct(*[attribute(t, levels).alias(name) for name, levels in words.items()]))

    clock = F.translate(F.regexp_replace(F.regexp_extract(c, r"\d{1,2}\s*[:.*]\s*\d{1,2}", 0), r"\s", ""), ".*", "::")
    quadrant = F.lit("unknown")
    for q in reversed(QUADRANTS):
        quadrant = F.when(c.contains(q), q).otherwise(quadrant)
    cm = F.regexp_extract(F.replace(F.lower(c), F.lit("scm"), F.lit("5cm")), r"(\d+)(?:-(\d+))?\s*cm", 0)
    # no number is null before the cast: a try_cast of an empty text throws and catches an exception for each row
    low, high = found(cm, r"^(\d+)").try_cast("int"), found(cm, r"-(\d+)").try_cast("int")
    distance = F.when(high.isNull(), low).otherwise(F.bround((low + high) / 2).cast("int"))
    return F.struct(
        *[named[name].alias(name) for name in words],
        F.when(clock != "", clock).otherwise(quadrant).alias("clock_pos"),
        F.when((distance > 0) & (distance <= 25), distance).alias("nipple_dist"),
    )


# Lesion wording by class, the first class wins.
LESION_TYPES = (
    ("Node", (r"\blymph\s*node\b", r"\bintramammary\s+(lymph\s+)?node\b", r"\baxillary\s+(lymph\s+)?node\b")),
    (
        "Lesion",
        (
            r"\bmass\b", r"\blesion\b", r"\bcomplex\b", r"\bcomplicated\b", r"\bbilobed\b", r"\bcalcified\b", r"\bsolid\b", r"\bnodule\b", r"\btumou?r\b", r"\bcancer\b", r"\bcarcinoma\b",
            r"\bmalignancy\b", r"\bseptate[ds]?\b", r"\bseptation\b", r"\bblood\s*flow\b", r"\bvascularity\b", r"\bvascular\b", r"\bshadowing\b", r"\bsebaceous\b", r"\badenoma\b",
            r"\bfibroadenoma\b", r"\bpapilloma\b", r"\bbiopsy[- ]?proven\b", r"\bclip\b", r"\bintraductal\b", r"\bless\s+defined\b", r"\bill[- ]?defined\b", r"\birregular\s+margin\b",
            r"\bpartially\s+circumscribed\b",
        ),
    ),
    ("Simple cyst", (r"cysts?\b", r"\bcystic\b")),
)


def first_rule_label(c: Column, rules=LESION_TYPES, other: str = "Other") -> Column:
    """The first class with a pattern that occurs; null for no text."""
    out = F.lit(other)
    for name, patterns in reversed(rules):
        out = F.when(any_of(F.lower(c), patterns), name).otherwise(out)
    return F.when(F.trim(c) != "", out)


def to_cm(c: Column) -> Column:
    """A length in centimetres; without a unit it is one."""
    text = F.lower(F.trim(c))
    value = F.regexp_extract(text, r"^([\d.]+)\s*(?:cm|mm)?", 1).try_cast("double")
    return F.when(text.rlike(r"^[\d.]+\s*mm"), value / 10).otherwise(value)


def clock_hour(c: Column) -> Column:
    """The hour 1 to 12 of a clock position."""
    hour = F.regexp_extract(F.trim(c), r"^(\d+)", 1).try_cast("int")
    return F.when(hour.between(1, 12), hour).when(hour == 0, 12)


def clock_decimal(c: Column) -> Column:
    """A clock position as decimal hours."""
    text = F.trim(F.replace(F.lower(F.trim(c)), F.lit("o'clock"), F.lit("")))
    hours, minutes = F.regexp_extract(text, r"^(\d+):(\d+)$", 1).try_cast("int"), F.regexp_extract(text, r"^(\d+):(\d+)$", 2).try_cast("int")
    return F.when(text.contains(":"), hours + minutes / 60).otherwise(text.try_cast("double"))


def dicom_time(*tags: Column) -> Column:
    """The first tag that is a time HHMMSS[.F...], as HH:MM:SS[.fff]."""

    def of(c: Column) -> Column:
        t = F.trim(c)
        clock = F.concat_ws(":", F.substring(t, 1, 2), F.substring(t, 3, 2), F.substring(t, 5, 2))
        fraction = F.regexp_extract(t, r"\.(.+)$", 1)
        full = F.when(fraction != "", F.concat(clock, F.lit("."), F.rpad(F.substring(fraction, 1, 3), 3, "0"))).otherwise(clock)
        return F.when(t.rlike(r"^\d{6}[^.]*(?:\..*)?$"), full)

    return F.coalesce(*map(of, tags))


REPLY = "array<struct<direction:string,distance:string,size:string,type:string>>"


def parse_reply(c: Column) -> Column:
    """struct<label, n, error> of a reply that holds a JSON list, in a code fence or not."""
    bare = F.trim(F.regexp_replace(c, r"```(?:json)?\n?", ""))
    items = F.from_json(bare, REPLY, {"mode": "PERMISSIVE"})
    good = bare.rlike(r"(?s)^\[.*\]$") & items.isNotNull() & ~F.exists(items, lambda x: x.isNull() | (x["direction"].isNull() & x["type"].isNull()))
    label = F.array_join(F.transform(items, lambda x: F.concat(F.lit("["), F.concat_ws(", ", x["direction"], x["distance"], x["size"], x["type"]), F.lit("]"))), ", ")
    return F.struct(F.when(good, label).otherwise("").alias("label"), F.when(good, F.size(items)).otherwise(0).alias("n"), F.when(~F.coalesce(good, F.lit(False)), "unreadable").alias("error"))


def path_part(c: Column, i: int) -> Column:
    """A part of a path, counted from 1 or from the end."""
    return F.try_element_at(F.split(c, "/"), F.lit(i))


def stem(c: Column) -> Column:
    return F.regexp_replace(path_part(c, -1), r"\.[^.]*$", "")


def map_codes(c: Column, words: dict[str, str], other: str | None = None, missing: str | None = None) -> Column:
    """The code of the first key word that the text has (any case)."""
    out = F.when(c.isNull(), F.lit(missing))
    for word, code in words.items():
        out = out.when(F.upper(c).contains(word.upper()), F.lit(code))
    return out.otherwise(F.lit(other))


def norm_side(c: Column) -> Column:
    v = F.upper(F.trim(c))
    return F.when(v.isin("LEFT", "L"), "LEFT").when(v.isin("RIGHT", "R"), "RIGHT").when(v.isin("BILATERAL", "BOTH"), "BILATERAL").when(~v.isin("NOT_SPECIFIED", "UNKNOWN", "NAN", ""), v)


def side_match(exam: Column, path: Column) -> Column:
    """How the side of an exam and of a finding agree."""
    u, p = norm_side(exam), norm_side(path)
    return (
        F.when(p.isNull() & u.isNull(), "UNKNOWN_BOTH")
        .when(p.isNull(), "UNKNOWN_PATH")
        .when(u == "BILATERAL", "BILATERAL_US")
        .when(u == p, "EXACT")
        .when(u.isNull(), "UNKNOWN_US")
        .otherwise("MISMATCH")
    )


def strip_evidence_rank(c: Column) -> Column:
    """BENIGN2 is BENIGN."""
    return F.regexp_replace(c, r"([A-Z]+)\d+", "$1")
