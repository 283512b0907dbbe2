"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are reduced to lower-case letters with single spaces between runs of letters; n-grams of 1 to 4 characters are
hashed into ``BUCKETS`` counters. Training counts are summed by Spark (each task sends sums, not rows); the matrix of
log probabilities, languages x BUCKETS numbers, is broadcast. Scoring gathers the columns of a batch's n-grams and sums
them document by document in numpy, in slices of bounded size, so that a text may have any length.

Training reads at most about ``MAX_TRAIN_DOCS`` documents of each language (the documented bound of the sample); a
language with fewer documents gives all of them. The model, at most ``MAX_LANGS`` x BUCKETS numbers, and the counts of
documents of each label have that bound; a label column of more values is refused. Only text and label are learned from, and only the text is scored.

Nulls and edges: a null text or one without letters is ``und`` with score 0; rows with a null label or null text teach
nothing; without any training row every document is ``und``; ties go to the first language in alphabetical order.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, map_arrow, map_batches, numbered, renamed

SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 16
MAX_TRAIN_DOCS = 20_000
MAX_LANGS = 256
SLICE = 1 << 18
EVIDENCE = 64
MIN_SCORE = 0.7
UNKNOWN = "und"
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a space if it is no letter (first plane; beyond it letters stand for themselves)."""
    table = np.full(0x11000, 0x20, np.uint32)
    for c in range(0x11000):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _mapped(text: str) -> np.ndarray:
    """The lower-case letter or a space for each code point."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _letters()
    x = table[np.minimum(raw, len(table) - 1)]
    if (far := raw >= len(table)).any():
        x[far] = [p if unicodedata.category(chr(p))[0] == "L" else 0x20 for p in raw[far].tolist()]
    return x


def _points(text: str) -> Iterator[np.ndarray]:
    """Letters with single spaces around and between their runs, for every SLICE characters; nothing if there is no letter."""
    space, begun = np.array([0x20], np.uint32), False
    after_space = True
    for a in range(0, len(text), SLICE):
        x = _mapped(text[a : a + SLICE])
        blank = x == 0x20
        kept = x[~(blank & np.concatenate(([after_space], blank[:-1])))]
        after_space = bool(blank[-1])
        if len(kept):
            yield kept if begun else np.concatenate((space, kept))
            begun = True
    if begun:
        yield space


def _hashes(points: np.ndarray, sizes: tuple[int, ...], buckets: int) -> np.ndarray:
    """One bucket for each n-gram; row n has those of the n-th size, -1 where the text has ended."""
    n = len(points)
    out = np.full((len(sizes), n), -1, np.int32)
    code = points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(n, np.uint64)
    for k in range(1, max(sizes) + 1):
        if n < k:
            break
        h = (h[: n - k + 1] * np.uint64(0xD6E8FEB86659FD93)) ^ (code[k - 1 :] + np.uint64(k))
        if k in sizes:
            out[sizes.index(k), : n - k + 1] = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) % np.uint64(buckets)
    return out


def _slices(texts: list[str | None], sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code points, document of each) in slices. A document that goes on in a further part brings its last points along,
    marked by the complement of its number, so that its n-grams are those of the whole text."""
    held: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    size, reach = 0, max(sizes) - 1
    for i, text in enumerate(texts):
        tail = np.zeros(0, np.uint32)
        for part in _points(text or ""):
            if not held and len(tail):  # the slice before has what these follow
                held.append(tail)
                owners.append(np.full(len(tail), ~i, np.int32))
            held.append(part)
            owners.append(np.full(len(part), i, np.int32))
            size += len(part)
            tail = np.concatenate((tail, part))[-reach:] if reach else tail
            if size >= SLICE:
                yield np.concatenate(held), np.concatenate(owners)
                held, owners, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owners)


def _grams(points: np.ndarray, owner: np.ndarray, sizes: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, their documents), size by size; n-grams never cross from one document into the next, and one that ends in
    points brought along was counted before."""
    of = np.where(owner < 0, ~owner, owner)
    for size, row in zip(sizes, _hashes(points, sizes, buckets)):
        end = len(owner) - size + 1
        if end <= 0:
            continue
        whole = of[:end] == owner[size - 1 :]
        yield row[:end][whole], of[:end][whole]


def _held_out(ident: Column) -> Column:
    """crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    key_col: str = "doc_id",
    sizes: tuple[int, ...] = SIZES,
    buckets: int = BUCKETS,
    max_docs: int = MAX_TRAIN_DOCS,
    smoothing: float = 0.5,
) -> tuple[list[str], np.ndarray]:
    """(languages in alphabetical order, log probabilities [buckets, languages])."""
    rows = labelled.select(
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.xxhash64(F.col(f"`{key_col}`")).alias("key"),
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    # one row for each language, at most MAX_LANGS of them
    per_lang = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(per_lang) > MAX_LANGS:
        raise ValueError(f"{lang_col} has more than {MAX_LANGS} values: is it a language label?")
    share = F.lit(1.0)
    for lang, n in per_lang.items():
        if n > max_docs:
            share = F.when(F.col("lang") == lang, F.lit(max_docs / n)).otherwise(share)
    sample = rows.where((F.col("key") / F.lit(2.0**64) + 0.5) <= share)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs], np.int64)
            total = np.zeros(len(names) * buckets, np.int64)
            for points, owner in _slices(texts, sizes):
                for bucket, doc in _grams(points, owner, sizes, buckets):
                    total += np.bincount(number[doc] * buckets + bucket, minlength=len(total))
            for k, name in enumerate(names):
                part = total[k * buckets : (k + 1) * buckets]
                sums[name] = sums[name] + part if name in sums else part
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    counted = (
        map_arrow(sample.select("text", "lang"), count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang", F.shiftright("bucket", 10).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("cells"))
    )
    counts: dict[str, np.ndarray] = {}
    for lang, _, cells in counted.toLocalIterator():
        row = counts.setdefault(lang, np.zeros(buckets))
        np.add.at(row, [c[0] for c in cells], [c[1] for c in cells])
    langs = sorted(counts)
    if not langs:
        return [], np.zeros((buckets, 0), np.float32)
    table = np.stack([counts[x] for x in langs], axis=1) + smoothing
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", sizes: tuple[int, ...] = SIZES, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred and score, the tempered probability of that language (equal priors; no posterior).

    Neighbouring n-grams are far from independent, and the plain posterior of any long text is 1. The evidence of a text
    therefore counts as that of ``EVIDENCE`` n-grams at most: a text of mixed or unknown language keeps a low score,
    whatever its length. The language is the same either way.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        langs, table = shared.value
        for texts, _ in batches:
            total = np.zeros((len(texts), max(1, len(langs))))
            seen, grams = np.zeros(len(texts), bool), np.zeros(len(texts))
            for points, owner in _slices(texts, sizes):
                for bucket, doc in _grams(points, owner, sizes, len(table)) if langs else ():
                    if len(doc):
                        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
                        total[doc[first]] += np.add.reduceat(table[bucket], first, axis=0, dtype=np.float64)
                        grams[doc[first]] += np.diff(np.append(first, len(doc)))
                seen[owner[owner >= 0]] = True
            best = total.argmax(axis=1)
            weight = np.minimum(1.0, EVIDENCE / np.maximum(grams, 1.0))[:, None]
            chance = np.exp((total - total.max(axis=1, keepdims=True)) * weight)
            chance /= chance.sum(axis=1, keepdims=True)
            seen &= bool(langs)
            names = [langs[k] if s else UNKNOWN for k, s in zip(best.tolist(), seen.tolist())]
            scores = np.where(seen, chance[np.arange(len(texts)), best], 0.0)
            yield [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return map_batches(docs, text_col, run, RESULT, keep)


def fit_held_in(docs: DataFrame, id_col: str = "doc_id", **options) -> tuple[list[str], np.ndarray]:
    """Train on the documents that are not held out."""
    return train(docs.where(~_held_out(F.col(f"`{id_col}`")) & F.col(f"`{id_col}`").isNotNull()), key_col=id_col, **options)


def drop_unidentified(docs: DataFrame, min_score: float = MIN_SCORE, text_col: str = "text") -> DataFrame:
    """The documents whose language is known with at least ``min_score``, with the columns they had."""
    plain, names = numbered(docs)
    judged = predict(plain, fit_held_in(docs, text_col=text_col), names[text_col])
    return renamed(judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)), names)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = predict(docs.select("doc_id", "text"), fit_held_in(docs), keep=["doc_id"])
    return found.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
