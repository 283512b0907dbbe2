"""Filters, exclusion reasons and projections."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, Column]]


def holds(condition: Column) -> Column:
    """A condition that a null leaves unmet."""
    return F.coalesce(condition, F.lit(False))


def contains_ci(c: Column, part: str) -> Column:
    """Text contains ``part`` in any case; null stays null."""
    return F.lower(c).contains(part.lower())


def drop_containing(df: DataFrame, column: str, token: str) -> DataFrame:
    """Rows whose text has the token go, rows without text stay."""
    return df.where(~F.upper(F.coalesce(F.col(column), F.lit(""))).contains(token.upper()))


def null_or_not_in(c: Column, values: Sequence) -> Column:
    """P3."""
    return c.isNull() | ~c.isin(*values)


def first_reason(rules: Rules) -> Column:
    """The name of the first rule that holds, null if none does."""
    return F.coalesce(*[F.when(holds(cond), F.lit(name)) for name, cond in rules], F.lit(None).cast("string"))


def exclude_first(df: DataFrame, rules: Rules, column: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejected rows with their first failing rule); rules are tried in order, in one pass."""
    judged = df.withColumn(column, first_reason(rules))
    return judged.where(F.col(column).isNull()).drop(column), judged.where(F.col(column).isNotNull())


def exclusion_reasons(rules: Rules) -> Column:
    """P5: names of all rules that hold, joined by semicolons; null if none does."""
    return F.nullif(F.concat_ws(";", *[F.when(holds(cond), F.lit(name)) for name, cond in rules]), F.lit(""))


def list_filter(df: DataFrame, column: str, allow: Sequence | None = None, deny: Sequence | None = None) -> DataFrame:
    """An allow list decides alone; else the deny list takes rows out (rows without a value stay)."""
    if allow:
        return df.where(F.col(column).isin(*allow))
    if deny:
        return df.where(null_or_not_in(F.col(column), deny))
    return df


def keep_or_mask(df: DataFrame, diagnoses: Sequence[str], modality: str, token: str, masked: Sequence[str]) -> DataFrame:
    """Rows with a diagnosis or the modality stay; ``masked`` columns are null where the modality lacks it."""
    has = holds(contains_ci(F.col(modality), token))
    labelled = F.lit(False)
    for c in diagnoses:
        labelled = labelled | F.col(c).isNotNull()
    return df.where(labelled | has).withColumns({c: F.when(has, F.col(c)) for c in masked})


def drop_unlabelled(df: DataFrame, labels: Sequence[str], also: Column) -> DataFrame:
    """Rows go where every label is null and ``also`` holds."""
    none = F.lit(True)
    for c in labels:
        none = none & F.col(c).isNull()
    return df.where(~(none & holds(also)))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P10: rows whose columns are all there and not empty."""
    for c in columns:
        df = df.where(F.col(c).isNotNull() & (F.col(c).cast("string") != ""))
    return df


def project(df: DataFrame, rename: dict[str, str] | None = None, drop: Sequence[str] = (), first: Sequence[str] = ()) -> DataFrame:
    """Rename, drop what is there, bring ``first`` to the front."""
    out = df.withColumnsRenamed(rename or {}).drop(*drop)
    return out.select(*first, *[c for c in out.columns if c not in first])


def snake_case(name: str) -> str:
    name = re.sub(r"[\s\-]+", "_", name.strip())
    if name.isupper():
        return name.lower()
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """P12."""
    return df.toDF(*[snake_case(c) for c in df.columns])


def norm_id(c: Column) -> Column:
    """Ids as text without a trailing .0; 'nan', 'none' and blanks are null."""
    text = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    return F.when(~F.lower(text).isin("nan", "none", "null", ""), text)


def coalesce_text(*columns: Column, valid=None) -> Column:
    """The first column whose text is valid (not blank, unless told otherwise)."""
    valid = valid or (lambda c: F.trim(c) != "")
    return F.coalesce(*[F.when(holds(valid(c)), c) for c in columns])


def label_flags(df: DataFrame, column: str, names: Sequence[str], sep: str = "; ") -> DataFrame:
    """A flag for each label of a joined list; rows with at least one stay."""
    parts = F.split(F.coalesce(F.col(column), F.lit("")), re.escape(sep))
    out = df.withColumns({n: F.array_contains(parts, n) for n in names})
    return out.where(F.greatest(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0]))


def none_of(c: Column, values: Sequence[str], sep: str = ",") -> Column:
    """No entry of the list is one of ``values``; an absent list has none."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), re.escape(sep)), lambda x: F.trim(x))
    return ~F.arrays_overlap(parts, F.array(*map(F.lit, values)))
