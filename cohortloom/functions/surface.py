"""User functions of the library for SQL: scalar, aggregate and table functions.

Native expressions come first; these wrap them (or a short Python rule) for SQL users.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fold_groups(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], start: Column, step: Callable[[Column, Column], Column], finish: Callable[[Column], Column]) -> DataFrame:
    """U4: a user's function over the ordered rows of each group (a patient's exams): ``step`` folds the rows, ``finish``
    makes the result. Both are expressions, so no rows leave the engine; a group's rows must fit in one value."""
    rows = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *columns))).alias("_rows"))
    return rows.select(key, F.aggregate("_rows", start, step, finish).alias("result"))


#: Rules of a pattern table that become one expression.
MAX_RULES = 1000


def first_rule(rules: DataFrame, text: Column) -> Column:
    """The code of the first rule (rule, pattern, code) whose pattern the text has, as one expression over the text."""
    rows = rules.orderBy("rule").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    out = F.lit(None).cast("string")
    for r in reversed(rows):
        out = F.when(text.rlike(r.pattern), F.lit(r.code)).otherwise(out)
    return out


def register(spark: SparkSession) -> None:
    """Make the functions known to a session's SQL."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION clock_distance(a DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN least(abs(a - b) % 12, 12 - abs(a - b) % 12)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION strip_rank(label STRING) RETURNS STRING RETURN regexp_replace(label, '([A-Z]+)[0-9]+', '$1')")

    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tidy_caption(text STRING) RETURNS STRING RETURN trim(regexp_replace(replace(lower(text), '$', 's'), '\\\\s+', ' '))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION join_values(vals ARRAY<STRING>) RETURNS STRING RETURN array_join(array_sort(array_distinct(filter(transform(vals, v -> trim(v)), v -> v <> ''))), '; ')")

    # a part begins with a letter at the start of a line and goes on to the next one
    part = r"(?s)(?:^|\\n)([A-Z][.)]\\s+(?:(?!\\n[A-Z][.)]\\s).)*)"
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION lettered_parts(text STRING) RETURNS TABLE (letter STRING, part STRING) RETURN
        SELECT substring(p, 1, 1), regexp_replace(substring(p, 3), '^\\\\s+|\\\\s+\\\\z', '') FROM (SELECT explode(regexp_extract_all(text, '{part}', 1)) AS p)"""
    )
