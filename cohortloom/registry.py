"""All registered queries of the cohort operators and their SQL twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame

from .fixtures import view, with_views
from .operators.lineage import spread

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


#: Views whose queries search texts: many expressions by row.
TEXTS = ("reports", "notes")


class Tables:
    """The tables and adapter views of one folder, as attributes."""

    def __init__(self, spark, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        rows = view(self.spark, self.sf_dir, name)
        return spread(rows) if name in TEXTS else rows


def query(name: str, sql: str | None = None):
    """Register a function of Tables as a query, with the SQL that gives the same rows."""

    def put(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = with_views(sql)
        return f

    return put


for _module in ("predicates", "joins", "aggregates", "timeline", "sampling", "changes", "text", "values", "sources", "jobs", "evaluation", "streams", "surface"):
    importlib.import_module(f"cohortloom.plans.{_module}")
