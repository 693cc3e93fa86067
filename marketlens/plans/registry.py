"""Registry of named queries: each entry is a Spark builder over a dataset
context, its output contract and its DuckDB oracle (final SELECT over the
fixture / fact CTEs). ``__spark_entry__`` exposes these."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from .context import MarketContext, get_context
from .contracts import spark_project, sql_project
from .oracle_base import with_ctes


@dataclass
class Query:
    name: str
    build: Callable[[MarketContext], DataFrame]
    spec: str
    sql: str | None = None          # final SELECT over the CTEs (None: rows-only check)
    extra_ctes: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        ctx = get_context(spark, sf_dir)
        return spark_project(self.build(ctx), self.spec)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        return sql_project(with_ctes(self.sql, self.extra_ctes), self.spec)


REGISTRY: dict[str, Query] = {}


def register(name: str, spec: str, sql: str | None = None, extra_ctes: str = ""):
    def deco(fn: Callable[[MarketContext], DataFrame]):
        REGISTRY[name] = Query(name, fn, spec, sql, extra_ctes)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    from . import queries_core, queries_customers, queries_delivery, queries_quality  # noqa: F401
    from . import queries_serve, queries_ml, queries_insights, queries_io, queries_model_checks  # noqa: F401
    return REGISTRY
