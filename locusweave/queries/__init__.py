"""Registered queries, by family, each with DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locusweave.plans.fixtures import oracle, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Given:
    """What a query reads: `given.reads` is the view fx_reads, `given.table(name)` a table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, f"fx_{name}")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of Given as a query."""

    def put(f: Callable[[Given], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Given(spark, sf_dir))
        if sql:
            SQL[name] = oracle(sql)
        return f

    return put


def registered() -> tuple[dict, dict]:
    from locusweave.queries import annotation, cohort, hic, intervals, models, reads, reports, variants  # noqa: F401

    return dict(QUERIES), dict(SQL)
