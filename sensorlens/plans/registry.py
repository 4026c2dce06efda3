"""Named queries: a Spark plan over the given tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.plans.fixtures import Tables


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(run: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return add


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return QUERIES[name].run(Tables(spark, sf_dir))

    return run


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Rounds columns whose last bits depend on the order of a floating-point sum.

    Bin averages and interpolated points of readings in hundredths often end in an exact 5 at
    the seventh decimal, where the two engines round differently; series compare 8 decimals.
    """
    cells: list[Column] = [
        F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns
    ]
    return df.select(*cells)
