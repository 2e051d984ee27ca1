"""Named queries. ``query`` registers a function of the retail tables, with checking SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide.plans.oracle import statement
from stocktide.plans.retail_tables import Retail


@dataclass(frozen=True)
class Query:
    run: Callable[[Retail], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(run: Callable[[Retail], DataFrame]):
        QUERIES[name] = Query(run, statement(sql) if sql else None)
        return run

    return add


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, the type the test tables use."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


_generation = 0
_opened: dict[tuple[str, str], Retail] = {}


def retail_tables(spark: SparkSession, sf_dir: str) -> Retail:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _opened:
        _opened[key] = Retail(spark, sf_dir, _generation)
    return _opened[key]


def forget_tables() -> None:
    """Later queries store their shared tables anew, in another folder."""
    global _generation
    _opened.clear()
    _generation += 1


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(QUERIES[name].run(retail_tables(spark, sf_dir)))
