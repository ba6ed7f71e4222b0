"""The queries over the driver's tables and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
LINE = ["l_partkey", "l_suppkey", "l_extendedprice"]  # with order and line number, a total order


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def n(x="*"):
    return F.count(F.lit(1) if x == "*" else x).cast("bigint")


def count_if(c):
    return F.count_if(c).cast("bigint")


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """All queries and their SQL; importing the modules registers them."""
    from . import core, listings, meetings, records  # noqa: F401

    return QUERIES, ORACLES
