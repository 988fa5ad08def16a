"""Named queries over the driver's tables, each beside the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name``, with its oracle if SQL can express it."""

    def put(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
