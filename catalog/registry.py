"""Register of queries and of the SQL they are checked with."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name, with the SQL of its check if there is one."""

    def register(function):
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = function
        if sql is not None:
            CHECKS[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
