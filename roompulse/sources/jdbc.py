"""Tables of a relational database, read in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str, lower: int, upper: int, partitions: int, column: str = "id", fetch: int = 10_000
) -> dict[str, str]:
    """Reader options that split the table by ranges of ``column``."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch),
    }


def read_table(spark: SparkSession, url: str, table: str, partitions: int, column: str = "id", **driver: str) -> DataFrame:
    """The whole table; filters and column lists are pushed into each range query.

    The range comes from one query for the lowest and highest ``column``.
    """
    reader = spark.read.format("jdbc").options(url=url, **driver)
    bounds = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    lo, hi = reader.option("query", bounds).load().first()
    if lo is None:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **driver).load()
    options = jdbc_options(url, table, int(lo), int(hi) + 1, partitions, column)
    return spark.read.format("jdbc").options(**driver).options(**options).load()
