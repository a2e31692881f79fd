"""Partitioned JDBC reads and writes (SRC-3, SNK-1 to a database)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, partition_column: str | None = None,
                 lower_bound=None, upper_bound=None, num_partitions: int | None = None,
                 fetch_size: int = 10_000, user: str | None = None,
                 password: str | None = None, driver: str | None = None) -> dict:
    """Options for a parallel JDBC scan: ``num_partitions`` range queries on
    ``partition_column`` between the bounds (the bounds only set the stride;
    rows outside them are still read)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            opts[key] = value
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """Filters and column selections applied to the result are pushed into
    the database's queries by Spark's JDBC source."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def write_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "append", **opts) -> None:
    mode = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}[if_exists]
    df.write.format("jdbc").options(url=url, dbtable=table, **opts).mode(mode).save()
