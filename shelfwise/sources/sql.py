"""Parameterised SQL over registered views (SRC-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def fetch_df(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """Run ``query`` with named ``:markers`` bound from ``params`` (also in
    ``LIMIT :n``).  Values are bound as literals, so Catalyst folds them and
    pushes date bounds into the scans."""
    return spark.sql(query, args=params or {})
