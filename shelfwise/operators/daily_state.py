"""Sales summed per day, product and store, kept as a table and refreshed for
changed dates only (RUN-3).

Reports that sum units and revenue need no single lines: read from the state they
give the same figures from far fewer rows, and a daily run opens only the new
dates of the fact.  The state is partitioned by date and replaced date by date
(dynamic partition overwrite), so a refresh that is repeated, or finds a date
whose sales are gone, leaves what one over the whole fact would.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sinks import batches, files
from shelfwise.sources.model import StarModel

STATE_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("store_id", T.LongType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("total_amount", T.DecimalType(24, 2)),
    T.StructField("lines", T.LongType()),
    T.StructField("sale_date", T.DateType()),
])


def summed(sales: DataFrame) -> DataFrame:
    """(product_id, store_id, sale_date, quantity, total_amount, lines)."""
    return sales.groupBy("sale_date", "product_id", "store_id").agg(
        F.sum("quantity").cast("long").alias("quantity"), F.sum("total_amount").alias("total_amount"),
        F.count(F.lit(1)).alias("lines")).select(*STATE_SCHEMA.fieldNames())


def write_dates(sales: DataFrame, path: str) -> None:
    """Replace the state of the dates that ``sales`` has."""
    (summed(sales).hint("rebalance", "sale_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("sale_date").parquet(path))


def _mark(path: str) -> str:
    return path.rstrip("/") + "_through"


def refresh(spark: SparkSession, fact_path: str, path: str) -> list[dt.date]:
    """Bring the state up to date with a fact of batches; returns the dates that
    were summed again (at most one per calendar day).

    What the ledger lists as finished since the last refresh decides: the instant
    of its newest row is noted after the state is written, so a refresh that died
    is repeated in full."""
    noted = files.read_text(spark, _mark(path))
    newest = batches.newest(spark, fact_path)
    if newest is None:
        return []
    dates = batches.changed_dates(spark, fact_path, int(noted) if noted else None)
    if dates:
        fact = batches.read_fact(spark, fact_path).where(F.col("sale_date").isin(dates))
        write_dates(fact, path)
        left = {r[0] for r in fact.select("sale_date").distinct().collect()}
        for day in dates:               # dates that lost all their sales
            if day not in left:
                files.delete(spark, f"{path.rstrip('/')}/sale_date={day.isoformat()}")
    files.swap_text(spark, _mark(path), str(newest))
    return dates


def read_state(spark: SparkSession, path: str) -> DataFrame:
    if not files.exists(spark, path):
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(path)


def as_model(model: StarModel, spark: SparkSession, path: str) -> StarModel:
    """The model with the state as its sales: for every report that only sums
    quantity and total_amount.  (Mean units per line and distinct orders need the
    lines: ``stock_coverage_view``, ``monthly_revenue``, ``aov``.)"""
    return StarModel(read_state(spark, path), model.products, model.categories, model.stores, model.inventory)
