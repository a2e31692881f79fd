"""Datasets of the daily executive summary (SUM-1/2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.defaults import STOCK_LOW_DAYS, VELOCITY_PER_DAYS, VELOCITY_WINDOW_DAYS
from shelfwise.functions import dates as D
from shelfwise.operators.common import product_dim, stock_by_product
from shelfwise.operators.forecast import forecast_total
from shelfwise.operators.reports import STATUS_CRITICAL, low_sellers, stock_coverage, stock_status, top_sellers
from shelfwise.sources.model import StarModel


def critical_rows(model: StarModel, as_of, warn_days: int = 14) -> DataFrame:
    return stock_coverage(model, as_of, warn_days).where(F.col("stock_status") == STATUS_CRITICAL)


def daily_summary(model: StarModel, as_of, warn_days: int = 14) -> DataFrame:
    """One row: YTD revenue, YTD units and the number of CRITICAL products."""
    this_year = D.year_to_date(F.col("sale_date"), as_of)
    recent = D.trailing_days(F.col("sale_date"), as_of, VELOCITY_WINDOW_DAYS)
    # one scan of the fact and one shuffle: sales, stock and products meet as rows of one product
    sold = (model.sales.where(this_year | recent).groupBy("product_id")
            .agg(F.sum(F.when(this_year, F.col("total_amount"))).alias("revenue"),
                 F.sum(F.when(this_year, F.col("quantity"))).cast("long").alias("units"),
                 F.sum(F.when(recent, F.col("quantity"))).cast("long").alias("units_w")))
    listed = product_dim(model).select("product_id", F.lit(1).alias("listed"))
    rows = (sold.unionByName(stock_by_product(model), allowMissingColumns=True)
            .unionByName(listed, allowMissingColumns=True)
            .groupBy("product_id").agg(*[F.sum(c).alias(c) for c in ("revenue", "units", "units_w", "total_stock", "listed")]))
    status = stock_status(F.col("total_stock"), F.coalesce("units_w", F.lit(0).cast("long")),
                          warn_days, STOCK_LOW_DAYS, VELOCITY_PER_DAYS)
    return rows.agg(
        F.coalesce(F.sum("revenue"), F.lit(0).cast("decimal(24,2)")).alias("ytd_revenue"),
        F.coalesce(F.sum("units"), F.lit(0).cast("long")).alias("ytd_units"),
        F.coalesce(F.sum(F.when(status == STATUS_CRITICAL, F.col("listed"))), F.lit(0).cast("long")).alias("critical_skus"))


def summary_section_critical(model: StarModel, as_of, rows: int = 10, warn_days: int = 14) -> DataFrame:
    """The first ``rows`` CRITICAL products by cover (a top-k, as the summary)."""
    return (critical_rows(model, as_of, warn_days)
            .orderBy(F.asc_nulls_last("days_of_cover"), "product_id").limit(rows))


def summary_sections(model: StarModel, as_of) -> dict[str, DataFrame]:
    """Top 10, low 10, critical 10 and the first 5 forecast months."""
    return {
        "top_sellers": top_sellers(model, as_of, top_n=10),
        "low_sellers": low_sellers(model, as_of).limit(10),
        "critical_stock": summary_section_critical(model, as_of),
        "forecast_total": forecast_total(model, as_of).limit(5),
    }
