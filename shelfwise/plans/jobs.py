"""End-to-end jobs (RUN-1..3): analytics, forecasting, the daily pipeline.

The pipeline publishes each report set and then reads the *written* reports
back for the summary: the written directory (in the shared output folder)
cuts lineage, so the summary neither recomputes the reports nor depends on
executors that may have been lost meanwhile.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import daily_state, forecast, kpis, quarantine, reports
from shelfwise.sinks import batches
from shelfwise.sinks.writers import (ANALYTICS_SHEETS, FORECAST_SHEETS, persist_forecasts,
                                     publish_reports)
from shelfwise.sources.model import StarModel


def run_all_analytics(model: StarModel, as_of) -> dict[str, DataFrame]:
    """The four analytics reports, lazily (RUN-1)."""
    return {
        "top_sellers": reports.top_sellers(model, as_of),
        "low_sellers": reports.low_sellers(model, as_of),
        "stock": reports.stock_coverage(model, as_of),
        "six_month": reports.six_month_average(model, as_of),
    }


def run_forecasting(spark: SparkSession, model: StarModel, as_of, root: str | None = None,
                    run_date: dt.date | None = None, persist: bool = True) -> dict[str, DataFrame]:
    """Both forecasts; replace the forecast tables and publish the set (RUN-2)."""
    fc = {"total": forecast.forecast_total(model, as_of),
          "products": forecast.forecast_products(model, as_of)}
    if root:
        paths = publish_reports(fc, f"{root.rstrip('/')}/forecasts", run_date, FORECAST_SHEETS)
        # the tables are filled from the published files: each forecast runs once
        fc = {k: _read_sheet(spark, p) for k, p in paths.items()}
    if persist:
        persist_forecasts(spark, fc["total"], fc["products"])
    return fc


def _read_sheet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/parquet")


def run_pipeline(spark: SparkSession, model: StarModel, as_of, root: str,
                 run_date: dt.date | None = None, persist_tables: bool = True) -> dict:
    """Analytics -> publish -> forecasts -> summary datasets (RUN-3)."""
    run_date = run_date or dt.date.today()
    root = root.rstrip("/")
    analytics = run_all_analytics(model, as_of)
    paths = publish_reports(analytics, f"{root}/analytics", run_date, ANALYTICS_SHEETS)
    fc = run_forecasting(spark, model, as_of, root, run_date, persist=persist_tables)

    stock = _read_sheet(spark, paths["stock"])
    critical = stock.where(F.col("stock_status") == reports.STATUS_CRITICAL)
    header = kpis.ytd(model, as_of).select(
        "ytd_revenue", "ytd_units",
        critical.agg(F.count(F.lit(1))).scalar().alias("critical_skus"))
    fc_total = spark.read.parquet(f"{root}/forecasts/run_date={run_date:%Y%m%d}/Total_Revenue/parquet")
    sections = {
        "header": header,
        "top_sellers": _read_sheet(spark, paths["top_sellers"])
        .orderBy(F.desc("revenue"), "product_id").limit(10),
        "low_sellers": _read_sheet(spark, paths["low_sellers"])
        .orderBy("units_sold", "product_id").limit(10),
        "critical_stock": critical.orderBy(F.asc_nulls_last("days_of_cover"), "product_id").limit(10),
        "forecast_total": fc_total.orderBy("month").limit(5),
    }
    summary_paths = publish_reports(sections, f"{root}/summary", run_date, formats=("parquet",))
    return {"analytics": paths, "forecasts": fc, "summary": summary_paths}


def load_batch(spark: SparkSession, sales: DataFrame, model: StarModel, root: str, batch_id: str,
               keys: list[tuple[str, list[str]]] | None = None) -> dict[str, int]:
    """One delivery of sales into ``root``: rows that break a constraint go to
    ``root/quarantine``, the others are appended to ``root/sales`` as ``batch_id``
    (both exactly once), then the daily state is brought up to date for the dates
    touched.  Returns the counts; a batch that is already there only refreshes
    the state."""
    root = root.rstrip("/")
    done = batches.finished(spark, f"{root}/sales").where(F.col("batch_id") == batch_id)
    counts = {"rows": 0, "accepted": 0}
    if done.isEmpty():
        parts = quarantine.split(sales, "sales", model, keys)
        counts = parts.counts
        batches.append_batch(parts.quarantined, f"{root}/quarantine", batch_id)
        batches.append_batch(parts.accepted, f"{root}/sales", batch_id)
    daily_state.refresh(spark, f"{root}/sales", f"{root}/daily")
    return counts


def run_daily(spark: SparkSession, sales: DataFrame, model: StarModel, root: str, batch_id: str, as_of,
              keys: list[tuple[str, list[str]]] | None = None) -> dict:
    """The daily run on new sales only (RUN-3): load the batch, then analytics,
    forecasts and summary from the daily state, whose folders outside a report's
    window are never opened."""
    root = root.rstrip("/")
    counts = load_batch(spark, sales, model, root, batch_id, keys)
    state = daily_state.as_model(model, spark, f"{root}/daily")
    run_date = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
    return {"counts": counts, **run_pipeline(spark, state, as_of, f"{root}/reports", run_date)}
