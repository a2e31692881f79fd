"""Named queries over the driver's parquet tables.

Each entry takes ``(spark, sf_dir)``, maps the tables onto the star model
and returns the operator's result with money and ratios published as
DOUBLE and integers as BIGINT (``to_edge``).  ``as_of`` is an argument of every
query; its default is the last ship date of the test data.  Only trailing
windows, year-to-date and same-period figures depend on it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.defaults import LOW_SELLER_VIEW_THRESHOLD
from shelfwise.functions.numeric import to_edge
from shelfwise.operators import etl, forecast, kpis, measures, order_counts, quality, quarantine, reports, summary
from shelfwise.operators.slicers import apply_slicers
from shelfwise.sources import seeds
from shelfwise.sources.model import StarModel, load_model, sales_delivery

AS_OF = dt.date(2001, 11, 4)
SLICER_CATEGORIES = ("MEDIUM", "STANDARD")
SLICER_DATES = (dt.date(2001, 9, 1), dt.date(2001, 10, 31))


def _q(fn: Callable[[StarModel, dt.date], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
        return to_edge(fn(load_model(spark, sf_dir), as_of))
    run.__doc__ = fn.__doc__
    run.operator = lambda model, as_of: to_edge(fn(model, as_of))     # on a model of the caller's
    return run


def _sliced(model: StarModel, fact: bool | str = False) -> StarModel:
    """The dashboard's slicers: two categories and a range of dates."""
    return apply_slicers(model, categories=SLICER_CATEGORIES, start=SLICER_DATES[0], end=SLICER_DATES[1], fact=fact)


# The stock rule of seed_inventory with patterns that the given skus match.
STOCK_PATTERNS = {"Brand#1_-%7": 5, "Brand#%-%3": 50}
LINE_KEY = [("unique:sale_id,line_no", ["sale_id", "line_no"])]


def _days_before(as_of: dt.date, n: int) -> dt.date:
    return as_of - dt.timedelta(days=n)


def quarantined_sales(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
    """Lines of a faulty delivery that a constraint refuses, and which ones."""
    delivery = quarantine.split(sales_delivery(spark, sf_dir), "sales", load_model(spark, sf_dir), LINE_KEY)
    return delivery.quarantined.select("sale_id", "line_no", F.concat_ws(" ", quarantine.BROKEN).alias("broken_rules"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_sellers": _q(lambda m, as_of: reports.top_sellers(m, as_of)),
    "top_sellers_view": _q(lambda m, as_of: reports.top_sellers_view(m, as_of)),
    "low_sellers": _q(lambda m, as_of: reports.low_sellers(m, as_of, threshold=10)),
    "low_sellers_view": _q(lambda m, as_of: reports.low_sellers(m, as_of, threshold=LOW_SELLER_VIEW_THRESHOLD)),
    "stock_coverage": _q(lambda m, as_of: reports.stock_coverage(m, as_of)),
    "stock_coverage_view": _q(lambda m, as_of: reports.stock_coverage_view(m, as_of)),
    "six_month_average": _q(lambda m, as_of: reports.six_month_average(m, as_of)),
    "six_month_calendar": _q(lambda m, as_of: reports.six_month_average(m, as_of, calendar=True)),
    "monthly_revenue": _q(lambda m, as_of: reports.monthly_revenue(m, as_of)),
    "monthly_revenue_24m": _q(lambda m, as_of: reports.monthly_revenue(m, as_of, months=24)),
    "ytd_kpis": _q(lambda m, as_of: kpis.ytd(m, as_of)),
    "top_product_names": _q(lambda m, as_of: kpis.top_product_names(m, as_of)),
    "critical_stock": _q(lambda m, as_of: kpis.critical_stock(m, as_of)),
    "category_contribution": _q(lambda m, as_of: kpis.category_contribution(m, as_of)),
    "etl_extract": _q(lambda m, as_of: etl.extract_sales(m, as_of)),
    "etl_clean": _q(lambda m, as_of: etl.clean_sales(m, as_of)),
    "forecast_total": _q(lambda m, as_of: forecast.forecast_total(m, as_of)),
    "forecast_products": _q(lambda m, as_of: forecast.forecast_products(m, as_of)),
    "revenue_with_forecast": _q(lambda m, as_of: forecast.revenue_with_forecast(m, as_of)),
    "forecast_matrix": _q(lambda m, as_of: forecast.forecast_matrix(m, as_of)),
    "totals_by_category": _q(lambda m, as_of: measures.totals(m, as_of, by=["category_name"])),
    "aov_by_month": _q(lambda m, as_of: measures.aov(m, as_of, by=["month"])),
    "gross_profit_60": _q(lambda m, as_of: measures.gross_profit_60(m, as_of, by=["month"])),
    "revenue_6m_avg": _q(lambda m, as_of: measures.revenue_6m_avg(m, as_of, by=["product_id"])),
    "coverage_days_measure": _q(lambda m, as_of: measures.coverage_days(m, as_of)),
    "top10_revenue": _q(lambda m, as_of: measures.top10_revenue(m, as_of)),
    "critical_sku_count": _q(lambda m, as_of: measures.critical_sku_count(m, as_of)),
    "yoy_growth": _q(lambda m, as_of: measures.yoy_growth(m, as_of)),
    "revenue_by_category": _q(lambda m, as_of: measures.revenue_by(m, as_of, dims=["category_name"])),
    "revenue_by_product": _q(lambda m, as_of: measures.revenue_by(m, as_of, dims=["product_id", "product_name"])),
    "stock_status_counts": _q(lambda m, as_of: measures.stock_status_counts(m, as_of)),
    "cover_bands": _q(lambda m, as_of: measures.cover_bands(m, as_of)),
    "seed_inventory": _q(lambda m, as_of: seeds.seed_inventory(m)),
    "demand_calendar": _q(lambda m, as_of: seeds.demand_calendar(m)),
    "constraint_report": _q(lambda m, as_of: quality.constraint_report(m)),
    "daily_summary": _q(lambda m, as_of: summary.daily_summary(m, as_of)),
    "aov_by_category": _q(lambda m, as_of: measures.aov(m, as_of, by=["category_name"])),
    "coverage_days_by_category": _q(lambda m, as_of: measures.coverage_days(m, as_of, by=["category_name"])),
    "sliced_top_sellers": _q(lambda m, as_of: reports.top_sellers(_sliced(m), as_of)),
    "sliced_stock_coverage": _q(lambda m, as_of: reports.stock_coverage(_sliced(m), as_of)),
    "sliced_ytd_kpis": _q(lambda m, as_of: kpis.ytd(_sliced(m, "summed"), as_of)),
    "sliced_totals_by_month": _q(lambda m, as_of: measures.totals(
        apply_slicers(m, categories=SLICER_CATEGORIES, fact="summed"), as_of, by=["month"])),
    "forecast_all_products": _q(lambda m, as_of: forecast.forecast_products(m, as_of, top_n=None)),
    "etl_clean_repeated": _q(lambda m, as_of: etl.transform(
        etl.extract_sales(m, as_of).unionAll(etl.extract_sales(m, as_of)), rows=2 * etl.extracted_rows(m, as_of))),
    "quarantined_sales": quarantined_sales,
    "demand_by_store": _q(lambda m, as_of: seeds.demand_by_store(m, _days_before(as_of, 2), _days_before(as_of, 1))),
    "distinct_orders": _q(lambda m, as_of: order_counts.distinct_orders(m)),
    "top10_revenue_by_month": _q(lambda m, as_of: measures.top_revenue_by(m, as_of)),
    "top10_revenue_by_category": _q(lambda m, as_of: measures.top_revenue_by(m, as_of, by=["category_name"])),
    "yoy_growth_by_quarter": _q(lambda m, as_of: measures.yoy_growth(m, as_of, grain="quarter")),
    "yoy_growth_by_year": _q(lambda m, as_of: measures.yoy_growth(m, as_of, grain="year")),
    "seed_inventory_patterns": _q(lambda m, as_of: seeds.seed_inventory(m, STOCK_PATTERNS)),
    "summary_section_critical": _q(lambda m, as_of: summary.summary_section_critical(m, as_of)),
}

FLAGSHIP = "top_sellers"
