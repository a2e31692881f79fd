"""Linear-trend revenue forecasts, total and per product (FC-1..4).

One plan, no per-series loop: monthly aggregate -> each known month and the
next one (``lead``) emit the gap months between them, linearly interpolated
(``explode(sequence)``) -> least squares per series (``regr_slope`` /
``regr_intercept``) -> ``explode`` of the horizon.  The window and the fit
share one hash partitioning by series, and a series holds one row per month
of its span (at most 19 for a product, 25 for the total).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.defaults import (BAND_HIGH, BAND_LOW, FORECAST_MONTHS, FORECAST_PRODUCT_HISTORY_MONTHS,
                                FORECAST_RECENT_MONTHS, FORECAST_TOP_N,
                                FORECAST_TOTAL_HISTORY_MONTHS, MIN_HISTORY_MONTHS)
from shelfwise.functions.numeric import guarded_round2
from shelfwise.session import write_once
from shelfwise.sources.model import StarModel

MIN_HISTORY = MIN_HISTORY_MONTHS


def _check_horizon(months_ahead: int) -> None:
    if months_ahead is None or months_ahead < 1:
        raise ValueError("months_ahead must be >= 1")


def monthly_revenue_series(model: StarModel, as_of, months: int = FORECAST_TOTAL_HISTORY_MONTHS) -> DataFrame:
    """Total revenue per month over the trailing window (SRC-7)."""
    return (model.sales.where(D.trailing_months(F.col("sale_date"), as_of, months))
            .groupBy(D.month_start(F.col("sale_date")).alias("month"))
            .agg(F.sum("total_amount").alias("revenue"),
                 F.sum("quantity").cast("long").alias("units_sold")))


def product_months(model: StarModel, as_of, months: int = FORECAST_PRODUCT_HISTORY_MONTHS) -> DataFrame:
    """Revenue per (product, month) over the trailing window (SRC-8)."""
    return (model.sales.where(D.trailing_months(F.col("sale_date"), as_of, months))
            .groupBy("product_id", D.month_start(F.col("sale_date")).alias("month"))
            .agg(F.sum("total_amount").alias("revenue")))


def product_monthly_revenue(model: StarModel, as_of, months: int = FORECAST_PRODUCT_HISTORY_MONTHS) -> DataFrame:
    """Revenue per (product, month) over the trailing window, named products only (SRC-8)."""
    return named(product_months(model, as_of, months), model)


def named(months: DataFrame, model: StarModel) -> DataFrame:
    return months.join(model.products.select("product_id", "product_name"), "product_id")


def fill_and_fit(series: DataFrame, keys: list[str]) -> DataFrame:
    """Per series (``keys``): fill the gap months linearly by position and fit
    revenue ~ month index (index 0 = the series' first month).

    Each known month emits itself and the gap months up to the next known
    month (``lead`` over the series), interpolated between the two; so no
    month spine has to be joined back.  The window and the fit aggregate
    share one hash partitioning on ``keys``: a single shuffle.

    Input columns: keys, month (DATE, month start), revenue.
    Output: keys, last_month, raw_months, span, slope, intercept.
    """
    w = Window.partitionBy(*keys).orderBy("month")
    whole = Window.partitionBy(*keys)
    mnum = D.month_number(F.col("month"))
    seg = series.select(
        *keys, "month", F.col("revenue").cast("double").alias("y0"),
        (mnum - F.min(mnum).over(whole)).alias("x0"),
        (D.month_number(F.lead("month").over(w)) - mnum).alias("gap"),
        F.lead(F.col("revenue").cast("double")).over(w).alias("y1"),
        F.max("month").over(whole).alias("last_month"),
        F.count(F.lit(1)).over(whole).alias("raw_months"))
    pts = seg.select(*keys, "last_month", "raw_months", "x0", "y0", "y1", "gap",
                     F.explode(F.sequence(F.lit(0), F.coalesce(F.col("gap") - 1, F.lit(0)))).alias("k"))
    x = F.col("x0") + F.col("k")
    y = F.when(F.col("k") == 0, F.col("y0")).otherwise(
        F.col("y0") + (F.col("y1") - F.col("y0")) * F.col("k") / F.col("gap"))
    return (pts.groupBy(*keys, "last_month", "raw_months")
            .agg(F.count(F.lit(1)).alias("span"),
                 F.regr_slope(y, x.cast("double")).alias("slope"),
                 F.regr_intercept(y, x.cast("double")).alias("intercept")))


def _horizon(fit: DataFrame, months_ahead: int) -> DataFrame:
    return fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(months_ahead))).alias("h")) \
        .withColumn("pred", F.col("intercept") + F.col("slope")
                    * (F.col("span") - 1 + F.col("h")).cast("double")) \
        .withColumn("month", F.add_months("last_month", F.col("h")))


def forecast_total(model: StarModel, as_of, months_ahead: int = FORECAST_MONTHS,
                   history_months: int = FORECAST_TOTAL_HISTORY_MONTHS) -> DataFrame:
    """Next ``months_ahead`` months of total revenue with a +/-10 % band (FC-1).

    Empty (with schema) when fewer than 6 months have sales; the forecast is
    not clamped, so a falling trend may go negative and invert the band.
    """
    _check_horizon(months_ahead)
    series = monthly_revenue_series(model, as_of, history_months) \
        .select(F.lit(0).alias("series"), "month", "revenue")
    fit = fill_and_fit(series, ["series"]).where(F.col("raw_months") >= MIN_HISTORY)
    out = _horizon(fit, months_ahead)
    return out.select("month",
                      guarded_round2(F.col("pred")).alias("forecast_revenue"),
                      guarded_round2(F.col("pred") * F.lit(BAND_LOW)).alias("lower_bound"),
                      guarded_round2(F.col("pred") * F.lit(BAND_HIGH)).alias("upper_bound")) \
        .orderBy("month")


def top_recent_products(series: DataFrame, top_n: int, recent_months: int = FORECAST_RECENT_MONTHS) -> DataFrame:
    """The ``top_n`` products of a (product_id, month, revenue) ``series`` by
    revenue in the last ``recent_months`` months before the series' own latest
    month (inclusive: recent_months + 1 buckets).  Ties break on product_id; the
    ranking is a distributed top-k."""
    latest = series.agg(F.max("month")).scalar()
    return (series.where(F.col("month") >= F.add_months(latest, -recent_months))
            .groupBy("product_id").agg(F.sum("revenue").alias("recent_revenue"))
            .orderBy(F.desc("recent_revenue"), F.asc("product_id"))
            .limit(top_n)
            .select("product_id"))


def forecast_products_h(model: StarModel, as_of, top_n: int | None = FORECAST_TOP_N,
                        months_ahead: int = FORECAST_MONTHS,
                        history_months: int = FORECAST_PRODUCT_HISTORY_MONTHS) -> DataFrame:
    """Per-product forecast with the horizon step ``h`` kept (for the matrix);
    ``top_n`` None takes every named product.

    The latest month, the ranking and the series itself all come from one
    (product, month) table, written once to the shared folder: the fact is
    scanned once however many readers that table has."""
    _check_horizon(months_ahead)
    series = product_monthly_revenue(model, as_of, history_months)
    if top_n is not None:
        series = write_once(series, "product-months")
        top = top_recent_products(series, top_n)
        # a short list of ids is broadcast; Spark sizes a longer one itself
        series = series.join(F.broadcast(top) if top_n <= 10_000 else top, "product_id", "left_semi")
    # a product has one name, so carrying it as a series key adds no group
    fit = fill_and_fit(series, ["product_id", "product_name"]).where(F.col("span") >= MIN_HISTORY)
    out = _horizon(fit, months_ahead)
    return out.select("product_id", "product_name", "h",
                      F.col("month").alias("forecast_month"),
                      guarded_round2(F.greatest(F.col("pred"), F.lit(0.0))).alias("forecast_revenue"))


def forecast_products(model: StarModel, as_of, top_n: int | None = FORECAST_TOP_N,
                      months_ahead: int = FORECAST_MONTHS,
                      history_months: int = FORECAST_PRODUCT_HISTORY_MONTHS) -> DataFrame:
    """Forecast revenue of the top-N recent products (FC-2).

    Each product's horizon starts after its *own* last month; products whose
    gap-filled history spans fewer than 6 months are skipped, not replaced;
    forecasts are clamped at 0.
    """
    return (forecast_products_h(model, as_of, top_n, months_ahead, history_months)
            .drop("h").orderBy("product_id", "forecast_month"))


def revenue_with_forecast(model: StarModel, as_of, months_ahead: int = FORECAST_MONTHS,
                          history_months: int = FORECAST_TOTAL_HISTORY_MONTHS) -> DataFrame:
    """Actual monthly revenue and the forecast band on one series (FC-3)."""
    actual = monthly_revenue_series(model, as_of, history_months).select(
        "month", F.lit("actual").alias("kind"), F.col("revenue").cast("double").alias("revenue"))
    fc = forecast_total(model, as_of, months_ahead, history_months).select(
        "month", F.lit("forecast").alias("kind"), F.col("forecast_revenue").alias("revenue"),
        "lower_bound", "upper_bound")
    return actual.unionByName(fc, allowMissingColumns=True).orderBy("month", "kind")


def forecast_matrix(model: StarModel, as_of, top_n: int = FORECAST_TOP_N,
                    months_ahead: int = FORECAST_MONTHS) -> DataFrame:
    """Product x horizon matrix of the per-product forecast (FC-4).  The pivot
    values are given, so no extra pass is needed to discover them."""
    fc = forecast_products_h(model, as_of, top_n, months_ahead)
    steps = list(range(1, months_ahead + 1))
    wide = fc.groupBy("product_id", "product_name").pivot("h", steps).agg(F.first("forecast_revenue"))
    return wide.select("product_id", "product_name",
                       *[F.col(str(h)).alias(f"month_{h}") for h in steps])
