"""Reporting operators: top/low sellers, stock coverage, rolling averages, trends.

Each function returns a lazy DataFrame; ``as_of`` replaces the reference's
"today" so runs are repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.defaults import (LOW_SELLER_THRESHOLD, ROLLING_FRAME_MONTHS, ROLLING_HISTORY_MONTHS,
                                SELLERS_WINDOW_DAYS, STOCK_LOW_DAYS, STOCK_WARNING_DAYS,
                                VELOCITY_PER_DAYS, VELOCITY_WINDOW_DAYS)
from shelfwise.functions.numeric import half_up
from shelfwise.operators.common import join_products, product_dim, product_totals, sales_where, stock_by_product
from shelfwise.sources.model import StarModel

STATUS_NO_SALES = "NO_SALES"
STATUS_CRITICAL = "CRITICAL"
STATUS_LOW = "LOW"
STATUS_OK = "OK"


def top_sellers(model: StarModel, as_of, window_days: int = SELLERS_WINDOW_DAYS, top_n: int | None = 20,
                with_profit: bool = False) -> DataFrame:
    """Best sellers by revenue over the trailing window (RPT-1; RPT-2 with
    ``top_n=None, with_profit=True``).  Ties break on product_id."""
    totals = product_totals(model, D.trailing_days(F.col("sale_date"), as_of, window_days))
    out = join_products(totals, model)
    cols = ["product_id", "sku", "product_name", "category_name", "units_sold", "revenue"]
    if with_profit:
        # sum(amount - cost*qty) = sum(amount) - cost*sum(qty): exact in decimal
        out = out.withColumn("gross_profit",
                             F.col("revenue") - F.col("cost_price") * F.col("units_sold"))
        cols.append("gross_profit")
    out = out.select(*cols).orderBy(F.desc("revenue"), F.asc("product_id"))
    return out if top_n is None else out.limit(top_n)


def top_sellers_view(model: StarModel, as_of, window_days: int = SELLERS_WINDOW_DAYS) -> DataFrame:
    return top_sellers(model, as_of, window_days, top_n=None, with_profit=True)


def low_sellers(model: StarModel, as_of, window_days: int = SELLERS_WINDOW_DAYS,
                threshold: int = LOW_SELLER_THRESHOLD) -> DataFrame:
    """Products (with a category) selling fewer than ``threshold`` units in the
    window, including products with no sale at all (RPT-3/4)."""
    totals = product_totals(model, D.trailing_days(F.col("sale_date"), as_of, window_days))
    out = (join_products(totals, model, products_left=True)
           .select("product_id", "sku", "product_name", "category_name",
                   F.coalesce("units_sold", F.lit(0).cast("long")).alias("units_sold"),
                   F.coalesce("revenue", F.lit(0).cast("decimal(24,2)")).alias("revenue")))
    return out.where(F.col("units_sold") < threshold).orderBy("units_sold", "product_id")


def stock_status(stock, units, warn_days: int, low_days: int, per_days: int):
    # cover = stock / (units / per_days) compared exactly in integers; a NULL
    # stock (no inventory rows) falls through to OK, as in the reference.
    # Net returns (negative units) turn both sides of the comparison round.
    sign = F.signum(units).cast("long")
    return (F.when(units == 0, F.lit(STATUS_NO_SALES))
            .when(stock * per_days * sign < units * sign * warn_days, F.lit(STATUS_CRITICAL))
            .when(stock * per_days * sign < units * sign * low_days, F.lit(STATUS_LOW))
            .otherwise(F.lit(STATUS_OK)))


def stock_coverage(model: StarModel, as_of, warn_days: int = STOCK_WARNING_DAYS,
                   window_days: int = VELOCITY_WINDOW_DAYS, low_days: int = STOCK_LOW_DAYS,
                   per_days: int = VELOCITY_PER_DAYS) -> DataFrame:
    """Days of stock cover from units sold per day (RPT-5).

    velocity = units in the trailing window / ``per_days``; cover rounded to
    one decimal; status NO_SALES / CRITICAL / LOW / OK.
    """
    units30 = product_totals(model, D.trailing_days(F.col("sale_date"), as_of, window_days)) \
        .select("product_id", F.col("units_sold").alias("units_w"))
    # three product-level relations joined on product_id, category names last
    base = (product_dim(model, category=None)
            .join(stock_by_product(model), "product_id", "left").join(units30, "product_id", "left")
            .join(model.categories.select("category_id", "category_name"), "category_id"))
    units = F.coalesce(F.col("units_w"), F.lit(0).cast("long"))
    stock = F.col("total_stock")
    cover = (F.when(units > 0, half_up(stock * per_days, units, 1))
             .when(units < 0, -half_up(stock * per_days, -units, 1)))
    return (base.select(
        "product_id", "sku", "product_name", "category_name",
        F.coalesce(stock, F.lit(0).cast("long")).alias("total_stock"),
        (units.cast("double") / F.lit(float(per_days))).alias("avg_daily_sales"),
        cover.cast("double").alias("days_of_cover"),
        stock_status(stock, units, warn_days, low_days, per_days).alias("stock_status"))
        .orderBy(F.asc_nulls_last("days_of_cover"), "product_id"))


def stock_coverage_view(model: StarModel, as_of, window_days: int = VELOCITY_WINDOW_DAYS) -> DataFrame:
    """The view form of stock cover (RPT-6): velocity is the mean quantity per
    sale line, rounded to cents; no category join; NULL stock is kept."""
    vel = (model.sales.where(D.trailing_days(F.col("sale_date"), as_of, window_days))
           .groupBy("product_id")
           .agg(F.sum("quantity").cast("long").alias("q"), F.count(F.lit(1)).alias("n"))
           .select("product_id", half_up(F.col("q") * 100, F.col("n"), 0)
                   .cast("long").alias("avg_cents")))
    base = (product_dim(model, category=None)
            .join(stock_by_product(model), "product_id", "left")
            .join(vel, "product_id", "left"))
    avg_cents = F.coalesce("avg_cents", F.lit(0).cast("long"))
    cover = F.when(avg_cents > 0, half_up(F.col("total_stock") * 100, avg_cents, 1))
    return (base.select(
        "product_id", "sku", "product_name", "total_stock",
        (avg_cents.cast("double") / 100).alias("avg_daily_sales"),
        cover.cast("double").alias("days_of_cover"))
        .orderBy(F.asc_nulls_last("days_of_cover"), "product_id"))


def product_months(model: StarModel, cond) -> DataFrame:
    """Per (product_id, month): units_sold, revenue — aggregated before any join."""
    return (model.sales.where(cond)
            .groupBy("product_id", D.month_start(F.col("sale_date")).alias("month"))
            .agg(F.sum("quantity").cast("long").alias("units_sold"),
                 F.sum("total_amount").alias("revenue")))


def six_month_average(model: StarModel, as_of, months: int = ROLLING_HISTORY_MONTHS,
                      calendar: bool = False, frame: int = ROLLING_FRAME_MONTHS, with_sku: bool = False, whole_months: bool = False) -> DataFrame:
    """Rolling mean of monthly revenue per product (RPT-7).

    Default: the last ``frame`` product-months *with sales* (row frame, as the
    SQL view and the rolling mean of the analytics code).  ``calendar=True``: the months
    falling in the last ``frame`` calendar months (the BI measure); months
    without sales are absent, never zeros.  ``with_sku`` adds the sku column
    (the view form).
    """
    pm = product_months(model, D.trailing_months(F.col("sale_date"), as_of, months, whole_months))
    ident = ["product_id", "sku", "product_name"] if with_sku else ["product_id", "product_name"]
    out = join_products(pm, model, cols=[c for c in ident if c != "product_id"])
    if calendar:
        w = (Window.partitionBy("product_id").orderBy(D.month_number(F.col("month")))
             .rangeBetween(-(frame - 1), 0))
    else:
        w = Window.partitionBy("product_id").orderBy("month").rowsBetween(-(frame - 1), 0)
    return (out.select(*ident, "category_name", "month", "units_sold", "revenue",
                       F.round(F.avg("revenue").over(w), 2).alias("rolling_6m_avg_revenue"))
            .orderBy("product_id", "month"))


def monthly_revenue(model: StarModel, as_of, months: int | None = None) -> DataFrame:
    """Revenue, units and distinct transactions per calendar month (RPT-8/9)."""
    cond = (None if months is None
            else D.trailing_months(F.col("sale_date"), as_of, months))
    return (sales_where(model, cond)
            .groupBy(D.month_start(F.col("sale_date")).alias("month"))
            .agg(F.sum("total_amount").alias("revenue"),
                 F.sum("quantity").cast("long").alias("units_sold"),
                 F.count_distinct("sale_id").alias("transactions"))
            .orderBy("month"))
