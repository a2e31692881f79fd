"""BI measures and dashboard datasets, evaluated as Spark aggregates.

Each measure takes the grouping (``by``) that the dashboard visual would
apply; the BI "Date" table is the calendar ending at ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.defaults import COST_RATIO
from shelfwise.functions.numeric import half_up
from shelfwise.operators.common import (cents, join_products, order_totals_by, product_dim, product_totals,
                                        stock_by_product, totals_by)
from shelfwise.operators.reports import stock_coverage
from shelfwise.sources.model import StarModel


def totals(model: StarModel, as_of, by=("category_name",)) -> DataFrame:
    """Total Revenue and Total Units (MSR-1).  Sales of unknown products or
    categories land in a NULL group, as a BI blank row."""
    t = totals_by(model, None, by)
    return t.select(*by, F.col("revenue").alias("total_revenue"),
                    F.col("units").alias("total_units"))


def aov(model: StarModel, as_of, by=("month",)) -> DataFrame:
    """Average order value = revenue / distinct orders, 0 when none (MSR-2), 4 dp.
    ``by`` mixes time and store keys with product and category attributes; an
    order counts once in every group it has lines in."""
    lines = order_totals_by(model, by)
    g = lines.groupBy(*by).agg(F.sum("revenue").alias("revenue"), F.count("sale_id").alias("orders"))
    value = F.coalesce(half_up(cents(F.col("revenue")), F.col("orders") * 100, 4),
                       F.lit(0).cast("decimal(38,4)"))
    return g.select(*by, value.alias("aov"))


def gross_profit_60(model: StarModel, as_of, by=("month",)) -> DataFrame:
    """SUMX(amount - amount * 0.60) (MSR-3): exact in decimal, so it is taken
    on the grouped sum."""
    t = totals_by(model, None, by)
    ratio = F.lit(COST_RATIO).cast("decimal(3,2)")
    return t.select(*by, (F.col("revenue") - F.col("revenue") * ratio).alias("gross_profit"))


def revenue_6m_avg(model: StarModel, as_of, by=("product_id",), months: int = 6) -> DataFrame:
    """Mean of monthly revenue over the months with sales in the ``months``
    calendar months ending at ``as_of`` (MSR-4), 2 dp."""
    per_month = totals_by(model, D.last_n_months(F.col("sale_date"), as_of, months),
                          list(by) + ["month"])
    return (per_month.groupBy(*by)
            .agg(half_up(cents(F.sum("revenue")), F.count(F.lit(1)) * 100, 2).alias("revenue_6m_avg")))


def _coverage_base(model: StarModel, as_of, days: int) -> DataFrame:
    units = product_totals(model, D.last_n_days(F.col("sale_date"), as_of, days)) \
        .select("product_id", "units_sold")
    return (model.products.select("product_id")
            .join(stock_by_product(model), "product_id", "left")
            .join(units, "product_id", "left"))


def coverage_days(model: StarModel, as_of, days: int = 30, by=("product_id",)) -> DataFrame:
    """Stock / (units in the last ``days`` dates / days) (MSR-5) per product or per
    group ``by`` of product and category attributes, over the group's products;
    NULL (BLANK) without sales or without stock.  2 dp."""
    cov = F.when(F.col("units_sold") > 0,
                 half_up(F.col("total_stock") * days, F.col("units_sold"), 2))
    base = _coverage_base(model, as_of, days)
    if list(by) != ["product_id"]:
        base = (base.join(product_dim(model, "left"), "product_id").groupBy(*by)
                .agg(F.sum("total_stock").alias("total_stock"), F.sum("units_sold").alias("units_sold")))
    return base.select(*by, cov.alias("coverage_days"))


def critical_sku_count(model: StarModel, as_of, warn_days: int = 14, days: int = 30) -> DataFrame:
    """Products whose coverage measure is below ``warn_days`` (MSR-7).  A BLANK
    coverage compares as 0, so products without sales or stock count too."""
    known_ok = (F.col("units_sold") > 0) & F.col("total_stock").isNotNull() & \
        (F.col("total_stock") * days >= F.col("units_sold") * warn_days)
    return (_coverage_base(model, as_of, days)
            .agg(F.count_if(~F.coalesce(known_ok, F.lit(False))).alias("critical_skus")))


def top10_revenue(model: StarModel, as_of, n: int = 10) -> DataFrame:
    """Revenue of the top ``n`` product names, ties at rank ``n`` kept (MSR-6).

    The rank-``n`` revenue comes from a distributed top-k (no global window);
    names at or above it are summed.
    """
    totals = product_totals(model, None)
    names = (totals.join(model.products.select("product_id", "product_name"), "product_id")
             .groupBy("product_name").agg(F.sum("revenue").alias("revenue")))
    cutoff = names.orderBy(F.desc("revenue")).limit(n).agg(F.min("revenue")).scalar()
    return names.where(F.col("revenue") >= cutoff).agg(F.sum("revenue").alias("top10_revenue"))


def top_revenue_by(model: StarModel, as_of, by=("month",), n: int = 10) -> DataFrame:
    """The top-``n`` measure inside a visual (MSR-6 in a filter context): for each
    group of ``by`` (time and store keys, category_name) the revenue of its top
    ``n`` product names and how many they are; names that tie at rank ``n`` all
    count.  Ranks are per group; Spark keeps only rows of rank ``n`` or better
    in each task before they are shuffled to their group."""
    by = list(by)
    names = totals_by(model, None, [*by, "product_name"]).where(F.col("product_name").isNotNull())
    ranked = names.withColumn("rank", F.rank().over(Window.partitionBy(*by).orderBy(F.desc("revenue"))))
    return (ranked.where(F.col("rank") <= n).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("names"), F.sum("revenue").alias(f"top{n}_revenue")))


YEAR_GRAINS = ("month", "quarter", "year")


def yoy_growth(model: StarModel, as_of, grain: str = "month") -> DataFrame:
    """Revenue per ``grain`` (month, quarter or year) against the same period a
    year earlier (MSR-8), 6 dp; NULL when last year has no revenue.  The Date table
    ends at ``as_of``, so its period is compared with the same days of last year
    only.  One scan: each period's sums are counted once as its own and once for
    the period a year on."""
    if grain not in YEAR_GRAINS:
        raise ValueError(f"grain must be one of {YEAR_GRAINS}")
    later = F.add_months("sale_date", 12)
    same_period = (F.trunc(later, grain) != F.trunc(D.as_of_col(as_of), grain)) | (later <= D.as_of_col(as_of))
    m = (model.sales.groupBy(F.trunc("sale_date", grain).alias(grain))
         .agg(F.sum("total_amount").alias("own"), F.sum(F.when(same_period, F.col("total_amount"))).alias("next")))
    both = m.select(F.explode(F.array(
        F.struct(F.col(grain), F.col("own").alias("revenue"), F.lit(None).cast("decimal(24,2)").alias("revenue_ly")),
        F.struct(F.add_months(grain, 12).alias(grain), F.lit(None).cast("decimal(24,2)").alias("revenue"),
                 F.when(F.col(grain).isNotNull(), F.col("next")).alias("revenue_ly")))).alias("x")).select("x.*")
    j = (both.groupBy(grain).agg(F.sum("revenue").alias("revenue"), F.sum("revenue_ly").alias("revenue_ly"))
         .where(F.col("revenue").isNotNull()))
    growth = F.when(F.col("revenue_ly") != 0,
                    half_up(cents(F.col("revenue") - F.col("revenue_ly")), cents(F.col("revenue_ly")), 6))
    return j.select(grain, "revenue", "revenue_ly", growth.alias("yoy_growth")).orderBy(grain)


def revenue_by(model: StarModel, as_of, dims=("category_name",), start=None, end=None,
               categories=None, product_ids=None) -> DataFrame:
    """Revenue and units by a dimension with the dashboard slicers (DSH-1):
    category names, a date range and product ids; inner joins as the views."""
    cond = D.date_range(F.col("sale_date"), start, end)
    if product_ids is not None:
        cond = cond & F.col("product_id").isin(list(product_ids))
    out = join_products(product_totals(model, cond), model)
    if categories is not None:
        out = out.where(F.col("category_name").isin(list(categories)))
    return (out
            .groupBy(*dims).agg(F.sum("revenue").alias("revenue"),
                                F.sum("units_sold").cast("long").alias("units_sold"))
            .orderBy(F.desc("revenue"), *dims))


def stock_status_counts(model: StarModel, as_of, warn_days: int = 14) -> DataFrame:
    """Products per stock status (DSH-2 donut)."""
    return (stock_coverage(model, as_of, warn_days).groupBy("stock_status")
            .agg(F.count(F.lit(1)).alias("products")))


BAND_RED, BAND_YELLOW, BAND_GREEN = "red", "yellow", "green"


def cover_bands(model: StarModel, as_of, red_below: float = 14, yellow_below: float = 30) -> DataFrame:
    """Conditional-format band of the displayed days_of_cover (DSH-2):
    red below 14, yellow below 30, green from 30; NULL cover has no band."""
    d = F.col("days_of_cover")
    band = (F.when(d < red_below, F.lit(BAND_RED)).when(d < yellow_below, F.lit(BAND_YELLOW))
            .when(d.isNotNull(), F.lit(BAND_GREEN)))
    return stock_coverage(model, as_of).select("product_id", "product_name", "days_of_cover",
                                               band.alias("cover_band"))
