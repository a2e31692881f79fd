"""Ad-hoc KPI queries: year to date, top product names, critical stock, category share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.functions.numeric import half_up
from shelfwise.operators.common import cents, product_totals
from shelfwise.operators.reports import stock_coverage_view
from shelfwise.sources.model import StarModel


def ytd(model: StarModel, as_of) -> DataFrame:
    """One row: revenue and units since 1 January of ``as_of``'s year, 0 when empty (KPI-1)."""
    return (model.sales.where(D.year_to_date(F.col("sale_date"), as_of))
            .agg(F.coalesce(F.sum("total_amount"), F.lit(0).cast("decimal(24,2)")).alias("ytd_revenue"),
                 F.coalesce(F.sum("quantity").cast("long"), F.lit(0).cast("long")).alias("ytd_units")))


def top_product_names(model: StarModel, as_of, n: int = 10) -> DataFrame:
    """Revenue by product *name* (products sharing a name merge), top ``n`` (KPI-2)."""
    totals = product_totals(model, None)
    names = model.products.select("product_id", "product_name")
    return (totals.join(names, "product_id")
            .groupBy("product_name").agg(F.sum("revenue").alias("revenue"))
            .orderBy(F.desc("revenue"), F.asc("product_name"))
            .limit(n))


def critical_stock(model: StarModel, as_of, days: int = 14) -> DataFrame:
    """Products whose (view) cover is known and below ``days`` (KPI-3)."""
    v = stock_coverage_view(model, as_of)
    return (v.where(F.col("days_of_cover").isNotNull() & (F.col("days_of_cover") < days))
            .select("product_name", "total_stock", "avg_daily_sales", "days_of_cover")
            .orderBy("days_of_cover", "product_name"))


def category_contribution(model: StarModel, as_of, window_days: int = 90) -> DataFrame:
    """Revenue per category and its share (percent, 2 dp) of *all* revenue in
    the window — including sales the category join drops (KPI-4)."""
    totals = product_totals(model, D.trailing_days(F.col("sale_date"), as_of, window_days))
    known = model.categories.select("category_id", "category_name", F.lit(True).alias("known"))
    # one scan: the total is taken over the category rows, the unmatched group among them
    by_cat = (totals.join(model.products.select("product_id", "category_id"), "product_id", "left")
              .join(known, "category_id", "left")
              .groupBy("known", "category_name").agg(F.sum("revenue").alias("revenue"))
              .withColumn("total", F.sum("revenue").over(Window.partitionBy())))
    return (by_cat.where("known")
            .select("category_name", "revenue",
                    (half_up(cents(F.col("revenue")), cents(F.col("total")), 4) * 100).alias("pct"))
            .orderBy(F.desc("revenue"), "category_name"))
