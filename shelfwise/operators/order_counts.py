"""Exact distinct orders that roll up (AGG-5).

A distinct count of a month says nothing about the year.  The orders of each
(month, category) are therefore kept as bitmaps: an order number's bucket and its
bit in it.  Counts at any coarser grain are the union of those bitmaps, so one
stored table answers them all and no order is shuffled a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.operators.common import join_products
from shelfwise.session import write_once
from shelfwise.sources.model import StarModel

GRAINS = (("month", "category_name"), ("month",), ("category_name",), ())


def order_bitmaps(model: StarModel) -> DataFrame:
    """(month, category_name, bucket, orders): the bitmap of each bucket's orders.

    Lines become one row per (order, month, product), meet the products, and
    become one per (order, month, category) before any bit is set.  Sales of
    unknown products or categories count under a null name; null order numbers
    count nowhere, as in COUNT(DISTINCT).  A bitmap takes 4 KB unpacked; order
    numbers that follow time leave most buckets in few months."""
    lines = (model.sales.where(F.col("sale_id").isNotNull())
             .groupBy("sale_id", D.month_start(F.col("sale_date")).alias("month"), "product_id").agg(F.lit(1).alias("one")))
    orders = (join_products(lines, model, how="left", category="left", cols=())
              .select("sale_id", "month", "category_name").distinct())
    return orders.groupBy("month", "category_name", F.bitmap_bucket_number("sale_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("sale_id")).alias("orders"))


def distinct_orders(model: StarModel) -> DataFrame:
    """grain, month, category_name, orders: distinct orders by month and category,
    by month, by category and in total, all from one stored table of bitmaps."""
    stored = write_once(order_bitmaps(model), "order-bitmaps")
    return count_grains(stored)


def count_grains(stored: DataFrame, grains=GRAINS) -> DataFrame:
    """Distinct orders of each grain from ``order_bitmaps``; names that a grain
    leaves out are null in its rows and ``grain`` tells them from unknown ones."""
    keys = ["month", "category_name"]
    merged = stored.groupingSets([[F.col(k) for k in (*g, "bucket")] for g in grains], *keys, "bucket").agg(
        F.grouping("month").alias("no_month"), F.grouping("category_name").alias("no_category"),
        F.bitmap_count(F.bitmap_or_agg("orders")).alias("n"))
    grain = (F.when((F.col("no_month") == 0) & (F.col("no_category") == 0), "month_category")
             .when(F.col("no_month") == 0, "month").when(F.col("no_category") == 0, "category").otherwise("total"))
    return (merged.groupBy(grain.alias("grain"), *keys).agg(F.sum("n").alias("orders"))
            .select("grain", *keys, "orders"))
