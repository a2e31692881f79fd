"""Building blocks shared by the reports.

The fact table is always aggregated to the join key *before* it meets a
dimension: the join then moves one row per product instead of one per sale,
and the dimension side never fans the fact out.  ``join_products`` attaches
product attributes on ``product_id`` first and category names last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.model import StarModel


def product_dim(model: StarModel, category: str = "inner") -> DataFrame:
    """product_id, sku, product_name, category_id, cost_price [, category_name].

    ``category='inner'`` drops products without a known category (the SQL
    views' inner join); ``'left'`` keeps them with a NULL name; ``None``
    skips the category join.
    """
    p = model.products.select("product_id", "sku", "product_name", "category_id", "cost_price")
    if category is None:
        return p
    c = model.categories.select("category_id", "category_name")
    return p.join(c, "category_id", category)


PRODUCT_COLUMNS = ("sku", "product_name", "category_id", "cost_price")


def join_products(df: DataFrame, model: StarModel, how: str = "inner", category: str | None = "inner",
                  cols=PRODUCT_COLUMNS, products_left: bool = False) -> DataFrame:
    """Attach product attributes (and the category name) to a frame keyed by
    ``product_id``.

    The product join comes first, on ``product_id``: the per-product
    aggregate is already hash-partitioned on it and a product table bucketed
    by it is read in place.  Category names are attached last, to at most one
    row per product; that side is the small category list (broadcast when
    its measured size allows, else a skew-split shuffle join).
    ``products_left`` keeps every product (``products LEFT JOIN df``).
    """
    keep = [c for c in cols if c != "category_id"] + ["category_id"]
    p = model.products.select("product_id", *keep)
    out = p.join(df, "product_id", "left") if products_left else df.join(p, "product_id", how)
    if category is None:
        return out
    c = model.categories.select("category_id", "category_name")
    return out.join(c, "category_id", category)


def sales_where(model: StarModel, cond: Column | None) -> DataFrame:
    return model.sales if cond is None else model.sales.where(cond)


def product_totals(model: StarModel, cond: Column | None) -> DataFrame:
    """Per product: units_sold (bigint), revenue (decimal)."""
    return (sales_where(model, cond)
            .groupBy("product_id")
            .agg(F.sum("quantity").cast("long").alias("units_sold"),
                 F.sum("total_amount").alias("revenue")))


def stock_by_product(model: StarModel) -> DataFrame:
    """Per product: summed stock over all stores (bigint)."""
    return (model.inventory.groupBy("product_id")
            .agg(F.sum("stock_qty").cast("long").alias("total_stock")))


def cents(money: Column) -> Column:
    """Integral cents of a 2-dp money value, as DECIMAL(20,0)."""
    return (money * 100).cast("decimal(20,0)")


_TIME_KEYS = {
    "month": lambda: F.trunc(F.col("sale_date"), "month"),
    "year": lambda: F.year(F.col("sale_date")).cast("long"),
    "sale_date": lambda: F.col("sale_date"),
    "store_id": lambda: F.col("store_id"),
}


def totals_by(model: StarModel, cond: Column | None, by=()) -> DataFrame:
    """Revenue and units grouped by any mix of time/store keys and product or
    category attributes.  The fact is pre-aggregated per (product, time keys)
    so the dimension join moves aggregated rows only."""
    by = list(by)
    fact_keys = [k for k in by if k in _TIME_KEYS]
    dim_keys = [k for k in by if k not in _TIME_KEYS and k != "product_id"]
    if not dim_keys and "product_id" not in by:
        # nothing to join: aggregate the fact by the time keys directly
        return (sales_where(model, cond)
                .groupBy(*[_TIME_KEYS[k]().alias(k) for k in by])
                .agg(F.sum("total_amount").alias("revenue"),
                     F.sum("quantity").cast("long").alias("units")))
    pre = (sales_where(model, cond)
           .groupBy("product_id", *[_TIME_KEYS[k]().alias(k) for k in fact_keys])
           .agg(F.sum("total_amount").alias("revenue"),
                F.sum("quantity").cast("long").alias("units")))
    if dim_keys:
        pre = join_products(pre, model, how="left",
                            category="left" if "category_name" in dim_keys else None,
                            cols=[k for k in dim_keys if k != "category_name"])
    return pre.groupBy(*by).agg(F.sum("revenue").alias("revenue"),
                                F.sum("units").cast("long").alias("units"))


def order_totals_by(model: StarModel, by=()) -> DataFrame:
    """(by..., sale_id, revenue): one row per order and group.  Product and category
    attributes are looked up by rows already summed per (order, product)."""
    by = list(by)
    fact = [k for k in by if k in _TIME_KEYS]
    dims = [k for k in by if k not in _TIME_KEYS and k != "product_id"]
    keys = [_TIME_KEYS[k]().alias(k) for k in fact]
    if dims or "product_id" in by:
        keys.append(F.col("product_id"))
    pre = model.sales.groupBy("sale_id", *keys).agg(F.sum("total_amount").alias("revenue"))
    if not dims:
        return pre
    pre = join_products(pre, model, how="left", category="left" if "category_name" in dims else None,
                        cols=[k for k in dims if k != "category_name"])
    return pre.groupBy("sale_id", *by).agg(F.sum("revenue").alias("revenue"))
