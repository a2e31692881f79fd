"""Dashboard slicers (FLT-9, DSH-3) applied to the model, so every report,
KPI and measure can be sliced by category, date range and product."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.operators import daily_state
from shelfwise.sources.model import StarModel


def apply_slicers(model: StarModel, categories=None, start=None, end=None,
                  product_ids=None, fact: bool | str = True) -> StarModel:
    """A model restricted to the selected categories (by name), sale dates
    and products.  Products outside the selection disappear from the
    dimension as well, so outer-joined reports (low sellers, stock cover)
    list only selected products.

    ``fact`` says how a category selection reaches the sales.  ``"summed"``: sales
    are summed per day, product and store first, and only those sums meet the
    selected products; for every report and KPI that sums quantity and
    total_amount.  ``False``: the sales keep all categories; enough for reports
    that look the products up anyway (sellers, stock cover).  ``True``: single
    lines are matched, for reports that need them (distinct orders, mean per line)."""
    products, sales = model.products, model.sales
    if categories is not None:
        chosen = model.categories.where(F.col("category_name").isin(list(categories))).select("category_id")
        products = products.join(chosen, "category_id", "left_semi")
    if product_ids is not None:
        ids = list(product_ids)
        products = products.where(F.col("product_id").isin(ids))
        sales = sales.where(F.col("product_id").isin(ids))
    if start is not None or end is not None:
        sales = sales.where(D.date_range(F.col("sale_date"), start, end))
    if categories is not None and fact == "summed":
        # an inner join by distinct ids: a semi join would be pushed below the sums
        sales = (daily_state.summed(sales).join(products.select("product_id").distinct(), "product_id")
                 .select(*daily_state.STATE_SCHEMA.fieldNames()))
    elif categories is not None and fact:
        sales = sales.join(products.select("product_id"), "product_id", "left_semi")
    return StarModel(sales, products, model.categories, model.stores, model.inventory)
