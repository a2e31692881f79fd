"""Extract -> clean/enrich -> save (SRC-6, ETL-1, ETL-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.defaults import COST_RATIO, ETL_LOOKBACK_DAYS
from shelfwise.operators.common import product_dim
from shelfwise.sources.model import StarModel

EXTRACT_COLUMNS = ["sale_date", "product_id", "store_id", "quantity", "unit_price",
                   "total_amount", "sku", "product_name", "category_id", "category_name"]


def _named_products(model: StarModel) -> DataFrame:
    """Products with their category, put together first: sales lines then meet one
    relation, on product_id, and never the few hot category ids."""
    return product_dim(model).select("product_id", "sku", "product_name", "category_id", "category_name")


# From so many products on (where a broadcast no longer serves) each task hashes
# its part of the products and its lines pass by, instead of both being sorted.
PRODUCTS_HASHED = 200_000


def _with_products(lines: DataFrame, model: StarModel) -> DataFrame:
    products = _named_products(model)
    if model.products.count() >= PRODUCTS_HASHED:
        products = products.hint("shuffle_hash")
    return lines.join(products, "product_id").select(*EXTRACT_COLUMNS)


def extract_sales(model: StarModel, as_of, days_back: int = ETL_LOOKBACK_DAYS) -> DataFrame:
    """Sales lines of the look-back window with product and category attributes.

    Row-level enrichment: the fact is shuffled (or, when the dimension is
    measured small at runtime, streamed past a broadcast) on product_id; a hot
    product is split by AQE's skew-join handling rather than one task.
    """
    s = model.sales.where(D.trailing_days(F.col("sale_date"), as_of, days_back))
    return _with_products(s, model)


# Rows that one task of the de-duplication holds: about 60 MB of them, more only
# where they would take more partitions than a map task writes without holding its
# rows to sort them (Spark's default), and never more than about 600 MB.
ROWS_PER_TASK, MOST_ROWS_PER_TASK, UNSORTED_PARTITIONS = 100_000, 1_000_000, 200


def extracted_rows(model: StarModel, as_of, days_back: int = ETL_LOOKBACK_DAYS) -> int:
    """Sales lines of the look-back window, from one column of the fact."""
    return model.sales.where(D.trailing_days(F.col("sale_date"), as_of, days_back)).count()


def _without_repeats(df: DataFrame, keys: list[str], rows: int | None) -> DataFrame:
    """One row per ``keys``.  The rows are dealt by all keys over as many tasks as
    their number needs: what a task holds does not grow with the input, nor with
    a hot product, as it does where the join's few partitions are kept."""
    rows = df.count() if rows is None else rows
    parts = max(min(-(-rows // ROWS_PER_TASK), UNSORTED_PARTITIONS), -(-rows // MOST_ROWS_PER_TASK), 1)
    return df.repartition(parts, *keys).dropDuplicates(keys)


def transform(df: DataFrame, keys: list[str] | None = None, dedupe: bool = True,
              rows: int | None = None) -> DataFrame:
    """Clean and enrich: month, year, weekday, 60 % cost and gross profit;
    drop duplicate rows (over all columns, or over ``keys``); keep quantity > 0.

    The positive-quantity filter commutes with de-duplication (quantity is
    part of the key), so it is applied first and reaches the scan.  The derived
    columns are functions of the given ones, so whole rows are compared before
    they are derived.  ``rows`` says about how many rows ``df`` has; without it
    they are counted.
    """
    ratio = F.lit(COST_RATIO).cast("decimal(3,2)")
    cost = F.round(F.col("total_amount") * ratio, 2)
    kept = df.where(F.col("quantity") > 0)
    if dedupe and not keys:
        kept = _without_repeats(kept, kept.columns, rows)
    out = (kept
           .withColumn("month", D.month_start(F.col("sale_date")))
           .withColumn("year", F.year("sale_date"))
           .withColumn("weekday", F.date_format("sale_date", "EEEE"))
           .withColumn("cost_amount", cost)
           .withColumn("gross_profit", F.round(F.col("total_amount") - cost, 2)))
    return _without_repeats(out, keys, rows) if dedupe and keys else out


FACT_COLUMNS = ["sale_date", "product_id", "store_id", "quantity", "unit_price", "total_amount"]


def clean_sales(model: StarModel, as_of, days_back: int = ETL_LOOKBACK_DAYS) -> DataFrame:
    """``transform(extract_sales(...))`` with the de-duplication moved before
    the enrichment join.

    The joined attributes are functions of ``product_id`` (the product key)
    and the derived columns are functions of the fact columns, so two
    extracted rows are equal exactly when their six fact columns are equal.
    De-duplicating those first shuffles six narrow columns instead of fifteen,
    and the join then enriches each distinct line once.
    """
    s = (model.sales.where(D.trailing_days(F.col("sale_date"), as_of, days_back))
         .where(F.col("quantity") > 0)
         .select(*FACT_COLUMNS).dropDuplicates())
    return transform(_with_products(s, model), dedupe=False)


def run_etl(model: StarModel, as_of, out_root: str | None = None,
            days_back: int = ETL_LOOKBACK_DAYS) -> DataFrame:
    """Extract, transform and (when ``out_root`` is given) save as Parquet and CSV."""
    clean = clean_sales(model, as_of, days_back)
    if out_root:
        from shelfwise.sinks.writers import save_processed
        save_processed(clean, out_root)
    return clean
