"""Seed and derived rows: demo dimensions, inventory seeding, demand calendar."""

from __future__ import annotations

import math
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.functions.demand import CELL_SCHEMA, RUN_SCHEMA, draw_tile, sum_runs
from shelfwise.functions.numbering import PRIME, numbered
from shelfwise.sources.model import (CATEGORIES_SCHEMA, PRODUCTS_SCHEMA, STORES_SCHEMA,
                                     StarModel)

# The reference's demo seed rows (categories, stores, products),
# and its inventory seeding rule (sku EL-002 -> 5 units, CL-003 -> 50, else
# 100; reorder level 20).
DEMO_CATEGORIES = [
    (1, "Electronics"),
    (2, "Clothing"),
    (3, "Groceries"),
    (4, "Home & Kitchen"),
    (5, "Sports & Outdoors"),
]
DEMO_STORES = [
    (1, "Downtown Flagship", "North", "New York"),
    (2, "Mall Central", "East", "Boston"),
    (3, "Westgate Outlet", "West", "Los Angeles"),
    (4, "South Plaza", "South", "Houston"),
]
DEMO_PRODUCTS = [
    (1, "EL-001", "Wireless Headphones", 1, "89.99", "35.00"),
    (2, "EL-002", '4K Smart TV 55"', 1, "599.00", "380.00"),
    (3, "EL-003", "Bluetooth Speaker", 1, "49.50", "18.00"),
    (4, "CL-001", "Men's Running Shoes", 2, "79.99", "32.00"),
    (5, "CL-002", "Women's Jacket", 2, "129.00", "55.00"),
    (6, "CL-003", "Cotton T-Shirt", 2, "19.99", "6.50"),
    (7, "GR-001", "Organic Coffee Beans", 3, "14.99", "5.00"),
    (8, "GR-002", "Premium Olive Oil", 3, "24.50", "9.00"),
    (9, "HK-001", "Stainless Cookware", 4, "199.00", "85.00"),
    (10, "HK-002", "Memory Foam Pillow", 4, "39.99", "12.00"),
    (11, "SP-001", "Yoga Mat", 5, "29.99", "9.50"),
    (12, "SP-002", "Dumbbell Set 20kg", 5, "89.00", "42.00"),
]
SEED_STOCK_BY_SKU = {"EL-002": 5, "CL-003": 50}
SEED_DEFAULT_STOCK = 100
SEED_REORDER_LEVEL = 20

# Fixed values of the demand calendar: weekends (Saturday, Sunday) x1.3, and
# a yearly season factor 1 + 0.15 * sin(2 * pi * day_of_year / 365).
WEEKEND_FACTOR = 1.3
SEASON_AMPLITUDE = 0.15

# Fixed values of the demand grid: a product sells in a store on 55 % of the
# days; Poisson mean 0.5 for every fourth product id, 3 for the others; 1 unit at
# least.
SELL_CHANCE = 0.55
SLOW_EVERY, SLOW_MEAN, USUAL_MEAN = 4, 0.5, 3.0

# Tiles of the demand grid: how many are aimed at, the least and most cells of one, and the most rows
# of a block of products or stores.
TILES, TILE_CELLS, BLOCK_ROWS = 256, (2 ** 20, 2 ** 30), 65_536


def demo_dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    """The literal demo dimension rows (SRC-4)."""
    products = [(pid, sku, name, cat, Decimal(up), Decimal(cp))
                for pid, sku, name, cat, up, cp in DEMO_PRODUCTS]
    return {
        "categories": spark.createDataFrame(DEMO_CATEGORIES, CATEGORIES_SCHEMA),
        "stores": spark.createDataFrame(DEMO_STORES, STORES_SCHEMA),
        "products": spark.createDataFrame(products, PRODUCTS_SCHEMA),
    }


def seed_inventory(model: StarModel, stock_by_sku: dict[str, int] | None = None,
                   default_stock: int = SEED_DEFAULT_STOCK,
                   reorder_level: int = SEED_REORDER_LEVEL) -> DataFrame:
    """Initial stock rows (SRC-5), one per (product, store) pair.

    The reference seeds every product in every store.  A products x stores
    product grows quadratically, so the pairs here are the assortment the
    sales fact shows each store carrying (an aggregate, not a Cartesian
    product); the stock rule matches sku patterns with LIKE.
    """
    rules = stock_by_sku if stock_by_sku is not None else SEED_STOCK_BY_SKU
    pairs = model.sales.select("product_id", "store_id").distinct()
    skus = model.products.select("product_id", "sku")
    stock = F.lit(default_stock)
    for pattern, qty in reversed(list(rules.items())):
        stock = F.when(F.col("sku").like(pattern), F.lit(qty)).otherwise(stock)
    return (pairs.join(skus, "product_id")
            .select("product_id", "store_id", stock.cast("int").alias("stock_qty"),
                    F.lit(reorder_level).cast("int").alias("reorder_level")))


def day_factors(day: Column) -> tuple[Column, Column]:
    """weekday_factor and season_factor (to a millionth) of a date."""
    weekend = F.dayofweek(day).isin(1, 7)                   # 1 = Sunday, 7 = Saturday
    season = F.lit(1.0) + F.lit(SEASON_AMPLITUDE) * F.sin(F.lit(2 * math.pi) * F.dayofyear(day) / F.lit(365))
    return (F.when(weekend, F.lit(WEEKEND_FACTOR)).otherwise(F.lit(1.0)).alias("weekday_factor"),
            (F.floor(season * 1e6 + 0.5) / 1e6).alias("season_factor"))


def poisson_steps(mean: float) -> list[int]:
    """Inverse table of a Poisson distribution: the draw reaches step k - 1 when
    the value is k or more; it ends where no draw can reach on."""
    steps, chance, below = [], math.exp(-mean), 0.0
    for k in range(1, 200):
        below += chance
        step = math.floor(below * PRIME)
        if step >= PRIME - 1:
            break
        steps.append(step)
        chance *= mean / k
    return steps


def _tile_sizes(n_products: int, n_stores: int, days: int) -> tuple[int, int]:
    """Products and stores of a tile: TILES tiles of even size if that leaves each a number of cells
    within TILE_CELLS; the more rows a block of products repeats in many tiles, the longer it is made."""
    pairs = min(max(n_products * n_stores * days // TILES, TILE_CELLS[0]), TILE_CELLS[1]) // max(1, days) + 1
    products = min(n_products, BLOCK_ROWS, max(math.isqrt(4 * pairs), pairs // max(1, n_stores)))
    products = -(-n_products // -(-n_products // products)) if products else 1
    return products, max(1, min(n_stores, BLOCK_ROWS, pairs // products))


def _blocks(numbered_rows: DataFrame, number: str, size: int, block: str) -> DataFrame:
    """One row for each ``size`` consecutive numbers: ``block``, and the other columns as arrays in order of number."""
    columns = [c for c in numbered_rows.columns if c != number]
    return (numbered_rows.groupBy(F.expr(f"{number} div {size}").alias(block))
            .agg(F.sort_array(F.collect_list(F.struct(number, *columns))).alias("rows"))
            .select(block, *(F.col(f"rows.{c}").alias(c) for c in columns)))


def demand_grid(model: StarModel, start, end, combine: tuple[Callable, str] | None = None) -> DataFrame:
    """Simulated sales at their own grain (SRC-9): every product in every store on
    every day from ``start`` to ``end`` sells with chance 0.55 a Poisson number of
    units times the day's factors, one at least.

    Columns: sale_date, product_id, store_id, quantity, unit_price, total_amount.
    A cell's number has three digits, (product, store, day), in mixed radix; its
    draws are functions of that number, so the same cell always sells the same,
    whatever else is asked for, and any lost task is computed again alike.  The
    cells are a ``range`` in strides of a block of products, cut into tiles by
    blocks of stores.  A tile meets the rows of its two blocks before it is dealt
    to a task, which draws it by the batch: a block is sent once for a tile, the
    cells are not joined, shuffled or kept.

    ``combine``: a function from a record batch of such rows to a shorter one, and
    the schema of that; it is applied to each batch in the task that draws it, for
    readers that sum the rows.  Within a batch the rows are in order of day and store.
    """
    spark = model.products.sparkSession
    products = numbered(model.products.select("product_id", "unit_price"), "product_id", "product_no")
    stores = numbered(model.stores.select("store_id"), "store_id", "store_no")
    n_products, n_stores = model.products.count(), model.stores.count()
    first, last = spark.range(1).select(F.unix_date(D.as_of_col(start)), F.unix_date(D.as_of_col(end))).first()
    days = max(0, last - first + 1)
    per_tile = _tile_sizes(n_products, n_stores, days)
    stride, store_blocks = max(1, per_tile[0] * n_stores * days), max(1, -(-n_stores // per_tile[1]))
    chance, steps = math.floor(SELL_CHANCE * PRIME), [poisson_steps(mean) for mean in (USUAL_MEAN, SLOW_MEAN)]
    reduce, schema = combine or (None, CELL_SCHEMA)

    def sell(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                block, store_block, *arrays = (column[row] for column in batch.columns)
                cells = draw_tile(block.as_py() * per_tile[0], store_block.as_py() * per_tile[1],
                                  *(array.values for array in arrays), n_stores, SLOW_EVERY, chance, steps)
                yield from cells if reduce is None else map(reduce, cells)

    calendar = F.transform(F.sequence(F.lit(first), F.lit(max(first, last))), lambda day: F.struct(
        day.alias("day_no"), *day_factors(F.date_from_unix_date(day))))
    tiles = (spark.range(0, n_products * n_stores * days, stride)
             .select(F.expr(f"id div {stride}").alias("products_block"),
                     F.explode(F.expr(f"sequence(0L, {store_blocks - 1}L)")).alias("stores_block"))
             .join(_blocks(stores.select("store_no", "store_id"), "store_no", per_tile[1], "stores_block"), "stores_block")
             .join(_blocks(products.select("product_no", "product_id", (F.col("unit_price") * 100).cast("long").alias("cents")),
                           "product_no", per_tile[0], "products_block"), "products_block")
             .select("products_block", "stores_block", "product_id", "cents", "store_id", calendar.alias("calendar")))
    # a tile is long work on few bytes: without a fixed number, small tiles would be put together into few tasks
    n_tiles = -(-n_products // per_tile[0]) * store_blocks
    return tiles.repartition(max(1, min(n_tiles, 10_000))).mapInArrow(sell, schema)


def demand_by_store(model: StarModel, start, end) -> DataFrame:
    """The demand grid summed per day and store: products sold, units, revenue.
    Rows of one batch are summed where they are drawn, those sums by the shuffle."""
    sums = demand_grid(model, start, end, combine=(sum_runs, RUN_SCHEMA))
    return sums.groupBy("sale_date", "store_id").agg(
        F.sum("products_sold").alias("products_sold"), F.sum("units").alias("units"),
        F.sum("revenue").cast("decimal(24,2)").alias("revenue"))


def demand_calendar(model: StarModel, start=None, end=None) -> DataFrame:
    """Daily demand calendar (SRC-9): each day from ``start`` to ``end``
    (default: the sales date range) with its weekday and season factors and
    the units and revenue actually sold that day (0 on days without sales).

    The day spine comes from one aggregated row, so it is as long as the date
    range, not the data; the daily actuals are a partial+final aggregate.
    """
    daily = (model.sales.groupBy("sale_date")
             .agg(F.sum("quantity").cast("long").alias("units_sold"),
                  F.sum("total_amount").alias("revenue")))
    lo = D.as_of_col(start) if start is not None else F.min("sale_date")
    hi = D.as_of_col(end) if end is not None else F.max("sale_date")
    # the range comes from the daily aggregate, not a second pass over the fact
    days = (daily.agg(lo.alias("lo"), hi.alias("hi"))
            .select(F.explode(F.sequence("lo", "hi")).alias("sale_date")))
    cal = days.select("sale_date", *day_factors(F.col("sale_date")))
    return (cal.join(daily, "sale_date", "left")
            .select("sale_date", "weekday_factor", "season_factor",
                    F.coalesce("units_sold", F.lit(0).cast("long")).alias("units_sold"),
                    F.coalesce("revenue", F.lit(0).cast("decimal(24,2)")).alias("revenue")))
