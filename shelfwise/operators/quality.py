"""Data-quality checks re-expressing the schema's constraints (DQ-1..5).

Spark does not enforce NOT NULL / UNIQUE / FOREIGN KEY / CHECK, so each
becomes an aggregate: one pass per table for its keys and row rules, and
``groupBy(key)`` for the other unique columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.model import StarModel

# The constraints declared by the reference schema.
NOT_NULL = {
    "categories": ["category_name"],
    "stores": ["store_name"],
    "products": ["sku", "product_name", "unit_price", "cost_price"],
    "inventory": ["stock_qty", "reorder_level"],
    "sales": ["sale_date", "quantity", "unit_price", "total_amount"],
}
PRIMARY_KEYS = {"categories": "category_id", "stores": "store_id", "products": "product_id", "sales": "sale_id"}
UNIQUE = {
    "categories": [["category_name"]],
    "products": [["sku"]],
    "inventory": [["product_id", "store_id"]],
}
# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("products", "category_id", "categories", "category_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("inventory", "store_id", "stores", "store_id"),
    ("sales", "product_id", "products", "product_id"),
    ("sales", "store_id", "stores", "store_id"),
]
DEFAULTS = {"inventory": {"stock_qty": 0, "reorder_level": 10}}

REPORT_SCHEMA = "table string, rule string, violations bigint"


def _row(table: str, rule: str, count_col) -> list:
    return [F.lit(table).alias("table"), F.lit(rule).alias("rule"),
            count_col.cast("long").alias("violations")]


# (table, rule name, violation predicate): a NULL never violates a CHECK
CHECKS = [("sales", "check:quantity>0", lambda: F.col("quantity") <= 0)]


def _key_checks(model: StarModel, table: str) -> list[DataFrame]:
    """PRIMARY KEY: rows beyond the first of each key, and rows without one.  The
    aggregate carries the key and its count only."""
    if table not in PRIMARY_KEYS:
        return []
    key = PRIMARY_KEYS[table]
    keys = getattr(model, table).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    refused = F.when(F.col(key).isNull(), F.col("rows")).otherwise(F.col("rows") - 1)
    return [keys.agg(F.coalesce(F.sum(refused), F.lit(0)).alias("n")).select(
        *_row(table, f"primary_key:{key}", F.col("n")))]


def _rule_checks(model: StarModel, table: str) -> DataFrame:
    """NOT NULL, CHECK and FOREIGN KEY counts in one scan.  Rows are counted by
    their parent keys first; those few groups become one (kind, key) row for each
    key and meet the distinct parent keys in an outer join: semi and anti joins
    would be pushed below the aggregate and join raw rows.  NULL keys have no
    parent to miss, as in SQL."""
    own = [(f"not_null:{c}", F.col(c).isNull()) for c in NOT_NULL[table]]
    own += [(name, pred()) for t, name, pred in CHECKS if t == table]
    links = [(c, p, pc) for child, c, p, pc in FOREIGN_KEYS if child == table]
    counted = getattr(model, table).groupBy(*[c for c, _, _ in links]).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(pred).alias(f"r{i}") for i, (_, pred) in enumerate(own)])
    sums = [(name, F.sum(f"r{i}")) for i, (name, _) in enumerate(own)]
    if links:
        first = [F.sum(F.when(F.col("kind") == 0, F.col(f"r{i}"))).alias(f"r{i}") for i in range(len(own))]
        keys = (counted.select("rows", *[f"r{i}" for i in range(len(own))],
                               F.posexplode(F.array(*[F.col(c).cast("long") for c, _, _ in links])).alias("kind", "k"))
                .groupBy("kind", "k").agg(F.sum("rows").alias("rows"), *first))
        parents = reduce(DataFrame.union, [
            getattr(model, p).select(F.lit(i).alias("kind"), F.col(pc).cast("long").alias("k"))
            for i, (_, p, pc) in enumerate(links)]).distinct()
        counted = keys.join(parents.withColumn("found", F.lit(True)), ["kind", "k"], "left")
        sums += [(f"foreign_key:{c}->{p}.{pc}",
                  F.sum(F.when((F.col("kind") == i) & F.col("k").isNotNull() & F.col("found").isNull(), F.col("rows"))))
                 for i, (c, p, pc) in enumerate(links)]
    counts = counted.agg(*[F.coalesce(n, F.lit(0)).alias(f"n{i}") for i, (_, n) in enumerate(sums)])
    return counts.select(F.explode(F.array(*[
        F.struct(*_row(table, name, F.col(f"n{i}"))) for i, (name, _) in enumerate(sums)])).alias("r")).select("r.*")


def table_checks(model: StarModel) -> list[DataFrame]:
    """All counts of each table: its rules and foreign keys in one narrow
    aggregate, its primary key in another."""
    return [part for table in sorted(NOT_NULL) for part in [_rule_checks(model, table), *_key_checks(model, table)]]


def unique_checks(model: StarModel) -> list[DataFrame]:
    """Rows a UNIQUE constraint would refuse: sum(count - 1) over repeated keys.
    NULL keys never collide, as in SQL."""
    out = []
    for table, keysets in UNIQUE.items():
        df = getattr(model, table)
        for keys in keysets:
            not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
            dup = (df.where(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") > 1)
                   .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))))
            out.append(dup.select(*_row(table, "unique:" + ",".join(keys), F.col(dup.columns[0]))))
    return out


def _union_all(parts: list[DataFrame]) -> DataFrame:
    """Union frames of one schema as a balanced tree: each ``union`` call is
    analysed eagerly, so a left-deep chain would re-analyse the growing plan
    n times.  Catalyst flattens the tree into one Union either way."""
    while len(parts) > 1:
        parts = [parts[i].union(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def constraint_report(model: StarModel) -> DataFrame:
    """table, rule, violations for every declared constraint (DQ-1..4)."""
    parts = table_checks(model) + unique_checks(model)
    return _union_all([p.select("table", "rule", "violations") for p in parts])


def apply_defaults(model: StarModel) -> StarModel:
    """Fill the declared column defaults (DQ-5)."""
    inv = model.inventory.fillna(DEFAULTS["inventory"])
    return StarModel(model.sales, model.products, model.categories, model.stores, inv)
