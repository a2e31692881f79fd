"""ETL (E12) and constraint checks (E15), seeds and the demand calendar."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.operators import etl, quality
from shelfwise.sources import seeds
from shelfwise.sources.model import model_from_rows
from tests.conftest import AS_OF, CATS, STORES, product, sale


def test_e12_dedup_ignores_sale_id(make_model):
    m = make_model(sales=[sale(1, "2001-11-01", 1, 2, 20), sale(2, "2001-11-01", 1, 2, 20)])
    clean = etl.transform(etl.extract_sales(m, AS_OF))
    assert clean.count() == 1
    keyed = etl.transform(etl.extract_sales(m, AS_OF).withColumn("sale_id", F.lit(1)), keys=["sale_id"])
    assert keyed.count() == 1


def test_repeats_of_a_hot_product_are_dealt_over_tasks(spark, make_model, monkeypatch):
    monkeypatch.setattr(etl, "ROWS_PER_TASK", 50)
    days = [(dt.date(2000, 1, 1) + dt.timedelta(n)).isoformat() for n in range(600)]
    m = make_model(sales=[sale(n, day, 1, 1, 5) for n, day in enumerate(days)])
    lines = etl.extract_sales(m, AS_OF)
    assert etl.extracted_rows(m, AS_OF) == lines.count() > 500
    clean = etl.transform(lines.unionAll(lines), rows=2 * lines.count())
    spread = [r["count"] for r in clean.groupBy(F.spark_partition_id()).count().collect()]
    # with the partitions of the join all lines of a product were held by one task
    assert sum(spread) == lines.count() and len(spread) > 10 and max(spread) < 100
    for keys in (None, ["sale_date"]):                       # counted, and by keys
        assert etl.transform(lines.unionAll(lines), keys=keys).count() == lines.count()


def test_many_products_are_hashed(spark, make_model, monkeypatch):
    from shelfwise.plans.inspect import executed_plan
    m = make_model(sales=[sale(n, "2001-11-01", n % 3, 1, 5 + n) for n in range(9)])
    want = [sorted(map(tuple, f(m, AS_OF).collect())) for f in (etl.extract_sales, etl.clean_sales)]
    monkeypatch.setattr(etl, "PRODUCTS_HASHED", 2)
    assert "ShuffledHashJoin" in executed_plan(etl.extract_sales(m, AS_OF))
    assert [sorted(map(tuple, f(m, AS_OF).collect())) for f in (etl.extract_sales, etl.clean_sales)] == want
    assert len(want[0]) == 6


def test_transform_columns(make_model):
    m = make_model(sales=[sale(1, "2001-11-04", 1, 3, "10.01")])
    r = etl.transform(etl.extract_sales(m, AS_OF)).collect()[0]
    assert r.month == dt.date(2001, 11, 1) and r.year == 2001 and r.weekday == "Sunday"
    assert float(r.cost_amount) == 6.01 and float(r.gross_profit) == 4.0
    assert float(r.unit_price) == 3.34


def test_quantity_filter(spark):
    bad = (1, dt.date(2001, 11, 1), 1, 1, 0, None, None)
    ok = sale(2, "2001-11-01", 1, 1, 5)
    m = model_from_rows(spark, sales=[bad, ok], products=[product(1)], categories=CATS, stores=STORES)
    assert etl.transform(etl.extract_sales(m, AS_OF)).count() == 1


def test_e15_constraint_report(spark):
    prods = [product(1, sku="A"), product(2, sku="A"), product(3, name=None, sku="C")]
    prods[2] = (3, "C", None, 1, prods[2][4], prods[2][5])
    sales = [sale(1, "2001-11-01", 1, 1, 5), (2, dt.date(2001, 11, 1), 1, 1, 0, None, None),
             sale(3, "2001-11-01", 99, 1, 5)]
    inv = [(1, 1, 5, 20), (1, 1, 6, 20)]
    m = model_from_rows(spark, sales=sales, products=prods, categories=CATS, stores=STORES, inventory=inv)
    rep = {(r.table, r.rule): r.violations for r in quality.constraint_report(m).collect()}
    assert rep[("products", "unique:sku")] == 1
    assert rep[("products", "not_null:product_name")] == 1
    assert rep[("inventory", "unique:product_id,store_id")] == 1
    assert rep[("sales", "foreign_key:product_id->products.product_id")] == 1
    assert rep[("sales", "check:quantity>0")] == 1
    assert rep[("sales", "not_null:unit_price")] == 1
    assert rep[("categories", "unique:category_name")] == 0


def test_defaults(spark):
    m = model_from_rows(spark, inventory=[(1, 1, None, None)])
    r = quality.apply_defaults(m).inventory.collect()[0]
    assert (r.stock_qty, r.reorder_level) == (0, 10)


def test_seed_inventory_rule(make_model):
    prods = [product(1, sku="EL-002"), product(2, sku="CL-003"), product(3, sku="X")]
    sales = [sale(i, "2001-11-01", p, 1, 5, store_id=s) for i, (p, s) in enumerate([(1, 1), (2, 1), (3, 2), (3, 2)])]
    m = make_model(sales=sales, products=prods)
    got = sorted((r.product_id, r.store_id, r.stock_qty, r.reorder_level)
                 for r in seeds.seed_inventory(m).collect())
    assert got == [(1, 1, 5, 20), (2, 1, 50, 20), (3, 2, 100, 20)]


def test_demand_calendar_factors(make_model):
    m = make_model(sales=[sale(1, "2001-01-05", 1, 2, 20), sale(2, "2001-01-07", 1, 1, 5)])
    cal = {r.sale_date: r for r in seeds.demand_calendar(m).collect()}
    assert len(cal) == 3
    assert cal[dt.date(2001, 1, 6)].weekday_factor == 1.3 and cal[dt.date(2001, 1, 6)].units_sold == 0
    assert cal[dt.date(2001, 1, 5)].weekday_factor == 1.0
    import math
    assert abs(cal[dt.date(2001, 1, 5)].season_factor - (1 + 0.15 * math.sin(2 * math.pi * 5 / 365))) < 1e-6


def test_demo_dimensions(spark):
    dims = seeds.demo_dimensions(spark)
    assert dims["products"].count() == 12 and dims["stores"].count() == 4
    assert dims["categories"].count() == 5


def test_clean_sales_equals_transform_of_extract(spark):
    from shelfwise.sources.model import load_model
    from tests.conftest import SF_SMALL
    m = load_model(spark, SF_SMALL)
    a = etl.clean_sales(m, AS_OF)
    b = etl.transform(etl.extract_sales(m, AS_OF))
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
