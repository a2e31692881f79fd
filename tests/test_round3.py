"""Rows refused on write, the daily state, the demand grid, order bitmaps, top names by group, growth by grain."""

import datetime as dt
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.functions.numbering import PRIME, draw, draw_array, numbered
from shelfwise.operators import (daily_state, forecast, kpis, measures, order_counts, quality, quarantine, reports,
                                 summary)
from shelfwise.operators.slicers import apply_slicers
from shelfwise.plans import jobs
from shelfwise.plans.inspect import executed_plan, raw_fact_joins
from shelfwise.sinks import batches
from shelfwise.sources import seeds
from shelfwise.sources.model import StarModel
from tests.conftest import AS_OF, money, product, sale


def broken(df):
    return {r[0]: r[1] for r in df.select("sale_id", "broken_rules").collect()}


def test_rows_are_refused_by_rule(spark, make_model):
    good = sale(1, "2001-11-01", 1, 2, 20)
    bad = [(2, None, 1, 1, 2, money(10), money(20)), (3, good[1], 9, 1, 1, money(1), money(1)),
           (4, good[1], None, None, 0, money(1), money(1)), (5, good[1], 1, 77, -3, None, None),
           (6, good[1], 2, 1, None, money(1), money(1)), (None, good[1], 2, 1, 1, money(1), money(1))]
    twice = [sale(7, "2001-11-02", 1, 1, 5), sale(7, "2001-11-02", 2, 4, 9)]
    m = make_model(sales=[good, *bad, *twice])
    found = quarantine.split(m.sales, "sales", m)
    assert broken(found.quarantined) == {
        2: ["not_null:sale_date"], 3: ["foreign_key:product_id->products.product_id"],
        4: ["check:quantity>0"], 5: ["check:quantity>0", "foreign_key:store_id->stores.store_id",
                                     "not_null:total_amount", "not_null:unit_price"],
        6: ["not_null:quantity"], None: ["primary_key:sale_id"], 7: ["primary_key:sale_id"]}
    assert found.accepted.columns == m.sales.columns
    kept = [tuple(r) for r in found.accepted.orderBy("sale_id").collect()]
    assert kept == [good, twice[0]]                       # the first of the batch stays
    assert found.counts["rows"] == 9 and found.counts["accepted"] == 2 and found.counts["primary_key:sale_id"] == 2
    # what is refused is what the report counts, and what passes has nothing to report
    after = StarModel(found.accepted, m.products, m.categories, m.stores, m.inventory)
    assert all(r.violations == 0 for r in quality.constraint_report(after).where("table = 'sales'").collect())
    report = {r.rule: r.violations for r in quality.constraint_report(m).where("table = 'sales'").collect()}
    assert report == {k: v for k, v in found.counts.items() if k not in ("rows", "accepted")}


def test_other_tables_are_judged_too(spark, make_model):
    m = make_model(products=[product(1, sku="a"), product(2, sku="a"), product(3, sku=None), product(4, category_id=9),
                             (5, None, None, None, None, None)], inventory=[(1, 1, 5, 1), (1, 1, 6, 1), (2, 9, None, 2)])
    found = quarantine.split(m.products, "products", m).quarantined
    rules = {r["product_id"]: r["broken_rules"] for r in found.collect()}
    assert rules == {2: ["unique:sku"], 4: ["foreign_key:category_id->categories.category_id"],
                     5: [f"not_null:{c}" for c in ("cost_price", "product_name", "sku", "unit_price")]}
    stock = quarantine.split(m.inventory, "inventory", m)
    assert [r["broken_rules"] for r in stock.quarantined.orderBy("stock_qty").collect()] == [
        ["foreign_key:store_id->stores.store_id", "not_null:stock_qty"], ["unique:product_id,store_id"]]
    empty = make_model()
    assert quarantine.split(empty.sales, "sales", empty).counts["rows"] == 0


def test_only_bad_keys_come_back_to_the_rows(spark, make_model):
    """A product with most rows: the foreign-key search sees it as one row."""
    m = make_model(sales=[sale(i, "2001-11-01", 1 if i % 10 else 50 + i, 1, 10) for i in range(300)])
    found = quarantine.split(m.sales, "sales", m)
    assert found.counts["foreign_key:product_id->products.product_id"] == 30 and found.accepted.count() == 270


def many_sales(n=400):
    return [sale(i, dt.date(2001, 1 + i % 11, 1 + i * 7 % 28), 1 + i * i % 5, 1 + i % 3, 10 + i % 17, 1 + i % 2)
            for i in range(n)]


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_state_gives_the_reports_of_the_lines(spark, make_model, tmp_out):
    m = make_model(sales=many_sales(), products=[product(i) for i in range(1, 6)],
                   inventory=[(i, 1, 3 * i, 1) for i in range(1, 6)])
    fact, path = f"{tmp_out}/sales", f"{tmp_out}/daily"
    assert daily_state.refresh(spark, fact, path) == []
    for month in range(1, 12):
        batches.append_batch(m.sales.where(F.month("sale_date") == month), fact, f"m{month}")
        dates = daily_state.refresh(spark, fact, path)
        assert dates and {d.month for d in dates} == {month}          # the new dates and no other
    assert daily_state.refresh(spark, fact, path) == []
    state = daily_state.as_model(m, spark, path)
    for report in (reports.top_sellers, reports.low_sellers, reports.stock_coverage, reports.six_month_average,
                   reports.top_sellers_view, kpis.ytd, kpis.category_contribution, kpis.top_product_names,
                   forecast.forecast_total, forecast.forecast_products, measures.yoy_growth, measures.top10_revenue,
                   measures.top_revenue_by, summary.daily_summary):
        same(report(state, AS_OF), report(m, AS_OF))
    plan = executed_plan(reports.top_sellers(state, AS_OF))
    assert "PartitionFilters: [isnotnull(sale_date" in plan
    # only the new dates' files are opened
    scan = executed_plan(daily_state.summed(batches.read_fact(spark, fact).where(F.col("sale_date").isin(dates[:1]))))
    assert re.search(rf"PartitionFilters: \[.*sale_date#\d+ = {dates[0]}", scan)


def test_state_follows_a_replaced_batch(spark, make_model, tmp_out):
    a = make_model(sales=[sale(1, "2001-11-01", 1, 2, 20), sale(2, "2001-11-02", 1, 1, 7)])
    b = make_model(sales=[sale(1, "2001-11-01", 1, 5, 50)])
    fact, path = f"{tmp_out}/sales", f"{tmp_out}/daily"
    batches.append_batch(a.sales, fact, "x")
    assert len(daily_state.refresh(spark, fact, path)) == 2
    batches.append_batch(b.sales, fact, "x", rerun=True)
    assert len(daily_state.refresh(spark, fact, path)) == 2
    got = [(r.sale_date, r.quantity, r.lines) for r in daily_state.read_state(spark, path).collect()]
    assert got == [(dt.date(2001, 11, 1), 5, 1)]


def test_daily_run_twice_is_once(spark, make_model, tmp_out):
    m = make_model(sales=many_sales(), products=[product(i) for i in range(1, 6)],
                   inventory=[(i, 1, 3, 1) for i in range(1, 6)])
    bad = m.sales.limit(3).withColumn("quantity", F.lit(-1)).withColumn("sale_id", F.col("sale_id") + 1000)
    for again in (False, True):
        out = jobs.run_daily(spark, m.sales.union(bad), m, tmp_out, "day-1", AS_OF)
        assert out["counts"]["rows"] == (0 if again else 403)
    assert batches.read_fact(spark, f"{tmp_out}/sales").count() == 400
    assert spark.read.parquet(f"{tmp_out}/quarantine").count() == 3
    top = spark.read.parquet(f"{tmp_out}/reports/analytics/run_date=20011104/Top_Sellers/parquet")
    same(top, reports.top_sellers(m, AS_OF))


def plain_draw(cell, salt):
    x = (cell % PRIME * 48_271 + cell // PRIME % PRIME * 69_621 + salt * 1_000_003) % PRIME
    for bits, factor in ((15, 1_597_334_677), (13, 1_132_489_760)):
        x = (x ^ x >> bits) * factor % PRIME
    return (x ^ x >> 16) % PRIME


def test_draws_are_even_and_repeatable(spark):
    cells = spark.range(0, 200_000).withColumn("big", F.col("id") * 7_919_000_000_003)
    for column in ("id", "big"):
        got = cells.select(column, draw(F.col(column), 1).alias("a"), draw(F.col(column), 2).alias("b")).collect()
        assert all(r.a == plain_draw(r[0], 1) and r.b == plain_draw(r[0], 2) for r in got[::997])
        a, b = [r.a / PRIME for r in got], [r.b / PRIME for r in got]
        assert abs(sum(a) / len(a) - 0.5) < 0.005 and abs(sum(x < 0.55 for x in a) / len(a) - 0.55) < 0.005
        both = sum(x < 0.5 and y < 0.5 for x, y in zip(a, b, strict=True)) / len(a)
        assert abs(both - 0.25) < 0.005
        following = sum(x < 0.5 and y < 0.5 for x, y in zip(a, a[1:], strict=False)) / len(a)
        assert abs(following - 0.25) < 0.005


def test_grid_has_the_generators_law(spark, make_model):
    m = make_model(products=[product(i) for i in range(1, 41)], stores=[(i, f"s{i}", "R", "C") for i in range(1, 51)])
    grid = seeds.demand_grid(m, "2001-11-02", "2001-11-05").cache()
    assert grid.groupBy("sale_date", "product_id", "store_id").count().where("count > 1").isEmpty()
    cells = 40 * 50 * 4
    assert abs(grid.count() / cells - 0.55) < 0.02
    mean = {(r.slow, r.d): r.q for r in grid.groupBy((F.col("product_id") % 4 == 0).alias("slow"), F.dayofweek(
        "sale_date").alias("d")).agg(F.avg("quantity").alias("q")).collect()}
    for (slow, day), got in mean.items():
        factor = (1.3 if day in (1, 7) else 1) * (1 + 0.15 * math.sin(2 * math.pi * 309 / 365))
        base = 0.5 if slow else 3.0
        law = sum(math.exp(-base) * base ** k / math.factorial(k) * max(1, math.floor(k * factor)) for k in range(40))
        assert got == pytest.approx(law, rel=0.08)
    # a cell sells the same whatever range is asked for
    day = seeds.demand_grid(m, "2001-11-03", "2001-11-03")
    same(day, grid.where("sale_date = DATE '2001-11-03'"))
    assert grid.where(F.col("total_amount") != F.col("quantity") * F.col("unit_price")).isEmpty()
    assert seeds.demand_grid(m, "2001-11-03", "2001-11-02").isEmpty()
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "Range (0, 2000" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_grid_draws_each_cell_once(spark, make_model):
    cells = [0, 1, PRIME - 1, PRIME, PRIME + 1, 2 * PRIME, 2 ** 53 + 7, *range(0, 2 ** 62, 2 ** 62 // 997), 2 ** 63 - 1]
    for salt in (1, 2):
        assert draw_array(np.array(cells), salt).tolist() == [plain_draw(c, salt) for c in cells]
    # repeated stores are cells of their own
    m = make_model(products=[product(4), product(5), product(7)], stores=[(i, "s", "R", "C") for i in (3, 3, 8)])
    grid = seeds.demand_grid(m, "2001-11-02", "2001-11-05")
    steps = {slow: seeds.poisson_steps(0.5 if slow else 3.0) for slow in (True, False)}
    want = []
    for pn, pid in enumerate((4, 5, 7)):
        for sn, sid in enumerate((3, 3, 8)):
            for day in (dt.date(2001, 11, n) for n in (2, 3, 4, 5)):
                number = (pn * 3 + sn) * 65536 + (day - dt.date(1970, 1, 1)).days
                if plain_draw(number, 1) < math.floor(0.55 * PRIME):
                    units = sum(plain_draw(number, 2) >= step for step in steps[pid % 4 == 0])
                    season = math.floor((1 + 0.15 * math.sin(2 * math.pi * day.timetuple().tm_yday / 365)) * 1e6 + 0.5) / 1e6
                    want.append((day, pid, sid, max(1, math.floor(units * (1.3 if day.weekday() > 4 else 1.0) * season))))
    assert sorted(map(tuple, grid.select("sale_date", "product_id", "store_id", "quantity").collect())) == sorted(want)
    # a filter on the draw as an expression had its multipliers eight times over
    assert grid._jdf.queryExecution().executedPlan().toString().count("48271") <= 2


def test_numbers_are_gapless_in_key_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 37 % 1009).alias("k"))
    got = numbered(df, "k", "no").orderBy("k").collect()
    assert [r.no for r in got] == list(range(1000))


def test_order_bitmaps_roll_up(spark, make_model):
    rows = [sale(1, "2001-10-01", 1, 1, 5), sale(1, "2001-10-02", 2, 1, 5), sale(1, "2001-11-01", 1, 1, 5),
            sale(2, "2001-11-01", 2, 1, 5), sale(70_000, "2001-11-01", 9, 1, 5), (None, dt.date(2001, 11, 1), 1, 1, 1,
                                                                                 money(1), money(1))]
    m = make_model(sales=rows, products=[product(1, category_id=1), product(2, category_id=2)])
    got = {(r.grain, r.month and r.month.month, r.category_name): r.orders for r in order_counts.distinct_orders(m).collect()}
    assert got == {("month_category", 10, "Alpha"): 1, ("month_category", 10, "Beta"): 1, ("month_category", 11, "Alpha"): 1,
                   ("month_category", 11, "Beta"): 1, ("month_category", 11, None): 1, ("month", 10, None): 1,
                   ("month", 11, None): 3, ("category", None, "Alpha"): 1, ("category", None, "Beta"): 2,
                   ("category", None, None): 1, ("total", None, None): 3}
    stored = order_counts.order_bitmaps(m)
    one = order_counts.count_grains(stored, grains=[("month",)])
    assert {r.month.month: r.orders for r in one.collect()} == {10: 1, 11: 3}


def test_top_names_of_each_group_keep_ties(spark, make_model):
    rows = [sale(i, f"2001-{month:02d}-01", i, 1, amount)
            for month, amounts in ((10, [30, 20, 20, 5]), (11, [1, 2, 3, 4])) for i, amount in enumerate(amounts, 1)]
    m = make_model(sales=rows, products=[product(i) for i in range(1, 5)])
    got = {r.month.month: (r.names, r.top2_revenue) for r in measures.top_revenue_by(m, AS_OF, n=2).collect()}
    assert got == {10: (3, money(70)), 11: (2, money(7))}


def test_growth_by_grain_compares_the_same_days(spark, make_model):
    m = make_model(sales=[sale(1, "2000-11-02", 1, 1, 100), sale(2, "2000-11-20", 1, 1, 900),
                          sale(3, "2001-11-03", 1, 1, 150), sale(4, "2000-10-20", 1, 1, 50)])
    for grain, last, growth in (("month", 100, 0.5), ("quarter", 150, 0.0), ("year", 150, 0.0)):
        r = measures.yoy_growth(m, AS_OF, grain=grain).collect()[-1]
        assert (float(r.revenue), float(r.revenue_ly), float(r.yoy_growth)) == (150, last, growth)
    with pytest.raises(ValueError):
        measures.yoy_growth(m, AS_OF, grain="week")


def test_summed_slicer_meets_no_line(spark, make_model, tmp_out):
    m = make_model(sales=many_sales(), products=[product(i, category_id=1 + i % 2) for i in range(1, 6)])
    m.sales.write.parquet(f"{tmp_out}/lines")
    m = StarModel(spark.read.parquet(f"{tmp_out}/lines"), m.products, m.categories, m.stores, m.inventory)
    summed, lines = (apply_slicers(m, categories=["Beta"], fact=f) for f in ("summed", True))
    for report in (kpis.ytd, measures.totals, measures.yoy_growth, reports.six_month_average):
        same(report(summed, AS_OF), report(lines, AS_OF))
    assert raw_fact_joins(executed_plan(kpis.ytd(summed, AS_OF)), f"{tmp_out}/lines") == []
    assert raw_fact_joins(executed_plan(kpis.ytd(lines, AS_OF)), f"{tmp_out}/lines")
