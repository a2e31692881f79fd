"""Report semantics on hand-made fixtures (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from shelfwise.operators import reports
from tests.conftest import AS_OF, product, sale


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_e1_inclusive_lower_bound(make_model):
    # as_of - 90 = 2001-08-06 counts, 2001-08-05 does not
    m = make_model(sales=[sale(1, "2001-08-06", 1, 2, 20), sale(2, "2001-08-05", 1, 5, 50)])
    r = reports.top_sellers(m, AS_OF).collect()
    assert [(x.product_id, x.units_sold, float(x.revenue)) for x in r] == [(1, 2, 20.0)]


def test_e2_product_without_sales(make_model):
    m = make_model(sales=[sale(1, "2001-11-01", 1, 50, 500)])
    low = reports.low_sellers(m, AS_OF, threshold=10)
    assert rows(low, "product_id", "units_sold") == [(2, 0)]
    sc = {r.product_id: r for r in reports.stock_coverage(m, AS_OF).collect()}
    assert sc[2].stock_status == "NO_SALES" and sc[2].days_of_cover is None
    assert sc[2].avg_daily_sales == 0.0


def test_e3_sales_without_inventory(make_model):
    m = make_model(sales=[sale(1, "2001-11-01", 1, 30, 300)])
    sc = {r.product_id: r for r in reports.stock_coverage(m, AS_OF).collect()}
    assert sc[1].total_stock == 0 and sc[1].days_of_cover is None and sc[1].stock_status == "OK"
    view = {r.product_id: r for r in reports.stock_coverage_view(m, AS_OF).collect()}
    assert view[1].total_stock is None and view[1].days_of_cover is None


def test_e4_cover_thresholds(make_model):
    # 300 units in the 30-day window = 10 per day
    sales = [sale(1, "2001-11-01", p, 300, 3000) for p in (1, 2, 3)]
    inv = [(1, 1, 140, 20), (2, 1, 139, 20), (3, 1, 300, 20)]
    m = make_model(sales=sales, products=[product(1), product(2), product(3)], inventory=inv)
    sc = {r.product_id: (r.days_of_cover, r.stock_status) for r in reports.stock_coverage(m, AS_OF).collect()}
    assert sc == {1: (14.0, "LOW"), 2: (13.9, "CRITICAL"), 3: (30.0, "OK")}


def test_e5_window_edges(make_model):
    # as_of - 30 = 2001-10-05: the 30-day report counts both days (31 dates)
    m = make_model(sales=[sale(1, "2001-10-05", 1, 3, 30), sale(2, "2001-10-06", 1, 3, 30)],
                   inventory=[(1, 1, 100, 20)])
    sc = {r.product_id: r for r in reports.stock_coverage(m, AS_OF).collect()}
    assert sc[1].avg_daily_sales == 6 / 30


def test_view_velocity_is_mean_per_line(make_model):
    m = make_model(sales=[sale(1, "2001-11-01", 1, 1, 10), sale(2, "2001-11-02", 1, 2, 20)],
                   inventory=[(1, 1, 3, 20)])
    v = {r.product_id: r for r in reports.stock_coverage_view(m, AS_OF).collect()}
    assert v[1].avg_daily_sales == 1.5 and v[1].days_of_cover == 2.0


def test_e6_rolling_row_and_calendar_frames(make_model):
    sales = [sale(1, "2001-01-10", 1, 1, 10), sale(2, "2001-02-10", 1, 1, 20), sale(3, "2001-09-10", 1, 1, 60)]
    m = make_model(sales=sales)
    by_rows = reports.six_month_average(m, AS_OF).orderBy("month")
    assert [float(x) for (x,) in rows(by_rows, "rolling_6m_avg_revenue")] == [10.0, 15.0, 30.0]
    by_cal = reports.six_month_average(m, AS_OF, calendar=True).orderBy("month")
    assert [float(x) for (x,) in rows(by_cal, "rolling_6m_avg_revenue")] == [10.0, 15.0, 60.0]


def test_rolling_mean_rounds_half_up(make_model):
    sales = [sale(1, "2001-09-10", 1, 1, "0.01"), sale(2, "2001-10-10", 1, 1, "0.02")]
    m = make_model(sales=sales)
    got = rows(reports.six_month_average(m, AS_OF).orderBy("month"), "rolling_6m_avg_revenue")
    assert [float(x) for (x,) in got] == [0.01, 0.02]  # 0.015 -> 0.02


def test_e13_null_category(make_model):
    m = make_model(sales=[sale(1, "2001-11-01", 1, 1, 10), sale(2, "2001-11-01", 2, 1, 10)],
                   products=[product(1), product(2, category_id=None)], inventory=[(2, 1, 5, 20)])
    assert [r.product_id for r in reports.stock_coverage(m, AS_OF).collect()] == [1]
    assert sorted(r.product_id for r in reports.stock_coverage_view(m, AS_OF).collect()) == [1, 2]
    assert [r.product_id for r in reports.top_sellers_view(m, AS_OF).collect()] == [1]


def test_e16_top_sellers_tie_break(make_model):
    prods = [product(i) for i in range(1, 6)]
    m = make_model(sales=[sale(i, "2001-11-01", i, 1, 10) for i in range(1, 6)], products=prods)
    assert [r.product_id for r in reports.top_sellers(m, AS_OF, top_n=3).collect()] == [1, 2, 3]


def test_top_sellers_view_gross_profit_uses_cost_price(make_model):
    m = make_model(sales=[sale(1, "2001-11-01", 1, 3, "30.00")], products=[product(1, cost="6.50")])
    r = reports.top_sellers_view(m, AS_OF).collect()[0]
    assert float(r.gross_profit) == 30.0 - 6.5 * 3


def test_monthly_revenue_counts_distinct_orders(make_model):
    sales = [sale(7, "2001-10-01", 1, 1, 10), sale(7, "2001-10-02", 2, 1, 10), sale(8, "2001-10-03", 1, 1, 5)]
    m = make_model(sales=sales)
    r = reports.monthly_revenue(m, AS_OF).collect()
    assert [(x.units_sold, x.transactions, float(x.revenue)) for x in r] == [(3, 2, 25.0)]


def test_statuses_partition_products(spark):
    from shelfwise.sources.model import load_model
    from tests.conftest import SF_SMALL
    m = load_model(spark, SF_SMALL)
    sc = reports.stock_coverage(m, AS_OF)
    n = sc.count()
    by = {r.stock_status: r["count"] for r in sc.groupBy("stock_status").count().collect()}
    assert sum(by.values()) == n and set(by) <= {"NO_SALES", "CRITICAL", "LOW", "OK"}
    assert sc.where(F.col("days_of_cover").isNull() & (F.col("stock_status") != "NO_SALES")
                    & (F.col("total_stock") > 0)).count() == 0


def test_six_month_view_form_has_sku(make_model):
    m = make_model(sales=[sale(1, "2001-10-01", 1, 1, 10)])
    df = reports.six_month_average(m, AS_OF, with_sku=True)
    assert df.columns[:3] == ["product_id", "sku", "product_name"]
    assert df.collect()[0].sku == "SKU-1"


def test_whole_months_option(make_model):
    # cut-off 2000-11-04: a sale on 2000-11-02 is outside by default, inside with whole months
    m = make_model(sales=[sale(1, "2000-11-02", 1, 1, 10), sale(2, "2001-10-01", 1, 1, 20)])
    assert reports.six_month_average(m, AS_OF).count() == 1
    assert reports.six_month_average(m, AS_OF, whole_months=True).count() == 2
