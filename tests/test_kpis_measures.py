"""KPI and measure semantics (FIXTURES.md §3: E11, E13, E14; quirks Q19-Q21)."""

from shelfwise.operators import kpis, measures
from tests.conftest import AS_OF, product, sale


def test_e11_names_merge(make_model):
    prods = [product(1, name="twin"), product(2, name="twin"), product(3, name="solo")]
    sales = [sale(1, "2001-01-01", 1, 1, 10), sale(2, "2001-01-01", 2, 1, 10), sale(3, "2001-01-01", 3, 1, 15)]
    m = make_model(sales=sales, products=prods)
    r = kpis.top_product_names(m, AS_OF).collect()
    assert [(x.product_name, float(x.revenue)) for x in r] == [("twin", 20.0), ("solo", 15.0)]


def test_ytd_bounds(make_model):
    m = make_model(sales=[sale(1, "2000-12-31", 1, 1, 10), sale(2, "2001-01-01", 1, 2, 20)])
    r = kpis.ytd(m, AS_OF).collect()[0]
    assert (float(r.ytd_revenue), r.ytd_units) == (20.0, 2)


def test_e14_empty_sales(make_model):
    m = make_model(sales=[])
    r = kpis.ytd(m, AS_OF).collect()[0]
    assert (float(r.ytd_revenue), r.ytd_units) == (0.0, 0)
    assert measures.aov(m, AS_OF, by=[]).collect()[0].aov == 0
    assert measures.yoy_growth(m, AS_OF).count() == 0


def test_e13_contribution_below_100(make_model):
    m = make_model(sales=[sale(1, "2001-11-01", 1, 1, 30), sale(2, "2001-11-01", 2, 1, 10)],
                   products=[product(1), product(2, category_id=None)])
    r = kpis.category_contribution(m, AS_OF).collect()
    assert [(x.category_name, float(x.pct)) for x in r] == [("Alpha", 75.0)]


def test_critical_stock_uses_view_cover(make_model):
    m = make_model(sales=[sale(1, "2001-11-01", 1, 10, 100)], inventory=[(1, 1, 50, 20)])
    r = kpis.critical_stock(m, AS_OF).collect()
    assert [(x.product_name, x.days_of_cover) for x in r] == [("product 1", 5.0)]


def test_aov_and_gross_profit(make_model):
    sales = [sale(1, "2001-10-01", 1, 1, 10), sale(1, "2001-10-01", 2, 1, 20), sale(2, "2001-10-05", 1, 1, "10.01")]
    m = make_model(sales=sales)
    a = measures.aov(m, AS_OF).collect()[0]
    assert float(a.aov) == 20.005
    g = measures.gross_profit_60(m, AS_OF).collect()[0]
    assert float(g.gross_profit) == 16.004


def test_revenue_6m_avg_skips_months_without_sales(make_model):
    # period is (2001-05-04, 2001-11-04]: May 4 is outside, May 5 inside
    sales = [sale(1, "2001-05-04", 1, 1, 1000), sale(2, "2001-05-05", 1, 1, 10), sale(3, "2001-11-04", 1, 1, 20)]
    m = make_model(sales=sales)
    r = measures.revenue_6m_avg(m, AS_OF).collect()[0]
    assert float(r.revenue_6m_avg) == 15.0


def test_coverage_measure_uses_30_dates_and_blank(make_model):
    # 2001-10-05 is outside the 30 dates ending 2001-11-04
    sales = [sale(1, "2001-10-05", 1, 100, 100), sale(2, "2001-10-06", 1, 30, 30)]
    m = make_model(sales=sales, products=[product(1), product(2)], inventory=[(1, 1, 10, 20), (2, 1, 10, 20)])
    got = {r.product_id: r.coverage_days for r in measures.coverage_days(m, AS_OF).collect()}
    assert float(got[1]) == 10.0 and got[2] is None


def test_q21_blank_coverage_counts_as_critical(make_model):
    sales = [sale(1, "2001-11-01", 1, 30, 30), sale(2, "2001-11-01", 3, 30, 30)]
    prods = [product(1), product(2), product(3), product(4)]
    inv = [(1, 1, 100, 20), (3, 1, 5, 20)]
    m = make_model(sales=sales, products=prods, inventory=inv)
    # p1 cover 100 (ok); p2 no sales (blank -> counts); p3 cover 5 (critical); p4 nothing (counts)
    assert measures.critical_sku_count(m, AS_OF).collect()[0].critical_skus == 3


def test_top10_keeps_ties(make_model):
    prods = [product(i, name=f"n{i}") for i in range(1, 13)]
    revenue = {i: 100 - i for i in range(1, 10)}
    revenue.update({10: 50, 11: 50, 12: 50})
    sales = [sale(i, "2001-01-01", i, 1, r) for i, r in revenue.items()]
    m = make_model(sales=sales, products=prods)
    got = measures.top10_revenue(m, AS_OF).collect()[0].top10_revenue
    assert float(got) == sum(revenue.values())


def test_yoy_growth(make_model):
    sales = [sale(1, "2000-03-03", 1, 1, 100), sale(2, "2001-03-09", 1, 1, 150), sale(3, "2001-04-01", 1, 1, 10)]
    m = make_model(sales=sales)
    got = {str(r.month): r.yoy_growth for r in measures.yoy_growth(m, AS_OF).collect()}
    assert float(got["2001-03-01"]) == 0.5 and got["2001-04-01"] is None and got["2000-03-01"] is None


def test_revenue_by_slicers(make_model):
    sales = [sale(1, "2001-01-01", 1, 1, 10), sale(2, "2001-06-01", 2, 1, 20), sale(3, "2001-06-02", 1, 1, 5)]
    prods = [product(1, category_id=1), product(2, category_id=2)]
    m = make_model(sales=sales, products=prods)
    r = measures.revenue_by(m, AS_OF, dims=["category_name"], start="2001-05-01").collect()
    assert [(x.category_name, float(x.revenue)) for x in r] == [("Beta", 20.0), ("Alpha", 5.0)]
    r = measures.revenue_by(m, AS_OF, dims=["category_name"], categories=["Alpha"]).collect()
    assert [(x.category_name, float(x.revenue)) for x in r] == [("Alpha", 15.0)]
    r = measures.revenue_by(m, AS_OF, dims=["product_id"], product_ids=[2]).collect()
    assert [(x.product_id, float(x.revenue)) for x in r] == [(2, 20.0)]


def test_cover_bands(make_model):
    sales = [sale(p, "2001-11-01", p, 300, 3000) for p in (1, 2, 3)]
    inv = [(1, 1, 139, 20), (2, 1, 290, 20), (3, 1, 300, 20)]
    m = make_model(sales=sales, products=[product(1), product(2), product(3), product(4)], inventory=inv)
    got = {r.product_id: r.cover_band for r in measures.cover_bands(m, AS_OF).collect()}
    assert got == {1: "red", 2: "yellow", 3: "green", 4: None}


def test_model_slicers(make_model):
    from shelfwise.operators import reports
    from shelfwise.operators.slicers import apply_slicers
    prods = [product(1, category_id=1), product(2, category_id=2), product(3, category_id=2)]
    sales = [sale(1, "2001-10-01", 1, 1, 10), sale(2, "2001-10-02", 2, 1, 20),
             sale(3, "2001-06-01", 2, 1, 40), sale(4, "2001-10-03", 3, 1, 5)]
    m = make_model(sales=sales, products=prods)
    beta = apply_slicers(m, categories=["Beta"])
    assert sorted(r.product_id for r in reports.low_sellers(beta, AS_OF, threshold=100).collect()) == [2, 3]
    assert float(kpis.ytd(beta, AS_OF).collect()[0].ytd_revenue) == 65.0
    recent = apply_slicers(m, categories=["Beta"], start="2001-09-01", product_ids=[2])
    assert float(kpis.ytd(recent, AS_OF).collect()[0].ytd_revenue) == 20.0
