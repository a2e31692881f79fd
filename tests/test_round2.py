"""All-time figures, same-period growth, returns and the fact writers."""

import datetime as dt

import pytest

from shelfwise.operators import kpis, measures, reports
from shelfwise.sinks.writers import persist_sales, write_fact
from tests.conftest import AS_OF, money, sale

LATER = "2002-03-01"


@pytest.fixture()
def later(make_model):
    return make_model(sales=[sale(1, "2001-10-01", 1, 1, 10), sale(2, LATER, 2, 2, 90)])


@pytest.mark.parametrize(("run", "column"), [
    (lambda m: reports.monthly_revenue(m, AS_OF), "revenue"),
    (lambda m: kpis.top_product_names(m, AS_OF), "revenue"),
    (lambda m: measures.totals(m, AS_OF), "total_revenue"),
    (lambda m: measures.gross_profit_60(m, AS_OF), "gross_profit"),
    (lambda m: measures.top10_revenue(m, AS_OF), "top10_revenue"),
    (lambda m: measures.yoy_growth(m, AS_OF), "revenue"),
    (lambda m: measures.revenue_by(m, AS_OF), "revenue"),
    (lambda m: measures.revenue_by(m, AS_OF, dims=["product_id"]), "revenue"),
])
def test_sales_after_the_date_count(later, run, column):
    total = sum(r[column] for r in run(later).collect())
    assert money(total) == money(40 if column == "gross_profit" else 100)


def test_order_value_of_months_after_the_date(later):
    assert {r.month: float(r.aov) for r in measures.aov(later, AS_OF).collect()} == {
        dt.date(2001, 10, 1): 10.0, dt.date(2002, 3, 1): 90.0}


def test_partial_month_is_compared_with_the_same_days(make_model):
    m = make_model(sales=[sale(1, "2000-11-03", 1, 1, 10), sale(2, "2000-11-20", 1, 1, 100),
                          sale(3, "2001-11-02", 1, 1, 15), sale(4, "2000-10-20", 1, 1, 50),
                          sale(5, "2001-10-05", 1, 1, 25)])
    rows = {r.month: r for r in measures.yoy_growth(m, dt.date(2001, 11, 4)).collect()}
    assert float(rows[dt.date(2001, 11, 1)].yoy_growth) == 0.5
    assert float(rows[dt.date(2001, 10, 1)].yoy_growth) == -0.5
    assert rows[dt.date(2000, 11, 1)].yoy_growth is None


def test_growth_reads_the_fact_once(spark):
    from shelfwise.plans.catalog import QUERIES
    from shelfwise.plans.inspect import executed_plan
    from tests.conftest import SF_SMALL
    plan = executed_plan(QUERIES["yoy_growth"](spark, SF_SMALL))
    assert str(plan).count("lineitem.parquet") == 1


def test_net_returns_have_a_negative_cover(make_model):
    m = make_model(sales=[sale(1, AS_OF, 1, -3, -30)], inventory=[(1, 1, 5, 20)])
    row = next(r for r in reports.stock_coverage(m, AS_OF).collect() if r.product_id == 1)
    assert (row.days_of_cover, row.stock_status) == (-50.0, "CRITICAL")


def test_a_hot_day_is_several_files(spark, tmp_out):
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "64k")
        df = spark.range(0, 200_000, 1, 16).selectExpr("id AS sale_id", "DATE'2001-11-04' AS sale_date", "uuid() AS note")
        write_fact(df, f"{tmp_out}/fact")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    back = spark.read.parquet(f"{tmp_out}/fact")
    assert back.count() == 200_000 and len(back.inputFiles()) > 3


def test_both_copies_hold_every_batch(spark, make_model, tmp_out):
    for k in range(2):
        persist_sales(make_model(sales=[sale(k, "2001-11-01", 1, 1, 10)]).sales, f"{tmp_out}/f", f"{tmp_out}/c")
    assert spark.read.parquet(f"{tmp_out}/f").count() == 2
    assert spark.read.option("header", True).csv(f"{tmp_out}/c").count() == 2
