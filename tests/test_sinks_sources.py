"""Sources and sinks round trips in a temp directory (SRC-1/3, SNK-1..7, E17)."""

import datetime as dt

import pytest

from shelfwise.operators import forecast
from shelfwise.sinks import writers
from shelfwise.sources import jdbc
from shelfwise.sources.sql import fetch_df
from tests.conftest import AS_OF, product, sale


def test_fetch_df_binds_parameters(spark, make_model):
    m = make_model(sales=[sale(i, "2001-11-01", 1 + i % 2, 1, 10 + i) for i in range(6)])
    m.register("t_")
    df = fetch_df(spark, "SELECT product_id, SUM(total_amount) AS r FROM t_sales "
                         "WHERE sale_date >= :cutoff GROUP BY product_id ORDER BY r DESC LIMIT :n",
                  {"cutoff": dt.date(2001, 10, 1), "n": 1})
    assert [r.product_id for r in df.collect()] == [2]


def test_jdbc_options():
    o = jdbc.jdbc_options("jdbc:postgresql://db/x", "sales", "sale_id", 1, 1000, 8, user="u")
    assert o["partitionColumn"] == "sale_id" and o["numPartitions"] == "8" and o["user"] == "u"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", "sale_id")


def test_write_table_modes(spark):
    df = spark.range(3)
    writers.write_table(df, "t_modes", if_exists="replace")
    writers.write_table(df, "t_modes", if_exists="append")
    assert spark.table("t_modes").count() == 6
    with pytest.raises(Exception):
        writers.write_table(df, "t_modes", if_exists="fail")
    with pytest.raises(ValueError):
        writers.write_table(df, "t_modes", if_exists="bogus")


def test_save_processed_round_trip(spark, make_model, tmp_out):
    from shelfwise.operators import etl
    m = make_model(sales=[sale(1, "2001-11-01", 1, 2, 20), sale(2, "2000-11-01", 2, 1, 7)])
    clean = etl.transform(etl.extract_sales(m, AS_OF))
    paths = writers.save_processed(clean, tmp_out)
    back = spark.read.parquet(paths["parquet"])
    assert back.count() == 2 and sorted(r.year for r in back.collect()) == [2000, 2001]
    csv = spark.read.option("header", True).csv(paths["csv"])
    assert csv.count() == 2


def test_persist_sales_appends(spark, make_model, tmp_out):
    m = make_model(sales=[sale(1, "2001-11-01", 1, 2, 20)])
    writers.persist_sales(m.sales, f"{tmp_out}/fact", f"{tmp_out}/csv")
    writers.persist_sales(m.sales, f"{tmp_out}/fact", f"{tmp_out}/csv")
    assert spark.read.parquet(f"{tmp_out}/fact").count() == 2


def test_e17_forecast_tables_replaced(spark, make_model):
    vals = [sale(i, dt.date(2001, 1 + i, 1), 1, 1, 10 * (i + 1)) for i in range(8)]
    m = make_model(sales=vals, products=[product(1)])
    tot, per = forecast.forecast_total(m, AS_OF), forecast.forecast_products(m, AS_OF)
    assert writers.persist_forecasts(spark, tot, per) == {
        "forecast_total_revenue": True, "forecast_product_revenue": True}
    assert spark.table("forecast_total_revenue").count() == 3
    empty = make_model(sales=[])
    writers.persist_forecasts(spark, forecast.forecast_total(empty, AS_OF),
                              forecast.forecast_products(empty, AS_OF))
    assert not spark.catalog.tableExists("forecast_total_revenue")


def test_publish_reports_layout(spark, tmp_out):
    out = writers.publish_reports({"top_sellers": spark.range(2)}, tmp_out, dt.date(2024, 1, 2),
                                  writers.ANALYTICS_SHEETS)
    assert out["top_sellers"].endswith("run_date=20240102/Top_Sellers")
    assert spark.read.parquet(out["top_sellers"] + "/parquet").count() == 2


def test_register_views(spark, make_model):
    m = make_model(sales=[sale(1, "2001-11-01", 1, 2, 20)])
    names = writers.register_views(spark, m, AS_OF)
    assert len(names) == 5
    assert spark.sql("SELECT COUNT(*) AS n FROM vw_top_selling_products").collect()[0].n == 1


def test_partitioned_fact_prunes_by_date(spark, make_model, tmp_out):
    from shelfwise.operators import reports
    from shelfwise.sources.model import model_from_tables
    m = make_model(sales=[sale(i, f"2001-{1 + i % 11:02d}-0{1 + i % 9}", 1 + i % 2, 1, 10 + i) for i in range(40)])
    writers.write_fact(m.sales, f"{tmp_out}/star/sales")
    for name in ("products", "categories", "stores", "inventory"):
        getattr(m, name).write.parquet(f"{tmp_out}/star/{name}")
    real = model_from_tables(spark, f"{tmp_out}/star")
    df = reports.top_sellers(real, AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_date" in plan and "sale_date" in plan
    got = [(r.product_id, r.units_sold) for r in df.collect()]
    want = [(r.product_id, r.units_sold) for r in reports.top_sellers(m, AS_OF).collect()]
    assert got == want


def test_bucketed_products_are_not_shuffled(spark, make_model):
    from shelfwise.operators import reports
    from shelfwise.sources.model import StarModel, model_from_catalog
    m = make_model(sales=[sale(i, "2001-11-01", 1 + i % 5, 1, 10 + i) for i in range(30)],
                   products=[product(i) for i in range(1, 6)])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writers.write_bucketed(m.products, "bk_products", "product_id", parts)
    for name in ("sales", "categories", "stores", "inventory"):
        getattr(m, name).write.mode("overwrite").saveAsTable(f"bk_{name}")
    cat = model_from_catalog(spark, "bk_")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = reports.top_sellers_view(StarModel(cat.sales, cat.products, cat.categories, cat.stores, cat.inventory),
                                      AS_OF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.product_id, r.units_sold) for r in df.collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # walk from the bucketed product scan up to its join: no exchange on the way
    import re
    lines = plan.split("\n")
    i = next(k for k, ln in enumerate(lines) if "bk_products" in ln)
    depth = re.match(r"[\s:+\-]*", lines[i]).end()
    ancestors = []
    for ln in reversed(lines[:i]):
        d = re.match(r"[\s:+\-]*", ln).end()
        if d < depth:
            ancestors.append(ln.strip())
            depth = d
            if "SortMergeJoin [product_id" in ln:
                break
    assert "SortMergeJoin [product_id" in ancestors[-1]
    assert not any("Exchange" in a for a in ancestors)
    assert "Bucketed: true" in plan
    want = sorted((r.product_id, r.units_sold) for r in reports.top_sellers_view(m, AS_OF).collect())
    assert got == want


def test_session_profiles():
    from shelfwise.session import CLUSTER_CONF, build_session
    with pytest.raises(ValueError):
        build_session(profile="bogus")
    assert int(CLUSTER_CONF["spark.sql.shuffle.partitions"]) >= 1000
