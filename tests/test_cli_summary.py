"""Command line, ETL job, summary sections."""

from shelfwise.__main__ import main
from shelfwise.operators import etl, summary
from shelfwise.sinks.batches import read_fact
from shelfwise.sources.model import load_model
from tests.conftest import AS_OF, SF_SMALL, sale


def test_summary_sections(spark):
    m = load_model(spark, SF_SMALL)
    secs = summary.summary_sections(m, AS_OF)
    assert set(secs) == {"top_sellers", "low_sellers", "critical_stock", "forecast_total"}
    assert secs["top_sellers"].count() == 10 and secs["forecast_total"].count() == 3
    assert secs["critical_stock"].where("stock_status <> 'CRITICAL'").count() == 0
    head = summary.daily_summary(m, AS_OF).collect()[0]
    assert head.critical_skus == summary.critical_rows(m, AS_OF).count()


def test_run_etl_writes_both_formats(spark, tmp_out):
    m = load_model(spark, SF_SMALL)
    clean = etl.run_etl(m, AS_OF, tmp_out)
    assert spark.read.parquet(f"{tmp_out}/sales_clean.parquet").count() == clean.count()
    assert spark.read.option("header", True).csv(f"{tmp_out}/sales_clean.csv").count() == clean.count()


def test_cli_query(spark, tmp_out):
    main(["query", "ytd_kpis", "--tables", SF_SMALL, "--out", f"{tmp_out}/q"])
    assert spark.read.parquet(f"{tmp_out}/q").count() == 1
    main(["pipeline", "--tables", SF_SMALL, "--out", f"{tmp_out}/r", "--as-of", "2001-11-04"])
    assert spark.read.parquet(f"{tmp_out}/r/summary/run_date=20011104/header/parquet").count() == 1
    assert spark.table("forecast_total_revenue").count() == 3 and spark.table("forecast_product_revenue").count() > 0


def test_cli_takes_date_and_prints_every_row(spark, capsys):
    main(["query", "stock_coverage", "--tables", SF_SMALL, "--as-of", "1990-01-01"])
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) == 1 + load_model(spark, SF_SMALL).products.count()
    assert all("NO_SALES" in x for x in lines[1:])


def test_cli_daily_twice_is_once(spark, make_model, tmp_out):
    m = make_model(sales=[sale(i, f"2001-1{i % 2}-0{1 + i % 4}", 1 + i % 2, 1, 10 + i) for i in range(12)])
    for name in ("sales", "products", "categories", "stores", "inventory"):
        getattr(m, name).write.parquet(f"{tmp_out}/star/{name}")
    for _ in range(2):
        main(["daily", "--tables", f"{tmp_out}/star", "--star", "--out", f"{tmp_out}/store", "--batch", "b1",
              "--as-of", "2001-11-04"])
    assert read_fact(spark, f"{tmp_out}/store/sales").count() == 12
    top = spark.read.parquet(f"{tmp_out}/store/reports/analytics/run_date=20011104/Top_Sellers/parquet")
    assert sum(r.units_sold for r in top.collect()) == 12
