"""Batches appended exactly once (SNK-3) and sets replaced in one step (SNK-4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import forecast, reports
from shelfwise.sinks import batches, files, writers
from tests.conftest import AS_OF, product, sale


def day(n, ids, month=11):
    return [sale(i, f"2001-{month:02d}-{n:02d}", 1 + i % 2, 1 + i % 3, 10 + i) for i in ids]


def rows(df):
    return sorted(map(tuple, df.select("sale_id", "sale_date", "product_id", "quantity", "total_amount").collect()), key=repr)


def csv_rows(spark, path):
    return spark.read.option("header", True).csv(path).count()


def test_same_batch_twice_is_once(spark, make_model, tmp_out):
    first, second = make_model(sales=day(1, range(5))), make_model(sales=day(1, range(5, 8)) + day(2, range(8, 20)))
    fact, copy = f"{tmp_out}/fact", f"{tmp_out}/copy"
    assert batches.read_fact(spark, fact).count() == 0
    assert batches.append_batch(first.sales, fact, "001", copy).rows == 5
    for again in (False, True, True):
        done = batches.append_batch(second.sales, fact, "day-2", copy)
        assert done.already_there is again and done.rows == (0 if again else 15)
    assert rows(batches.read_fact(spark, fact)) == rows(first.sales.union(second.sales))
    assert csv_rows(spark, copy) == 20
    assert sorted(r[0] for r in batches.finished(spark, fact).collect()) == ["001", "day-2"]
    # a batch of its own at each call without a name
    for _ in range(2):
        writers.persist_sales(first.sales, fact)
    assert batches.read_fact(spark, fact).count() == 30


def test_job_that_dies_between_the_copies(spark, make_model, tmp_out, monkeypatch):
    m, other = make_model(sales=day(1, range(6)) + day(3, range(6, 9))), make_model(sales=day(1, range(50, 53)))
    fact, copy = f"{tmp_out}/fact", f"{tmp_out}/copy"
    batches.append_batch(other.sales, fact, "other", copy)
    write = batches._overwrite

    def dies(batch, path, fmt):
        if fmt == "csv":
            raise RuntimeError("killed")
        write(batch, path, fmt)
    monkeypatch.setattr(batches, "_overwrite", dies)
    with pytest.raises(RuntimeError):
        batches.append_batch(m.sales, fact, "b", copy)
    # the fact has its files, but no reader takes them
    assert spark.read.parquet(fact).count() == 12
    assert rows(batches.read_fact(spark, fact)) == rows(other.sales) and csv_rows(spark, copy) == 3
    monkeypatch.undo()
    # the second attempt has fewer dates: those of the first go
    fewer = make_model(sales=day(1, range(6)))
    assert batches.append_batch(fewer.sales, fact, "b", copy).rows == 6
    assert rows(batches.read_fact(spark, fact)) == rows(other.sales.union(fewer.sales))
    assert spark.read.parquet(fact).count() == 9 and csv_rows(spark, copy) == 9
    assert batches.changed_dates(spark, fact) == [dt.date(2001, 11, 1), dt.date(2001, 11, 3)]
    assert batches.changed_dates(spark, fact, batches.newest(spark, fact)) == []


def test_rerun_replaces_the_batch_and_no_other(spark, make_model, tmp_out):
    a, b, c = (make_model(sales=day(n, ids)) for n, ids in ((1, range(4)), (1, range(10, 13)), (2, range(20, 22))))
    fact = f"{tmp_out}/fact"
    batches.append_batch(a.sales, fact, "a")
    batches.append_batch(b.sales, fact, "b")
    assert not batches.append_batch(c.sales, fact, "a", rerun=True).already_there
    assert rows(batches.read_fact(spark, fact)) == rows(b.sales.union(c.sales))


def test_empty_batches_and_null_dates(spark, make_model, tmp_out):
    fact = f"{tmp_out}/fact"
    none, m = make_model(), make_model(sales=day(1, range(3)))
    assert batches.append_batch(none.sales, fact, "none").rows == 0
    assert batches.append_batch(none.sales, fact, "none").already_there
    blank = m.sales.withColumn("sale_date", F.lit(None).cast("date"))
    batches.append_batch(m.sales.union(blank), fact, "some")
    assert rows(batches.read_fact(spark, fact)) == rows(m.sales.union(blank))
    for bad in ("", "a/b", "a=b", "a b"):
        with pytest.raises(ValueError):
            batches.append_batch(m.sales, fact, bad)


def test_reports_on_batches_prune_dates(spark, make_model, tmp_out):
    m = make_model(sales=[s for n in range(1, 9) for s in day(n, range(n * 10, n * 10 + 6), month=n + 3)])
    fact = f"{tmp_out}/fact"
    for n in range(4, 12):
        batches.append_batch(m.sales.where(F.month("sale_date") == n), fact, f"month-{n}")
    real = batches.with_fact(m, spark, fact)
    df = reports.top_sellers(real, AS_OF)
    assert list(map(tuple, df.collect())) == list(map(tuple, reports.top_sellers(m, AS_OF).collect()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "PartitionFilters" in line and "batch_id" in line)
    assert "sale_date" in scan.split("PartitionFilters")[1] and "dynamicpruning" in scan


def forecasts(make_model, scale=1, months=8):
    m = make_model(sales=[sale(i, dt.date(2001, 1 + i, 1), 1, 1, 10 * scale * (i + 1)) for i in range(months)],
                   products=[product(1)])
    return forecast.forecast_total(m, AS_OF), forecast.forecast_products(m, AS_OF)


def contents(frames):
    return {name: sorted(map(tuple, df.collect())) for name, df in frames.items()}


def test_failed_replacement_leaves_the_old_set(spark, make_model, tmp_out):
    root = f"{tmp_out}/set"
    assert writers.read_set(spark, root) == {}
    total, product_ = forecasts(make_model)
    writers.replace_set(spark, {"total": total, "products": product_}, root)
    old = contents(writers.read_set(spark, root))
    assert old["total"] and old["products"]
    total, product_ = forecasts(make_model, 7)
    broken = product_.withColumn("forecast_revenue", F.raise_error(F.lit("out of luck")).cast("double"))
    with pytest.raises(Exception, match="out of luck"):
        writers.replace_set(spark, {"total": total, "products": broken}, root)
    assert contents(writers.read_set(spark, root)) == old
    # what the failed job left goes with the next replacement; readers of the old set can finish
    reading = writers.read_set(spark, root)
    writers.replace_set(spark, {"total": total, "products": product_}, root)
    new = contents(writers.read_set(spark, root))
    assert new["total"] != old["total"] and new["products"] != old["products"]
    assert contents(reading) == old
    assert sum(c.startswith("version=") for c in files.children(spark, root)) == 2


def test_empty_forecast_is_absent_and_both_switch_together(spark, make_model, tmp_out):
    root = f"{tmp_out}/set"
    names = ("fc_total", "fc_products")
    assert writers.persist_forecasts(spark, *forecasts(make_model), *names, root) == dict.fromkeys(names, True)
    assert spark.table("fc_total").count() == 3 and spark.table("fc_products").count() == 3
    assert writers.persist_forecasts(spark, *forecasts(make_model, months=0), *names, root) == dict.fromkeys(names, False)
    assert not any(map(spark.catalog.tableExists, names)) and writers.read_set(spark, root) == {}
