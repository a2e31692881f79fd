"""Output operators (SNK-1..7).

All writes go through Spark's file-commit protocol, so a lost executor's
tasks are retried without leaving partial files; nothing is collected to
the driver.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shelfwise.sinks import batches, files

MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}

# The sheet names of the reference's two workbooks.
ANALYTICS_SHEETS = {"top_sellers": "Top_Sellers", "low_sellers": "Low_Sellers",
                    "stock": "Stock_Coverage", "six_month": "6M_Average"}
FORECAST_SHEETS = {"total": "Total_Revenue", "products": "Product_Forecast"}


def _mode(if_exists: str) -> str:
    try:
        return MODES[if_exists]
    except KeyError:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}") from None


def write_table(df: DataFrame, table: str, if_exists: str = "append",
                partition_by: list[str] | None = None) -> None:
    """Write to a catalog table: append / replace / fail (SNK-1)."""
    w = df.write.mode(_mode(if_exists))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def save_processed(df: DataFrame, root: str, name: str = "sales_clean",
                   partition_by: tuple[str, ...] = ("year",)) -> dict[str, str]:
    """Processed data as a Parquet directory and a CSV directory with header (SNK-2)."""
    root = root.rstrip("/")
    paths = {"parquet": f"{root}/{name}.parquet", "csv": f"{root}/{name}.csv"}
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(paths["parquet"])
    # the CSV copy is made from the written files: the plan is computed once
    written = df.sparkSession.read.parquet(paths["parquet"])
    written.write.mode("overwrite").partitionBy(*partition_by).option("header", True).csv(paths["csv"])
    return paths


def persist_sales(df: DataFrame, fact_path: str, csv_path: str | None = None,
                  batch_id: str | None = None) -> batches.Appended:
    """Append to the sales fact and keep a CSV copy (SNK-3): as the batch
    ``batch_id``, once however often the job runs; without a name each call is a
    batch of its own."""
    return batches.append_batch(df, fact_path, batch_id or f"batch-{uuid.uuid4().hex}", csv_path)


def write_fact(df: DataFrame, path: str, partition_by: str = "sale_date",
               if_exists: str = "append") -> None:
    """Lay the sales fact out partitioned by ``sale_date``.

    Every report filters on a trailing date window; with the date as the
    partition column those filters prune whole directories at planning time
    (``PartitionFilters``) instead of reading row-group statistics.  Rows are
    rebalanced by date: small days share a task, and a day larger than the
    advisory partition size is split over several tasks and files.
    """
    (df.hint("rebalance", partition_by)
     .write.mode(_mode(if_exists)).partitionBy(partition_by).parquet(path))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int,
                   if_exists: str = "replace") -> None:
    """Store a dimension as a catalog table bucketed (and sorted) by its key.

    Every report joins the per-product aggregate of the fact to the product
    table on ``product_id``.  With the table bucketed by that key into as
    many buckets as the shuffle has partitions, the join reads the table
    already partitioned: only the (aggregated) fact side is shuffled.
    """
    (df.write.mode(_mode(if_exists)).bucketBy(buckets, key).sortBy(key)
     .saveAsTable(table))


CURRENT = "CURRENT"


def replace_set(spark: SparkSession, frames: dict[str, DataFrame], root: str, keep: int = 2) -> dict[str, bool]:
    """Replace a set of tables in one step (SNK-4).

    All of them are written to a new folder ``root/version=...``; then one small
    file, ``root/CURRENT``, is swapped to name it.  Until the swap readers see
    the whole old set, from then on the whole new one; a job that dies before it
    leaves the old set as it was, and its folder goes with a later replacement.
    Empty frames are left out of the set.  The last ``keep`` folders stay for
    readers that have begun.  Returns which names the set holds.
    """
    root = root.rstrip("/")
    version = f"version={uuid.uuid4().hex}"
    written = {}
    for name, df in frames.items():
        path = f"{root}/{version}/{name}"
        df.write.parquet(path)
        written[name] = not spark.read.schema(df.schema).parquet(path).isEmpty()
    before = _current(spark, root)
    files.swap_text(spark, f"{root}/{CURRENT}", json.dumps(
        {"version": version, "tables": {n: frames[n].schema.json() for n, full in written.items() if full},
         "before": ([before["version"], *before["before"]] if before else [])[:keep - 1]}))
    now = _current(spark, root)
    for folder in files.children(spark, root):
        if folder.startswith("version=") and folder not in (now["version"], *now["before"]):
            files.delete(spark, f"{root}/{folder}")
    return written


def _current(spark: SparkSession, root: str) -> dict | None:
    text = files.read_text(spark, f"{root.rstrip('/')}/{CURRENT}")
    return json.loads(text) if text else None


def read_set(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the current version of a set; none before the first."""
    current = _current(spark, root)
    if current is None:
        return {}
    base = f"{root.rstrip('/')}/{current['version']}"
    return {name: spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{base}/{name}")
            for name, schema in current["tables"].items()}


def forecast_root(spark: SparkSession) -> str:
    """Folder of the forecast tables: in the warehouse."""
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/forecasts"


def persist_forecasts(spark: SparkSession, total: DataFrame, per_product: DataFrame,
                      total_table: str = "forecast_total_revenue",
                      product_table: str = "forecast_product_revenue", root: str | None = None) -> dict[str, bool]:
    """Replace both forecast tables in one step; an empty forecast leaves its
    table absent (SNK-4).  The catalog's views of these names follow the set;
    ``register_forecasts`` makes them again in another session."""
    root = root or forecast_root(spark)
    replace_set(spark, {total_table: total, product_table: per_product}, root)
    return register_forecasts(spark, root, (total_table, product_table))


def register_forecasts(spark: SparkSession, root: str | None = None,
                       tables=("forecast_total_revenue", "forecast_product_revenue")) -> dict[str, bool]:
    """Views of the current forecasts; a table that the set lacks has no view."""
    held = read_set(spark, root or forecast_root(spark))
    for table in tables:
        if table in held:
            held[table].createOrReplaceTempView(table)
        else:
            spark.catalog.dropTempView(table)
    return {table: table in held for table in tables}


def publish_reports(reports: dict[str, DataFrame], root: str, run_date: dt.date | None = None,
                    sheets: dict[str, str] | None = None,
                    formats: tuple[str, ...] = ("parquet", "csv")) -> dict[str, str]:
    """One dated report set: ``root/run_date=YYYYMMDD/<sheet>/{parquet,csv}`` (SNK-5/6).

    Replaces the single-machine workbook: each sheet becomes a directory
    written in parallel by the executors.
    """
    run_date = run_date or dt.date.today()
    base = f"{root.rstrip('/')}/run_date={run_date:%Y%m%d}"
    out = {}
    for key, df in reports.items():
        sheet = (sheets or {}).get(key, key)
        path = f"{base}/{sheet}"
        source = df
        for fmt in formats:
            w = source.write.mode("overwrite")
            if fmt == "csv":
                w = w.option("header", True)
            w.format(fmt).save(f"{path}/{fmt}")
            if source is df:
                # later copies come from the first written files, not a recompute
                source = df.sparkSession.read.format(fmt).load(f"{path}/{fmt}") if fmt == "parquet" else df
        out[key] = path
    return out


def register_views(spark: SparkSession, model, as_of) -> list[str]:
    """Install the five reporting views as temp views (SNK-7)."""
    from shelfwise.defaults import LOW_SELLER_VIEW_THRESHOLD
    from shelfwise.operators import reports
    views = {
        "vw_top_selling_products": reports.top_sellers_view(model, as_of),
        "vw_low_selling_products": reports.low_sellers(model, as_of, threshold=LOW_SELLER_VIEW_THRESHOLD),
        "vw_stock_coverage": reports.stock_coverage_view(model, as_of),
        "vw_six_month_avg": reports.six_month_average(model, as_of, with_sku=True),
        "vw_monthly_revenue": reports.monthly_revenue(model, as_of),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
