"""Batches appended to the sales fact exactly once (SNK-3).

The fact is partitioned by date and batch: ``sale_date=.../batch_id=...``.  A
batch is written with dynamic partition overwrite, so a second run of the same
batch replaces its own folders and touches no other.  A ledger beside the fact
only grows: one row per attempt and date before the fact is written (``started``)
and one, all in one file, after both copies are (``done``).  Readers take the
batches whose latest attempt is done, so a batch whose job died half-way is not
seen until its rerun has finished.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import write_once
from shelfwise.sinks import files
from shelfwise.sources.model import SALES_SCHEMA, StarModel

STARTED, DONE = "started", "done"
KEYS = ("sale_date", "batch_id")

LEDGER_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("sale_date", T.DateType()),
    T.StructField("rows", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("at", T.TimestampType()),
])


def ledger_path(fact_path: str) -> str:
    return fact_path.rstrip("/") + "_ledger"


def ledger(spark: SparkSession, fact_path: str) -> DataFrame:
    """(batch_id, attempt, sale_date, rows, state, at); empty before the first batch."""
    path = ledger_path(fact_path)
    if not files.exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def finished(spark: SparkSession, fact_path: str) -> DataFrame:
    """(batch_id) of the batches whose latest attempt has written all copies."""
    attempts = ledger(spark, fact_path).groupBy("batch_id", "attempt").agg(
        F.min("at").alias("began"), F.count_if(F.col("state") == DONE).alias("done"))
    # a comparison, which Spark takes for selective, so that it prunes the fact's folders
    return attempts.groupBy("batch_id").agg(F.max_by("done", "began").alias("done")).where("done > 0").select("batch_id")


def newest(spark: SparkSession, fact_path: str) -> int | None:
    """Microseconds since 1970 of the ledger's newest finished row."""
    done = ledger(spark, fact_path).where(F.col("state") == DONE)
    return done.agg(F.max(F.unix_micros("at"))).first()[0]


def changed_dates(spark: SparkSession, fact_path: str, after: int | None = None) -> list[dt.date]:
    """Dates that attempts finished after ``after`` (see ``newest``) have touched:
    at most one per calendar day."""
    done = ledger(spark, fact_path).where((F.col("state") == DONE) & F.col("sale_date").isNotNull())
    if after is not None:
        done = done.where(F.unix_micros("at") > after)
    return sorted(r[0] for r in done.select("sale_date").distinct().collect())


@dataclass(frozen=True)
class Appended:
    batch_id: str
    rows: int
    already_there: bool


def _record(dates: DataFrame, fact_path: str, attempt: str, state: str) -> None:
    """Ledger rows of one attempt, in one file: all of them are seen or none."""
    (dates.select("batch_id", F.lit(attempt).alias("attempt"), "sale_date", "rows", F.lit(state).alias("state"),
                  F.current_timestamp().alias("at"))
     .coalesce(1).write.mode("append").parquet(ledger_path(fact_path)))


def _overwrite(batch: DataFrame, path: str, fmt: str) -> None:
    (batch.hint("rebalance", "sale_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("header", True).partitionBy(*KEYS).format(fmt).save(path))


def _folder(path: str, date, batch_id: str) -> str:
    day = "__HIVE_DEFAULT_PARTITION__" if date is None else date.isoformat()
    return f"{path.rstrip('/')}/sale_date={day}/batch_id={batch_id}"


def append_batch(df: DataFrame, fact_path: str, batch_id: str, csv_path: str | None = None,
                 rerun: bool = False) -> Appended:
    """Append ``df`` to the sales fact (and its CSV copy) as one batch.

    A batch id that the ledger has as done is left alone and ``already_there`` is
    true, unless ``rerun`` asks for the batch to be replaced by ``df``.  After a
    job that died between the copies, the same call finishes the work: the fact
    is as if the batch had been appended once.  Dates that an earlier attempt
    wrote and this one no longer has lose that batch's folder.  Rows with a null
    date are kept in a partition of their own; an empty batch is recorded and
    adds no rows.  Two jobs must not append the same batch id at once.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
        raise ValueError("batch_id must consist of letters, digits, dots, hyphens and underscores")
    spark = df.sparkSession
    if not rerun and not finished(spark, fact_path).where(F.col("batch_id") == batch_id).isEmpty():
        return Appended(batch_id, 0, True)
    # computed once; both copies and the counts come from the written rows
    batch = write_once(df.drop("batch_id").withColumn("batch_id", F.lit(batch_id)), "sales-batch")
    dates = batch.groupBy("batch_id", "sale_date").agg(F.count("*").alias("rows"))
    rows = batch.count()
    # dates of earlier attempts that this one lacks: at most one row per calendar day
    own = ledger(spark, fact_path).where((F.col("batch_id") == batch_id) & (F.col("rows") > 0))
    stale = [r["sale_date"] for r in own.select("sale_date").distinct()
             .join(dates.select(F.col("sale_date").alias("kept")), F.col("sale_date").eqNullSafe(F.col("kept")),
                   "left_anti").collect()]
    if stale or not rows:       # an empty batch has to be known too
        gone = spark.createDataFrame([(batch_id, d, 0) for d in stale or [None]], dates.schema)
        dates = dates.union(gone)
    attempt = uuid.uuid4().hex
    _record(dates, fact_path, attempt, STARTED)
    for path, fmt in ((fact_path, "parquet"), (csv_path, "csv")):
        if path is None:
            continue
        if rows:
            _overwrite(batch, path, fmt)
        for date in stale:
            files.delete(spark, _folder(path, date, batch_id))
    _record(dates, fact_path, attempt, DONE)
    return Appended(batch_id, rows, False)


def read_fact(spark: SparkSession, fact_path: str) -> DataFrame:
    """The sales of all finished batches.  Date filters prune folders, and so does
    the semi-join with the finished batches (dynamic partition pruning)."""
    schema = T.StructType([f for f in SALES_SCHEMA if f.name != "sale_date"] + [
        SALES_SCHEMA["sale_date"], T.StructField("batch_id", T.StringType())])
    done = finished(spark, fact_path)
    if not files.exists(spark, fact_path):
        return spark.createDataFrame([], SALES_SCHEMA)
    return (spark.read.schema(schema).parquet(fact_path).join(done, "batch_id", "left_semi")
            .select(*SALES_SCHEMA.fieldNames()))


def with_fact(model: StarModel, spark: SparkSession, fact_path: str) -> StarModel:
    """The model with its sales read from a fact of batches."""
    return StarModel(read_fact(spark, fact_path), model.products, model.categories, model.stores, model.inventory)
