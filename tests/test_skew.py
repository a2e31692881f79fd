"""A hot key holding a third of the fact: the line-level join is split by
AQE's skew handling and the results are unchanged; aggregates combine the
hot key map-side before the shuffle."""

from pyspark.sql import functions as F

from shelfwise.operators import etl, reports
from shelfwise.sources.model import StarModel, load_model
from tests.conftest import AS_OF

HOT = {"spark.sql.autoBroadcastJoinThreshold": "-1",
       "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
       "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
       "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
       "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
       "spark.sql.shuffle.partitions": "16"}


def skewed(model: StarModel) -> StarModel:
    # every third line (by a hash of its key) is re-assigned to one product
    hot = F.when(F.abs(F.xxhash64("sale_id", "store_id", "quantity")) % 3 == 0, F.lit(1)) \
        .otherwise(F.col("product_id"))
    # the test file is one row group (one map task); a real fact spans many
    # files, so spread it over several input partitions
    sales = model.sales.withColumn("product_id", hot.cast("long")).repartition(8)
    return StarModel(sales, model.products, model.categories, model.stores, model.inventory)


def with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_product_join_is_split(spark):
    m = skewed(load_model(spark, "/root/testdata/sf0.01"))
    ext = etl.extract_sales(m, AS_OF)
    share = ext.where(F.col("product_id") == 1).count() / ext.count()
    assert share > 0.3

    def run():
        df = etl.extract_sales(m, AS_OF)
        df.collect()          # final adaptive plan is kept on this DataFrame's execution
        rows = df.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("r"))
        return df, sorted(rows.collect())
    df, got = with_conf(spark, HOT, run)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan and "skewed" in plan
    base = sorted(etl.extract_sales(m, AS_OF).groupBy("product_id")
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("r")).collect())
    assert got == base


def test_hot_product_is_combined_before_the_shuffle(spark):
    m = skewed(load_model(spark, "/root/testdata/sf0.01"))
    df = reports.top_sellers(m, AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.index("Exchange hashpartitioning(product_id")
    assert "partial_sum" in plan[first_exchange:]
