"""Whole pipeline into a temp directory."""

import datetime as dt

from shelfwise.plans.jobs import run_pipeline
from shelfwise.sources.model import load_model
from tests.conftest import AS_OF, SF_SMALL


def test_run_pipeline(spark, tmp_out):
    m = load_model(spark, SF_SMALL)
    out = run_pipeline(spark, m, AS_OF, tmp_out, run_date=dt.date(2001, 11, 4))
    header = spark.read.parquet(out["summary"]["header"] + "/parquet").collect()[0]
    assert header.ytd_units > 0 and header.critical_skus >= 0
    top = spark.read.parquet(out["analytics"]["top_sellers"] + "/parquet")
    assert top.count() == 20
    assert spark.read.parquet(out["summary"]["top_sellers"] + "/parquet").count() == 10
    fc = spark.read.parquet(f"{tmp_out}/forecasts/run_date=20011104/Product_Forecast/parquet")
    assert fc.count() > 0
