"""Properties over the sf0.001 tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.operators import forecast, kpis, reports
from shelfwise.sources.model import load_model
from tests.conftest import AS_OF, SF_SMALL


@pytest.fixture(scope="module")
def model(spark):
    return load_model(spark, SF_SMALL)


def test_rolling_mean_within_frame_bounds(model):
    df = reports.six_month_average(model, AS_OF)
    w = Window.partitionBy("product_id").orderBy("month").rowsBetween(-5, 0)
    chk = df.select("rolling_6m_avg_revenue",
                    F.min("revenue").over(w).alias("lo"), F.max("revenue").over(w).alias("hi"))
    bad = chk.where((F.col("rolling_6m_avg_revenue") < F.round("lo", 2) - 0.005)
                    | (F.col("rolling_6m_avg_revenue") > F.round("hi", 2) + 0.005))
    assert bad.count() == 0


def test_contribution_at_most_100(model):
    total = kpis.category_contribution(model, AS_OF).agg(F.sum("pct")).collect()[0][0]
    assert 0 < float(total) <= 100.0 + 0.01 * 6


def test_statuses_partition_products(model):
    sc = reports.stock_coverage(model, AS_OF)
    assert sc.count() == sc.select("product_id").distinct().count()
    assert sc.where(~F.col("stock_status").isin("NO_SALES", "CRITICAL", "LOW", "OK")).count() == 0


def test_interpolation_keeps_known_points_and_residuals_sum_to_zero(model, spark):
    pm = forecast.product_monthly_revenue(model, AS_OF)
    top = forecast.top_recent_products(pm, 5)
    series = pm.join(top, "product_id", "left_semi").select("product_id", "month", "revenue")
    fit = forecast.fill_and_fit(series, ["product_id"])
    rows = {r.product_id: r for r in fit.collect()}
    import numpy as np
    for pid, r in rows.items():
        pts = sorted((m.month, float(m.revenue)) for m in series.where(F.col("product_id") == pid).collect())
        first = pts[0][0]
        idx = [(m.year - first.year) * 12 + m.month - first.month for m, _ in pts]
        full = np.interp(np.arange(idx[-1] + 1), idx, [v for _, v in pts])
        assert r.span == len(full) and r.raw_months == len(pts)
        resid = full - (r.intercept + r.slope * np.arange(len(full)))
        assert abs(resid.sum()) < 1e-6 * max(1.0, float(np.abs(full).sum()))
