"""Forecast semantics (FIXTURES.md §3: E7-E10, E14) and an OLS property test."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.operators import forecast
from tests.conftest import AS_OF, product, sale


def month_sales(values, start=(2000, 1), pid=1, first_id=0):
    out, (y, m) = [], start
    for i, v in enumerate(values):
        if v is not None:
            out.append(sale(first_id + i, dt.date(y, m, 1), pid, 1, v))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def test_e7_interpolation_then_trend(make_model):
    # 24-month window from 2001-11-04 starts 1999-11-04
    m = make_model(sales=month_sales([10, None, None, 40, 50, 60], start=(2001, 1)))
    r = forecast.forecast_total(m, AS_OF).collect()
    # raw months = 4 < 6: no forecast for the total
    assert r == []
    m = make_model(sales=month_sales([10, None, None, 40, 50, 60, 70, 80], start=(2001, 1)))
    r = forecast.forecast_total(m, AS_OF).collect()
    assert [(str(x.month), x.forecast_revenue, x.lower_bound, x.upper_bound) for x in r] == [
        ("2001-09-01", 90.0, 81.0, 99.0), ("2001-10-01", 100.0, 90.0, 110.0), ("2001-11-01", 110.0, 99.0, 121.0)]


def test_e8_product_min_history_is_on_filled_span(make_model):
    # 5 raw months spanning 7: product forecast is made (span 7 >= 6), total is not (5 < 6)
    vals = [10, None, 30, None, 50, 60, 70]
    m = make_model(sales=month_sales(vals, start=(2001, 1)))
    assert forecast.forecast_total(m, AS_OF).count() == 0
    r = forecast.forecast_products(m, AS_OF).collect()
    assert [x.forecast_revenue for x in r] == [80.0, 90.0, 100.0]


def test_e9_falling_series(make_model):
    vals = [60, 50, 40, 30, 20, 10]
    m = make_model(sales=month_sales(vals, start=(2001, 4)))
    p = forecast.forecast_products(m, AS_OF).collect()
    assert [x.forecast_revenue for x in p] == [0.0, 0.0, 0.0]
    t = forecast.forecast_total(m, AS_OF).collect()
    assert t[0].forecast_revenue == 0.0 and t[1].forecast_revenue == -10.0
    assert t[1].lower_bound == -9.0 and t[1].upper_bound == -11.0   # inverted band


def test_e10_horizon_starts_after_own_last_month(make_model):
    a = month_sales([10, 20, 30, 40, 50, 60], start=(2001, 6), pid=1)
    b = month_sales([10, 20, 30, 40, 50, 60], start=(2001, 4), pid=2, first_id=100)
    m = make_model(sales=a + b)
    r = forecast.forecast_products(m, AS_OF).collect()
    first = {x.product_id: str(x.forecast_month) for x in r if x.forecast_revenue == 70.0}
    assert first == {1: "2001-12-01", 2: "2001-10-01"}


def test_top_n_selection_and_skip(make_model):
    long_series = month_sales([10] * 8, start=(2001, 3), pid=1)
    short_but_big = month_sales([1000, 1000], start=(2001, 10), pid=2, first_id=100)
    m = make_model(sales=long_series + short_but_big)
    # top 1 is product 2, whose span is 2 < 6: skipped and not replaced
    assert forecast.forecast_products(m, AS_OF, top_n=1).count() == 0
    assert {r.product_id for r in forecast.forecast_products(m, AS_OF, top_n=2).collect()} == {1}


def test_e14_empty_forecast_keeps_schema(make_model):
    m = make_model(sales=[])
    t = forecast.forecast_total(m, AS_OF)
    assert t.count() == 0 and t.columns == ["month", "forecast_revenue", "lower_bound", "upper_bound"]
    p = forecast.forecast_products(m, AS_OF)
    assert p.count() == 0 and p.columns == ["product_id", "product_name", "forecast_month", "forecast_revenue"]


def test_horizon_must_be_positive(make_model):
    with pytest.raises(ValueError):
        forecast.forecast_total(make_model(sales=[]), AS_OF, months_ahead=0)


def test_matrix_pivots_horizons(make_model):
    m = make_model(sales=month_sales([10, 20, 30, 40, 50, 60], start=(2001, 6)))
    r = forecast.forecast_matrix(m, AS_OF).collect()
    assert [(x.product_id, x.month_1, x.month_2, x.month_3) for x in r] == [(1, 70.0, 80.0, 90.0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(1, 10_000)), min_size=6, max_size=12))
def test_fit_matches_numpy(spark, values):
    values = [v if v is not None else None for v in values]
    values[0] = values[0] or 5
    values[-1] = values[-1] or 7
    from tests.conftest import CATS, STORES
    from shelfwise.sources.model import model_from_rows
    m = model_from_rows(spark, sales=month_sales(values, start=(2000, 12)), products=[product(1)],
                        categories=CATS, stores=STORES)
    got = [r.forecast_revenue for r in forecast.forecast_products(m, AS_OF).collect()]
    y = np.array([np.nan if v is None else float(v) for v in values])
    idx = np.arange(len(y))
    known = ~np.isnan(y)
    y = np.interp(idx, idx[known], y[known])
    slope, intercept = np.polyfit(idx, y, 1)
    want = [max(intercept + slope * (len(y) - 1 + h), 0) for h in (1, 2, 3)]
    assert np.allclose(got, want, atol=0.011)
