"""The demand grid in tiles: no cell is joined or shuffled, every cell is drawn and summed once."""

import datetime as dt
import math
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.functions import demand
from shelfwise.functions.numbering import PRIME
from shelfwise.plans.inspect import executed_plan
from shelfwise.sources import seeds
from tests.conftest import product
from tests.test_round3 import plain_draw

DAYS = [dt.date(2001, 11, n) for n in (2, 3, 4)]


def plain_cells(products, stores):
    """Sold cells by loops; products (id, price) and stores (id) in order, nulls first."""
    steps = {slow: seeds.poisson_steps(0.5 if slow else 3.0) for slow in (True, False)}
    for pn, (pid, price) in enumerate(products):
        for sn, sid in enumerate(stores):
            for day in DAYS:
                number = (pn * len(stores) + sn) * 65536 + (day - dt.date(1970, 1, 1)).days
                if plain_draw(number, 1) < math.floor(0.55 * PRIME):
                    units = sum(plain_draw(number, 2) >= s for s in steps[pid is not None and pid % 4 == 0])
                    season = math.floor((1 + 0.15 * math.sin(2 * math.pi * day.timetuple().tm_yday / 365)) * 1e6 + 0.5) / 1e6
                    quantity = max(1, math.floor(units * (1.3 if day.weekday() > 4 else 1.0) * season))
                    yield day, pid, sid, quantity, price, None if price is None else quantity * price


@pytest.fixture()
def small_tiles(spark, monkeypatch):
    """Tiles of a few cells in batches of a few stores, and no join by broadcast."""
    for where, name, value in ((seeds, "TILE_CELLS", (120, 120)), (seeds, "BLOCK_ROWS", 7), (demand, "BATCH_CELLS", 12)):
        monkeypatch.setattr(where, name, value)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_cells_are_summed_where_drawn(spark, make_model, small_tiles):
    prices = [(None, Decimal("2.50")), *[(i, None if i % 5 == 0 else Decimal(f"{i}.99")) for i in range(1, 23)]]
    stores = [None, 3, 3, *range(8, 20)]                      # repeated stores are cells of their own
    m = make_model(products=[(pid, f"s{pid}", "p", 1, price, price) for pid, price in prices],
                   stores=[(i, "s", "R", "C") for i in stores])
    grid = seeds.demand_grid(m, str(DAYS[0]), str(DAYS[-1]))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, grid.collect()), key=key) == sorted(plain_cells(prices, stores), key=key)
    want = defaultdict(lambda: [0, 0, None])
    for day, _, sid, quantity, _, amount in plain_cells(prices, stores):
        sums = want[day, sid]
        sums[0], sums[1] = sums[0] + 1, sums[1] + quantity
        sums[2] = amount if sums[2] is None else sums[2] + (amount or 0)
    by_store = seeds.demand_by_store(m, str(DAYS[0]), str(DAYS[-1]))
    got = by_store.collect()
    assert {(r.sale_date, r.store_id): [r.products_sold, r.units, r.revenue] for r in got} == want and len(got) == len(want)
    assert [f.dataType.simpleString() for f in by_store.schema] == ["date", "bigint", "bigint", "bigint", "decimal(24,2)"]
    # drawn cells went through two sort-merge joins where the dimensions were not broadcast: 4 GB at 6 times sf0.1
    for frame, shuffles in ((grid, 0), (by_store, 1)):
        above = executed_plan(frame).split("MapInArrow")[0]
        assert "Join" not in above and above.count("Exchange") == shuffles


def test_no_price_no_revenue(spark, make_model):
    m = make_model(products=[product(1)[:4] + (None, None)], stores=[(1, "s", "R", "C")])
    days = seeds.demand_by_store(m, "2001-01-01", "2001-03-01").collect()
    assert days and all(r.revenue is None and r.products_sold == 1 and r.units >= 1 for r in days)
    assert seeds.demand_by_store(make_model(products=[]), "2001-01-01", "2001-03-01").isEmpty()
    assert seeds.demand_by_store(make_model(stores=[]), "2001-01-01", "2001-03-01").isEmpty()


def test_units_are_looked_up_exactly():
    for mean in (0.5, 3.0):
        steps = np.array(seeds.poisson_steps(mean))
        units = demand.units_by_bucket(steps)
        u = np.concatenate([[0, PRIME - 1], steps, steps - 1, steps + 1, np.arange(0, PRIME, 99_991)])
        u = u[u < PRIME]
        got, want = units[u >> demand.BUCKET_BITS], np.searchsorted(steps, u, side="right")
        assert ((got == want) | (got == -1)).all() and (got == -1).mean() < 0.05


def test_runs_are_summed():
    rows = [(DAYS[0], 1, 7, None, 2, None), (DAYS[0], 1, 7, None, 3, Decimal("-2.50")), (DAYS[0], 1, None, None, 1, None),
            (DAYS[1], 1, None, None, 4, Decimal("1.01")), (DAYS[1], 1, 7, None, 5, Decimal("999999999999.99"))]
    types = [pa.date32(), pa.int64(), pa.int64(), pa.decimal128(12, 2), pa.int32(), pa.decimal128(14, 2)]
    order = [0, 1, 2, 4, 3, 5]
    for some in (rows, rows[1:3], rows[3:], []):
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in some], types[i]) for i in order], names=demand.CELL_COLUMNS)
        assert [tuple(r.values()) for r in demand.sum_runs(batch).to_pylist()] == {
            5: [(DAYS[0], 7, 2, 5, Decimal("-2.50")), (DAYS[0], None, 1, 1, None), (DAYS[1], None, 1, 4, Decimal("1.01")),
                (DAYS[1], 7, 1, 5, Decimal("999999999999.99"))],
            2: [(DAYS[0], 7, 1, 3, Decimal("-2.50")), (DAYS[0], None, 1, 1, None)] if some == rows[1:3] else
               [(DAYS[1], None, 1, 4, Decimal("1.01")), (DAYS[1], 7, 1, 5, Decimal("999999999999.99"))], 0: []}[len(some)]
