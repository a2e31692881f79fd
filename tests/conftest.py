import datetime as dt
import sys
import tempfile
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfwise.session import build_session, ensure_checkpoint_dir  # noqa: E402
from shelfwise.sources.model import model_from_rows  # noqa: E402

AS_OF = dt.date(2001, 11, 4)
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="shelfwise-test-")
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse",
                             "spark.driver.memory": "4g",
                             "spark.sql.maxMetadataStringLength": "2000"})      # plan tests read whole filters
    ensure_checkpoint_dir(s, f"{scratch}/checkpoints")
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def sale(sale_id, date, product_id, qty, amount, store_id=1):
    amount = money(amount)
    return (sale_id, d(date) if isinstance(date, str) else date, product_id, store_id, qty,
            money(amount / qty), amount)


def product(pid, name=None, category_id=1, price="10.00", cost="6.00", sku=None):
    return (pid, sku or f"SKU-{pid}", name or f"product {pid}", category_id, money(price), money(cost))


CATS = [(1, "Alpha"), (2, "Beta")]
STORES = [(1, "S1", "R", "C"), (2, "S2", "R", "C")]


@pytest.fixture()
def make_model(spark):
    def build(sales=(), products=None, categories=None, stores=None, inventory=()):
        return model_from_rows(
            spark,
            sales=list(sales),
            products=list(products if products is not None else [product(1), product(2)]),
            categories=list(categories if categories is not None else CATS),
            stores=list(stores if stores is not None else STORES),
            inventory=list(inventory),
        )
    return build
