"""Cells of the demand grid drawn by the batch, and sums of such batches (numpy and Arrow, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfwise.functions.numbering import PRIME, draw_seeded, seed_array

# Rows of the grid and of its sums over runs, as Spark schemas.
CELL_SCHEMA = ("sale_date date, product_id long, store_id long, quantity int, unit_price decimal(12,2), "
               "total_amount decimal(14,2)")
RUN_SCHEMA = "sale_date date, store_id long, products_sold long, units long, revenue decimal(24,2)"
CELL_COLUMNS, RUN_COLUMNS = ([c.split()[0] for c in schema.split(", ")] for schema in (CELL_SCHEMA, RUN_SCHEMA))

# Cells drawn together (arrays of that length stay in the processor's cache), and the low bits of a
# draw that are left out when its units are looked up.
BATCH_CELLS = 65_536
BUCKET_BITS = 19
BUCKETS = (PRIME >> BUCKET_BITS) + 1


def units_by_bucket(steps: np.ndarray) -> np.ndarray:
    """Units of the draws in each bucket by an inverse table; -1 where a step lies within the bucket."""
    low = np.arange(BUCKETS) << BUCKET_BITS
    first, last = (np.searchsorted(steps, at, side="right") for at in (low, low + (1 << BUCKET_BITS) - 1))
    return np.where(first == last, first, -1)


def cents_array(cents: np.ndarray, known: np.ndarray | None, digits: int) -> pa.Array:
    """decimal(digits, 2) of whole cents, null where not ``known``."""
    words = np.empty((len(cents), 2), np.int64)             # a decimal has 128 bits, the low ones first
    words[:, 0], words[:, 1] = cents, cents >> 63
    valid = None if known is None else pa.py_buffer(np.packbits(known, bitorder="little"))
    return pa.Array.from_buffers(pa.decimal128(digits, 2), len(cents), [valid, pa.py_buffer(words)])


def _known(column: pa.Array) -> np.ndarray:
    return column.is_valid().to_numpy(zero_copy_only=False)


def draw_tile(first_product: int, first_store: int, product_id: pa.Array, cents: pa.Array, store_id: pa.Array,
              calendar: pa.StructArray, n_stores: int, slow_every: int, chance: int,
              steps: list[list[int]]) -> Iterator[pa.RecordBatch]:
    """The sold cells of consecutive products (ids, prices in cents) from number ``first_product`` on in
    consecutive stores from ``first_store`` on, on all days of ``calendar`` (day from 1970, factors); a
    batch has one day and whole stores.

    ``steps``: inverse tables of usual and of slow products (ids divisible by ``slow_every``)."""
    n = len(product_id)
    slow = (product_id.fill_null(1).to_numpy() % slow_every == 0).astype(np.int64)
    known = _known(cents) if cents.null_count else None
    cents = cents.fill_null(0).to_numpy()
    unit_price = cents_array(cents, known, 12)
    steps = [np.array(s) for s in steps]
    units_at, most = np.concatenate([units_by_bucket(s) for s in steps]), max(map(len, steps))
    # a cell's number is (product_no * n_stores + store_no) * 65536 + day: the day has room for
    # 65536 values, so the number does not depend on the range of days asked for
    of_product = np.arange(first_product, first_product + n) * (n_stores * 65536)
    of_store = np.arange(first_store, first_store + len(store_id)) * 65536
    at_once = max(1, BATCH_CELLS // n)
    for day, weekday, season in zip(*(x.to_numpy() for x in calendar.flatten()), strict=True):
        quantity_of = np.maximum(1, np.floor(np.arange(most + 1) * weekday * season)).astype(np.int32)
        quantity_at = np.where(units_at < 0, np.int32(-1), quantity_of[units_at])
        for k in range(0, len(of_store), at_once):
            seed = seed_array(np.add.outer(of_store[k:k + at_once] + day, of_product).ravel())
            sold = np.flatnonzero(draw_seeded(seed, 1) < chance)
            u, (store, product) = draw_seeded(seed[sold], 2), np.divmod(sold, n)
            is_slow = slow[product]
            quantity = quantity_at[(u >> BUCKET_BITS) + BUCKETS * is_slow]
            split = np.flatnonzero(quantity < 0)
            usual_units, slow_units = (np.searchsorted(s, u[split], side="right") for s in steps)
            quantity[split] = quantity_of[np.where(is_slow[split], slow_units, usual_units)]
            rows = pa.array(product)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sold), day, np.int32)).cast(pa.date32()), product_id.take(rows),
                 store_id.take(pa.array(store + k)), pa.array(quantity), unit_price.take(rows),
                 cents_array(quantity * cents[product], None if known is None else known[product], 14)],
                names=CELL_COLUMNS)


def sum_runs(cells: pa.RecordBatch) -> pa.RecordBatch:
    """Products sold, units and revenue of each run of rows of one day and store; no price: no revenue."""
    keys, amount = [cells.column("sale_date"), cells.column("store_id")], cells.column("total_amount")
    ends = np.unique(np.concatenate([pc.run_end_encode(key).run_ends.to_numpy() for key in keys])).astype(np.int64)
    starts = np.concatenate([np.zeros(1, np.int64), ends])[:len(ends)]

    def total(column: np.ndarray) -> np.ndarray:
        return np.add.reduceat(column, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
    words = np.frombuffer(amount.fill_null(0).buffers()[1], np.int64)[::2] if len(starts) else starts
    known = total(_known(amount)) > 0 if amount.null_count else None
    return pa.RecordBatch.from_arrays(
        [*(key.take(pa.array(starts)) for key in keys), pa.array(ends - starts),
         pa.array(total(cells.column("quantity").to_numpy())), cents_array(total(words), known, 24)], names=RUN_COLUMNS)
