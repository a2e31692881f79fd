import hashlib
import math
import random

import pytest

from shelfwise.llm import queries, vector_codes
from shelfwise.llm.common import bound_batches
from tests.conftest import SF_SMALL
from tests.llm.conftest import ordered, rows_of

SCHEMA = "vec_id long, embedding array<double>, label int"


def exact_floor(x):
    whole, part = divmod(x, 1.0) if abs(x) < 2 ** 53 else (x, 0.0)
    return int(whole) * 256 + math.floor(part * 256)


def brute(rows, parts=16, entries=64, rounds=2):
    """The whole contract with Python's integers."""
    def order(r):
        return (r[0] is None, r[0] or 0, r[1])
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])),
                  key=order)
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    ints = [[exact_floor(x) for x in r[1]] for r in kept]
    dim = len(ints[0])
    cuts = [(dim * p // parts, dim * (p + 1) // parts) for p in range(parts)]
    books = [[v[lo:hi] for v in ints[:entries]] for lo, hi in cuts]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p, (lo, hi) in enumerate(cuts):
            members = [[] for _ in books[p]]
            for v in ints:
                members[nearest(v[lo:hi], books[p])[1]].append(v[lo:hi])
            books[p] = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else e
                        for m, e in zip(members, books[p], strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for r, v in zip(kept, ints, strict=True):
        found = [nearest(v[lo:hi], b) for (lo, hi), b in zip(cuts, books, strict=True)]
        error = sum(d for d, _ in found)
        by_label[r[2]] = by_label.get(r[2], 0) + error
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), error, r[2]))
    return [(i, c, e if e < 1 << 63 else None, by_label[k] if by_label[k] < 1 << 63 else None, sha)
            for i, c, e, k in out]


def test_query_equals_plain_integers(spark):
    rows = rows_of(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label"))
    got = queries.op12_vector_codes(spark, SF_SMALL)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert ordered(rows_of(got)) == ordered(brute(rows))


@pytest.mark.parametrize("size, block_rows", [(1.0, 7), (1e6, 50), (1e12, 50), (1e30, 50), (3e300, 20)])
def test_every_size_of_number(spark, size, block_rows):
    bound_batches(spark)
    rng = random.Random(size)
    rows = [(i % 90, [rng.uniform(-size, size) for _ in range(32)], rng.choice([None, 1, 2])) for i in range(120)]
    rows += [rows[3], rows[3], (None, rows[5][1], 1), (200, None, 1), (201, [math.nan] * 32, 1), (202, [], 2),
             (203, [math.inf] + [0.0] * 31, 1), (204, [None] + [0.0] * 31, 1), (205, [1.0] * 31, 1)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", code string, error int")
    got = vector_codes.compressed_codes(table, block_rows=block_rows)
    assert ordered(rows_of(got)) == ordered(brute(rows))


def test_few_or_no_rows(spark):
    bound_batches(spark)
    few = [(5, [0.5] * 16, 1), (2, [0.25] * 16, None)]
    assert ordered(rows_of(vector_codes.compressed_codes(spark.createDataFrame(few, SCHEMA)))) == ordered(brute(few))
    assert vector_codes.compressed_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert rows_of(vector_codes.compressed_codes(spark.createDataFrame([(1, [], None)], SCHEMA)))[0][:4] == (
        1, "00" * 16, 0, 0)


def test_decoded_vectors_are_as_far_as_stated(spark):
    bound_batches(spark)
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    codes, books = vector_codes.compress(table)
    source = {r["vec_id"]: r["embedding"] for r in table.collect()}
    for r in codes.collect():
        near = books.decode(r["codes"])
        assert r["error"] == sum((math.floor(256 * a) - round(256 * b)) ** 2
                                 for a, b in zip(source[r["vec_id"]], near, strict=True))
