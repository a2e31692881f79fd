from collections import Counter

import numpy as np
import pytest

from shelfwise.llm import shards
from tests.llm.conftest import EDGE, ordered, rows_of


@pytest.mark.parametrize("block_rows", [100_000, 7])
def test_exact_sizes_and_gapless_slots(spark, block_rows):
    df = spark.range(1003).repartition(5).withColumnRenamed("id", "doc_id")
    rows = rows_of(shards.uniform_shards(df, 24, block_rows=block_rows))
    assert sorted(r[0] for r in rows) == list(range(1003))
    sizes = Counter(r[1] for r in rows)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r[2] for r in rows if r[1] == s) == list(range(n))


def test_edge_rows_keep_all_columns(edge, nothing):
    out = shards.uniform_shards(edge, 5)
    assert out.columns == [*edge.columns, "shard", "slot"]
    assert ordered((r["doc_id"], r["text"]) for r in out.collect()) == ordered(EDGE)
    assert shards.uniform_shards(nothing, 5).count() == 0
    with pytest.raises(ValueError, match="positive"):
        shards.uniform_shards(edge, 0)


def test_every_place_is_equally_likely(spark):
    """Where row 0 of 8 goes, over seeds: 2 shards x 4 slots."""
    df = spark.range(8).coalesce(1)
    places = Counter()
    for seed in range(40):
        places.update((r[1], r[2]) for r in rows_of(shards.uniform_shards(df, 2, seed=seed)))
        places.update((r[1],) for r in rows_of(shards.uniform_shards(df, 2, seed=seed)) if r[0] == 0)
    assert 8 <= places[(0,)] <= 32


def test_matrix_margins(spark):
    counts = spark.createDataFrame([(k, 10 + 3 * k) for k in range(300)], "part long, rows long")
    rows = rows_of(shards.communication_matrix(counts, 7, seed=1, groups=16))
    drawn = np.array([np.diff([0, *ends]) for _, ends in sorted(rows)])
    assert drawn.sum(1).tolist() == [10 + 3 * k for k in range(300)] and (drawn >= 0).all()
    assert drawn.sum(0).tolist() == shards.shard_sizes(int(drawn.sum()), 7).tolist()


@pytest.mark.parametrize(("good", "bad", "sample"), [(6, 4, 5), (3 * 10**9, 10**9, 10**6), (10**11, 10**10, 6 * 10**10)])
def test_hypergeometric_moments(good, bad, sample):
    rng, n = np.random.default_rng(4), 3000
    draws = np.array([shards.hypergeometric(rng, good, bad, sample) for _ in range(n)], float)
    total = good + bad
    mean = sample * good / total
    var = sample * (good / total) * (bad / total) * (total - sample) / (total - 1)
    assert draws.min() >= max(0, sample - bad) and draws.max() <= min(good, sample)
    assert abs(draws.mean() - mean) < 5 * (var / n) ** 0.5
    assert 0.85 < draws.var() / var < 1.15
