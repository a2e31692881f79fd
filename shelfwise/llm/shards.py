"""Sharding: a uniform shuffle into shards of exact sizes.

The number of rows that each source partition sends to each shard is drawn
first (a multivariate hypergeometric communication matrix).  Each partition
permutes its rows locally and deals them out by its matrix row; the rows are
exchanged and permuted again inside their shard.  Every assignment of rows to
shard places is equally likely, and shard sizes are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import n_partitions, stage

_NUMPY_LIMIT = 10 ** 9          # numpy draws hypergeometric variates below this population


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Good ones among ``sample`` draws without replacement, for any population.

    Beyond numpy's limit: keep each item with probability sample / population,
    then correct the difference (about its square root) by drawing that many
    items back out of the kept, or in from the rest - the same problem, smaller.
    """
    total = good + bad
    if sample > total - sample:
        return good - hypergeometric(rng, good, bad, total - sample)
    if sample == 0 or good == 0:
        return 0
    if bad == 0:
        return sample
    if total < _NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, sample))
    if sample <= 64:
        taken = 0
        for i in range(sample):
            taken += int(rng.integers(total - i) < good - taken)
        return taken
    kept_good = int(rng.binomial(good, sample / total))
    kept_bad = int(rng.binomial(bad, sample / total))
    extra = kept_good + kept_bad - sample
    if extra >= 0:
        return kept_good - hypergeometric(rng, kept_good, kept_bad, extra)
    return kept_good + hypergeometric(rng, good - kept_good, bad - kept_bad, -extra)


def draw_row(rng: np.random.Generator, room: np.ndarray, rows: int) -> np.ndarray:
    """How many of ``rows`` rows go to each shard with ``room`` places left."""
    out, left, places = np.zeros(len(room), dtype=np.int64), rows, int(room.sum())
    for shard, size in enumerate(room.tolist()):
        out[shard] = hypergeometric(rng, size, places - size, left)
        left -= int(out[shard])
        places -= size
    return out


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes at most one apart."""
    return np.array([rows // shards + (s < rows % shards) for s in range(shards)], dtype=np.int64)


def communication_matrix(counts: DataFrame, shards: int, seed: int, groups: int = 256) -> DataFrame:
    """(part, ends): cumulative shard counts per partition, from (part, rows).

    The matrix is drawn in two levels, so that the driver only sees ``groups``
    totals however many partitions there are: it deals the shard places to
    groups of partitions, each group deals its share to its own partitions.
    """
    counts = counts.withColumn("grp", F.pmod(F.col("part"), F.lit(groups)).cast("int"))
    totals = {r["grp"]: r["rows"] for r in counts.groupBy("grp").agg(F.sum("rows").alias("rows")).collect()}
    rng, room, shares = np.random.default_rng([seed, 0]), shard_sizes(sum(totals.values()), shards), {}
    for grp in sorted(totals):
        drawn = draw_row(rng, room, totals[grp])
        room = room - drawn
        shares[grp] = drawn.tolist()

    def deal(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        own = np.random.default_rng([seed, 1, int(key[0])])
        left, out = np.array(shares[int(key[0])], dtype=np.int64), []
        for part, rows in frame.sort_values("part")[["part", "rows"]].itertuples(index=False):
            drawn = draw_row(own, left, int(rows))
            left = left - drawn
            out.append((int(part), np.cumsum(drawn).tolist()))
        return pd.DataFrame(out, columns=["part", "ends"])

    return counts.groupBy("grp").applyInPandas(deal, "part long, ends array<long>")


def uniform_shards(df: DataFrame, shards: int, seed: int = 20, block_rows: int = 100_000) -> DataFrame:
    """All rows and columns of ``df`` plus ``shard`` (0..shards-1) and ``slot``
    (gapless from 0 in each shard), a uniform shuffle with shard sizes at most
    one apart.

    The rows are staged once with their source partition and place in it; the
    draws depend on these and ``seed`` only, so a lost executor changes
    nothing.  Nulls, equal and repeated rows are ordinary rows.  Input columns
    named like the helper columns (``__part``, ``__row``) are not allowed;
    columns called shard or slot are replaced.  An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = df.sparkSession
    rows = stage(df.drop("shard", "slot").withColumn("__part", F.spark_partition_id().cast("long"))
                 .withColumn("__row", F.monotonically_increasing_id()), "shard-rows")
    counts = rows.groupBy(F.col("__part").alias("part")).agg(F.count("*").alias("rows"))
    matrix = stage(communication_matrix(counts, shards, seed), "shard-matrix")

    def draw(salt: int):
        return F.xxhash64(F.col("__row"), F.lit(seed), F.lit(salt))

    # permute locally: the order of a partition's rows by a random key, cut at the matrix row
    local = Window.partitionBy("__part").orderBy(draw(1), "__row")
    dealt = (rows.withColumn("__rank", F.row_number().over(local) - 1)
             .join(matrix.withColumnRenamed("part", "__part"), "__part")
             .withColumn("shard", F.expr("size(filter(ends, e -> e <= __rank))").cast("int")).drop("ends", "__rank"))
    # exchange and permute again: a second random key orders each shard; its leading bits cut the
    # shard into blocks of about block_rows, so no task holds a whole shard
    total = counts.agg(F.sum("rows")).first()[0] or 0
    blocks = max(1, -(-total // (shards * block_rows)))
    dealt = (dealt.withColumn("__key", draw(2))
             .withColumn("__block", F.floor((F.shiftrightunsigned(F.col("__key"), 33) * blocks) / F.lit(1 << 31)))
             )
    dealt = stage(dealt, "shard-dealt") if blocks > 1 else dealt
    in_block = Window.partitionBy("shard", "__block").orderBy(F.shiftrightunsigned("__key", 1), "__key", "__row")
    ranked = dealt.repartition(n_partitions(spark), "shard", "__block").withColumn(
        "slot", (F.row_number().over(in_block) - 1).cast("long"))
    if blocks > 1:
        before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        sizes = (dealt.groupBy("shard", "__block").agg(F.count("*").alias("__n"))
                 .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
        ranked = ranked.join(sizes, ["shard", "__block"]).withColumn("slot", F.col("slot") + F.col("__before"))
    return ranked.select(*[c for c in df.columns if c not in ("shard", "slot")], "shard", "slot")
