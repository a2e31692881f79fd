"""Gapless numbers and counter-based random draws as plain expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import write_once

# Fixed values of the draws: a prime modulus and multipliers below it, so that
# every product stays inside 64 bits in any SQL engine.
PRIME = 2_147_483_647
MULTIPLIERS = (48_271, 69_621, 1_597_334_677, 1_132_489_760)


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` plus ``name``: 0, 1, 2 ... in order of ``key`` (ties in any order),
    without a global sort: rows are range-partitioned, written with their place in
    the partition, and the partitions' sizes (one small row each) give the offsets."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = write_once(df.repartitionByRange(parts, key).sortWithinPartitions(key)
                        .withColumn("__part", F.spark_partition_id())
                        .withColumn("__place", F.monotonically_increasing_id()), "numbered")
    sizes = placed.groupBy("__part").agg(F.count("*").alias("n"), F.min("__place").alias("__first"))
    # as many rows as the sort had partitions, a setting
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", "__first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    return (placed.join(F.broadcast(offsets), "__part")
            .withColumn(name, F.col("__place") - F.col("__first") + F.col("__before"))
            .drop("__part", "__place", "__first", "__before"))


def draw(cell: Column, salt: int) -> Column:
    """A number in [0, PRIME) that depends on ``cell`` (0 or more) and ``salt``
    only: the same in any order of evaluation, on any executor, in any engine."""
    a, b, c, d = MULTIPLIERS
    high = F.call_function("div", cell, F.lit(PRIME)) % PRIME
    x = (cell % PRIME * a + high * b + F.lit(salt * 1_000_003)) % PRIME
    x = x.bitwiseXOR(F.shiftright(x, 15)) * c % PRIME
    x = x.bitwiseXOR(F.shiftright(x, 13)) * d % PRIME
    return x.bitwiseXOR(F.shiftright(x, 16)) % PRIME


def _reduce(x: np.ndarray, spare: np.ndarray) -> None:
    """x %= PRIME of products of two numbers below PRIME, in place; PRIME is 2^31 - 1, so the high bits
    are added to the low ones, and one PRIME less is a huge number without sign where it is not due."""
    np.right_shift(x, 31, out=spare)
    np.bitwise_and(x, PRIME, out=x)
    np.add(x, spare, out=x)
    np.subtract(x, PRIME, out=spare)
    np.minimum(x.view(np.uint64), spare.view(np.uint64), out=x.view(np.uint64))


def seed_array(cell: np.ndarray) -> np.ndarray:
    """What all draws of an int64 array of cells begin with: cell % PRIME * a + cell // PRIME * b."""
    a, b = MULTIPLIERS[:2]
    # cell * a may wrap around in 64 bits, the sum of both terms fits again
    return cell * a + cell // PRIME * (b - PRIME * a)


def draw_seeded(seed: np.ndarray, salt: int) -> np.ndarray:
    """``draw`` of the cells that ``seed_array`` was given."""
    x = seed + salt * 1_000_003
    spare = np.empty_like(x)
    _reduce(x, spare)
    for bits, factor in zip((15, 13), MULTIPLIERS[2:], strict=True):
        np.right_shift(x, bits, out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, factor, out=x)
        _reduce(x, spare)
    np.right_shift(x, 16, out=spare)
    np.bitwise_xor(x, spare, out=x)
    x[x == PRIME] = 0
    return x


def draw_array(cell: np.ndarray, salt: int) -> np.ndarray:
    """``draw`` of an int64 array.  As an expression a draw names its cell sixteen
    times, which a filter computes anew each time; here each step is taken once."""
    return draw_seeded(seed_array(cell), salt)
