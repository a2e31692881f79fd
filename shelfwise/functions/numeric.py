"""Money, ratio and rounding helpers.

Money stays DECIMAL inside every plan (sums are exact); ratios use guarded
division because ANSI mode raises on a zero divisor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def half_up(num: Column, den: Column, scale: int) -> Column:
    """Exact ``round(num / den, scale)``, half away from zero, as a decimal.

    ``num`` and ``den`` must be integral (counts, units, cents).  As
    DECIMAL(20,0) operands the quotient keeps 18 fractional digits, so the
    final rounding is never disturbed by an earlier one.  NULL when ``den``
    is zero.
    """
    n = num.cast(T.DecimalType(20, 0))
    d = den.cast(T.DecimalType(20, 0))
    return F.round(F.try_divide(n, d), scale)


# half a cent plus a millionth of a cent
ROUND_GUARD = 0.500001


def guarded_round2(x: Column) -> Column:
    """Round a double to cents, half-up, absorbing last-bit noise.

    Least-squares fits are computed in floating point and can land exactly on
    a half cent; engines differ in the last bit there.  A 1e-6-cent nudge
    makes the result stable.
    """
    return F.floor(x * 100 + F.lit(ROUND_GUARD)) / 100


def to_edge(df: DataFrame) -> DataFrame:
    """Cast report outputs to their published types: money/ratios to DOUBLE,
    integers to BIGINT.  Applied once, at the edge of a report."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("long").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
