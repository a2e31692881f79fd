"""The declared constraints enforced on write (DQ-1..4): rows that break one are
set aside with the names of the rules they break, the others go on.

Each row is judged once.  Row rules are plain expressions.  Parents and repeated
keys are found from aggregated keys, so a key that a third of the rows hold is one
row of that search; what comes back to the rows is only the list of keys without
a parent and of repeated keys, which is short unless the data is bad.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfwise.operators.quality import CHECKS, FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, UNIQUE
from shelfwise.session import write_once
from shelfwise.sources.model import StarModel

BROKEN, ROW = "broken_rules", "__row"


def row_rules(table: str) -> list[tuple[str, Column]]:
    """(rule, violated) for the rules that a row breaks by itself; a null breaks no CHECK."""
    rules = [(f"not_null:{c}", F.col(c).isNull()) for c in NOT_NULL[table]]
    return rules + [(name, F.coalesce(violated(), F.lit(False))) for t, name, violated in CHECKS if t == table]


def key_rules(table: str) -> list[tuple[str, list[str]]]:
    """(rule, key columns) of the table's PRIMARY KEY and UNIQUE constraints."""
    own = [(f"primary_key:{PRIMARY_KEYS[table]}", [PRIMARY_KEYS[table]])] if table in PRIMARY_KEYS else []
    return own + [("unique:" + ",".join(keys), keys) for keys in UNIQUE.get(table, [])]


def _orphans(rows: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``column`` that no parent has (nulls have none to miss)."""
    own = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count("*").alias("n"))
    known = parents.select(F.col(key).alias("k")).distinct().withColumn("found", F.lit(True))
    return own.join(known, "k", "left").where("found is null").select("k")


def _marked(rows: DataFrame, rule: str, columns: list[str], bad: DataFrame, value: str = "hit") -> DataFrame:
    """``rows`` with ``rule`` = the ``value`` of the ``bad`` keys (null elsewhere)."""
    on = reduce(lambda a, b: a & b, [rows[c] == bad[f"k{i}"] for i, c in enumerate(columns)])
    return rows.join(bad.withColumnRenamed(value, rule), on, "left").drop(*[f"k{i}" for i in range(len(columns))])


def judged(rows: DataFrame, table: str, model: StarModel, keys: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """``rows`` plus ``broken_rules``: the sorted names of the constraints of
    ``table`` that each row breaks (empty: none).

    Foreign keys are looked up in ``model``; ``keys`` replaces the table's PRIMARY
    KEY and UNIQUE rules.  Of rows that share a key the first in the order of the
    batch stays, as it would if they were inserted one by one; null keys never
    collide, but a null PRIMARY KEY is refused.  Columns named like the rules must
    not occur; repeated rows are rows of their own; an empty table gives none.
    """
    keys = key_rules(table) if keys is None else keys
    columns = rows.columns
    # numbered as written, so that "first" means the same in every later read
    out = numbered = write_once(rows.withColumn(ROW, F.monotonically_increasing_id()), f"{table}-judged")
    found = row_rules(table)
    for child, column, parent, key in FOREIGN_KEYS:
        if child == table:
            rule = f"foreign_key:{column}->{parent}.{key}"
            bad = _orphans(numbered, column, getattr(model, parent), key).select(
                F.col("k").alias("k0"), F.lit(True).alias("hit"))
            out = _marked(out, rule, [column], bad)
            found.append((rule, F.col(f"`{rule}`").isNotNull()))
    for rule, names in keys:
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
        repeated = (numbered.where(whole).groupBy(*[F.col(c).alias(f"k{i}") for i, c in enumerate(names)])
                    .agg(F.min(ROW).alias("hit"), F.count("*").alias("n")).where("n > 1").drop("n"))
        out = _marked(out, rule, names, repeated)
        later = F.coalesce(F.col(f"`{rule}`") != F.col(ROW), F.lit(False))
        refused = F.col(names[0]).isNull() if rule.startswith("primary_key:") else F.lit(False)
        found.append((rule, later | refused))
    names = F.array(*[F.when(violated, F.lit(rule)) for rule, violated in sorted(found, key=lambda f: f[0])])
    return out.select(*columns, F.array_compact(names).alias(BROKEN))


@dataclass(frozen=True)
class Split:
    accepted: DataFrame
    quarantined: DataFrame
    counts: dict[str, int]          # rows, accepted, and rows that break each rule


def split(rows: DataFrame, table: str, model: StarModel, keys: list[tuple[str, list[str]]] | None = None) -> Split:
    """The rows that break no constraint and those that do (with ``broken_rules``),
    both read from one written result; the counts are observed while it is written."""
    rules = [r for r, _ in row_rules(table)] + [
        f"foreign_key:{c}->{p}.{pc}" for child, c, p, pc in FOREIGN_KEYS if child == table] + [
        r for r, _ in (key_rules(table) if keys is None else keys)]
    seen = Observation(f"{table}-rules")
    clean = F.size(BROKEN) == 0
    counted = judged(rows, table, model, keys).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(clean).alias("accepted"),
        *[F.count_if(F.array_contains(BROKEN, r)).alias(r) for r in rules])
    written = write_once(counted, f"{table}-split")
    return Split(written.where(clean).drop(BROKEN), written.where(~clean), {k: int(v) for k, v in seen.get.items()})
