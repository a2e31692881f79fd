"""Helpers to read executed (final adaptive) plans — used by the plan tests
and ``tools/plan_report.py`` on small test data only (``executed_plan`` runs
the query and collects its result so the adaptive plan is final); no
operator calls them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def _depth(line: str) -> int:
    return re.match(r"[\s:+\-]*", line).end()


def executed_plan(df: DataFrame, run: bool = True) -> str:
    """The executed plan text; with ``run`` the query is executed first so
    the adaptive plan is final.  Every ``Initial Plan`` subtree is dropped."""
    if run:
        df.collect()
    out, skip_at = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        if skip_at is not None:
            if line.strip() and _depth(line) <= skip_at:
                skip_at = None
            else:
                continue
        if "== Initial Plan ==" in line:
            skip_at = line.index("== Initial Plan ==") - 3    # column of its "+- " marker
            continue
        out.append(line)
    return "\n".join(out)


def _subplans(plan: str) -> list[list[tuple[int, str]]]:
    """The main plan and each subquery's own plan, as (depth, line) lists.  A
    subquery is printed between the operator that uses it and that operator's
    children; it is no part of their branch, so it is taken out as a plan of its
    own (its root keeps the subquery's depth)."""
    plans, open_ = [[]], [(-1, 0)]                  # (depth of the subquery's line, its plan's number)
    for line in plan.split("\n"):
        if not line.strip():
            continue
        d = _depth(line)
        while d <= open_[-1][0]:
            open_.pop()
        if re.match(r"(Reused)?Subquery", line[d:]):
            if line[d:].startswith("Reused"):
                continue
            plans.append([])
            open_.append((d, len(plans) - 1))
        else:
            plans[open_[-1][1]].append((d, line.strip()))
    return plans


def raw_fact_joins(plan: str, fact_marker: str = "lineitem.parquet") -> list[str]:
    """Joins that reach a fact scan with no aggregate (or top-k) on the way, in
    the plan and in each of its subqueries."""
    found = []
    for lines in _subplans(plan):
        path: list[tuple[int, str, int]] = []       # operators from the root to the current line
        reached = set()
        for number, (d, line) in enumerate(lines):
            while path and path[-1][0] >= d:
                path.pop()
            path.append((d, line, number))
            if fact_marker not in line:
                continue
            for _, above, at in reversed(path[:-1]):
                if "HashAggregate" in above or "TakeOrderedAndProject" in above:
                    break
                if "Join" in above and "Exchange" not in above:
                    reached.add(at)
        found += [lines[at][1] for at in sorted(reached)]
    return found
