"""Plan checks: no Python in the hot path, no Cartesian products, pushdown
and pruning reach the scan, top-k stays a distributed top-k."""

import pytest

from shelfwise.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_cartesian(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_date_filter_and_columns_reach_parquet(spark):
    plan = plan_of(QUERIES["top_sellers"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
    assert "TakeOrderedAndProject" in plan


def test_fact_aggregated_before_dimension_join(spark):
    plan = QUERIES["top_sellers"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # the join's fact side is an Aggregate, not raw lineitem rows
    # the product join's fact side is an Aggregate, and category names are attached after it
    join = plan.index("Join Inner, (product_id")
    assert plan[join:].split("\n")[1].strip(" :").startswith("- Aggregate [product_id")
    assert plan.index("Join Inner, (category_id") < join


def test_orphan_lookups_stay_above_the_key_aggregate(spark):
    # semi/anti joins would be pushed below the aggregate and join raw fact rows
    plan = plan_of(QUERIES["constraint_report"](spark, SF_SMALL))
    assert "LeftAnti" not in plan and "LeftSemi" not in plan
    assert plan.count("LeftOuter") == 3


@pytest.mark.parametrize("name", ["forecast_products", "forecast_matrix"])
def test_forecasts_read_one_product_month_table(spark, name):
    """The top-N's month, its ranking and the series come from one written table, the fact is no part of the plan."""
    from shelfwise.plans.inspect import executed_plan, raw_fact_joins
    plan = executed_plan(QUERIES[name](spark, SF_SMALL))
    assert "lineitem" not in plan and "product-months" in plan
    semi = plan[plan.index("LeftSemi"):]
    assert plan.count("LeftSemi") == 1 and "TakeOrderedAndProject(limit=10" in semi
    assert raw_fact_joins(plan, "product-months")       # the semi-join is by rows already summed


def test_product_months_scan_the_fact_once(spark):
    from shelfwise.operators.forecast import product_monthly_revenue
    from shelfwise.plans.catalog import AS_OF, load_model
    from shelfwise.plans.inspect import executed_plan, raw_fact_joins
    plan = executed_plan(product_monthly_revenue(load_model(spark, SF_SMALL), AS_OF))
    assert plan.count("lineitem.parquet") == 1 and raw_fact_joins(plan) == []


RAW_JOIN_ALLOWED = {
    "etl_extract": "line-level enrichment is the operator",
    "etl_clean_repeated": "the same, on a doubled extract",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_fact_meets_dimensions_only_after_aggregation(spark, name):
    from shelfwise.plans.inspect import executed_plan, raw_fact_joins
    joins = raw_fact_joins(executed_plan(QUERIES[name](spark, SF_SMALL)))
    if name in RAW_JOIN_ALLOWED:
        assert joins                      # product, then category name, per line
    else:
        assert joins == [], joins


@pytest.mark.parametrize("name", ["category_contribution", "daily_summary", "yoy_growth", "yoy_growth_by_quarter",
                                  "top10_revenue_by_month", "sliced_ytd_kpis", "etl_extract", "etl_clean"])
def test_fact_is_read_once(spark, name):
    from shelfwise.plans.inspect import executed_plan
    assert str(executed_plan(QUERIES[name](spark, SF_SMALL))).count("lineitem.parquet") == 1


def test_constraints_take_two_narrow_scans(spark):
    """One for the primary key alone, one for the rules and foreign keys."""
    from shelfwise.plans.inspect import executed_plan
    plan = executed_plan(QUERIES["constraint_report"](spark, SF_SMALL))
    assert plan.count("lineitem.parquet") == 2 and plan.count("ReadSchema: struct<l_orderkey:bigint>") == 1


# Two shapes of one plan: the subquery prints the distinct ids' aggregate or a reused exchange.
SUBQUERY_PLAN = """\
*(9) Project [product_id#1L]
+- *(9) BroadcastHashJoin [product_id#1L], [product_id#2L], Inner, BuildRight, false
   :- *(9) HashAggregate(keys=[product_id#1L], functions=[sum(total#3)])
   :  +- AQEShuffleRead coalesced
   :     +- Exchange hashpartitioning(product_id#1L, 4)
   :        +- *(1) HashAggregate(keys=[product_id#1L], functions=[partial_sum(total#3)])
   :           +- *(1) Filter (sale_date#4 >= Subquery subquery#5, [id=#6])
   :              :  +- Subquery subquery#5, [id=#6]
   :              :     +- *(7) HashAggregate(keys=[], functions=[max(last_month#7)])
   :              :        +- *(6) BroadcastHashJoin [product_id#8L], [product_id#9L], Inner, {side}, false
   :              :           :- {left}
   :              :           +- *(5) HashAggregate(keys=[product_id#8L], functions=[max(month#10)])
   :              :              +- *(5) FileScan parquet [l_partkey#8L] Location: [file:/x/lineitem.parquet]
   :              +- *(1) FileScan parquet [l_partkey#1L] Location: [file:/x/lineitem.parquet]
   +- BroadcastExchange HashedRelationBroadcastMode(List(input[0, bigint, true]))
      +- *(8) FileScan parquet [product_id#2L] Location: [file:/x/products]
"""


@pytest.mark.parametrize("side, left", [
    ("BuildLeft", "ReusedExchange [product_id#9L], BroadcastExchange HashedRelationBroadcastMode, [plan_id=11]"),
    ("BuildRight", "*(4) HashAggregate(keys=[product_id#9L], functions=[])")])
def test_plan_reader_keeps_subqueries_apart(side, left):
    from shelfwise.plans.inspect import raw_fact_joins
    assert raw_fact_joins(SUBQUERY_PLAN.format(side=side, left=left)) == []
    raw = SUBQUERY_PLAN.replace("*(5) HashAggregate", "*(5) Project").format(side=side, left=left)
    assert [j.split("Inner")[0].strip() for j in raw_fact_joins(raw)] == [
        "+- *(6) BroadcastHashJoin [product_id#8L], [product_id#9L],"] or [
        j for j in raw_fact_joins(raw) if "product_id#8L" in j]
    outer = SUBQUERY_PLAN.replace("*(1) HashAggregate", "*(1) Project").replace("*(9) HashAggregate", "*(9) Project")
    assert any("product_id#1L" in j for j in raw_fact_joins(outer.format(side=side, left=left)))


def test_group_limit_before_the_shuffle(spark):
    plan = plan_of(QUERIES["top10_revenue_by_month"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan[plan.index("WindowGroupLimit"):]


def test_extract_joins_lines_once(spark):
    from shelfwise.plans.inspect import executed_plan, raw_fact_joins
    assert len(raw_fact_joins(executed_plan(QUERIES["etl_extract"](spark, SF_SMALL)))) == 1
