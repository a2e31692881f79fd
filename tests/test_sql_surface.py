"""The SQL path: statements over the registered views with ``fetch_df`` agree
with the DataFrame operators."""

from shelfwise.operators import kpis, reports
from shelfwise.sinks.writers import register_views
from shelfwise.sources.model import load_model
from shelfwise.sources.sql import fetch_df
from tests.conftest import AS_OF, SF_SMALL


def test_sql_over_views(spark):
    m = load_model(spark, SF_SMALL)
    m.register()
    register_views(spark, m, AS_OF)

    bands = fetch_df(spark, """
        SELECT CAST(floor(days_of_cover / :width) AS INT) AS band, count(*) AS n, sum(total_stock) AS stock
        FROM vw_stock_coverage GROUP BY ALL HAVING band IS NOT NULL""", {"width": 14}).collect()
    covers = [r for r in reports.stock_coverage_view(m, AS_OF).collect() if r.days_of_cover is not None]
    assert {r.band: (r.n, r.stock) for r in bands} == {
        b: (len(x), sum(r.total_stock for r in x))
        for b in {int(r.days_of_cover // 14) for r in covers}
        for x in [[r for r in covers if r.days_of_cover // 14 == b]]}
    assert sum(r.n for r in bands if r.band == 0) == kpis.critical_stock(m, AS_OF).count()

    share = fetch_df(spark, """
        WITH sold AS (SELECT product_id, sum(total_amount) AS amount FROM sales GROUP BY product_id)
        SELECT count(*) AS names, max(amount) AS best FROM (
          SELECT product_name, sum(amount) AS amount FROM sold NATURAL JOIN products GROUP BY product_name)""").first()
    assert share.best == kpis.top_product_names(m, AS_OF).first().revenue and share.names >= 10
    assert fetch_df(spark, "SELECT max(month) AS last FROM vw_monthly_revenue").first().last is not None
