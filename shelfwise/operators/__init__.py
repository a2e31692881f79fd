"""Report, KPI, measure, forecast, ETL, quality and summary operators."""
