"""Default parameters shared by the operators.

Fixed values — these must equal the reference's for the same results:
forecast horizon 3 months; low-seller threshold 10 units (50 in the view
form); stock warning below 14 days of cover, LOW below 30; velocity over a
30-day window divided by 30; 60 % cost ratio (ETL, gross-profit measure and
the test-data cost price); trailing windows of 90 days (sellers, category
share), 730 days (ETL), 12 months (rolling average, frame of 6), 24 months
(total forecast), 18 months (product forecast, top 10 products ranked over
the last 3 months); at least 6 months of history; forecast band 0.90 / 1.10.
"""

FORECAST_MONTHS = 3
LOW_SELLER_THRESHOLD = 10
LOW_SELLER_VIEW_THRESHOLD = 50
STOCK_WARNING_DAYS = 14
STOCK_LOW_DAYS = 30
VELOCITY_WINDOW_DAYS = 30
VELOCITY_PER_DAYS = 30
COST_RATIO = "0.60"
SELLERS_WINDOW_DAYS = 90
ETL_LOOKBACK_DAYS = 730
ROLLING_HISTORY_MONTHS = 12
ROLLING_FRAME_MONTHS = 6
FORECAST_TOTAL_HISTORY_MONTHS = 24
FORECAST_PRODUCT_HISTORY_MONTHS = 18
FORECAST_TOP_N = 10
FORECAST_RECENT_MONTHS = 3
MIN_HISTORY_MONTHS = 6
BAND_LOW, BAND_HIGH = 0.90, 1.10
