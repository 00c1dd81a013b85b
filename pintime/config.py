"""Fixed values that must equal the reference's for the same results.

Fixed values (the lists below are in the reference's order):
  default TTL: 52 * 10 weeks; weekly bins close on Monday (Tue..Mon)
  model: 250 trees, depth 4, seed 42

Fixed values for the driver's stand-in tables (FIXTURES.md section 2):
  excluded locations: NATION_0, NATION_24; date floor 1996-01-01;
  drift windows 1997-01-01..1997-12-31 and 1998-01-01..1998-12-31;
  short TTL for the expiry check: 3 days.
"""

from __future__ import annotations

from datetime import timedelta

ENTITY_KEY = "state"
EVENT_TS = "event_timestamp"

TREND_FEATURES = [
    "lag_1_vaccine_interest",
    "lag_2_vaccine_interest",
    "lag_1_vaccine_intent",
    "lag_2_vaccine_intent",
    "lag_1_vaccine_safety",
    "lag_2_vaccine_safety",
]
COUNT_FEATURES = [
    "lag_1_weekly_vaccinations_count",
    "weekly_vaccinations_count",
    "lag_2_weekly_vaccinations_count",
]
X_COLS = [
    "lag_1_vaccine_interest",
    "lag_2_vaccine_interest",
    "lag_1_vaccine_intent",
    "lag_2_vaccine_intent",
    "lag_1_vaccine_safety",
    "lag_2_vaccine_safety",
    "lag_1_weekly_vaccinations_count",
    "lag_2_weekly_vaccinations_count",
]
Y_COL = "weekly_vaccinations_count"

DEFAULT_TTL = timedelta(weeks=52 * 10)
SHORT_TTL = timedelta(days=3)

EXCLUDED_LOCATIONS = ["NATION_0", "NATION_24"]
DATE_FLOOR = "1996-01-01"
DRIFT_WINDOW_A = ("1997-01-01", "1997-12-31")
DRIFT_WINDOW_B = ("1998-01-01", "1998-12-31")

TREND_TABLE = "vaccine_search_trends"
COUNT_TABLE = "us_weekly_vaccinations"

GBT_TREES = 250
GBT_DEPTH = 4
SEED = 42

# Time-bucket width of the as-of join's partitions. A key's rows are split into
# buckets of this many days so one hot key spreads over many tasks; the newest
# row of earlier buckets is carried in, so results stay exact.
ASOF_BUCKET_DAYS = 91

# Fixed value: the single key the notebooks filter on ('Virginia' in the
# reference); a nation present at every test scale stands in for it.
FILTER_STATE = "NATION_19"
# End of the first increment and the upsert windows.
FIRST_INCREMENT_END = "1998-06-30 00:00:00"
UPSERT_LATE_WINDOW = ("1997-01-01", "1997-12-31")
UPSERT_NEW_AFTER = "1999-06-30"
