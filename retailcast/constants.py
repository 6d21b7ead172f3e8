"""Domain constants and defaults of the retail planning pipeline.

FIXED VALUES -- these must equal the planning tool we mirror, so they are
spelled out plainly, in their natural order, and never derived.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: store, state, category and department labels (retail data set
# with 10 stores in 3 states, 3 categories and 7 departments).
# ---------------------------------------------------------------------------
STORE_LABELS = {
    "CA_1": "California - Store 1",
    "CA_2": "California - Store 2",
    "CA_3": "California - Store 3",
    "CA_4": "California - Store 4",
    "TX_1": "Texas - Store 1",
    "TX_2": "Texas - Store 2",
    "TX_3": "Texas - Store 3",
    "WI_1": "Wisconsin - Store 1",
    "WI_2": "Wisconsin - Store 2",
    "WI_3": "Wisconsin - Store 3",
}

STATE_LABELS = {
    "CA": "California",
    "TX": "Texas",
    "WI": "Wisconsin",
}

STORES_BY_STATE = {
    "CA": ["CA_1", "CA_2", "CA_3", "CA_4"],
    "TX": ["TX_1", "TX_2", "TX_3"],
    "WI": ["WI_1", "WI_2", "WI_3"],
}

STORE_SHORT_LABELS = {
    "CA_1": "Store 1", "CA_2": "Store 2", "CA_3": "Store 3", "CA_4": "Store 4",
    "TX_1": "Store 1", "TX_2": "Store 2", "TX_3": "Store 3",
    "WI_1": "Store 1", "WI_2": "Store 2", "WI_3": "Store 3",
}

CATEGORY_LABELS = {
    "FOODS": "Foods",
    "HOBBIES": "Hobbies",
    "HOUSEHOLD": "Household",
}

DEPT_LABELS = {
    "FOODS_1": "Foods - Dept 1",
    "FOODS_2": "Foods - Dept 2",
    "FOODS_3": "Foods - Dept 3",
    "HOBBIES_1": "Hobbies - Dept 1",
    "HOBBIES_2": "Hobbies - Dept 2",
    "HOUSEHOLD_1": "Household - Dept 1",
    "HOUSEHOLD_2": "Household - Dept 2",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: parameters and thresholds of the pipeline.
# ---------------------------------------------------------------------------
ID_COLUMNS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]

DEFAULT_HORIZON = 90          # forecast days (slider 30..180)
DEFAULT_LEAD_TIME = 7         # days (slider 1..30)
DEFAULT_ORDERING_COST = 10.0  # per order (slider 1..100)
DEFAULT_HOLDING_COST = 0.20   # share of price per year (slider 0.05..0.50)
HORIZON_RANGE = (30, 180)
LEAD_TIME_RANGE = (1, 30)
ORDERING_COST_RANGE = (1, 100)
HOLDING_COST_RANGE = (0.05, 0.50)

Z_SERVICE = 1.645             # z for the 95 % service level (fixed)
DAYS_PER_YEAR = 365
MIN_HISTORY_ROWS = 30         # fewer rows -> no forecast for the series
HOLDOUT_DAYS = 90             # backtest window (rows)
BACKTEST_EXTRA_ROWS = 60      # backtest needs holdout + 60 rows
MAPE_GOOD = 20.0              # accuracy band limits, percent
MAPE_FAIR = 40.0
INTERMITTENT_BELOW = 1.5      # units per day
HISTORY_TAIL = 180            # rows shown before the forecast
SAVED_RUNS_LIMIT = 200        # saved runs read back

# Two-sided 80 % normal interval (the forecasting method's default band width).
BAND_Z = 1.2815515655446004

SERIES = ["item_id", "store_id"]
