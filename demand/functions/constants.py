"""Fixed values that must equal the behaviour being reproduced."""

# --- fixed values -----------------------------------------------------------
# Tiny constant added to numerator and denominator of percentage errors, and
# the value a NaN prediction is replaced with.
EPSILON = 1e-10
# Model labels as stored in the forecast record, in tie-break order.
MODEL_ORDER = ["SARIMAX", "Prophet", "XGBoost", "HWExSmooth"]
BASELINE = "Baseline"
# Option names of the model subset switch, and the label each selects.
MODEL_OPTIONS = {"sarimax": "SARIMAX", "prophet": "Prophet", "xgboost": "XGBoost", "hwexsmooth": "HWExSmooth"}
DEFAULT_MODELS = "sarimax,prophet,xgboost,hwexsmooth"
# Channel codes: the joined invoice tables, the denormalised invoice table.
CHANNEL_JOINED = "AC"
CHANNEL_DENORM = "UL"
ALL = "All"
# Invoice type kept from the denormalised table.
NORMAL_INVOICE = "Normal"
# Work-list rules: lookback of the activity window, density, minimum span.
ACTIVE_LOOKBACK_MONTHS = 3
DENSITY = 0.8
MIN_SPAN_MONTHS = 20
# Hold-out length, forecast horizon, cap multiple of the hold-out mean.
N_TEST = 6
HORIZON = 3
CAP_MULTIPLE = 5
# Trend label band (+/- 10 % of the last actual).
TREND_BAND = 0.1
# Lags used by the boosted model.
N_LAGS = 6
# Digits after the point that sums of amounts keep.
AMOUNT_SCALE = 6
# Default work-list items, in output order.
DEFAULT_ITEMS = [("All", "All", "All"), ("All", "All", "UL"), ("All", "All", "AC")]
# --- end of fixed values ----------------------------------------------------
