"""Fixed values. Everything here is given by the data contract, not derived."""

# Tokens that mean "missing" in the delimited sources.
NA_TOKENS = [
    "NULL", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NaN", "None", "n/a", "nan", "null",
]

# Personal columns that never leave the scan.
PII_COLUMNS = ["Name", "Phone", "Driver", "Plate", "DriverPhone", "DriverPicture", "Registration"]

# Source renames.
RIDE_RENAMES = {"price": "RidePrice", "CategoryID": "RideCategoryID"}
PRODUCT_RENAMES = {"ProviderID": "ProductProviderID", "Description": "ProductDescription"}

# Columns of the four sources and their types.
ESTIMATE_TYPES = {
    "RideEstimativeID": "bigint", "RideID": "bigint", "ProductID": "string", "WaitingTime": "bigint",
    "Price": "double", "FareID": "string", "Selected": "bigint",
    "RideReasonSelectedEstimativeID": "bigint", "Fee": "bigint",
}
RIDE_TYPES = {
    "RideID": "bigint", "UserID": "string", "Schedule": "timestamp_ntz", "Create": "timestamp_ntz",
    "RideStatusID": "bigint", "CompanyID": "bigint", "ProviderID": "bigint", "RideProviderID": "bigint",
    "price": "double", "Updated": "timestamp_ntz", "CategoryID": "bigint", "TotalUsers": "bigint",
    "Car": "string", "RideDriverLocationID": "bigint", "ScheduledRide": "bigint",
}
PRODUCT_TYPES = {
    "ProductID": "string", "ProviderID": "bigint", "CategoryID": "bigint", "Description": "string",
}
ADDRESS_TYPES = {
    "RideID": "bigint", "RideAddressTypeID": "bigint", "RideAddressID": "bigint", "Lat": "double",
    "Lng": "double", "City": "string", "State": "string",
}

# Cleaning rules.
FARE_ID_SENTINEL = "MISSING_FAREID"
LABEL_SENTINEL = "MISSING"
TARGET_CAP_QUANTILE = 0.995
WAITING_CAP_QUANTILE = 0.99
MAX_SCHEDULE_GAP_SECONDS = 300
LEAKAGE_COLUMNS = ["RidePrice", "Selected", "RideReasonSelectedEstimativeID"]
SPARSE_COLUMNS = [
    "Car", "ProviderID", "RideProviderID", "RideCategoryID", "RideDriverLocationID", "ScheduledRide",
]

# Target categories and the product name of each.
CATEGORY_NAMES = {2: "UberX", 9: "Uber Comfort", 4: "Uber Black"}
CANONICAL_PRODUCTS = ["UberX", "Comfort", "Black"]

# Calendar labels.
WEEKDAY_PT = ["segunda", "terca", "quarta", "quinta", "sexta", "sabado", "domingo"]
WEEKDAY_EN = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DAY_PERIODS = ["madrugada", "manha", "tarde", "noite"]
UNKNOWN_PERIOD = "desconhecido"

# National holidays of Brazil as (month, day), and the one added from 2024.
FIXED_HOLIDAYS = [(1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)]
CONSCIOUSNESS_DAY = (11, 20)
CONSCIOUSNESS_DAY_FROM = 2024

# Profiling thresholds.
HIGH_NULL_PCT = 30.0
CRITICAL_NULL_PCT = 90.0
HIGH_OUTLIER_PCT = 1.0
CATEGORICAL_MAX_UNIQUES = 1000
CATEGORICAL_MAX_RATIO = 0.20
SMALL_DOMAIN = 50
HIGH_CORRELATION = 0.85
LOW_TARGET_CORRELATION = 0.05
TARGET_PERCENTILES = {
    "p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.50, "p75": 0.75,
    "p90": 0.90, "p95": 0.95, "p99": 0.99, "p99_5": 0.995, "p99_9": 0.999,
}

# Action per feature family for features with a weak correlation to the target.
LOW_SIGNAL_ACTIONS = {
    "categorical_code": "keep_as_categorical_test_not_by_pearson_alone",
    "spatial_coordinate": "transform_into_distance_or_zone_features",
    "count": "keep_for_baseline_due_business_plausibility",
    "continuous": "keep_for_baseline_due_business_plausibility",
    "monetary_component": "deprioritize_raw_feature_or_validate_semantics",
}
LOW_SIGNAL_DEFAULT = "deprioritize_or_exclude_after_model_baseline"

# Temporal validation.
REGIME_START = "2021-11-01"
N_SPLITS = 4
TEST_DAYS = 28
GAP_DAYS = 7
HOLDOUT_DAYS = 28

# Model inputs.
NUMERIC_FEATURES = [
    "WaitingTime", "Fee", "TotalUsers", "RideStatusID", "CompanyID", "ProductProviderID",
    "OriginLat", "OriginLng", "DestinationLat", "DestinationLng",
    "ScheduleHour", "ScheduleDayOfWeek", "ScheduleMonth", "ScheduleQuarter",
    "CreateHour", "CreateDayOfWeek", "CreateMonth", "CreateQuarter",
    "UserPriorRideCount", "UserPriorPaidPriceMean",
    "UserPriorCategoryRideCount", "UserPriorCategoryPriceMean",
]
BOOLEAN_FEATURES = ["ScheduleIsHolidayBR", "CreateIsHolidayBR", "FareIDWasImputed", "WaitingTimeWasCapped"]
CATEGORICAL_FEATURES = ["ProductID"]
ONE_HOT_MIN_ROWS = 5
MAPE_EPSILON = 2.220446049250313e-16
SEED = 42
SAMPLE_ROWS_PER_CATEGORY = 100_000
SEARCH_TRIALS = 15

# Risk level and decision per feature group, and per product; the measured rate shown beside a group.
RISKS = [
    ("Create* temporais", "low", "keep"),
    ("Schedule* temporais", "low", "keep"),
    ("Updated* temporais", "high", "exclude"),
    ("UserPriorRideCount / UserPriorPaidPriceMean", "low", "keep"),
    ("UserPriorCategoryRideCount / UserPriorCategoryPriceMean", "low", "keep"),
    ("PriceWasCapped", "high", "exclude"),
    ("WaitingTimeWasCapped / FareIDWasImputed", "low", "optional"),
]
PRODUCT_RISKS = [
    ("Cross own price ({price})", "high", "exclude"),
    ("Cross auxiliar ({product})", "medium", "keep_with_control"),
]
RISK_RATES = {"Updated* temporais": "updated_after_create_pct", "PriceWasCapped": "price_was_capped_pct"}
