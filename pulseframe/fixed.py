"""Column names, bounds and class names shared by all operators.

Everything in this module is a fixed value of the data contract: results are
only right when these are exactly as written.
"""

# -- columns ----------------------------------------------------------------
CITIZEN = "citizen_id"
TIMESTAMP = "timestamp"
HEART_RATE = "average_heart_beat_rate"
O2 = "o2_content"
SLEEP = "sleep_time"
CALORIES = "calories_burned"
LABEL = "label"
CLASSIFICATION = "classification"
INFERENCE_TS = "inference_timestamp"

VITALS = [HEART_RATE, O2, SLEEP, CALORIES]
ENGINEERED = ["calorie_efficiency", "composite_risk_score", "hr_sleep_interaction"]
NUMERIC_FEATURES = VITALS + ENGINEERED
SCALED_FEATURES = [f"{c}_scaled" for c in NUMERIC_FEATURES]

RAW_COLUMNS = [CITIZEN, TIMESTAMP] + VITALS
RAW_KEY = [CITIZEN, TIMESTAMP]
ANALYTICS_COLUMNS = RAW_COLUMNS + [CLASSIFICATION, INFERENCE_TS]
ANALYTICS_KEY = [CITIZEN, INFERENCE_TS]

# -- documents, table properties and files of the batch job ----------------------
STATISTICS_KEYS = ["features", "stats", "train_count", "val_count", "total_processed", "created_at"]
TABLE_PROPERTIES = ["recordCount", "trainCount", "valCount", "featureCount", "last_etl_run", "sourceKey"]
PROCESSED, CONFIG = "processed", "config"
TRAIN_FILE, VALIDATION_FILE = "train/train.csv", "validation/validation.csv"
STATISTICS_FILE = "normalization_stats.json"
RESULTS_PREFIX = "results_"

TRAINING_CSV = {
    CITIZEN: "string",
    HEART_RATE: "int",
    O2: "double",
    SLEEP: "double",
    CALORIES: "int",
    LABEL: "int",
}

# -- valid ranges -------------------------------------------------------------
HEART_RATE_RANGE = (40, 200)
CLIP_RANGES = {O2: (0.85, 1.0), SLEEP: (2.0, 14.0)}

# -- category rules: (source column, [(comparison, bound, name)], last name) ----
CATEGORIES = {
    "heart_rate_zone": (
        HEART_RATE,
        [("<", 60, "Bradycardia"), ("<=", 100, "Normal")],
        "Tachycardia",
    ),
    "o2_risk": (O2, [("<", 0.93, "Hypoxia_Risk"), ("<", 0.95, "Borderline")], "Normal"),
    "sleep_quality": (
        SLEEP,
        [("<", 5, "Insufficient"), ("<", 7, "Below_Recommended"), ("<=", 9, "Optimal")],
        "Extended",
    ),
}

# -- label rule: unhealthy when any of these holds --------------------------------
UNHEALTHY_IF = [(HEART_RATE, ">", 100), (O2, "<", 0.95), (SLEEP, "<", 5)]

# -- risk score: (column, ideal, direction, span, weight) ------------------------
RISK_TERMS = [
    (HEART_RATE, 75, "either", 75.0, 0.30),
    (O2, 1.0, "below", 0.1, 0.40),
    (SLEEP, 8.0, "either", 8.0, 0.30),
]

# -- heart rate x missing sleep: rate * (ceiling - sleep) / divisor --------------
INTERACTION_CEILING = 10.0
INTERACTION_DIVISOR = 100.0

# -- two-way class ----------------------------------------------------------------
CLASS_THRESHOLD = 0.5
HEALTHY, UNHEALTHY, UNKNOWN = "healthy", "unhealthy", "unknown"

# -- generated data: (mean, spread, low, high) -------------------------------------
GENERATED = {
    HEART_RATE: (75.0, 15.0, 40.0, 200.0),
    O2: (0.97, 0.02, 0.92, 1.0),
    SLEEP: (7.0, 1.5, 3.0, 12.0),
    CALORIES: (500.0, 150.0, 200.0, 900.0),
}
GENERATED_ROWS = 10_000
SEED = 42

# -- split and boosted trees ---------------------------------------------------------
TRAIN_SHARE = 0.8
BOOSTING = {
    "rounds": 100,
    "leaves": 31,
    "learning_rate": 0.1,
    "feature_fraction": 0.8,
    "bagging_fraction": 0.8,
    "bagging_every": 5,
    "max_bins": 255,
    "min_data_in_leaf": 20,
    "early_stopping_rounds": 10,
    "seed": SEED,
}
TOPIC = "citizen/health"
