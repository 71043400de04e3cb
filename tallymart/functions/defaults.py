"""Default limits and parameters that decide results. Each is a parameter of its operator."""

# Cleaning.
MAX_AMOUNT = 1_000_000
TRANSACTION_MAX_AGE_DAYS = 1825
PROFILE_MAX_AGE_DAYS = 3650
TOP_DAYS = 10

# Churn and risk.
CHURN_AFTER_DAYS = 30
RECENT_DAYS = 90

# Scoring features.
MAX_AGE_YEARS = 100
MAX_INCOME = 1_000_000

# Splits and models.
SEED = 42
TRAIN_SHARE = 0.8
TEST_SHARE = 0.3
FOLDS = 5
CHURN_MAX_ITER = 50
CHURN_REG_PARAM = 0.01

# Segments, anomalies and oversampling.
CLUSTERS = 3
RESTARTS = 10
CONTAMINATION = 0.1
TREES = 100
TREE_ROWS = 256
NEIGHBOURS = 5
