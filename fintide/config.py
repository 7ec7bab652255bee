"""Schemas, thresholds and domains.

Everything in the "fixed values" blocks must equal the business rules of the
system we re-implement; everything else is a default that callers override.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (business rules; must stay equal for equal results)
# --------------------------------------------------------------------------

# Client cleaning: defaults filled after trimming.
CLIENT_DEFAULTS = {
    "city": "Unknown",
    "risk_profile": "Moderate",
    "kyc_status": "PENDING",
    "advisor_id": "ADV000",
}
MIN_AGE = 18
MAX_AGE = 100

# Enrichment buckets: (exclusive upper bound, label), then the open-ended label.
AGE_BUCKETS = [(35, "Young"), (55, "Middle-Aged")]
AGE_OTHERWISE = "Senior"
AUM_BUCKETS = [(500_000, "Mass"), (5_000_000, "HNI")]
AUM_OTHERWISE = "UHNI"
TIER1_CITIES = ["Mumbai", "Delhi", "Bangalore", "Chennai", "Hyderabad", "Kolkata"]
HIGH_VALUE_AUM = 1_000_000
KYC_VERIFIED = "VERIFIED"
DAYS_PER_YEAR = 365.25

# Holdings: fund types kept by the portfolio roll-up.
FUND_TYPES = ["equity", "debt", "gold"]

# Risk classes (alphabetical = label-encoder order) and the age-group code.
RISK_CLASSES = ["Aggressive", "Conservative", "Moderate"]
AGE_GROUP_CODES = {"Young": 0, "Middle-Aged": 1, "Senior": 2}
AGE_GROUP_DEFAULT_CODE = 1

# Model feature order and training parameters.
FEATURE_COLS = [
    "equity_pct",
    "debt_pct",
    "gold_pct",
    "total_num_funds",
    "years_invested",
    "aum_lakh",
    "age_group_encoded",
]
N_TREES = 100
MAX_DEPTH = 10
MIN_SAMPLES_SPLIT = 5
TEST_SIZE = 0.2
SEED = 42
MODEL_VERSION = "v1.0-random-forest"

# Scoring request validation ranges (inclusive).
REQUEST_RANGES = {
    "equity_pct": (0.0, 100.0),
    "debt_pct": (0.0, 100.0),
    "gold_pct": (0.0, 100.0),
    "total_num_funds": (1, 50),
    "years_invested": (0.0, 50.0),
    "aum_lakh": (0.0, None),
}
REQUEST_FIELDS = ["client_id"] + list(REQUEST_RANGES) + ["age_group"]
CACHE_TTL_SECONDS = 3600

# Money units.
LAKH = 100_000
CRORE = 10_000_000

# Suspicious-transaction rules.
SUSPICIOUS_AMOUNT = 1_000_000
SUSPICIOUS_HOURS = (2, 4)
SUSPICIOUS_CHANNELS = ["API"]

# Fund-type pools per risk profile (weights = repetitions in the pool).
ALLOCATION_POOLS = {
    "Conservative": [("Debt", 7), ("Hybrid", 2), ("Gold", 1)],
    "Moderate": [("Equity", 4), ("Hybrid", 3), ("Debt", 2), ("Gold", 1)],
    "Aggressive": [("Equity", 7), ("Hybrid", 2), ("Debt", 1)],
}
FALLBACK_POOL = "Aggressive"  # of every other profile
HOLDINGS_PER_CLIENT = (3, 6)
TXN_TYPE_WEIGHTS = [("SIP", 0.55), ("BUY", 0.25), ("SELL", 0.15), ("DIVIDEND", 0.05)]
CHANNEL_WEIGHTS = [("APP", 0.45), ("WEB", 0.30), ("ADVISOR", 0.20), ("API", 0.05)]

# --------------------------------------------------------------------------
# Declared raw schemas (all nullable: a file scan never enforces NOT NULL, the cleaners do)
# --------------------------------------------------------------------------

CLIENTS_RAW_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("risk_profile", T.StringType()),
        T.StructField("aum", T.DoubleType()),
        T.StructField("onboarded_date", T.StringType()),
        T.StructField("advisor_id", T.StringType()),
        T.StructField("kyc_status", T.StringType()),
    ]
)

HOLDINGS_RAW_SCHEMA = T.StructType(
    [
        T.StructField("portfolio_id", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("fund_id", T.StringType()),
        T.StructField("fund_type", T.StringType()),
        T.StructField("invested_amt", T.DecimalType(18, 2)),
        T.StructField("current_value", T.DecimalType(18, 2)),
        T.StructField("num_units", T.DoubleType()),
        T.StructField("purchase_date", T.StringType()),
    ]
)

TRAINING_FEATURES_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.StringType()),
        T.StructField("equity_pct", T.DoubleType()),
        T.StructField("debt_pct", T.DoubleType()),
        T.StructField("gold_pct", T.DoubleType()),
        T.StructField("total_num_funds", T.LongType()),
        T.StructField("years_invested", T.DoubleType()),
        T.StructField("aum_lakh", T.DoubleType()),
        T.StructField("age_group_encoded", T.IntegerType()),
        T.StructField("target", T.StringType()),
    ]
)

SCORE_REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.StringType()),
        T.StructField("equity_pct", T.DoubleType()),
        T.StructField("debt_pct", T.DoubleType()),
        T.StructField("gold_pct", T.DoubleType()),
        T.StructField("total_num_funds", T.LongType()),
        T.StructField("years_invested", T.DoubleType()),
        T.StructField("aum_lakh", T.DoubleType()),
        T.StructField("age_group", T.StringType()),
    ]
)

# --------------------------------------------------------------------------
# Defaults for the compared queries (deterministic; never current_date)
# --------------------------------------------------------------------------

LAKE_BUCKETS = 16  # of bucketed lake tables: a property of the tables, not of the session that writes them
FIXTURE_AS_OF = dt.date(2001, 12, 31)
FIXTURE_METROS = ["Nation_0", "Nation_1", "Nation_2", "Nation_3", "Nation_4", "Nation_5"]
