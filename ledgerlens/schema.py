"""Column contracts and fixed settings shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "tx_id"
LABEL = "isFraud"

_float, _byte = T.FloatType(), T.ByteType()

#: Layout of the raw CSV (no key column: a stable one is added when the file is first read).
CSV_SCHEMA = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", _float),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", _float),
    T.StructField("newbalanceOrig", _float),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", _float),
    T.StructField("newbalanceDest", _float),
    T.StructField("isFraud", _byte),
    T.StructField("isFlaggedFraud", _byte),
])

# Names and limits that results depend on.
PROFILED = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
LEAKAGE = ["nameOrig", "nameDest", "isFlaggedFraud",
           "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
KEPT_TYPES = ["CASH_OUT", "TRANSFER"]
FEATURES = ["step", "amount", "amount_log", "amount_zscore", "is_round_amount", "is_extreme_amount",
            "amount_category", "hour", "day", "is_night", "is_weekend", "is_deep_night", "type_encoded",
            "is_cash_out", "amount_hour_interaction", "round_amount_night", "extreme_amount_cashout",
            "high_risk_pattern", "suspicious_timing"]
AMOUNT_QUANTILES = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
FRAUD_PERCENT_BAND = (0.1, 5.0)
TARGET_RANGES = {"precision": (0.30, 0.55), "recall": (0.45, 0.70), "f1": (0.35, 0.55),
                 "auc_roc": (0.70, 0.85), "fpr": (0.0, 0.05)}
EARLIER_MODEL = {"precision": 0.1487, "recall": 0.5298, "f1": 0.2322, "auc_roc": 0.8595}

#: Stands in for a NULL feature wherever rows are treated as vectors.
NULL_FILL = -1.0


def feature_table_schema() -> T.StructType:
    return T.StructType([T.StructField(KEY, T.LongType())]
                        + [T.StructField(f, _float) for f in FEATURES]
                        + [T.StructField(LABEL, T.IntegerType())])


def split_table_schema() -> T.StructType:
    return T.StructType(feature_table_schema().fields
                        + [T.StructField("is_synthetic", T.BooleanType()), T.StructField("split", T.StringType())])
