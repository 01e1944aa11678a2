"""Column names and schemas of the bronze, silver, gold and stream tables."""

from pyspark.sql import types as T

V_COLS = [f"V{i}" for i in range(1, 29)]
N_V = len(V_COLS)

# Order of the raw card file.
BRONZE_COLS = ["Time", *V_COLS, "Amount", "Class"]
REQUIRED_BRONZE = ["Time", "Amount", "Class"]

BRONZE_SCHEMA = T.StructType(
    [T.StructField("Time", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in V_COLS]
    + [T.StructField("Amount", T.DoubleType()), T.StructField("Class", T.IntegerType())]
)

TXN_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("account_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        *BRONZE_SCHEMA.fields,
    ]
)

CORRUPT = "_corrupt_record"

# Features silver is expected to carry, by the two validations that look for them.
SILVER_ENGINEERED = ["Amount_Log", "Hour", "IsWeekend", "DataQuality_Score"]
SILVER_EXPECTED = [
    "Amount_Category",
    "Amount_Log",
    "Amount_Percentile",
    "Hour",
    "DayOfWeek",
    "IsWeekend",
    "TimeOfDay",
    "ProcessedTimestamp",
    "DataQuality_Score",
]

HOURLY_COLS = [
    "timestamp",
    "Hour",
    "IsWeekend",
    "fraud_count",
    "total_transactions",
    "total_amount",
    "avg_amount",
    "median_amount",
    "std_amount",
    "avg_data_quality",
    "fraud_rate",
    "created_at",
    "data_version",
]

# What the hourly check expects, compared without regard to case.
HOURLY_EXPECTED = [
    "timestamp",
    "hour",
    "is_weekend",
    "fraud_count",
    "total_transactions",
    "total_amount",
    "avg_amount",
    "median_amount",
    "std_amount",
    "avg_data_quality",
    "amount_category_dist",
    "fraud_rate",
    "created_at",
    "data_version",
]

ML_BASE = [
    *V_COLS,
    "Amount_Log",
    "Amount_Percentile",
    "Hour",
    "DayOfWeek",
    "IsWeekend",
    "DataQuality_Score",
    "Class",
]

# The source table of the change stream: decimals there become doubles in bronze.
OLTP_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("time_stamp", T.LongType(), False)]
    + [T.StructField(c.lower(), T.DecimalType(20, 10)) for c in V_COLS]
    + [
        T.StructField("amount", T.DecimalType(10, 2), False),
        T.StructField("class", T.IntegerType(), False),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)

STREAM_NESTED_SCHEMA = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [T.StructField("id", T.StringType()), T.StructField("time_stamp", T.TimestampNTZType())]
                + [T.StructField(c.lower(), T.DoubleType()) for c in V_COLS]
                + [
                    T.StructField("amount", T.DoubleType()),
                    T.StructField("fraud_class", T.IntegerType()),
                    T.StructField("processed_at", T.TimestampNTZType()),
                    T.StructField("amount_zscore", T.DoubleType()),
                    T.StructField("rolling_amount_mean", T.DoubleType()),
                    T.StructField("rolling_amount_std", T.DoubleType()),
                    T.StructField("risk_score", T.DoubleType()),
                    T.StructField("is_anomaly", T.BooleanType()),
                    T.StructField("feature_version", T.StringType()),
                ]
            ),
        )
    ]
)
