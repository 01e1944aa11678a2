"""DuckDB SQL for every registered query that SQL can express.

Written against the test tables alone, independently of the Spark code: common table expressions
build the fixture and the derived tables, each query selects from them.
"""

from __future__ import annotations

V = [f"V{i}" for i in range(1, 29)]
v = [c.lower() for c in V]
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
ORIGIN_US = 1704067200000000
KEYS = "id, account_id, ts, Time"


def _component(i: int) -> str:
    return (
        f"CASE WHEN event_id % 113 = {i} THEN NULL WHEN event_id % 151 = {i} THEN 12.5e0 "
        f"ELSE CAST((event_id * {1009 + 37 * i} + {131 * i}) % 1999 AS DOUBLE) / 1999e0 * 8e0 - 4e0 END AS V{i}"
    )


def _list(items) -> str:
    return ", ".join(items)


def _plus(items) -> str:
    return " + ".join(items)


CATEGORY = "CASE WHEN {0} <= 50 THEN 'Low' WHEN {0} <= 200 THEN 'Medium' WHEN {0} <= 1000 THEN 'High' ELSE 'Very_High' END"
HOUR = "CAST(floor((Time % 86400e0) / 3600e0) AS INTEGER)"
DAY = "CAST(floor((Time / 86400e0) % 7) AS INTEGER)"
WEEKEND = f"CASE WHEN {DAY} IN (5, 6) THEN 1 ELSE 0 END"
FLAGS = ["V1", "V2", "V3", "V4", "V5"]
FLAG_COLS = [f"{c}_IsOutlier" for c in FLAGS]


def _flag(c: str) -> str:
    return f"CAST({c} < -3e0 OR {c} > 3e0 AS INTEGER)"


def _sin(x: str, period: int) -> str:
    return f"sin(2e0 * pi() * {x} / {period}e0)"


def _cos(x: str, period: int) -> str:
    return f"cos(2e0 * pi() * {x} / {period}e0)"


TIME_US = "make_timestamp(CAST(round(Time * 1e6) AS BIGINT))"
IN_TRAIN = "CAST(concat('0x', substr(md5(concat('42:', CAST(id AS VARCHAR))), 1, 8)) AS BIGINT) % 10 < 8"

IN_TENTH = "CAST(concat('0x', substr(md5(concat('42:', CAST(id AS VARCHAR))), 1, 8)) AS BIGINT) < 429496729"

ROLL = "PARTITION BY account_id ORDER BY Time, id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW"
ROLL_RT = "PARTITION BY account_id ORDER BY time_stamp, transaction_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW"

MEAN = "CAST(sum(CAST(Amount AS DECIMAL(20, 6))) AS DOUBLE) / count(Amount)"

# Half up in whole numbers of a millionth.
MEAN_2 = (
    "CAST((2 * CAST(sum(CAST(Amount AS DECIMAL(20, 6))) * 1000000 AS HUGEINT) + count(Amount) * 10000) "
    "// (2 * count(Amount) * 10000) AS DOUBLE) / 100"
)

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTE[name] = (needs, sql)


_cte(
    "base",
    (),
    f"""SELECT event_id AS id, user_id AS account_id, ts, CAST(epoch_us(ts) - {ORIGIN_US} AS DOUBLE) / 1e6 AS Time,
    {_list(_component(i) for i in range(1, 29))},
    CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_id % 307 = 0 THEN 0e0 WHEN event_id % 101 = 0 THEN round(value * 100e0, 2)
      WHEN event_id % 13 = 0 THEN round(value * 10e0, 2) ELSE value END AS Amount,
    CASE WHEN event_id % 499 = 0 THEN NULL WHEN event_type = 'error' AND event_id % 5 = 0 THEN 1 ELSE 0 END AS Class
    FROM events""",
)
_cte("txn", ("base",), "SELECT * FROM base UNION ALL SELECT * FROM base WHERE id % 50 = 0")
_cte("uniq", ("txn",), "SELECT DISTINCT * FROM txn")
_cte(
    "clean",
    ("uniq",),
    f"SELECT {KEYS}, {_list(f'coalesce({c}, 0e0) AS {c}' for c in V)}, coalesce(Amount, 22e0) AS Amount, Class FROM uniq",
)
_cte("iqr", ("clean",), "SELECT quantile_disc(Amount, 0.25) AS q1, quantile_disc(Amount, 0.75) AS q3 FROM clean")
_cte(
    "featured",
    ("clean", "iqr"),
    f"""SELECT {KEYS}, {_list(V)}, Amount, Class,
    CAST(Amount < q1 - 1.5e0 * (q3 - q1) OR Amount > q3 + 1.5e0 * (q3 - q1) AS INTEGER) AS Amount_IsOutlier,
    ln(1e0 + Amount) AS Amount_Log, percent_rank() OVER (ORDER BY Amount) AS Amount_Percentile,
    {CATEGORY.format('Amount')} AS Amount_Category, {HOUR} AS Hour, {DAY} AS DayOfWeek, {WEEKEND} AS IsWeekend,
    {_list(f'{_flag(c)} AS {c}_IsOutlier' for c in FLAGS)},
    {AS_OF} AS ProcessedTimestamp, 1e0 AS DataQuality_Score, 'FULL' AS ProcessingMode,
    (SELECT count(*) FROM txn) AS SampleSize, (SELECT count(*) FROM txn) AS OriginalTotalRecords
    FROM clean, iqr""",
)
_cte("silver", ("featured",), "SELECT * FROM featured WHERE Class IS NOT NULL")
_cte(
    "hours",
    ("silver",),
    f"""SELECT date_trunc('hour', {TIME_US}) AS timestamp, Hour, IsWeekend, CAST(sum(Class) AS BIGINT) AS fraud_count,
    count(*) AS total_transactions, sum(Amount) AS total_amount, avg(Amount) AS avg_amount,
    quantile_disc(Amount, 0.5) AS median_amount, stddev_samp(Amount) AS std_amount, avg(DataQuality_Score) AS avg_data_quality,
    max(ts) AS created_at FROM silver GROUP BY 1, 2, 3""",
)
_cte(
    "hourly",
    ("hours",),
    """SELECT timestamp, Hour, IsWeekend, fraud_count, total_transactions, total_amount, avg_amount, median_amount, std_amount,
    avg_data_quality, CAST(fraud_count AS DOUBLE) / total_transactions AS fraud_rate, created_at, 'run-1' AS data_version FROM hours""",
)
_cte(
    "cur",
    ("silver",),
    f"""SELECT *, (V1_IsOutlier + V2_IsOutlier + V3_IsOutlier + V4_IsOutlier + V5_IsOutlier + Amount_IsOutlier) / 6e0 AS Outlier_Ratio,
    ts AS created_at, CASE WHEN {IN_TRAIN} THEN 'train' ELSE 'test' END AS split FROM silver""",
)
_cte(
    "sets",
    ("cur",),
    """SELECT 'current' AS dataset, * FROM cur UNION ALL SELECT 'train', * FROM cur WHERE split = 'train'
    UNION ALL SELECT 'test', * FROM cur WHERE split = 'test'""",
)

MISSING = _plus(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in V)
EXTREME = _plus(f"CASE WHEN abs({c}) > 10 THEN 1 ELSE 0 END" for c in V)
QUALITY = (
    "greatest(0e0, 1e0 - CASE WHEN Amount IS NULL OR Amount <= 0 THEN 0.3e0 ELSE 0e0 END "
    "- CASE WHEN Amount > 25000 THEN 0.2e0 ELSE 0e0 END "
    f"- ({MISSING}) / 28e0 * 0.3e0 - ({EXTREME}) / 28e0 * 0.2e0)"
)
PERCENTILE = (
    "CASE WHEN amount <= 0 THEN 0.1e0 WHEN amount <= 5 THEN 0.25e0 WHEN amount <= 25 THEN 0.5e0 WHEN amount <= 50 THEN 0.7e0 "
    "WHEN amount <= 100 THEN 0.85e0 WHEN amount <= 200 THEN 0.95e0 WHEN amount <= 500 THEN 0.99e0 ELSE 1e0 END"
)
RANGE = "CASE WHEN amount < 10 THEN 0 WHEN amount < 100 THEN 1 WHEN amount < 500 THEN 2 WHEN amount < 1000 THEN 3 ELSE 4 END"
CLUSTER = "CASE WHEN hour BETWEEN 9 AND 17 THEN 1 WHEN hour BETWEEN 18 AND 22 THEN 2 ELSE 0 END"
SHARE_OUT = f"({_plus(f'CASE WHEN abs({c}) > 3 THEN 1 ELSE 0 END' for c in v)}) / 28e0"
RISK = (
    "least(1e0, CASE WHEN amount > 1000 THEN 0.3e0 WHEN amount > 500 THEN 0.2e0 WHEN amount < 1 THEN 0.4e0 ELSE 0e0 END "
    "+ CASE WHEN time_cluster = 0 THEN 0.2e0 ELSE 0e0 END + CASE WHEN is_weekend = 1 THEN 0.1e0 ELSE 0e0 END "
    "+ CASE WHEN outlier_ratio > 0.5 THEN 0.3e0 ELSE 0e0 END + CASE WHEN data_quality_score < 0.7e0 THEN 0.2e0 ELSE 0e0 END)"
)
_cte(
    "rt0",
    ("uniq",),
    f"""SELECT id AS transaction_id, account_id, ts AS time_stamp, {_list(f'coalesce({c}, 0e0) AS {c.lower()}' for c in V)},
    coalesce(Amount, 0e0) AS amount, {QUALITY} AS data_quality_score, Class AS fraud_class,
    CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
    CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend, ts + INTERVAL 2 SECOND AS processed_at FROM uniq""",
)
_cte(
    "rt1",
    ("rt0",),
    f"""SELECT *, ln(1e0 + amount) AS amount_log, {PERCENTILE} AS amount_percentile, (amount - 88.35e0) / 250.12e0 AS amount_zscore,
    {RANGE} AS amount_range_flag, {_sin('hour', 24)} AS hour_sin, {_cos('hour', 24)} AS hour_cos,
    {_sin('day_of_week', 7)} AS day_of_week_sin, {_cos('day_of_week', 7)} AS day_of_week_cos,
    {CLUSTER} AS time_cluster, {SHARE_OUT} AS outlier_ratio FROM rt0""",
)
_cte(
    "rt",
    ("rt1",),
    f"""SELECT *, {_list(f'v{i} * amount_log AS v{i}_amount_interaction' for i in range(1, 6))}, {RISK} AS risk_score,
    outlier_ratio > 0.3e0 AS is_anomaly, '1.0' AS feature_version, processed_at AS created_at, 'stream_layer' AS data_source FROM rt1""",
)
_cte("longv", ("rt0",), f"SELECT transaction_id, x FROM (UNPIVOT (SELECT transaction_id, {_list(v)} FROM rt0) ON {_list(v)} INTO NAME n VALUE x)")
_cte(
    "pca",
    ("longv",),
    """SELECT transaction_id, avg(x) AS pca_mean, stddev_pop(x) AS pca_std, CASE WHEN min(x) = max(x) THEN 0e0 ELSE skewness(x) END AS pca_skewness,
    CASE WHEN min(x) = max(x) THEN 0e0 ELSE kurtosis(x) END AS pca_kurtosis FROM longv GROUP BY 1""",
)
_cte(
    "rolled",
    ("rt",),
    f"""SELECT *, avg(amount_log) OVER w AS amount_rolling_mean, stddev_pop(amount_log) OVER w AS amount_rolling_std,
    min(amount_log) OVER w AS amount_rolling_min, max(amount_log) OVER w AS amount_rolling_max,
    count(*) OVER w / 5e0 AS transaction_velocity FROM rt WINDOW w AS ({ROLL_RT})""",
)
_cte(
    "streamrates",
    ("rt",),
    """SELECT 'realtime' AS source, CAST(hour(time_stamp) AS INTEGER) AS hour, CAST(processed_at AS DATE) AS day, processed_at, fraud_class,
    amount FROM rt""",
)
_cte(
    "summary",
    ("sets",),
    f"""SELECT dataset AS dataset_type, count(*) AS total_transactions, count(*) FILTER (Class = 1) AS fraud_transactions,
    avg(CAST(Class AS DOUBLE)) AS fraud_rate, {MEAN} AS avg_amount, stddev_samp(Amount) AS stddev_amount,
    min(Amount) AS min_amount, max(Amount) AS max_amount, avg({_plus(FLAG_COLS)}) AS avg_outlier_features_per_transaction
    FROM sets GROUP BY 1""",
)
_cte(
    "profiles",
    ("silver",),
    f"""SELECT account_id, count(*) AS total_transactions, avg(Amount) AS avg_amount, avg(CAST(Class AS DOUBLE)) AS fraud_rate,
    avg(({_plus(FLAG_COLS)}) / 5e0) AS avg_outlier_ratio FROM silver GROUP BY 1""",
)
_cte(
    "scored",
    ("profiles",),
    """SELECT *, 0.5e0 * fraud_rate + 0.3e0 * avg_outlier_ratio + 0.2e0 * least(avg_amount / 1000e0, 1e0) AS risk_score FROM profiles""",
)
_cte(
    "risks",
    ("scored",),
    f"""SELECT *, CASE WHEN risk_score < 0.15e0 THEN 'Low' WHEN risk_score < 0.3e0 THEN 'Medium' WHEN risk_score < 0.6e0 THEN 'High'
    ELSE 'Critical' END AS risk_category, {CATEGORY.format('avg_amount')} AS customer_segment FROM scored""",
)
_cte(
    "stats",
    ("silver",),
    """SELECT aggregation_level, date, count(*) AS total_transactions, count(*) FILTER (Class = 1) AS fraud_count,
    CAST(count(*) FILTER (Class = 1) AS DOUBLE) / count(*) AS fraud_rate, sum(Amount) AS total_amount, avg(Amount) AS avg_amount,
    max(Amount) AS max_amount FROM (
      SELECT 'daily' AS aggregation_level, CAST(ts AS DATE) AS date, Class, Amount FROM silver
      UNION ALL SELECT 'weekly', CAST(date_trunc('week', ts) AS DATE), Class, Amount FROM silver
      UNION ALL SELECT 'monthly', CAST(date_trunc('month', ts) AS DATE), Class, Amount FROM silver) GROUP BY 1, 2""",
)
_cte(
    "changes",
    ("uniq",),
    """SELECT id, id * 10 + k AS lsn, k = 2 AS deleted, 'fraud_transactions' AS source_table, epoch_us(ts) // 1000 AS source_ts_ms,
    CASE WHEN k = 1 THEN coalesce(Amount, 0e0) + 1e0 ELSE Amount END AS amount, Class AS class
    FROM uniq, (VALUES (0), (1), (2)) kinds(k) WHERE k = 0 OR (k = 1 AND id % 10 = 3) OR (k = 2 AND id % 17 = 5)""",
)
_cte("latest", ("changes",), "SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY id ORDER BY lsn DESC) = 1")

# A message decodes unless its shape is one of the four undecodable ones.
DECODABLE = "id % 12 NOT IN (1, 2, 3, 4)"


def _with(names: tuple[str, ...]) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for need in CTE[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in order) + "\n" if order else ""


ORACLE: dict[str, str] = {}


def _add(key: str, needs: str, sql: str, doubles: str = "", digits: int = 6) -> None:
    """Register; ``doubles`` names the columns to round (and to free of minus zero)."""
    if doubles:
        replaced = ", ".join(f"round({c}, {digits}) + 0e0 AS {c}" for c in doubles.split())
        sql = f"SELECT * REPLACE ({replaced}) FROM ({sql}) q"
    ORACLE[key] = _with(tuple(needs.split())) + sql


VS = " ".join(V)
vs = " ".join(v)
BRONZE = _list(["id", "account_id", "ts", "Time", *V, "Amount", "Class"])

# Sources, sinks, catalog
_add("src_bronze_land", "txn", "SELECT CAST(count(*) AS BIGINT) AS lines_read, CAST(count(*) AS BIGINT) AS lines_landed, true AS verified FROM txn")
_add("src_csv_typed", "txn", f"SELECT {BRONZE} FROM txn", f"Time {VS} Amount")
_add("src_parquet", "silver", "SELECT id, Amount, Hour, Class FROM silver WHERE Amount > 1000", "Amount")
_add("src_latest_snapshot", "hourly", "SELECT timestamp, total_transactions, data_version FROM hourly")
_add("src_fallback", "txn", f"SELECT Time, {_list(V)}, Amount, Class FROM txn", f"Time {VS} Amount")
_add(
    "src_jdbc_txn",
    "uniq",
    f"SELECT id, ts, CAST(floor(Time) AS DOUBLE) AS Time, {_list(f'CAST(CAST({c} AS DECIMAL(20,10)) AS DOUBLE) AS {c}' for c in V)}, "
    "CAST(CAST(Amount AS DECIMAL(10,2)) AS DOUBLE) AS Amount, Class FROM uniq",
    f"Time {VS} Amount",
)
_add(
    "src_jdbc_constraints",
    "uniq",
    """SELECT 'time_stamp_not_null' AS rule, count(*) FILTER (Time IS NULL) AS violations FROM uniq
    UNION ALL SELECT 'amount_not_null', count(*) FILTER (Amount IS NULL) FROM uniq
    UNION ALL SELECT 'class_not_null', count(*) FILTER (Class IS NULL) FROM uniq
    UNION ALL SELECT 'class_in_0_1', count(*) FILTER (Class NOT IN (0, 1)) FROM uniq""",
)
_add(
    "src_table_stats",
    "uniq",
    f"""SELECT Class AS class, count(*) AS records, count(*) * 100e0 / (SELECT count(*) FROM uniq) AS percentage,
    (SELECT count(*) FROM uniq) AS total_records, (SELECT count(*) FROM uniq WHERE ts >= {AS_OF} - INTERVAL 1 HOUR) AS recent_records
    FROM uniq GROUP BY 1""",
    "percentage",
)
BUCKET = "strftime(processed_at, '%Y-%m-%d--%H')"
_add("src_json_raw", "rt0", f"SELECT {BUCKET} AS hour_bucket, count(*) AS lines FROM rt0 GROUP BY 1")
_add("st_file_sink", "rt0", f"SELECT {BUCKET} AS hour_bucket, count(*) AS lines FROM rt0 GROUP BY 1")
_add("src_path_bucket", "rt0", f"SELECT transaction_id, {BUCKET} AS hour_bucket FROM rt0")
_add(
    "src_json_nested",
    "rolled",
    "SELECT CAST(transaction_id AS VARCHAR) AS id, amount, risk_score, is_anomaly, amount_rolling_mean AS rolling_amount_mean, v28 FROM rolled",
    "amount risk_score rolling_amount_mean v28",
)
_add("src_positional_bind", "silver", "SELECT id AS key, Amount AS value, Class AS label FROM silver", "value")
_add(
    "snk_parquet_current_versioned",
    "silver",
    """SELECT 'versioned' AS dataset, count(*) AS rows, CAST(sum(id) AS BIGINT) AS ids FROM silver
    UNION ALL SELECT 'current', count(*), CAST(sum(id) AS BIGINT) FROM silver""",
)
_add(
    "snk_gold_parquet",
    "hourly",
    """SELECT CASE WHEN CAST(created_at AS DATE) = DATE '2024-01-10' THEN 'run-2' ELSE 'run-1' END AS data_version, count(*) AS hours,
    CAST(sum(total_transactions) AS BIGINT) AS transactions FROM hourly GROUP BY 1""",
)
_add("snk_csv_export", "silver", "SELECT id, Time, Amount, Amount_Category, Hour, IsWeekend, Class FROM silver", "Time Amount")
_add("ddl_external_tables", "cur", "SELECT Class, count(*) AS records FROM cur GROUP BY 1")
_add("ddl_table_like", "cur", "SELECT count(*) AS records, CAST(sum(id) AS BIGINT) AS ids FROM cur WHERE split = 'train'")

# Validation
_add(
    "dq_bronze_profile",
    "txn",
    f"""SELECT 'rows' AS metric, '*' AS "column", count(*) AS value FROM txn UNION ALL SELECT 'columns', '*', 34
    UNION ALL SELECT 'duplicates', '*', (SELECT count(*) FROM txn) - (SELECT count(*) FROM (SELECT DISTINCT * FROM txn))
    {' '.join(f"UNION ALL SELECT 'nulls', '{c}', count(*) - count({c}) FROM txn" for c in ['id', 'account_id', 'ts', 'Time', *V, 'Amount', 'Class'])}""",
)
_add("dq_invalid_class", "txn", "SELECT DISTINCT Class FROM txn WHERE Class IS NULL OR Class NOT IN (0, 1)")


def _rule(check: str, column: str, value: str, passed: str, severity: str, table: str) -> str:
    return (
        f"""SELECT '{check}' AS "check", '{column}' AS "column", CAST({value} AS DOUBLE) AS value, """
        f"{passed.format(value)} AS passed, '{severity}' AS severity FROM {table}"
    )


def _rules(key: str, table: str, *rules: tuple[str, str, str, str, str]) -> None:
    _add(key, table, " UNION ALL ".join(_rule(*r, table) for r in rules), "value")


BAD_CLASS = "count(*) FILTER (Class IS NULL OR Class NOT IN (0, 1))"


def _ranges(name: str, cols, limit: float, severity: str) -> list[tuple[str, str, str, str, str]]:
    out = []
    for c in cols:
        out.append((f"{name}_min", c, f"min({c})", f"{{0}} >= -{limit}", severity))
        out.append((f"{name}_max", c, f"max({c})", f"{{0}} <= {limit}", severity))
    return out


_ROWS = [("row_count_min", "*", "count(*)", "{0} >= 1000", "fail"), ("row_count_max", "*", "count(*)", "{0} <= 1000000", "fail")]
_CLASS = [("class_binary", "Class", BAD_CLASS, "{0} = 0", "fail"), ("class_nulls", "Class", "count(*) - count(Class)", "{0} = 0", "fail")]
_AMOUNT = [
    ("amount_min", "Amount", "min(Amount)", "{0} >= 0", "warn"),
    ("amount_max", "Amount", "max(Amount)", "{0} <= 100000", "warn"),
    ("amount_nulls", "Amount", "count(*) - count(Amount)", "{0} = 0", "fail"),
]
_TIME = [("time_nonnegative", "Time", "min(Time)", "{0} >= 0", "fail")]
_S_EMPTY = [("silver_nonempty", "*", "count(*)", "{0} > 0", "fail")]
_S_NULLS = [("silver_critical_nulls", c, f"count(*) - count({c})", "{0} = 0", "fail") for c in ("Class", "Amount")]
_S_CLASS = [("silver_class", "Class", BAD_CLASS, "{0} = 0", "fail")]
_S_AMOUNT = [
    ("silver_amount_min", "Amount", "min(Amount)", "{0} >= 0", "fail"),
    ("silver_amount_max", "Amount", "max(Amount)", "{0} <= 100000", "fail"),
]
_S_HOUR = [("silver_hour_min", "Hour", "min(Hour)", "{0} >= 0", "fail"), ("silver_hour_max", "Hour", "max(Hour)", "{0} <= 23", "fail")]
_rules("dq_row_count_bounds", "txn", *_ROWS)
_rules("dq_class_binary", "txn", *_CLASS)
_rules("dq_amount_range", "txn", *_AMOUNT)
_rules("dq_time_nonnegative", "txn", *_TIME)
_rules("dq_pca_range", "txn", *_ranges("pca_range", V, 100, "warn"))
_rules("dq_silver_nonempty", "silver", *_S_EMPTY)
_rules("dq_silver_critical_nulls", "silver", *_S_NULLS)
_rules("dq_silver_class", "silver", *_S_CLASS)
_rules("dq_silver_amount", "silver", *_S_AMOUNT)
_rules("dq_silver_hour_range", "silver", *_S_HOUR)
STATUS = """SELECT count(*) FILTER (passed) AS checks_passed, count(*) FILTER (NOT passed) AS errors_found,
    CASE WHEN count(*) = 0 THEN 'ERROR' WHEN count(*) FILTER (NOT passed) = 0 THEN 'PASSED' ELSE 'FAILED_BUT_CONTINUING' END AS status FROM ({0})"""
_add(
    "dq_silver_report",
    "silver",
    STATUS.format(
        " UNION ALL ".join(
            _rule(*r, "silver")
            for r in [*_S_EMPTY, *_S_NULLS, *_S_CLASS, *_S_AMOUNT, *_S_HOUR, *_ranges("silver_pca_range", V, 50, "fail")]
        )
    ),
)
_add(
    "dq_bronze_report",
    "txn",
    STATUS.format(
        " UNION ALL ".join(_rule(*r, "txn") for r in [_ROWS[0], *_CLASS, *_AMOUNT, *_TIME, *_ranges("pca_range", V, 100, "warn")])
    ),
)
EXPECT = """SELECT '{0}' AS expectation, '{1}' AS "column", count(*) AS element_count, count(*) - count({1}) AS missing_count,
    count(*) FILTER ({2}) AS unexpected_count, count(*) FILTER ({2}) * 100e0 / count({1}) AS unexpected_percent,
    count(*) FILTER ({2}) = 0 AS success FROM txn"""
_add("dq_expect_in_set", "txn", EXPECT.format("in_set", "Class", "Class NOT IN (0, 1)"), "unexpected_percent")
_add("dq_expect_between", "txn", EXPECT.format("between", "Amount", "Amount NOT BETWEEN 0 AND 1000"), "unexpected_percent")
_add(
    "dq_sample_for_validation",
    "clean",
    f"SELECT {BRONZE} FROM clean WHERE {IN_TENTH}",
    f"Time {VS} Amount",
)
_add(
    "dq_silver_pca_range",
    "silver",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", min({c}) AS min_value, max({c}) AS max_value, {b}e0 AS bound FROM silver HAVING min({c}) < -{b} OR max({c}) > {b}"""
        for cols, b in ((V, 50.0), (V, 3.9))
        for c in cols
    ),
    "min_value max_value bound",
)
CELLS = [*V, "Amount", "Time", "Class"]
_add(
    "dq_scores",
    "txn",
    f"""SELECT *, (completeness + accuracy + consistency) / 3e0 AS overall FROM (SELECT
    CAST({_plus(f'count({c})' for c in CELLS)} AS DOUBLE) / (31 * count(*)) AS completeness,
    CAST({_plus(f'count(*) FILTER (abs({c}) <= 10)' for c in V)} + count(*) FILTER (Amount BETWEEN 0 AND 25000)
      + count(*) FILTER (Time >= 0) + count(*) FILTER (Class IN (0, 1)) AS DOUBLE) / ({_plus(f'count({c})' for c in CELLS)}) AS accuracy,
    CAST(count(*) FILTER (Class IN (0, 1) AND Amount >= 0 AND Time >= 0) AS DOUBLE) / count(*) AS consistency FROM txn)""",
    "completeness accuracy consistency overall",
)

# Silver
_add(
    "silver_sample",
    "txn",
    f"SELECT id, account_id, ts, Amount, Class FROM txn WHERE {IN_TENTH}",
    "Amount",
)
_add("silver_dedup", "uniq", f"SELECT {BRONZE} FROM uniq", f"Time {VS} Amount")
_add(
    "silver_dedup_counts",
    "uniq",
    """SELECT (SELECT count(*) FROM txn) AS rows, (SELECT count(*) FROM uniq) AS distinct_rows,
    (SELECT count(*) FROM txn) - (SELECT count(*) FROM uniq) AS duplicates_removed""",
)
_add(
    "silver_fill_missing",
    "txn",
    f"SELECT id, account_id, ts, Time, {_list(f'coalesce({c}, 0e0) AS {c}' for c in V)}, coalesce(Amount, 22e0) AS Amount, Class FROM txn",
    f"Time {VS} Amount",
)
_add(
    "silver_fill_median",
    "txn",
    f"""SELECT id, account_id, ts, Time, {_list(f'coalesce(t.{c}, m.{c}) AS {c}' for c in [*V, 'Amount'])}, Class FROM txn t,
    (SELECT {_list(f'quantile_disc({c}, 0.5) AS {c}' for c in [*V, 'Amount'])} FROM txn) m""",
    f"Time {VS} Amount",
)
_add("silver_time_cast", "base", "SELECT id, CAST(floor(Time) AS DOUBLE) AS Time FROM base", "Time")
_add("silver_amount_log", "clean", "SELECT id, Amount, ln(1e0 + Amount) AS Amount_Log FROM clean", "Amount Amount_Log")
_add(
    "silver_row_fraction",
    "uniq",
    "SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS DOUBLE) / (SELECT count(*) FROM uniq) AS Row_Fraction FROM uniq",
    "Row_Fraction",
)
_add(
    "silver_amount_percentile",
    "clean",
    "SELECT id, Amount, percent_rank() OVER (ORDER BY Amount) AS Amount_Percentile FROM clean",
    "Amount Amount_Percentile",
)
_add("silver_amount_category", "txn", f"SELECT id, Amount, {CATEGORY.format('Amount')} AS Amount_Category FROM txn", "Amount")
_add("silver_time_features", "txn", f"SELECT id, Time, {HOUR} AS Hour, {DAY} AS DayOfWeek, {WEEKEND} AS IsWeekend FROM txn", "Time")
_add("silver_outlier_fixed", "clean", f"SELECT id, {_list(f'{_flag(c)} AS {c}_IsOutlier' for c in FLAGS)} FROM clean")
_add(
    "silver_outlier_iqr",
    "clean",
    f"""SELECT id, {_list(f'CAST(c.{x} < q.a_{x} - 1.5e0 * (q.b_{x} - q.a_{x}) OR c.{x} > q.b_{x} + 1.5e0 * (q.b_{x} - q.a_{x}) AS INTEGER) AS {x}_IsOutlier' for x in [*V, 'Amount'])}
    FROM clean c, (SELECT {_list(f'quantile_disc({x}, 0.25) AS a_{x}, quantile_disc({x}, 0.75) AS b_{x}' for x in [*V, 'Amount'])} FROM clean) q""",
)
_add(
    "silver_metadata",
    "clean",
    f"""SELECT id, {AS_OF} AS ProcessedTimestamp, 1e0 AS DataQuality_Score, 'FULL' AS ProcessingMode,
    (SELECT count(*) FROM clean) AS SampleSize, (SELECT count(*) FROM clean) AS OriginalTotalRecords FROM clean""",
)
_add("silver_filter_label", "txn", "SELECT id, Class FROM txn WHERE Class IS NOT NULL")
_add("silver_build", "silver", "SELECT * FROM silver", f"Time {VS} Amount Amount_Log Amount_Percentile DataQuality_Score")
METRICS = """SELECT '{mode}' AS processing_mode, (SELECT count(*) FROM txn) AS original_total_records, (SELECT count(*) FROM s) AS sample_size,
    (SELECT count(*) FROM (SELECT DISTINCT * FROM s) WHERE Class IS NOT NULL) AS final_records,
    (SELECT count(*) FROM s) - (SELECT count(*) FROM (SELECT DISTINCT * FROM s)) AS duplicates_removed,
    (SELECT count(*) FROM s) - (SELECT count(*) FROM (SELECT DISTINCT * FROM s) WHERE Class IS NOT NULL) AS records_removed,
    round((SELECT count(*) FROM s) * 100e0 / (SELECT count(*) FROM txn), 2) AS sample_percentage"""
_cte("full_s", ("txn",), "SELECT * FROM txn")
_cte("tenth_s", ("txn",), f"SELECT * FROM txn WHERE {IN_TENTH}")
_add("silver_run_metrics", "full_s", METRICS.format(mode="FULL").replace("FROM s)", "FROM full_s)"))
_add("silver_run_metrics_sample", "tenth_s", METRICS.format(mode="SAMPLE").replace("FROM s)", "FROM tenth_s)"))
_STEPS = ["duplicate_removal", "missing_value_handling", "feature_engineering", "outlier_detection", "data_quality_scoring"]
_BRONZE_RULES = [_ROWS[0], *_CLASS, *_AMOUNT, *_TIME, *_ranges("pca_range", V, 100, "warn")]
_add(
    "silver_lineage_report",
    "full_s",
    f"""SELECT * FROM (WITH m AS ({METRICS.format(mode="FULL").replace("FROM s)", "FROM full_s)")}),
    c AS ({" UNION ALL ".join(_rule(*r, "txn") for r in _BRONZE_RULES)})
    SELECT 'bronze_layer' AS section, "check" || ':' || "column" AS item,
    CASE WHEN passed THEN 'passed' ELSE 'failed' END || '=' || CAST(value AS VARCHAR) AS value FROM c
    {" ".join(f"UNION ALL SELECT 'transformation', '{c}', CAST({c} AS VARCHAR) FROM m" for c in ["processing_mode", "original_total_records", "sample_size", "final_records", "duplicates_removed", "records_removed", "sample_percentage"])}
    UNION ALL VALUES ('data_lineage', 'source', 'bronze/creditcard.csv'), ('data_lineage', 'destination', 'silver/current'),
    ('silver_layer', 'filename', 'current'), {", ".join(f"('data_lineage', 'step_{i}', '{x}')" for i, x in enumerate(_STEPS, 1))})""",
)

# Gold hours
HOURS = "total_amount avg_amount median_amount std_amount avg_data_quality"
_add("gold_default_columns", "base", "SELECT id, 0 AS Hour, 0 AS IsWeekend, 'Unknown' AS Amount_Category FROM base")
_add("gold_hourly_fraud", "hours", "SELECT * EXCLUDE (created_at) FROM hours", HOURS)
_add(
    "gold_hourly_no_time",
    "silver",
    f"""SELECT {AS_OF} AS timestamp, Hour, IsWeekend, CAST(sum(Class) AS BIGINT) AS fraud_count, count(*) AS total_transactions,
    sum(Amount) AS total_amount, avg(Amount) AS avg_amount, quantile_disc(Amount, 0.5) AS median_amount, stddev_samp(Amount) AS std_amount,
    avg(DataQuality_Score) AS avg_data_quality FROM silver GROUP BY Hour, IsWeekend""",
    HOURS,
)
_add("gold_fraud_rate", "hourly", "SELECT * FROM hourly", f"{HOURS} fraud_rate")
_add(
    "gold_time_range",
    "hourly",
    "SELECT 'fraud_analytics' AS dataset, count(*) AS records, min(timestamp) AS min_ts, max(timestamp) AS max_ts FROM hourly",
)
_add(
    "gold_hourly_compact",
    "silver",
    """SELECT date_trunc('hour', ts) AS hour_window, count(*) AS total_transactions, count(*) FILTER (Class = 1) AS fraud_transactions,
    CAST(count(*) FILTER (Class = 1) AS DOUBLE) / count(*) AS fraud_rate, sum(Amount) AS total_amount, avg(Amount) AS avg_amount,
    max(Amount) AS max_amount FROM silver GROUP BY 1""",
    "fraud_rate total_amount avg_amount max_amount",
)
_add(
    "gold_amount_category_dist",
    "silver",
    f"SELECT date_trunc('hour', {TIME_US}) AS timestamp, Amount_Category, count(*) AS transactions FROM silver GROUP BY 1, 2",
)
RISKS = "avg_amount fraud_rate avg_outlier_ratio risk_score"
_add("gold_risk_profiles", "risks", "SELECT * FROM risks", RISKS, digits=9)
_add("gold_summary_stats", "stats", "SELECT * FROM stats", "fraud_rate total_amount avg_amount max_amount")
_add(
    "gold_retention",
    "cur",
    f"SELECT id, created_at, Amount FROM cur WHERE created_at >= {AS_OF} - INTERVAL 10 DAY",
    "Amount",
)

# ML features
ML_CARRIED = "id, account_id, ts, Time, Amount"
_add(
    "ml_feature_select",
    "clean",
    f"""SELECT {ML_CARRIED}, {_list(V)}, ln(1e0 + Amount) AS Amount_Log, 0e0 AS Amount_Percentile, {HOUR} AS Hour, {DAY} AS DayOfWeek,
    {WEEKEND} AS IsWeekend, 0e0 AS DataQuality_Score, Class, {_list(f'{_flag(c)} AS {c}_IsOutlier' for c in FLAGS)} FROM clean""",
    f"Time Amount {VS} Amount_Log",
)
_add(
    "ml_interactions",
    "clean",
    "SELECT id, V1 * ln(1e0 + Amount) AS V1_Amount_Interaction, V2 * ln(1e0 + Amount) AS V2_Amount_Interaction FROM clean",
    "V1_Amount_Interaction V2_Amount_Interaction",
)
CYCLES = f"{_sin('Hour', 24)} AS Hour_Sin, {_cos('Hour', 24)} AS Hour_Cos, {_sin('DayOfWeek', 7)} AS DayOfWeek_Sin, {_cos('DayOfWeek', 7)} AS DayOfWeek_Cos"
_add(
    "ml_cyclic",
    "base",
    f"SELECT id, {CYCLES} FROM (SELECT id, {HOUR} AS Hour, {DAY} AS DayOfWeek FROM base)",
    "Hour_Sin Hour_Cos DayOfWeek_Sin DayOfWeek_Cos",
)
ROLLING = "avg(Amount_Log) OVER w AS Amount_Rolling_Mean, stddev_pop(Amount_Log) OVER w AS Amount_Rolling_Std"
LOGS = "(SELECT id, account_id, Time, ln(1e0 + Amount) AS Amount_Log FROM clean)"
R3 = "Amount_Log Amount_Rolling_Mean Amount_Rolling_Std"
_add("ml_rolling_100", "clean", f"SELECT id, Amount_Log, {ROLLING} FROM {LOGS} WINDOW w AS ({ROLL})", R3)
_add(
    "ml_rolling_100_global",
    "clean",
    f"SELECT id, Amount_Log, {ROLLING} FROM {LOGS} WINDOW w AS ({ROLL.replace('PARTITION BY account_id ', '')})",
    R3,
)
RATIO5 = f"({_plus(_flag(c) for c in FLAGS)}) / 5e0"
_add("ml_outlier_ratio", "clean", f"SELECT id, {RATIO5} AS Outlier_Ratio FROM clean", "Outlier_Ratio")
_add("ml_outlier_ratio_fallback", "clean", f"SELECT id, {RATIO5} AS Outlier_Ratio FROM clean", "Outlier_Ratio")
_add("ml_metadata", "base", "SELECT id, '1.0' AS feature_version, ts AS created_at, 'silver_layer' AS data_source FROM base")
_add(
    "ml_build",
    "silver",
    f"""SELECT {ML_CARRIED}, {_list(V)}, Amount_Log, Amount_Percentile, Amount_IsOutlier, Hour, DayOfWeek, IsWeekend, DataQuality_Score, Class,
    {_list(FLAG_COLS)}, V1 * Amount_Log AS V1_Amount_Interaction, V2 * Amount_Log AS V2_Amount_Interaction, {CYCLES}, {ROLLING},
    ({_plus([*FLAG_COLS, 'Amount_IsOutlier'])}) / 6e0 AS Outlier_Ratio, '1.0' AS feature_version, ts AS created_at, 'silver_layer' AS data_source
    FROM silver WINDOW w AS ({ROLL})""",
    f"Time Amount {VS} {R3} Amount_Percentile V1_Amount_Interaction V2_Amount_Interaction Hour_Sin Hour_Cos DayOfWeek_Sin DayOfWeek_Cos Outlier_Ratio",
)
_add("ml_train_test_split", "cur", "SELECT id, split FROM cur")
_add(
    "ml_split_counts",
    "cur",
    """SELECT 'ml_features' AS dataset, count(*) AS total_records, count(*) FILTER (split = 'train') AS train_records,
    count(*) FILTER (split = 'test') AS test_records, 45 AS feature_count FROM cur""",
)

# Stream features
_add("st_message_size", "", "SELECT event_id, CAST(length(props) AS INTEGER) AS message_length FROM events")
_add(
    "st_decode_cdc",
    "uniq",
    f"""SELECT id AS message_id, id, account_id, {_list(f"CASE WHEN id % 12 = 6 THEN 0e0 ELSE {c} END AS {c.lower()}" if c == 'V5' else f'{c} AS {c.lower()}' for c in V)},
    Amount AS amount, Class AS class, ts AS created, true AS created_present FROM uniq WHERE {DECODABLE}""",
    f"{vs} amount",
)
_add("st_drop_invalid", "uniq", f"SELECT id AS message_id, {DECODABLE} AS decoded FROM uniq")
_cte(
    "decoded",
    ("uniq",),
    f"SELECT * REPLACE (CASE WHEN id % 12 = 6 THEN 0e0 ELSE V5 END AS V5) FROM uniq WHERE {DECODABLE}",
)
_cte("dq0", ("decoded",), CTE["rt0"][1].replace("FROM uniq", "FROM decoded"))
_cte("dq1", ("dq0",), CTE["rt1"][1].replace("FROM rt0", "FROM dq0"))
_add(
    "st_decoded_quality",
    "dq1",
    f"SELECT transaction_id, v5, amount, hour, data_quality_score, {RISK} AS risk_score FROM dq1",
    "v5 amount data_quality_score risk_score",
)


def _stream(key: str, cols: str, doubles: str, source: str = "rt") -> None:
    _add(key, source, f"SELECT transaction_id, {', '.join(cols.split())} FROM {source}", doubles)


TIMES = "hour day_of_week is_weekend hour_sin hour_cos day_of_week_sin day_of_week_cos time_cluster"
CYCLIC = "hour_sin hour_cos day_of_week_sin day_of_week_cos"
INTER = " ".join(f"v{i}_amount_interaction" for i in range(1, 6))
_stream("st_pca_copy", vs, vs)
_stream("st_amount_features", "amount amount_log", "amount amount_log")
_stream("st_amount_percentile", "amount amount_percentile", "amount amount_percentile")
_stream("st_amount_zscore", "amount amount_zscore", "amount amount_zscore")
_stream("st_amount_range", "amount amount_range_flag", "amount")
_stream("st_time_features", TIMES, CYCLIC)
_stream("st_interactions", INTER, INTER)
_stream("st_data_quality", "data_quality_score", "data_quality_score")
_stream("st_outlier_ratio", "outlier_ratio is_anomaly", "outlier_ratio")
_stream("st_risk_score", "risk_score", "risk_score")
_add(
    "st_parse_created_at",
    "base",
    """SELECT id, CASE id % 8 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN ts WHEN 2 THEN date_trunc('second', ts)
      WHEN 3 THEN date_trunc('day', ts) WHEN 4 THEN NULL WHEN 5 THEN date_trunc('second', ts) WHEN 6 THEN date_trunc('millisecond', ts)
      ELSE ts END AS parsed,
    CASE id % 8 WHEN 5 THEN make_timestamp(CAST(floor(epoch_us(ts) / 1e6) AS BIGINT) * 1000) WHEN 6 THEN make_timestamp(epoch_us(ts) // 1000)
      WHEN 7 THEN ts END AS legacy FROM base""",
)
_add(
    "st_time_fallback",
    "rt1",
    "SELECT transaction_id AS id, "
    + _list(
        f"CASE transaction_id % 3 WHEN 0 THEN {c} WHEN 1 THEN {bad} ELSE {none} END AS {c}"
        for c, bad, none in (
            ("hour", "12", "0"),
            ("day_of_week", "1", "0"),
            ("is_weekend", "0", "0"),
            ("hour_sin", "0e0", "0e0"),
            ("hour_cos", "1e0", "0e0"),
            ("day_of_week_sin", "0e0", "0e0"),
            ("day_of_week_cos", "1e0", "0e0"),
            ("time_cluster", "1", "0"),
        )
    )
    + " FROM rt1",
    CYCLIC,
)
PCAS = "pca_mean pca_std pca_skewness pca_kurtosis"
_add("st_pca_stats", "pca", "SELECT * FROM pca", PCAS)
RT_DOUBLES = f"{vs} amount amount_log amount_percentile amount_zscore {CYCLIC} {INTER} outlier_ratio data_quality_score risk_score"
_add("st_feature_record", "rt pca", "SELECT * FROM rt JOIN pca USING (transaction_id)", f"{RT_DOUBLES} {PCAS}")
ROLLED = "amount_rolling_mean amount_rolling_std amount_rolling_min amount_rolling_max"
_stream("st_rolling_100", ROLLED, ROLLED, "rolled")
_stream("st_velocity_count", "transaction_velocity", "transaction_velocity", "rolled")
_stream("st_rolling_100_stream", f"{ROLLED} transaction_velocity", f"{ROLLED} transaction_velocity", "rolled")
_add("st_json_out", "rt", "SELECT transaction_id, fraud_class IS NULL AS null_kept FROM rt")
_add(
    "st_velocity_5min",
    "rt",
    "SELECT account_id, time_bucket(INTERVAL 5 MINUTE, time_stamp) AS window_start, count(*) AS transactions FROM rt GROUP BY 1, 2",
)
_add(
    "st_hourly_buckets",
    "rt",
    """SELECT date_trunc('hour', time_stamp) AS timestamp, CAST(sum(fraud_class) AS BIGINT) AS fraud_count, count(*) AS total_transactions,
    sum(amount) AS total_amount, avg(amount) AS avg_amount, quantile_disc(amount, 0.5) AS median_amount, stddev_samp(amount) AS std_amount,
    avg(data_quality_score) AS avg_data_quality, CAST(sum(fraud_class) AS DOUBLE) / count(*) AS fraud_rate FROM rt GROUP BY 1""",
    f"{HOURS} fraud_rate",
    digits=9,
)
_add("st_cdc_latest", "latest", "SELECT id, lsn, deleted, source_table, source_ts_ms, amount, class FROM latest", "amount")
_add("st_cdc_deletes", "latest", "SELECT id, lsn, amount FROM latest WHERE NOT deleted", "amount")
_add("st_cdc_latest_stream", "latest", "SELECT id, lsn, amount FROM latest WHERE NOT deleted", "amount")
ALERT = "risk_score > 0.8e0 OR is_anomaly"
_add("st_fraud_alerts", "rt", f"SELECT transaction_id, account_id, risk_score, is_anomaly, processed_at FROM rt WHERE {ALERT}", "risk_score")
_add("st_checkpoint", "rt", f"SELECT transaction_id, risk_score FROM rt WHERE {ALERT}", "risk_score")
_add("st_kafka_source", "uniq", f"SELECT id, Amount AS amount, ts AS created FROM uniq WHERE {DECODABLE}", "amount")
_add(
    "st_quarantine",
    "uniq",
    """SELECT CASE id % 12 WHEN 1 THEN '{"payloa' WHEN 2 THEN '{"payloa' WHEN 3 THEN left(concat('{"id":', id, ',"acc'), 8) ELSE 'not json' END
    AS starts_with, count(*) AS messages FROM uniq WHERE id % 12 IN (1, 2, 3, 4) GROUP BY 1""",
)

# Views
_add(
    "vw_fraud_analytics_unified",
    "hourly rt",
    """SELECT 'batch' AS source_type, timestamp, Hour AS hour, fraud_count, total_transactions, fraud_rate, avg_amount, created_at FROM hourly
    UNION ALL SELECT 'realtime', processed_at, hour, count(*) FILTER (fraud_class = 1), count(*),
    CAST(count(*) FILTER (fraud_class = 1) AS DOUBLE) / count(*), avg(amount), max(processed_at) FROM rt GROUP BY processed_at, hour""",
    "fraud_rate avg_amount",
)
_add(
    "vw_ml_combined",
    "sets",
    f"SELECT dataset AS dataset_type, Time, {_list(V)}, Amount, Class, {_plus(FLAG_COLS)} AS outlier_count_sample FROM sets",
    f"Time {VS} Amount",
)
SUMS = "fraud_rate avg_amount stddev_amount min_amount max_amount avg_outlier_features_per_transaction"
_add("vw_fraud_summary", "summary", "SELECT * FROM summary", SUMS)
PARSED = f"SELECT CAST(NULL AS DOUBLE) AS time, amount, CAST(fraud_class AS BIGINT) AS class, risk_score, v1, v2, v3, {BUCKET} AS hour_bucket FROM rt"
_add("vw_stream_parsed", "rt", PARSED, "amount risk_score v1 v2 v3")
_add(
    "vw_stream_nested",
    "rt",
    "SELECT CAST(transaction_id AS VARCHAR) AS id, time_stamp, amount, fraud_class, risk_score, is_anomaly FROM rt",
    "amount risk_score",
)

# Batch and stream together
_add(
    "an_batch_vs_realtime",
    "hourly rt",
    f"""SELECT hour, max(batch_rate) AS batch_fraud_rate, max(rt_rate) AS realtime_fraud_rate, max(batch_n) AS batch_transactions,
    max(rt_n) AS realtime_transactions FROM (
      SELECT Hour AS hour, fraud_rate AS batch_rate, NULL AS rt_rate, total_transactions AS batch_n, NULL AS rt_n FROM hourly
      WHERE created_at >= {AS_OF} - INTERVAL 1 DAY
      UNION ALL SELECT hour, NULL, CAST(count(*) FILTER (fraud_class = 1) AS DOUBLE) / count(*), NULL, count(*) FROM rt
      WHERE processed_at >= {AS_OF} - INTERVAL 1 DAY GROUP BY hour) GROUP BY hour""",
    "batch_fraud_rate realtime_fraud_rate",
)
_add(
    "an_high_risk",
    "rt",
    f"""SELECT 'realtime' AS source, transaction_id, amount, risk_score, is_anomaly, fraud_class AS actual_fraud, processed_at FROM rt
    WHERE {ALERT} ORDER BY risk_score DESC, transaction_id LIMIT 100""",
    "amount risk_score",
)
_add(
    "an_feature_quality",
    "cur rt",
    """SELECT 'batch' AS pipeline, count(*) AS total_records, avg(DataQuality_Score) AS avg_quality_score, avg(Outlier_Ratio) AS avg_outlier_ratio,
    max(created_at) AS latest_update FROM cur
    UNION ALL SELECT 'stream', count(*), avg(CASE WHEN risk_score IS NOT NULL THEN 1e0 ELSE 0.5e0 END),
    avg(CASE WHEN is_anomaly THEN 1e0 ELSE 0e0 END), max(processed_at) FROM rt""",
    "avg_quality_score avg_outlier_ratio",
)
_add(
    "an_hourly_unified",
    "hourly rt",
    f"""SELECT hour, analysis_date, CAST(sum(CASE WHEN source = 'batch' THEN n ELSE 0 END) AS BIGINT) AS batch_transactions,
    CAST(sum(CASE WHEN source = 'realtime' THEN n ELSE 0 END) AS BIGINT) AS realtime_transactions,
    avg(CASE WHEN source = 'batch' THEN rate END) AS batch_fraud_rate, avg(CASE WHEN source = 'realtime' THEN rate END) AS realtime_fraud_rate
    FROM (SELECT 'batch' AS source, Hour AS hour, CAST(created_at AS DATE) AS analysis_date, total_transactions AS n, fraud_rate AS rate FROM hourly
      UNION ALL SELECT 'realtime', hour, CAST(processed_at AS DATE), count(*), CAST(sum(fraud_class) AS DOUBLE) / count(*) FROM rt
      GROUP BY hour, CAST(processed_at AS DATE))
    WHERE analysis_date >= CAST({AS_OF} AS DATE) - INTERVAL 7 DAY GROUP BY hour, analysis_date""",
    "batch_fraud_rate realtime_fraud_rate",
)
_add(
    "an_top_features",
    "cur",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature_name, avg({c}) FILTER (Class = 1) AS avg_fraud_value, avg({c}) FILTER (Class = 0) AS avg_normal_value,
        avg({c}) FILTER (Class = 1) - avg({c}) FILTER (Class = 0) AS fraud_difference FROM cur"""
        for c in V
    ),
    "avg_fraud_value avg_normal_value fraud_difference",
)
_add(
    "an_freshness",
    "hourly cur rt",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS record_count, min({ts}) AS oldest_record, max({ts}) AS newest_record,
        CAST(epoch_us({AS_OF}) - epoch_us(max({ts})) AS DOUBLE) / 1e6 AS data_age_seconds FROM {table}"""
        for name, table, ts in (
            ("fraud_analytics_batch", "hourly", "created_at"),
            ("ml_features_batch", "cur", "created_at"),
            ("ml_features_stream", "rt", "processed_at"),
        )
    ),
    "data_age_seconds",
)
_add(
    "an_prediction_accuracy",
    "cur rt",
    """SELECT CAST(count(*) AS DECIMAL(38, 0)) AS total_comparisons, avg(CASE WHEN b.actual = b.predicted THEN 1e0 ELSE 0e0 END) AS batch_accuracy,
    avg(CASE WHEN s.actual = s.predicted THEN 1e0 ELSE 0e0 END) AS stream_accuracy,
    avg(CASE WHEN b.predicted = s.predicted THEN 1e0 ELSE 0e0 END) AS prediction_agreement
    FROM (SELECT epoch_us(created_at) AS us, CAST(Outlier_Ratio > 0.3e0 AS INTEGER) AS predicted, Class AS actual FROM cur) b
    JOIN (SELECT epoch_us(processed_at) AS us, CAST(is_anomaly AS INTEGER) AS predicted, fraud_class AS actual FROM rt
      WHERE fraud_class IS NOT NULL) s ON s.us > b.us - 3600000000 AND s.us < b.us + 3600000000""",
    "batch_accuracy stream_accuracy prediction_agreement",
)

# Feature sets
_add("gl_dataset_counts", "sets", "SELECT 'ml_features_' || dataset AS table_name, count(*) AS record_count FROM sets GROUP BY 1")
_add(
    "gl_fraud_summary",
    "summary",
    """SELECT dataset_type, total_transactions, fraud_transactions, round(fraud_rate * 100, 4) AS fraud_rate_percent,
    round(avg_amount, 2) AS avg_amount, round(stddev_amount, 2) AS stddev_amount,
    round(avg_outlier_features_per_transaction, 2) AS avg_outlier_features FROM summary""",
)
_add(
    "gl_amount_by_class",
    "cur",
    f"""SELECT Class AS fraud_class, count(*) AS transaction_count, {MEAN_2} AS avg_amount, round(stddev_samp(Amount), 2) AS stddev_amount,
    round(min(Amount), 2) AS min_amount, round(max(Amount), 2) AS max_amount, round(quantile_cont(Amount, 0.5), 2) AS median_amount,
    round(quantile_cont(Amount, 0.95), 2) AS p95_amount FROM cur GROUP BY 1""",
)
_add(
    "gl_hour_bucket",
    "cur",
    f"""SELECT CAST(floor(Time / 3600e0) AS BIGINT) AS hour_bucket, count(*) AS total_transactions, count(*) FILTER (Class = 1) AS fraud_count,
    round(avg(CAST(Class AS DOUBLE)) * 100, 4) AS fraud_rate_percent,
    {MEAN_2} AS avg_amount FROM cur GROUP BY 1 ORDER BY 1 LIMIT 24""",
)
_add(
    "gl_outlier_by_class",
    "cur",
    " UNION ALL ".join(
        f"""SELECT '{c}_IsOutlier' AS feature_name, round(avg({c}_IsOutlier) FILTER (Class = 1) * 100, 2) AS fraud_outlier_rate,
        round(avg({c}_IsOutlier) FILTER (Class = 0) * 100, 2) AS normal_outlier_rate FROM cur"""
        for c in [*FLAGS, "Amount"]
    ),
)
_add(
    "gl_feature_distribution",
    "cur",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature_name, round(avg({c}), {n}) + 0e0 AS avg_value, round(stddev_samp({c}), {n}) AS stddev_value,
        round(min({c}), {n}) AS min_value, round(max({c}), {n}) AS max_value FROM cur"""
        for c, n in [*((c, 6) for c in V), ("Amount", 2)]
    ),
)
_add(
    "gl_dataset_compare",
    "sets",
    f"""SELECT dataset, count(*) AS record_count, round(avg(CAST(Class AS DOUBLE)) * 100, 4) AS fraud_rate_percent, {MEAN_2} AS avg_amount,
    count(*) FILTER (V1_IsOutlier = 1) AS V1_outliers, round(count(*) FILTER (V1_IsOutlier = 1) * 100e0 / count(*), 2) AS outlier_percentage
    FROM sets GROUP BY 1""",
)
_add(
    "gl_amount_ranges",
    "cur",
    """SELECT CASE WHEN Amount < 10 THEN '< $10' WHEN Amount < 50 THEN '$10-$50' WHEN Amount < 100 THEN '$50-$100'
      WHEN Amount < 500 THEN '$100-$500' ELSE '> $500' END AS amount_range, count(*) AS transaction_count,
    count(*) FILTER (Class = 1) AS fraud_count, round(avg(CAST(Class AS DOUBLE)) * 100, 4) AS fraud_rate_percent FROM cur GROUP BY 1""",
)
_add(
    "gl_fraud_samples",
    "cur",
    """SELECT id, Time, round(V1, 4) + 0e0 AS V1, round(V2, 4) + 0e0 AS V2, round(V3, 4) + 0e0 AS V3, round(Amount, 2) AS Amount, Class AS fraud_class,
    V1_IsOutlier, V2_IsOutlier, Amount_IsOutlier, 'FRAUD' AS transaction_type FROM cur WHERE Class = 1 ORDER BY cur.Amount DESC, id LIMIT 20""",
    "Time",
)
_add("doc_count", "cur", "SELECT count(*) AS record_count FROM cur")
_add("doc_class_counts", "cur", "SELECT Class, count(*) AS record_count FROM cur WHERE split = 'train' GROUP BY 1")
_add(
    "doc_training_rows",
    "cur",
    f"SELECT {_list(V)}, Amount, Class FROM cur WHERE split = 'train' AND Amount IS NOT NULL ORDER BY id LIMIT 1000",
    f"{VS} Amount",
)
_add("doc_outlier_bool", "cur", "SELECT V1_IsOutlier = 1 AS v1_isoutlier_bool, Amount AS amount, Class AS class FROM cur ORDER BY id LIMIT 10", "amount")
_add("doc_stream_count", "rt0", "SELECT count(*) AS record_count FROM rt0")
_add(
    "doc_stream_latest",
    "rt",
    f"SELECT * FROM ({PARSED}) ORDER BY hour_bucket DESC, amount DESC, v1, v2, v3 LIMIT 10",
    "amount risk_score v1 v2 v3",
)
_add(
    "doc_overall_fraud_rate",
    "cur",
    "SELECT count(*) AS records, avg(CAST(Class AS DOUBLE)) * 100 AS fraud_rate_percent FROM cur",
    "fraud_rate_percent",
)
_add(
    "prof_correlation",
    "cur",
    " UNION ALL ".join(f"SELECT '{c}' AS feature_name, corr({c}, CAST(Class AS DOUBLE)) AS correlation FROM cur" for c in [*V, "Amount"]),
    "correlation",
)

# Profiles
_NUM = ["id", "Time", *V, "Amount", "Amount_Log", "Hour", "DayOfWeek", "Class"]
_add(
    "prof_dataset",
    "silver",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, (count(*) - count({c})) * 100e0 / count(*) AS null_percent,
        avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std, min(CAST({c} AS DOUBLE)) AS min,
        quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50,
        quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, max(CAST({c} AS DOUBLE)) AS max FROM silver"""
        for c in _NUM
    )
    + """ UNION ALL SELECT 'Amount_Category', count(*), count(*) - count(Amount_Category), 0e0, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM silver""",
    "null_percent mean std min q25 q50 q75 max",
)
_add(
    "prof_categorical",
    "",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", (SELECT count(DISTINCT {c}) FROM events) AS distinct_values,
        CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER) AS rank, {c} AS value, count(*) AS count FROM events GROUP BY {c}) WHERE rank <= 5"""
        for c in ("event_type", "props")
    ),
)
QCOLS = ["id", "account_id", "Time", *V, "Amount", "Amount_Category", "Hour", "Class"]


def _metrics(table: str, *rows: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, '{i}' AS item, CAST({x} AS DOUBLE) AS value FROM {table}" for m, i, x in rows)


_add(
    "prof_silver_quality",
    "silver",
    _metrics(
        "silver",
        ("missing_values", "*", _plus(f"(count(*) - count({c}))" for c in QCOLS)),
        ("duplicate_records", "*", f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {_list(QCOLS)} FROM silver))"),
        ("label_count", "normal", "count(*) FILTER (Class = 0)"),
        ("label_count", "fraud", "count(*) FILTER (Class = 1)"),
        ("label_percent", "normal", "count(*) FILTER (Class = 0) * 100e0 / count(*)"),
        ("label_percent", "fraud", "count(*) FILTER (Class = 1) * 100e0 / count(*)"),
    ),
    "value",
)
_add(
    "prof_silver_amount",
    "silver",
    _metrics(
        "silver",
        ("amount", "min", "min(Amount)"),
        ("amount", "max", "max(Amount)"),
        ("amount", "mean", "avg(Amount)"),
        ("amount", "median", "quantile_cont(Amount, 0.5)"),
    )
    + """ UNION ALL SELECT 'category_count', Amount_Category, CAST(count(*) AS DOUBLE) FROM silver GROUP BY 2
    UNION ALL SELECT 'category_percent', Amount_Category, count(*) * 100e0 / (SELECT count(*) FROM silver) FROM silver GROUP BY 2""",
    "value",
)
_add(
    "prof_silver_time",
    "silver",
    _metrics("silver", ("hour", "min", "min(Hour)"), ("hour", "max", "max(Hour)"))
    + """ UNION ALL SELECT 'day_count', CASE WHEN IsWeekend = 1 THEN 'weekend' ELSE 'weekday' END, CAST(count(*) AS DOUBLE) FROM silver GROUP BY 2
    UNION ALL SELECT 'day_percent', CASE WHEN IsWeekend = 1 THEN 'weekend' ELSE 'weekday' END, count(*) * 100e0 / (SELECT count(*) FROM silver) FROM silver GROUP BY 2""",
    "value",
)
_add(
    "prof_silver_outliers",
    "silver",
    f"SELECT 28 AS components, 6 AS flag_columns, CAST(sum({_plus([*FLAG_COLS, 'Amount_IsOutlier'])}) AS BIGINT) AS total_flags FROM silver",
)
_add("prof_silver_processing", "silver", f"SELECT {AS_OF} AS last_processed, 1e0 AS avg_quality")
_ADDED = sorted(
    [
        *["Amount_IsOutlier", "Amount_Log", "Amount_Percentile", "Amount_Category", "Hour", "DayOfWeek", "IsWeekend", *FLAG_COLS],
        *["ProcessedTimestamp", "DataQuality_Score", "ProcessingMode", "SampleSize", "OriginalTotalRecords"],
    ]
)
_add(
    "prof_bronze_silver_diff",
    "silver",
    f"""SELECT (SELECT count(*) FROM txn) AS bronze_rows, count(*) AS silver_rows, (SELECT count(*) FROM txn) - count(*) AS removed_rows,
    34 AS bronze_columns, {34 + len(_ADDED)} AS silver_columns, {len(_ADDED)} AS new_columns, '{','.join(_ADDED)}' AS added FROM silver""",
)
_add(
    "prof_hourly",
    "hourly",
    """SELECT '' AS missing_columns, '' AS extra_columns, count(*) AS records, min(Hour) AS min_hour, max(Hour) AS max_hour,
    min(fraud_rate) AS min_fraud_rate, max(fraud_rate) AS max_fraud_rate, CAST(sum(total_transactions) AS BIGINT) AS total_transactions,
    CAST(sum(fraud_count) AS BIGINT) AS total_frauds, CAST(sum(fraud_count) AS DOUBLE) / CAST(sum(total_transactions) AS DOUBLE) AS overall_fraud_rate,
    min(timestamp) AS min_time, max(timestamp) AS max_time FROM hourly""",
    "min_fraud_rate max_fraud_rate overall_fraud_rate",
)
_add(
    "prof_ml",
    "sets",
    """SELECT dataset, count(*) AS rows, 58 AS features, avg(CAST(Class AS DOUBLE)) AS fraud_rate, count(*) FILTER (Class = 1) AS fraud_cases,
    count(*) FILTER (Class = 0) AS normal_cases, 2 AS interaction_features, 4 AS cyclic_features FROM sets GROUP BY 1""",
    "fraud_rate",
)
_add(
    "prof_risk",
    "risks",
    _metrics("risks", ("segments", "total", "count(*)"), ("risk_score", "min", "min(risk_score)"), ("risk_score", "max", "max(risk_score)"))
    + """ UNION ALL SELECT 'category', risk_category, CAST(count(*) AS DOUBLE) FROM risks GROUP BY 2
    UNION ALL SELECT * FROM (SELECT 'top_score', CAST(account_id AS VARCHAR), risk_score FROM risks ORDER BY risk_score DESC, account_id LIMIT 5)""",
    "value",
)
_add(
    "prof_summary",
    "stats",
    """SELECT aggregation_level, count(*) AS records, min(date) AS first_date, max(date) AS last_date, avg(fraud_rate) AS avg_fraud_rate
    FROM stats GROUP BY 1""",
    "avg_fraud_rate",
)


def _present(names, table: str = "silver") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {'false' if c == 'TimeOfDay' else 'true'} AS present, "
        f"{'count(*) * 0' if c == 'TimeOfDay' else f'count({c})'} AS filled FROM {table}"
        for c in names
    )


_add(
    "prof_silver_features",
    "silver",
    _present(
        ["Amount_Category", "Amount_Log", "Amount_Percentile", "Hour", "DayOfWeek", "IsWeekend", "TimeOfDay"]
        + ["ProcessedTimestamp", "DataQuality_Score"]
    ),
)
_add("dq_silver_features_present", "silver", _present(["Amount_Log", "Hour", "IsWeekend", "DataQuality_Score"]))
_add("dq_required_columns", "txn", "SELECT Time, Amount, Class FROM txn", "Time Amount")
