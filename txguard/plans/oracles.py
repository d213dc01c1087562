"""SQL twins of the registered queries, for DuckDB over the same parquet tables."""

from __future__ import annotations

from txguard.schema import NUMERIC_FEATURES

FIELDS = 'transaction_id, user_id, amount, currency, merchant, "timestamp", location, is_fraud'

TX = """
tx AS (
    SELECT CAST(e.event_id AS VARCHAR) AS transaction_id,
           CAST(1000 + MOD(e.user_id * 10, 9000) AS INTEGER) AS user_id,
           ROUND(e.value * 10, 2) AS amount,
           'USD' AS currency,
           CASE MOD(CAST(JSON_EXTRACT_STRING(e.props, '$.k') AS INTEGER), 25)
                WHEN 0 THEN 'QuickCash' WHEN 1 THEN 'GlobalDigital' WHEN 2 THEN 'FastMoneyX'
                ELSE CONCAT('M', JSON_EXTRACT_STRING(e.props, '$.k')) END AS merchant,
           CAST(e.ts AS TIMESTAMP) AS "timestamp",
           CONCAT(CHR(CAST(65 + n.n_regionkey AS INTEGER)), CHR(CAST(65 + n.n_nationkey AS INTEGER))) AS location,
           CASE WHEN e.event_type = 'error' THEN 1 ELSE 0 END AS is_fraud
    FROM events e
    JOIN customer c ON e.user_id = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

RAW = """
numbered AS (SELECT *, CAST(transaction_id AS BIGINT) % 97 AS k FROM tx),
raw AS (
    SELECT CASE WHEN k = 1 THEN NULL ELSE transaction_id END AS transaction_id,
           CASE WHEN k IN (1, 3) THEN NULL WHEN k = 12 THEN '99'
                WHEN k = 5 THEN CONCAT(CAST(user_id AS VARCHAR), '.0') ELSE CAST(user_id AS VARCHAR) END AS user_id,
           CASE WHEN k = 1 THEN NULL WHEN k = 2 THEN 'oops' WHEN k = 6 THEN 'nan' WHEN k = 9 THEN '-5'
                ELSE CAST(amount AS VARCHAR) END AS amount,
           CASE WHEN k = 1 THEN NULL WHEN k = 10 THEN 'usd' ELSE currency END AS currency,
           CASE WHEN k IN (1, 7) THEN NULL ELSE merchant END AS merchant,
           CASE WHEN k = 1 THEN NULL WHEN k = 4 THEN 'bad'
                ELSE CONCAT(STRFTIME("timestamp", '%Y-%m-%dT%H:%M:%S.%f'), '+00:00') END AS "timestamp",
           CASE WHEN k = 1 THEN NULL WHEN k = 8 THEN LOWER(location) ELSE location END AS location,
           CASE WHEN k = 1 THEN NULL WHEN k = 11 THEN '2' ELSE CAST(is_fraud AS VARCHAR) END AS is_fraud,
           k = 1 AS bad_json
    FROM numbered
),
typed AS (
    SELECT transaction_id,
           CAST(TRUNC(TRY_CAST(user_id AS DOUBLE)) AS INTEGER) AS user_id,
           CASE WHEN ISNAN(TRY_CAST(amount AS DOUBLE)) THEN NULL ELSE TRY_CAST(amount AS DOUBLE) END AS amount,
           currency,
           merchant,
           TRY_CAST(REPLACE("timestamp", '+00:00', '') AS TIMESTAMP) AS "timestamp",
           location,
           CAST(TRUNC(TRY_CAST(is_fraud AS DOUBLE)) AS INTEGER) AS is_fraud,
           bad_json,
           transaction_id AS raw_transaction_id, user_id AS raw_user_id, amount AS raw_amount,
           currency AS raw_currency, merchant AS raw_merchant, "timestamp" AS raw_timestamp,
           location AS raw_location, is_fraud AS raw_is_fraud
    FROM raw
),
reasoned AS (
    SELECT *,
           CASE WHEN bad_json THEN 'bad_json' WHEN user_id IS NULL THEN 'user_id' WHEN amount IS NULL THEN 'amount'
                WHEN merchant IS NULL THEN 'merchant' WHEN "timestamp" IS NULL THEN 'timestamp'
                WHEN location IS NULL THEN 'location' WHEN is_fraud IS NULL THEN 'is_fraud' END AS reason
    FROM typed
),
clean AS (SELECT * FROM reasoned WHERE reason IS NULL)"""

CHECKED = """
broken AS (
    SELECT *,
           raw_transaction_id IS NULL AS b1,
           COALESCE(NOT (TRY_CAST(raw_user_id AS DOUBLE) BETWEEN 1000 AND 9999), TRUE) AS b2,
           COALESCE(NOT (amount BETWEEN 0.01 AND 100000), TRUE) AS b3,
           NOT COALESCE(REGEXP_MATCHES(raw_currency, '^[A-Z]{3}$'), FALSE) AS b4,
           "timestamp" IS NULL AS b5,
           NOT COALESCE(REGEXP_MATCHES(raw_location, '^[A-Z]{2}$'), TRUE) AS b6,
           COALESCE(TRY_CAST(raw_is_fraud AS DOUBLE) NOT IN (0, 1), TRUE) AS b7
    FROM typed
)"""

TIME_FEATURES = """
           CAST(HOUR("timestamp") AS INTEGER) AS transaction_hour,
           CASE WHEN HOUR("timestamp") >= 22 OR HOUR("timestamp") < 5 THEN 1 ELSE 0 END AS is_night,
           CASE WHEN ISODOW("timestamp") >= 6 THEN 1 ELSE 0 END AS is_weekend,
           CAST(DAY("timestamp") AS INTEGER) AS transaction_day"""

AMOUNT_FEATURES = """
           ROUND(LN(1 + GREATEST(amount, 0)), 6) AS amount_log,
           CASE WHEN amount > 500 THEN 1 ELSE 0 END AS amount_over_500,
           CASE WHEN amount > 1000 THEN 1 ELSE 0 END AS amount_over_1000"""

USER_FEATURES = """
           CAST(MOD(user_id, 500) AS INTEGER) AS user_id_mod_500,
           CAST(MOD(user_id, 1000) AS INTEGER) AS user_id_mod_1000,
           CASE WHEN MOD(user_id, 500) = 0 THEN 1 ELSE 0 END AS user_id_divisible_500,
           CASE WHEN MOD(user_id, 1000) = 0 THEN 1 ELSE 0 END AS user_id_divisible_1000"""

PLACE_FEATURES = """
           CASE WHEN merchant IN ('QuickCash', 'GlobalDigital', 'FastMoneyX') THEN 1 ELSE 0 END AS merchant_risk,
           UPPER(COALESCE(location, 'UNKNOWN')) AS location"""

ALL_FEATURES = f"amount, {AMOUNT_FEATURES}, {TIME_FEATURES}, {USER_FEATURES}, {PLACE_FEATURES}"

BUCKETED = """
bucketed AS (
    SELECT *, ('0x' || SUBSTR(MD5('42:' || transaction_id), 1, 8))::BIGINT % 10000 AS bucket FROM tx
),
parted AS (
    SELECT *, CASE WHEN bucket < 2000 THEN 'test' WHEN bucket < 4000 THEN 'validation' ELSE 'train' END AS split
    FROM bucketed
)"""

# Part sizes are rounded up in total and split over the classes by largest remainder.
EXACT_SPLIT = """
classes AS (SELECT is_fraud, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total FROM tx GROUP BY is_fraud),
tested AS (
    SELECT is_fraud, n, total, size, FLOOR(share) + CASE WHEN ROW_NUMBER() OVER (ORDER BY FLOOR(share) - share, is_fraud)
           <= size - SUM(FLOOR(share)) OVER () THEN 1 ELSE 0 END AS test_n
    FROM (SELECT *, CEIL(0.2 * total - 1e-9) AS size, CEIL(0.2 * total - 1e-9) * n / total AS share FROM classes)
),
remaining AS (SELECT is_fraud, test_n, n - test_n AS n, total - size AS total FROM tested),
validated AS (
    SELECT is_fraud, test_n, FLOOR(share) + CASE WHEN ROW_NUMBER() OVER (ORDER BY FLOOR(share) - share, is_fraud)
           <= size - SUM(FLOOR(share)) OVER () THEN 1 ELSE 0 END AS validation_n
    FROM (SELECT *, CEIL(0.25 * total - 1e-9) AS size, CEIL(0.25 * total - 1e-9) * n / total AS share FROM remaining)
),
placed AS (
    SELECT transaction_id, is_fraud,
           ROW_NUMBER() OVER (PARTITION BY is_fraud ORDER BY MD5('42:' || transaction_id)) AS place FROM tx
)"""

# Rows without an id are placed by a digest of their columns in alphabetical order.
NAMED = """
keyed AS (
    SELECT is_fraud, MD5(CONCAT_WS('|', CAST(is_fraud AS VARCHAR), 'row ' || transaction_id,
           CAST(EPOCH_US("timestamp") AS VARCHAR), CAST(user_id AS VARCHAR))) AS name FROM tx
),
named AS (
    SELECT is_fraud, CASE WHEN b < 2000 THEN 'test' WHEN b < 4000 THEN 'validation' ELSE 'train' END AS split,
           CAST((('0x' || SUBSTR(MD5('fold:' || name), 1, 8))::BIGINT % 10000) % 3 AS INTEGER) AS fold
    FROM (SELECT *, ('0x' || SUBSTR(MD5('42:' || name), 1, 8))::BIGINT % 10000 AS b FROM keyed)
)"""

# Keys repeat and are missing; only counts per key are told, as equal rows cannot be told apart.
TIES = """
WITH keyed AS (
    SELECT CASE WHEN event_id % 7 <> 0 THEN DATE_TRUNC('day', CAST(ts AS TIMESTAMP)) END AS day, event_type FROM events
),
counted AS (
    SELECT 'oldest' AS keep, * FROM (SELECT * FROM keyed ORDER BY day NULLS LAST, event_type LIMIT 700)
    UNION ALL
    SELECT 'newest' AS keep, * FROM (SELECT * FROM keyed ORDER BY day DESC NULLS LAST, event_type DESC LIMIT 700)
    UNION ALL
    SELECT 'all' AS keep, * FROM keyed
)
SELECT keep, CAST(day AS TIMESTAMP) AS day, event_type, COUNT(*) AS n FROM counted GROUP BY ALL"""

SCORED = """
scored AS (
    SELECT transaction_id, is_fraud, split,
           CAST(((bucket % 1000) * 7) // 10 + 300 * is_fraud AS DOUBLE) / 1000 AS p
    FROM parted
)"""

RANKED = """
grouped AS (
    SELECT p AS score, CAST(SUM(is_fraud) AS BIGINT) AS pos, COUNT(*) AS n FROM scored GROUP BY p
),
ranked AS (
    SELECT score, pos, n,
           CAST(SUM(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
           CAST(SUM(n) OVER (ORDER BY score DESC) AS BIGINT) AS pp,
           CAST(SUM(pos) OVER () AS BIGINT) AS positives,
           CAST(SUM(n) OVER () AS BIGINT) AS total
    FROM grouped
)"""

# The same table for the validation and test parts, each on its own.
RANKED_PARTS = """
grouped AS (
    SELECT split, p AS score, SUM(is_fraud) AS pos, COUNT(*) AS n FROM scored WHERE split <> 'train' GROUP BY split, p
),
ranked AS (
    SELECT split, score, CAST(pos AS DOUBLE) AS pos, CAST(n AS DOUBLE) AS n,
           CAST(SUM(pos) OVER (PARTITION BY split ORDER BY score DESC) AS DOUBLE) AS tp,
           CAST(SUM(n) OVER (PARTITION BY split ORDER BY score DESC) AS DOUBLE) AS pp,
           CAST(SUM(pos) OVER (PARTITION BY split) AS DOUBLE) AS positives,
           CAST(SUM(n) OVER (PARTITION BY split) AS DOUBLE) AS total
    FROM grouped
),
chosen AS (
    SELECT score AS threshold FROM ranked WHERE split = 'validation'
    ORDER BY 2 * (tp / pp) * (tp / positives) / (tp / pp + tp / positives + 1e-12) DESC, score LIMIT 1
),
summary AS (
    SELECT SUM((n - pos) / (total - positives) * (tp - pos + pos / 2) / positives) AS roc_auc,
           SUM(pos / positives * tp / pp) AS auc_pr,
           SUM(CASE WHEN score >= threshold THEN pos END) AS hits,
           SUM(CASE WHEN score >= threshold THEN n END) AS calls,
           MAX(positives) AS positives, MAX(total) AS total, MAX(threshold) AS threshold
    FROM ranked, chosen WHERE split = 'test'
),
evaluation AS (
    SELECT ROUND(roc_auc, 6) AS roc_auc, ROUND(auc_pr, 6) AS auc_pr,
           ROUND(COALESCE(hits / calls, 0), 6) AS "precision", ROUND(COALESCE(hits / positives, 0), 6) AS recall,
           ROUND(COALESCE(2 * hits / (calls + positives), 0), 6) AS f1,
           ROUND(threshold, 6) AS threshold, ROUND(calls / total, 6) AS predicted_fraud_rate
    FROM summary
)"""

WATCHED = """
watch_list AS (SELECT DISTINCT user_id FROM tx WHERE MOD(user_id, 70) = 0),
watched AS (
    SELECT tx.*, w.user_id IS NOT NULL AS on_watch_list
    FROM tx LEFT JOIN watch_list w ON tx.user_id = w.user_id
),
patterned AS (
    SELECT *, CASE WHEN on_watch_list AND amount > 500 THEN 'account_takeover'
                   WHEN amount < 2.0 AND MOD(user_id, 1000) = 0 THEN 'card_testing'
                   WHEN merchant IN ('QuickCash', 'GlobalDigital', 'FastMoneyX') AND amount > 300
                   THEN 'merchant_collusion'
                   WHEN MOD(user_id, 500) = 0 THEN 'geo_anomaly' ELSE 'none' END AS pattern
    FROM watched
)"""

DECIDED = f"""
featured AS (
    SELECT transaction_id, user_id, currency, merchant, "timestamp", is_fraud, {ALL_FEATURES} FROM tx
),
decided AS (
    SELECT *, CAST(200 * merchant_risk + 300 * amount_over_500 + 150 * is_night + 100 * is_weekend
                   + 50 * user_id_divisible_500 + 5 * transaction_hour AS DOUBLE) / 1000 AS fraud_probability
    FROM featured
),
predicted AS (
    SELECT *, CASE WHEN fraud_probability >= 0.5 THEN 1 ELSE 0 END AS prediction FROM decided
)"""

# The learnable label, its training weight, and the sums of all numeric inputs per part.
TRAINING = f"""
learnable AS (
    SELECT transaction_id, user_id, amount, merchant, "timestamp", location, split,
           CASE WHEN (merchant IN ('QuickCash', 'GlobalDigital', 'FastMoneyX') AND amount > 300) <> (('0x' || SUBSTR(MD5('noise:' || transaction_id), 1, 8))::BIGINT % 10000 < 150)
                THEN 1 ELSE 0 END AS is_fraud
    FROM parted
),
inputs AS (
    SELECT split, is_fraud, {ALL_FEATURES.replace("ROUND(LN(1 + GREATEST(amount, 0)), 6)", "LN(1 + GREATEST(amount, 0))")}
    FROM learnable
),
known AS (SELECT DISTINCT location FROM inputs WHERE split = 'train'),
weighing AS (
    SELECT COUNT(*) FILTER (WHERE is_fraud = 0) / CAST(COUNT(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) AS w
    FROM inputs WHERE split = 'train'
)"""

# Gradients and hessians at even odds by node, feature and bin, and the sums on both sides of every split.
BINNED = """
cells AS (
    SELECT CAST(is_weekend AS INT) AS node, f.feature, f.bin,
           CASE WHEN is_fraud = 1 THEN w ELSE 1.0 END * (0.5 - is_fraud) AS g, CASE WHEN is_fraud = 1 THEN w ELSE 1.0 END * 0.25 AS h
    FROM weighing, inputs, LATERAL (VALUES
        (0, CAST(LEAST(FLOOR(amount / 25), 63) AS INT)), (1, CAST(transaction_hour AS INT)),
        (2, CAST(merchant_risk AS INT)), (3, CAST(FLOOR(user_id_mod_500 / 10) AS INT))) f(feature, bin)
    WHERE split = 'train'
),
summed AS (SELECT node, feature, bin, SUM(g) AS g, SUM(h) AS h FROM cells GROUP BY ALL),
sides AS (
    SELECT node, feature, bin, SUM(g) OVER upto AS gl, SUM(h) OVER upto AS hl, SUM(g) OVER beyond AS gr, SUM(h) OVER beyond AS hr
    FROM summed
    WINDOW upto AS (PARTITION BY node, feature ORDER BY bin),
           beyond AS (PARTITION BY node, feature ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
)"""

SPLIT_GAINS = """
SELECT node, feature, bin, ROUND(gl, 6) AS gl, ROUND(hl, 6) AS hl, ROUND(gr, 6) AS gr, ROUND(hr, 6) AS hr,
       ROUND(POWER(GREATEST(ABS(gl) - 0.5, 0), 2) / (hl + 2) + POWER(GREATEST(ABS(gr) - 0.5, 0), 2) / (hr + 2)
             - POWER(GREATEST(ABS(gl + gr) - 0.5, 0), 2) / (hl + hr + 2), 6) AS gain
FROM sides WHERE hl >= 3 AND hr >= 3"""

# The upper tail of the chi-square distribution with three degrees of freedom, by the series of its logarithms.
PATTERN_FIT = """
, mix(pattern, share) AS (
    VALUES ('account_takeover', 0.4), ('card_testing', 0.3), ('merchant_collusion', 0.2), ('geo_anomaly', 0.1)
),
fitted AS (
    SELECT mix.pattern, COUNT(patterned.pattern) AS n, CAST(share AS DOUBLE) * SUM(COUNT(patterned.pattern)) OVER () AS expected
    FROM mix LEFT JOIN patterned USING (pattern) GROUP BY mix.pattern, share
),
whole AS (SELECT SUM(POWER(n - expected, 2) / expected) AS x FROM fitted WHERE expected > 0)
SELECT pattern, n, ROUND(expected, 4) AS expected, ROUND((n - expected) / SQRT(expected), 4) AS residual, ROUND(x, 4) AS statistic,
       ROUND(CASE WHEN x >= 1000 THEN 0 ELSE 1 - (SELECT SUM(EXP((1.5 + k) * LN(x / 2) - x / 2 - LGAMMA(2.5 + k))) FROM range(1500) r(k)) END, 4) AS p_value
FROM fitted, whole"""


ALERTS = """
SELECT transaction_id AS "key", transaction_id, user_id, amount, merchant, location, is_fraud,
       transaction_hour, amount_log, ROUND(fraud_probability, 6) AS fraud_probability, prediction
FROM predicted WHERE prediction = 1"""

BOUNDED = "SELECT event_id, ts, user_id, event_type, ROUND(value, 6) AS value FROM events"

TYPED_FIELDS = f"SELECT {FIELDS} FROM"

MESSAGE_FEATURES = f"SELECT transaction_id, {ALL_FEATURES}, is_fraud FROM clean"

REJECTED = """
SELECT raw_transaction_id AS transaction_id, raw_user_id AS user_id, raw_amount AS amount, raw_currency AS currency,
       raw_merchant AS merchant, raw_timestamp AS "timestamp", raw_location AS location, raw_is_fraud AS is_fraud, reason
FROM reasoned WHERE reason IS NOT NULL"""


def _with(select: str, *parts: str) -> str:
    return "WITH " + ",".join([TX, *parts]) + "\n" + select.strip()


def oracles() -> dict[str, str]:
    rules = ["transaction_id", "user_id", "amount", "currency", "timestamp", "location", "is_fraud"]
    names = ", ".join(f"CASE WHEN b{i} THEN '{rule}' END" for i, rule in enumerate(rules, start=1))
    counts = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, COUNT(*) FILTER (WHERE b{i}) AS n FROM broken" for i, rule in enumerate(rules, start=1)
    )
    raw_names = ", ".join(f'raw_{name} AS "{name}"' for name in FIELDS.replace('"', "").split(", "))
    return {
        "bounded_read_cap": f"{BOUNDED} ORDER BY ts, event_id LIMIT 1000",
        "bounded_read_newest": f"{BOUNDED} ORDER BY ts DESC, event_id DESC LIMIT 1000",
        "bounded_read_ties": TIES,
        "stream_until_idle": (
            "SELECT date_trunc('hour', ts) AS hour, event_type, COUNT(*) AS n, ROUND(SUM(value), 6) AS value, 'idle' AS stopped_by "
            "FROM events GROUP BY ALL"
        ),
        "stream_until_rows": (
            "SELECT n, n AS distinct_events, n AS known, 'rows' AS stopped_by FROM (SELECT GREATEST(1, COUNT(*) // 4) AS n FROM events)"
        ),
        "decode_whitespace": _with(f"SELECT {FIELDS}, bad_json FROM raw", RAW),
        "decode_json": _with(f"SELECT {FIELDS}, bad_json FROM raw", RAW),
        "coerce_types": _with(f"{TYPED_FIELDS} typed", RAW),
        "clean_rows": _with(f"{TYPED_FIELDS} clean", RAW),
        "rejected_rows": _with(REJECTED, RAW),
        "reject_reasons": _with("SELECT reason, COUNT(*) AS n FROM reasoned WHERE reason IS NOT NULL GROUP BY reason", RAW),
        "validate_rules": _with(
            f"SELECT {raw_names}, CONCAT_WS(',', {names}) AS violations, "
            "NOT (b1 OR b2 OR b3 OR b4 OR b5 OR b6 OR b7) AS valid FROM broken",
            RAW,
            CHECKED,
        ),
        "validate_types": _with(
            "SELECT transaction_id AS id, CASE CAST(transaction_id AS BIGINT) % 5 WHEN 1 THEN 'transaction_id' "
            "WHEN 2 THEN 'user_id' WHEN 3 THEN 'is_fraud' WHEN 4 THEN 'merchant' ELSE '' END AS type_violations FROM tx"
        ),
        "violation_counts": _with(counts, RAW, CHECKED),
        "time_features": _with(f"SELECT transaction_id, {TIME_FEATURES} FROM tx"),
        "amount_features": _with(f"SELECT transaction_id, amount, {AMOUNT_FEATURES} FROM tx"),
        "user_features": _with(f"SELECT transaction_id, {USER_FEATURES} FROM tx"),
        "merchant_location_features": _with(f"SELECT transaction_id, {PLACE_FEATURES} FROM tx"),
        "feature_table": _with(f"SELECT {ALL_FEATURES}, is_fraud FROM tx"),
        "message_feature_table": _with(MESSAGE_FEATURES, RAW),
        "rule_account_takeover": _with(
            "SELECT transaction_id, user_id, CASE WHEN on_watch_list AND amount > 500 THEN 1 ELSE 0 END "
            "AS rule_account_takeover FROM watched",
            WATCHED,
        ),
        "watch_list_spread": _with("SELECT transaction_id, user_id, on_watch_list FROM watched", WATCHED),
        "rule_card_testing": _with(
            "SELECT transaction_id, amount, CASE WHEN amount < 2.0 AND MOD(user_id, 1000) = 0 THEN 1 ELSE 0 END "
            "AS rule_card_testing FROM tx"
        ),
        "rule_merchant_collusion": _with(
            "SELECT transaction_id, merchant, CASE WHEN merchant IN ('QuickCash', 'GlobalDigital', 'FastMoneyX') "
            "AND amount > 300 THEN 1 ELSE 0 END AS rule_merchant_collusion FROM tx"
        ),
        "rule_geo_anomaly": _with(
            "SELECT transaction_id, user_id, CASE WHEN MOD(user_id, 500) = 0 THEN 1 ELSE 0 END AS rule_geo_anomaly, "
            "CASE WHEN UPPER(location) IN ('CN', 'RU', 'NG') THEN 1 ELSE 0 END AS high_risk_location FROM tx"
        ),
        "fraud_pattern": _with("SELECT transaction_id, pattern FROM patterned", WATCHED),
        "pattern_summary": _with(
            "SELECT pattern, COUNT(*) AS n, ROUND(COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 6) AS share, "
            "CAST(SUM(is_fraud) AS BIGINT) AS n_fraud, ROUND(AVG(is_fraud), 6) AS fraud_rate "
            "FROM patterned GROUP BY pattern",
            WATCHED,
        ),
        "pattern_fit": _with(PATTERN_FIT, WATCHED),
        "fraud_rate": _with("SELECT COUNT(*) AS n, ROUND(AVG(is_fraud), 6) AS fraud_rate FROM tx"),
        "class_balance": _with(
            "SELECT COUNT(*) FILTER (WHERE is_fraud = 1) AS positive, COUNT(*) FILTER (WHERE is_fraud = 0) AS negative, "
            "ROUND(AVG(is_fraud), 6) AS fraud_rate FROM tx"
        ),
        "class_weight": _with(
            "SELECT COUNT(*) FILTER (WHERE is_fraud = 1) AS positive, COUNT(*) FILTER (WHERE is_fraud = 0) AS negative, "
            "ROUND(COUNT(*) FILTER (WHERE is_fraud = 0) / CAST(GREATEST(COUNT(*) FILTER (WHERE is_fraud = 1), 1) AS DOUBLE), 6)"
            " AS positive_weight FROM parted WHERE split = 'train'",
            BUCKETED,
        ),
        "stratified_split": _with("SELECT transaction_id, is_fraud, split FROM parted", BUCKETED),
        "exact_split": _with(
            "SELECT transaction_id, p.is_fraud, CASE WHEN place <= test_n THEN 'test' "
            "WHEN place <= test_n + validation_n THEN 'validation' ELSE 'train' END AS split "
            "FROM placed p JOIN validated v ON p.is_fraud = v.is_fraud",
            EXACT_SPLIT,
        ),
        "split_without_id": _with(
            "SELECT 'hashed' AS kind, split, fold, is_fraud, COUNT(*) AS n FROM named GROUP BY ALL UNION ALL "
            "SELECT 'exact' AS kind, CASE WHEN place <= test_n THEN 'test' WHEN place <= test_n + validation_n "
            "THEN 'validation' ELSE 'train' END AS split, -1 AS fold, p.is_fraud, COUNT(*) AS n "
            "FROM placed p JOIN validated v ON p.is_fraud = v.is_fraud GROUP BY ALL",
            EXACT_SPLIT,
            NAMED,
        ),
        "stratified_folds": _with(
            "SELECT transaction_id, is_fraud, CAST(CASE WHEN place <= more * (each + 1) THEN (place - 1) // (each + 1) "
            "ELSE more + (place - 1 - more * (each + 1)) // each END AS INTEGER) AS fold FROM ("
            "SELECT transaction_id, is_fraud, ROW_NUMBER() OVER (PARTITION BY is_fraud ORDER BY MD5('fold:42:' || transaction_id)) AS place, "
            "COUNT(*) OVER (PARTITION BY is_fraud) // 3 AS each, COUNT(*) OVER (PARTITION BY is_fraud) % 3 AS more FROM tx)"
        ),
        "split_counts": _with("SELECT split, is_fraud, COUNT(*) AS n FROM parted GROUP BY split, is_fraud", BUCKETED),
        "fold_assignment": _with(
            "SELECT transaction_id, CAST((('0x' || SUBSTR(MD5('fold:' || transaction_id), 1, 8))::BIGINT % 10000) % 3 "
            "AS INTEGER) AS fold FROM tx"
        ),
        "location_vocab": _with("SELECT UPPER(location) AS location, COUNT(*) AS n FROM tx GROUP BY UPPER(location)"),
        "location_onehot": _with(
            "SELECT transaction_id, t.location, (SELECT CAST(COUNT(*) AS INTEGER) FROM known) AS slots, "
            "known.slot FROM parted t LEFT JOIN known ON t.location = known.location",
            BUCKETED,
            "known AS (SELECT location, CAST(ROW_NUMBER() OVER (ORDER BY location) - 1 AS INTEGER) AS slot "
            "FROM (SELECT DISTINCT location FROM parted WHERE split = 'train'))",
        ),
        "ranked_cumulative": _with("SELECT * FROM ranked", BUCKETED, SCORED, RANKED),
        "pr_curve": _with(
            'SELECT ROUND(score, 6) AS threshold, ROUND(tp / CAST(pp AS DOUBLE), 6) AS "precision", '
            "ROUND(tp / CAST(positives AS DOUBLE), 6) AS recall, tp, pp FROM ranked "
            "UNION ALL SELECT NULL, 1.0, 0.0, 0, 0",
            BUCKETED,
            SCORED,
            RANKED,
        ),
        "roc_curve": _with(
            "SELECT ROUND(score, 6) AS threshold, ROUND((pp - tp) / CAST(total - positives AS DOUBLE), 6) AS fpr, "
            "ROUND(tp / CAST(positives AS DOUBLE), 6) AS tpr FROM ranked UNION ALL SELECT NULL, 0.0, 0.0",
            BUCKETED,
            SCORED,
            RANKED,
        ),
        "best_threshold": _with(
            "SELECT ROUND(score, 6) AS threshold, ROUND(f1, 6) AS f1 FROM (SELECT score, "
            "2 * (tp / CAST(pp AS DOUBLE)) * (tp / CAST(positives AS DOUBLE)) / (tp / CAST(pp AS DOUBLE) "
            "+ tp / CAST(positives AS DOUBLE) + 1e-12) AS f1 FROM ranked) ORDER BY f1 DESC, score LIMIT 1",
            BUCKETED,
            SCORED,
            RANKED,
        ),
        "average_precision": _with(
            "SELECT ROUND(SUM(pos / CAST(positives AS DOUBLE) * tp / pp), 6) AS average_precision FROM ranked",
            BUCKETED,
            SCORED,
            RANKED,
        ),
        "roc_auc": _with(
            "SELECT ROUND(SUM((n - pos) / CAST(total - positives AS DOUBLE) * (tp - pos + pos / 2.0) / positives), 6) "
            "AS roc_auc FROM ranked",
            BUCKETED,
            SCORED,
            RANKED,
        ),
        "confusion_matrix": _with(
            "SELECT actual, predicted, COUNT(scored.p) AS n FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(actual, predicted) "
            "LEFT JOIN scored ON is_fraud = actual AND CAST(p >= 0.5 AS INTEGER) = predicted GROUP BY actual, predicted",
            BUCKETED,
            SCORED,
        ),
        "threshold_metrics": _with(
            'SELECT ROUND(COALESCE(tp / NULLIF(calls, 0), 0), 6) AS "precision", ROUND(COALESCE(tp / NULLIF(pos, 0), 0), 6) '
            "AS recall, ROUND(COALESCE(2 * tp / NULLIF(calls + pos, 0), 0), 6) AS f1, ROUND(calls / n, 6) AS predicted_fraud_rate "
            "FROM (SELECT CAST(COUNT(*) FILTER (WHERE p >= 0.5 AND is_fraud = 1) AS DOUBLE) AS tp, "
            "CAST(COUNT(*) FILTER (WHERE p >= 0.5) AS DOUBLE) AS calls, "
            "CAST(SUM(is_fraud) AS DOUBLE) AS pos, CAST(COUNT(*) AS DOUBLE) AS n FROM scored)",
            BUCKETED,
            SCORED,
        ),
        "evaluation_summary": _with("SELECT * FROM evaluation", BUCKETED, SCORED, RANKED_PARTS),
        "apply_threshold": _with(
            "SELECT transaction_id, ROUND(fraud_probability, 6) AS fraud_probability, prediction FROM predicted", DECIDED
        ),
        "fraud_only": _with(
            "SELECT transaction_id, user_id, amount, ROUND(fraud_probability, 6) AS fraud_probability "
            "FROM predicted WHERE prediction = 1",
            DECIDED,
        ),
        "fraud_messages": _with(ALERTS, DECIDED),
        "udf_score": _with(
            "SELECT transaction_id, ROUND(fraud_probability, 6) AS fraud_probability, prediction "
            "FROM predicted WHERE prediction = 1",
            DECIDED,
        ),
        "stream_decode": _with(f"{TYPED_FIELDS} typed", RAW),
        "stream_features": _with(MESSAGE_FEATURES, RAW),
        "stream_score_files": _with(ALERTS, DECIDED),
        "stream_rejects": _with(REJECTED, RAW),
        "stream_delivery_alerts": _with(ALERTS, DECIDED),
        "stream_delivery_rejects": _with(
            REJECTED.replace("\nFROM reasoned", ", COUNT(*) OVER () AS unusable, (SELECT COUNT(*) FROM reasoned) AS messages FROM reasoned"), RAW
        ),
        "training_table": _with(
            "SELECT split, COUNT(*) AS n, CAST(SUM(is_fraud) AS BIGINT) AS positives, "
            "ROUND(SUM(CASE WHEN is_fraud = 1 THEN w ELSE 1.0 END), 3) AS weight, "
            "ROUND(CAST(COUNT(known.location) AS DOUBLE), 3) AS located, "
            + ", ".join(f"ROUND(SUM(CAST({name} AS DOUBLE)), 3) AS {name}" for name in NUMERIC_FEATURES)
            + " FROM weighing, inputs LEFT JOIN known ON inputs.location = known.location GROUP BY split",
            BUCKETED,
            TRAINING,
        ),
        "boost_split_gains": _with(SPLIT_GAINS, BUCKETED, TRAINING, BINNED),
        "boosted_parity": _with("SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS mismatches FROM inputs WHERE split = 'train'", BUCKETED, TRAINING),
        "stream_batch_parity": _with("SELECT COUNT(*) AS streamed, CAST(0 AS BIGINT) AS mismatches FROM tx"),
        "stream_progress": _with(
            "SELECT (SELECT COUNT(*) FROM events) AS input_rows, COUNT(*) AS messages, COUNT(reason) AS unusable FROM reasoned",
            RAW,
        ),
        "run_log": _with(
            "SELECT 'fixed-score' AS run_id, 'param' AS kind, split || '_samples' AS name, CAST(COUNT(*) AS DOUBLE) AS value "
            "FROM parted GROUP BY split UNION ALL "
            "SELECT 'fixed-score', 'metric', name, value FROM evaluation UNPIVOT (value FOR name IN "
            '(roc_auc, auc_pr, "precision", recall, f1, threshold, predicted_fraud_rate)) '
            "UNION ALL SELECT 'fixed-score', 'model', 'fraud_model/1', NULL",
            BUCKETED,
            SCORED,
            RANKED_PARTS,
        ),
    }
