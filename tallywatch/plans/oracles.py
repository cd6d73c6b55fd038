"""Independent SQL for the registered queries, over views named like the provided tables.

The texts state what a result must be, not how the engine gets there: trailing windows are plain
self-joins, logs and streams are left out, and rounding and units follow ``functions.numbers``.
"""

from __future__ import annotations

from tallywatch.plans.gold import GOLD_VALUES
from tallywatch.plans.views import VIEW_VALUES

# Common tables in dependency order; a query gets every one up to the last it needs.
_CTES: dict[str, str] = {
    "raw_tx": """
SELECT event_id AS log_offset, concat('ing-', event_id) AS ingestion_id,
  CASE WHEN event_id % 307 = 0 THEN NULL ELSE event_id END AS transaction_id,
  CAST(date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) AS BIGINT) AS transaction_dt,
  CASE WHEN event_id % 401 = 0 THEN NULL WHEN event_id % 199 = 0 THEN CAST(0 AS DOUBLE)
       WHEN event_id % 211 = 0 THEN CAST(-5 AS DOUBLE)
       ELSE CAST(CAST(value AS DECIMAL(10,2)) * 4 AS DOUBLE) END AS transaction_amt,
  CASE WHEN event_id % 223 = 0 THEN 'X' WHEN event_id % 227 = 0 THEN NULL
       WHEN event_type = 'view' THEN 'W' WHEN event_type = 'click' THEN 'C'
       WHEN event_type = 'signup' THEN 'S' WHEN event_type = 'purchase' THEN 'R' ELSE 'H' END AS product_cd,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(1000 + user_id AS DOUBLE) END AS card1,
  CASE user_id % 3 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' ELSE NULL END AS card4,
  CASE user_id % 2 WHEN 0 THEN 'credit' ELSE 'debit' END AS card6,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(100 + user_id % 50 AS DOUBLE) END AS addr1,
  CASE user_id % 8 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com' WHEN 2 THEN 'anonymous.com'
       WHEN 3 THEN 'hotmail.com' WHEN 4 THEN 'protonmail.com' WHEN 5 THEN ' Outlook.COM '
       WHEN 6 THEN '' ELSE NULL END AS p_emaildomain,
  CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) * 30 AS DOUBLE) AS c13,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 5 - 2 AS DOUBLE) END AS v258,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 7 - 2 AS DOUBLE) END AS v257,
  CASE event_id % 4 WHEN 0 THEN 'T' WHEN 1 THEN 'F' WHEN 2 THEN 't' ELSE NULL END AS m1,
  CASE event_id % 4 WHEN 0 THEN 'M0' WHEN 1 THEN 'M1' WHEN 2 THEN 'M2' ELSE NULL END AS m4,
  CASE WHEN event_id % 6 = 0 THEN CAST(event_id % 10 AS DOUBLE) ELSE NULL END AS id_01,
  CASE WHEN event_id % 53 = 0 THEN NULL
       WHEN CAST(regexp_extract(props, '[0-9]+', 0) AS INT) >= 96 THEN 1 ELSE 0 END AS is_fraud
FROM events""",
    "checked": """
SELECT *, CASE WHEN transaction_id IS NULL THEN 'null_transaction_id'
  WHEN transaction_amt IS NULL THEN 'invalid_amount:None'
  WHEN transaction_amt <= 0 THEN concat('invalid_amount:', CAST(transaction_amt AS VARCHAR))
  WHEN product_cd IS NULL THEN 'invalid_product:None'
  WHEN product_cd NOT IN ('W','H','C','S','R') THEN concat('invalid_product:', product_cd) END AS reject_reason,
  log_offset % 41 = 0 OR log_offset % 43 = 0 OR log_offset % 47 = 0 OR log_offset % 59 = 0 AS broken
FROM raw_tx""",
    "accepted": "SELECT * FROM checked WHERE reject_reason IS NULL",
    "valid_tx": """
SELECT *, TIMESTAMP '2017-11-30' + to_seconds(transaction_dt) AS event_ts,
  CAST(TIMESTAMP '2017-11-30' + to_seconds(transaction_dt) AS DATE) AS transaction_date,
  CAST(extract(hour FROM TIMESTAMP '2017-11-30' + to_seconds(transaction_dt)) AS INTEGER) AS transaction_hour,
  CASE WHEN card1 IS NULL OR addr1 IS NULL THEN NULL
       ELSE concat(CAST(CAST(card1 AS BIGINT) AS VARCHAR), '_', CAST(CAST(addr1 AS BIGINT) AS VARCHAR)) END AS uid,
  CAST(round(transaction_amt * 10000.0) AS BIGINT) AS units
FROM accepted""",
    "history": """
SELECT a.log_offset,
  coalesce(sum(b.units) FILTER (WHERE b.transaction_dt >= a.transaction_dt - 60), 0) AS u1,
  coalesce(sum(b.units) FILTER (WHERE b.transaction_dt >= a.transaction_dt - 300), 0) AS u5,
  coalesce(sum(b.units) FILTER (WHERE b.transaction_dt >= a.transaction_dt - 3600), 0) AS u60,
  coalesce(sum(b.units), 0) AS u1440,
  count(b.units) FILTER (WHERE b.transaction_dt >= a.transaction_dt - 3600) AS n60,
  count(b.units) AS n1440
FROM valid_tx a LEFT JOIN valid_tx b ON a.uid = b.uid AND b.transaction_dt >= a.transaction_dt - 86400
  AND (b.transaction_dt < a.transaction_dt
       OR (b.transaction_dt = a.transaction_dt AND b.transaction_id < a.transaction_id))
GROUP BY a.log_offset""",
    "velocity": """
SELECT v.*,
  CASE WHEN uid IS NULL THEN NULL ELSE floor((u1 + 50) / 100.0) / 100.0 END AS spend_1min,
  CASE WHEN uid IS NULL THEN NULL ELSE floor((u5 + 50) / 100.0) / 100.0 END AS spend_5min,
  CASE WHEN uid IS NULL THEN NULL ELSE floor((u60 + 50) / 100.0) / 100.0 END AS spend_1hr,
  CASE WHEN uid IS NULL THEN NULL ELSE floor((u1440 + 50) / 100.0) / 100.0 END AS spend_24hr,
  CASE WHEN uid IS NULL THEN NULL ELSE CAST(n60 AS INTEGER) END AS txn_count_1hr,
  CASE WHEN uid IS NULL THEN NULL ELSE CAST(n1440 AS INTEGER) END AS txn_count_24hr
FROM valid_tx v JOIN history h ON v.log_offset = h.log_offset""",
    "dim_product": """
SELECT * FROM (VALUES ('W','LOW'),('C','HIGH'),('H','HIGH'),('S','MEDIUM')) AS t(code, tier)""",
    "dim_email": """
SELECT * FROM (VALUES ('gmail.com',false,10.0::DOUBLE),('yahoo.com',false,25.0),('anonymous.com',true,80.0),
  ('protonmail.com',true,60.0),('outlook.com',false,15.0)) AS t(domain, anonymous, risk)""",
    "dim_hour": """
SELECT CAST(h AS INTEGER) AS hod, CASE WHEN h <= 5 THEN 'HIGH' WHEN h <= 9 OR h >= 22 THEN 'MEDIUM' ELSE 'LOW' END AS lvl,
  CAST(CASE WHEN h <= 5 THEN 80 WHEN h <= 9 OR h >= 22 THEN 40 ELSE 10 END AS DOUBLE) AS risk
FROM range(24) AS t(h) WHERE h <> 12""",
    "enriched": """
SELECT v.*, coalesce(spend_24hr > 0 AND spend_1hr > 3.0 * (spend_24hr / 24.0), false) AS velocity_flag,
  p.tier AS product_risk_tier, e.risk AS p_email_risk_score, e.anonymous AS p_email_is_anonymous,
  h.lvl AS hour_risk_level, h.risk AS hour_risk_score, trim(lower(coalesce(p_emaildomain, ''))) AS domain_text
FROM velocity v LEFT JOIN dim_product p ON v.product_cd = p.code
LEFT JOIN dim_email e ON trim(lower(coalesce(p_emaildomain, ''))) = e.domain
LEFT JOIN dim_hour h ON v.transaction_hour = h.hod""",
    "points": """
SELECT *,
  CAST(CASE WHEN transaction_amt > 500 AND coalesce(txn_count_1hr, 0) <= 1
              THEN least(CAST(100 AS DOUBLE), (transaction_amt / CAST(500 AS DOUBLE)) * CAST(60 AS DOUBLE))
            WHEN transaction_amt > 200 AND coalesce(txn_count_1hr, 0) <= 2 THEN 30 ELSE 0 END AS DOUBLE) AS s1,
  CAST(CASE WHEN coalesce(p_email_is_anonymous, false) AND transaction_amt > 100
              THEN least(CAST(100 AS DOUBLE),
                         coalesce(p_email_risk_score, 0) + (transaction_amt / CAST(100 AS DOUBLE)) * CAST(10 AS DOUBLE))
            WHEN coalesce(p_email_is_anonymous, false) THEN coalesce(p_email_risk_score, 0) ELSE 0 END AS DOUBLE) AS s2,
  CAST(CASE product_cd WHEN 'H' THEN 75 WHEN 'C' THEN 60 ELSE 0 END AS DOUBLE) AS s3,
  CAST(CASE WHEN velocity_flag
            THEN least(CAST(100 AS DOUBLE), (spend_1hr / (spend_24hr / CAST(24 AS DOUBLE))) * CAST(25 AS DOUBLE))
            ELSE 0 END AS DOUBLE) AS s4,
  CAST(CASE WHEN coalesce(hour_risk_level, 'LOW') <> 'HIGH' THEN 0
            WHEN coalesce(p_email_is_anonymous, false) THEN 80
            WHEN domain_text <> '' AND domain_text NOT IN ('gmail.com','hotmail.com','outlook.com','icloud.com','live.com',
              'msn.com','comcast.net','att.net','verizon.net','me.com') THEN 80 ELSE 40 END AS DOUBLE) AS s5,
  CAST(0 AS DOUBLE) AS s6,
  CAST(CASE WHEN c13 > 2500 THEN 100 WHEN c13 > 1500 THEN 60 WHEN c13 > 500 THEN 25 ELSE 0 END AS DOUBLE) AS s7,
  CAST(CASE WHEN coalesce(v258, 0) > 0 AND coalesce(v257, 0) > 0
              THEN least(CAST(100 AS DOUBLE), (v258 + v257) * CAST(10 AS DOUBLE))
            WHEN coalesce(v258, 0) > 0 OR coalesce(v257, 0) > 0 THEN 30 ELSE 0 END AS DOUBLE) AS s8
FROM enriched""",
    "scored": """
SELECT *, floor(least(CAST(100 AS DOUBLE), greatest(CAST(0 AS DOUBLE),
    s1 * CAST(0.2 AS DOUBLE) + s2 * CAST(0.15 AS DOUBLE) + s3 * CAST(0.15 AS DOUBLE) + s4 * CAST(0.2 AS DOUBLE)
    + s5 * CAST(0.1 AS DOUBLE) + s6 * CAST(0.05 AS DOUBLE) + s7 * CAST(0.1 AS DOUBLE) + s8 * CAST(0.05 AS DOUBLE)
  )) * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE) AS fraud_score,
  floor(s1 * 100 + 0.5) / 100 AS r1, floor(s2 * 100 + 0.5) / 100 AS r2, s3 AS r3, floor(s4 * 100 + 0.5) / 100 AS r4,
  s5 AS r5, s6 AS r6, s7 AS r7, floor(s8 * 100 + 0.5) / 100 AS r8,
  concat_ws(',', CASE WHEN s1 > 0 THEN 'rule_high_amount_new_uid' END, CASE WHEN s2 > 0 THEN 'rule_anonymous_email_amount' END,
    CASE WHEN s3 > 0 THEN 'rule_product_h_cnp' END, CASE WHEN s4 > 0 THEN 'rule_velocity_breach' END,
    CASE WHEN s5 > 0 THEN 'rule_night_foreign_email' END, CASE WHEN s7 > 0 THEN 'rule_c13_spike' END,
    CASE WHEN s8 > 0 THEN 'rule_v258_v257_threshold' END) AS rules_triggered,
  CASE WHEN s1 > 0 THEN 1 ELSE 0 END + CASE WHEN s2 > 0 THEN 1 ELSE 0 END + CASE WHEN s3 > 0 THEN 1 ELSE 0 END
    + CASE WHEN s4 > 0 THEN 1 ELSE 0 END + CASE WHEN s5 > 0 THEN 1 ELSE 0 END + CASE WHEN s7 > 0 THEN 1 ELSE 0 END
    + CASE WHEN s8 > 0 THEN 1 ELSE 0 END AS rule_count
FROM points""",
    "decided": """
SELECT *, CASE WHEN fraud_score < 35 THEN 'APPROVE' WHEN fraud_score < 65 THEN 'REVIEW' ELSE 'BLOCK' END AS decision,
  CASE WHEN fraud_score < 35 THEN 'Low fraud score' WHEN fraud_score < 65 THEN 'Medium fraud risk'
       ELSE 'High fraud risk' END AS decision_reason,
  floor(least(CAST(1 AS DOUBLE), greatest(CAST(0.5 AS DOUBLE), fraud_score / CAST(100 AS DOUBLE))) * 100 + 0.5) / 100
    AS confidence
FROM scored""",
    "daily": """
SELECT transaction_date AS summary_date, count(*) AS total_transactions, CAST(sum(units) AS DOUBLE) / 10000.0 AS total_amount,
  count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
  CAST(sum(units) FILTER (WHERE is_fraud = 1) AS DOUBLE) / 10000.0 AS fraud_amount,
  CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS fraud_rate,
  CAST(sum(units) FILTER (WHERE is_fraud = 1) AS DOUBLE) / 10000.0 / nullif(count(*) FILTER (WHERE is_fraud = 1), 0)
    AS avg_fraud_amount,
  max(transaction_amt) FILTER (WHERE is_fraud = 1) AS max_fraud_amount,
  count(*) FILTER (WHERE decision = 'BLOCK') AS blocked_count,
  CAST(sum(units) FILTER (WHERE decision = 'BLOCK') AS DOUBLE) / 10000.0 AS blocked_amount
FROM decided GROUP BY transaction_date""",
    "profile": """
SELECT uid, CAST(split_part(uid, '_', 1) AS DOUBLE) AS card1, CAST(split_part(uid, '_', 2) AS DOUBLE) AS addr1,
  count(*) AS total_transactions, CAST(sum(units) AS DOUBLE) / 10000.0 AS total_amount,
  count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
  CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS fraud_rate,
  CAST(sum(units) AS DOUBLE) / 10000.0 / count(*) AS avg_amount, max(transaction_amt) AS max_amount,
  count(DISTINCT product_cd) AS distinct_merchants, count(DISTINCT p_emaildomain) AS distinct_emails,
  max(event_ts) AS last_seen,
  CASE WHEN sum(CAST(round(fraud_score * 100) AS BIGINT)) / 100.0 / count(*) >= 65 THEN 'HIGH'
       WHEN sum(CAST(round(fraud_score * 100) AS BIGINT)) / 100.0 / count(*) >= 35 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
FROM decided WHERE uid IS NOT NULL GROUP BY uid""",
    "tiers": """
SELECT risk_tier, count(*) AS uid_count,
  CAST(sum(CAST(round(fraud_rate * 1000000000.0) AS BIGINT)) AS DOUBLE) / 1000000000.0 / count(fraud_rate) AS avg_fraud_rate
FROM profile GROUP BY risk_tier""",
    "totals": """
SELECT CAST(sum(total_transactions) AS BIGINT) AS total_transactions, CAST(sum(fraud_count) AS BIGINT) AS fraud_count,
  CAST(sum(CAST(round(fraud_rate * 1000000000.0) AS BIGINT)) AS DOUBLE) / 1000000000.0 / count(fraud_rate) AS avg_fraud_rate,
  CAST(sum(blocked_count) AS BIGINT) AS blocked_count, count(DISTINCT summary_date) AS days_tracked
FROM daily""",
    "hourly": """
SELECT DATE '2024-02-01' AS summary_date, transaction_hour, count(*) AS total_transactions,
  count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
  CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS fraud_rate,
  CAST(sum(units) AS DOUBLE) / 10000.0 / count(*) AS avg_amount,
  CASE WHEN transaction_hour <= 5 THEN 'HIGH' WHEN transaction_hour <= 9 OR transaction_hour >= 22 THEN 'MEDIUM'
       ELSE 'LOW' END AS risk_level
FROM decided GROUP BY transaction_hour""",
    "product_days": """
SELECT transaction_date AS summary_date, product_cd AS productcd, count(*) AS total_transactions,
  CAST(sum(units) AS DOUBLE) / 10000.0 AS total_amount, count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
  CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS fraud_rate,
  CAST(sum(units) AS DOUBLE) / 10000.0 / count(*) AS avg_transaction_amt,
  CAST(sum(units) FILTER (WHERE is_fraud = 1) AS DOUBLE) / 10000.0 / nullif(count(*) FILTER (WHERE is_fraud = 1), 0)
    AS avg_fraud_amt
FROM decided GROUP BY transaction_date, product_cd""",
    "rule_rows": """
SELECT transaction_id, is_fraud, decision, units, fraud_score, rule_name, rule_score FROM (
  SELECT d.*, unnest(['high_amount','anonymous_email','product_h','velocity','night_tx','mismatch','c13_spike','v258_v257'])
    AS rule_name, unnest([r1, r2, r3, r4, r5, r6, r7, r8]) AS rule_score FROM decided d)""",
}


def _performance(score: str) -> str:
    tp = f"CAST(count(*) FILTER (WHERE {score} > 0 AND is_fraud = 1) AS DOUBLE)"
    precision = f"{tp} / nullif(count(*) FILTER (WHERE {score} > 0), 0)"
    recall = f"{tp} / nullif(count(*) FILTER (WHERE is_fraud = 1), 0)"
    return f"""
SELECT DATE '2024-02-01' AS summary_date, rule_name, 'scoring' AS rule_type,
  count(*) FILTER (WHERE {score} > 0) AS triggers_count,
  count(*) FILTER (WHERE {score} > 0 AND is_fraud = 1) AS true_positive,
  count(*) FILTER (WHERE {score} > 0 AND is_fraud = 0) AS false_positive,
  count(*) FILTER (WHERE {score} = 0 AND is_fraud = 0) AS true_negative,
  count(*) FILTER (WHERE {score} = 0 AND is_fraud = 1) AS false_negative,
  {precision} AS precision_score, {recall} AS recall_score,
  CAST(2 AS DOUBLE) * ({precision} * {recall}) / nullif({precision} + {recall}, 0) AS f1_score,
  CAST(sum(units) FILTER (WHERE {score} > 0 AND decision = 'BLOCK') AS DOUBLE) / 10000.0 AS blocked_amount
FROM rule_rows GROUP BY rule_name"""


_CTES["performance"] = _performance("fraud_score")
_CTES["performance_own"] = _performance("rule_score")
_CTES["metrics"] = """
SELECT 'fraud_daily_total_transactions' AS metric, '' AS labels, CAST(total_transactions AS DOUBLE) AS value
  FROM (SELECT * FROM daily ORDER BY summary_date DESC LIMIT 1)
UNION ALL SELECT 'fraud_daily_total_amount', '', coalesce(total_amount, 0) FROM (SELECT * FROM daily ORDER BY summary_date DESC LIMIT 1)
UNION ALL SELECT 'fraud_daily_fraud_count', '', fraud_count FROM (SELECT * FROM daily ORDER BY summary_date DESC LIMIT 1)
UNION ALL SELECT 'fraud_daily_fraud_rate', '', coalesce(fraud_rate, 0) FROM (SELECT * FROM daily ORDER BY summary_date DESC LIMIT 1)
UNION ALL SELECT 'fraud_daily_blocked_count', '', blocked_count FROM (SELECT * FROM daily ORDER BY summary_date DESC LIMIT 1)
UNION ALL SELECT 'fraud_daily_blocked_amount', '', coalesce(blocked_amount, 0)
  FROM (SELECT * FROM daily ORDER BY summary_date DESC LIMIT 1)
UNION ALL SELECT 'fraud_total_transactions_all', '', total_transactions FROM totals
UNION ALL SELECT 'fraud_total_fraud_count_all', '', fraud_count FROM totals
UNION ALL SELECT 'fraud_avg_fraud_rate_all', '', avg_fraud_rate FROM totals
UNION ALL SELECT 'fraud_total_blocked_all', '', blocked_count FROM totals
UNION ALL SELECT 'fraud_days_tracked', '', days_tracked FROM totals
UNION ALL SELECT 'fraud_product_transactions', concat('product=', productcd), total_transactions FROM product_days p
  WHERE summary_date = (SELECT max(summary_date) FROM product_days q WHERE q.productcd = p.productcd)
UNION ALL SELECT 'fraud_product_fraud_count', concat('product=', productcd), fraud_count FROM product_days p
  WHERE summary_date = (SELECT max(summary_date) FROM product_days q WHERE q.productcd = p.productcd)
UNION ALL SELECT 'fraud_product_fraud_rate', concat('product=', productcd), fraud_rate FROM product_days p
  WHERE summary_date = (SELECT max(summary_date) FROM product_days q WHERE q.productcd = p.productcd)
UNION ALL SELECT 'fraud_hourly_transactions', concat('hour=', transaction_hour, ',risk=', risk_level), total_transactions FROM hourly
UNION ALL SELECT 'fraud_hourly_fraud_rate', concat('hour=', transaction_hour, ',risk=', risk_level), fraud_rate FROM hourly
UNION ALL SELECT 'fraud_uid_risk_count', concat('tier=', risk_tier), uid_count FROM tiers
UNION ALL SELECT 'fraud_uid_avg_fraud_rate', concat('tier=', risk_tier), avg_fraud_rate FROM tiers
UNION ALL SELECT 'fraud_rule_triggers', concat('rule=', rule_name), triggers_count FROM performance
UNION ALL SELECT 'fraud_rule_true_positive', concat('rule=', rule_name), true_positive FROM performance
UNION ALL SELECT 'fraud_rule_false_positive', concat('rule=', rule_name), false_positive FROM performance
UNION ALL SELECT 'fraud_rule_precision', concat('rule=', rule_name), coalesce(precision_score, 0) FROM performance
UNION ALL SELECT 'fraud_silver_decisions_count', '', count(*) FROM decided
UNION ALL SELECT 'fraud_silver_transactions_count', '', count(*) FROM valid_tx"""


def _with(last: str | None, body: str) -> str:
    if last is None:
        return body.strip()
    names = list(_CTES)
    parts = [f"{n} AS ({_CTES[n].strip()})" for n in names[: names.index(last) + 1]]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


_DIRTY = """
SELECT c_custkey, CASE c_custkey % 12 WHEN 0 THEN '' WHEN 1 THEN ' null ' WHEN 2 THEN 'NaN' WHEN 3 THEN 'abc'
  WHEN 4 THEN '3.7' WHEN 5 THEN ' None' WHEN 6 THEN '-12' WHEN 7 THEN 'yes' WHEN 8 THEN ' TRUE '
  WHEN 9 THEN CAST(c_acctbal AS VARCHAR) WHEN 10 THEN c_mktsegment ELSE NULL END AS dirty FROM customer"""
_CLEAN = f"""
SELECT c_custkey, CASE WHEN lower(trim(dirty)) IN ('', 'null', 'none', 'nan') THEN NULL ELSE trim(dirty) END AS v
FROM ({_DIRTY})"""
# whole numbers are truncated towards zero, as through a float
_WHOLE = "CAST(trunc(TRY_CAST(v AS DOUBLE)) AS {})"
_FLAG = "CASE WHEN v IS NOT NULL THEN lower(v) IN ('true', '1', 'yes', 'y') END"

_VELOCITY = "spend_1min, spend_5min, spend_1hr, spend_24hr, txn_count_1hr, txn_count_24hr"


def _velocity_over(valid: str) -> str:
    """The velocity result with another version of ``valid_tx``."""
    parts = [f"{n} AS ({_CTES[n].strip()})" for n in ("raw_tx", "checked", "accepted")]
    parts.append(f"plain_tx AS ({_CTES['valid_tx'].strip()})")
    parts.append(f"valid_tx AS ({valid})")
    parts += [f"{n} AS ({_CTES[n].strip()})" for n in ("history", "velocity")]
    return "WITH " + ",\n".join(parts) + f"\nSELECT log_offset, uid, {_VELOCITY} FROM velocity"


_LOG = """
SELECT CASE WHEN event_id % 307 = 0 THEN 'unknown' ELSE CAST(event_id AS VARCHAR) END AS message_key,
  CAST(event_id % 6 AS INTEGER) AS log_partition, event_id AS log_offset,
  NOT (event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 47 = 0) AS is_framed FROM events"""

_SILVER = """
SELECT transaction_id AS transactionid, is_fraud AS isfraud, transaction_amt AS transactionamt, product_cd AS productcd, uid,
  transaction_date, transaction_hour"""

def _gold_values() -> str:
    """Every figure of the gold tables, one row each."""
    relations = {
        "daily_fraud_summary": "daily",
        "product_fraud_stats": "product_days",
        "hourly_fraud_pattern": "hourly",
        "rule_performance": "performance",
        "uid_risk_profile": "profile",
    }
    parts = []
    for name, relation in relations.items():
        keys, metrics = GOLD_VALUES[name]
        key = "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + ")"
        parts += [f"SELECT '{name}' AS table_name, {key} AS row_key, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {relation}" for m in metrics]
    return "\nUNION ALL ".join(parts)


_TICKS = "SELECT event_type AS symbol, value AS price, ts AS ingested_at, event_id AS seq FROM events"
def _signals_over(ticks: str) -> str:
    """Signals by sums of two-part floats, oldest price first: (h, l) is a sum and what its additions rounded away."""

    def total(terms: str) -> str:
        step = "struct_pack(h := a.h + b.h, l := a.l + ((a.h - ((a.h + b.h) - ((a.h + b.h) - a.h))) + (b.h - ((a.h + b.h) - a.h))))"
        return f"list_reduce(list_transform({terms}, lambda x: struct_pack(h := x, l := CAST(0 AS DOUBLE))), lambda a, b: {step})"

    return f"""
WITH windows AS (
  SELECT *, list(price) OVER w AS prices, count(*) OVER w AS n FROM ({ticks})
  WINDOW w AS (PARTITION BY symbol ORDER BY seq ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)),
sized AS (
  SELECT *, list_max(list_transform(prices, lambda x: abs(x))) AS largest,
    CASE WHEN largest >= pow(2.0, 500) THEN pow(2.0, -600) WHEN largest < pow(2.0, -400) AND largest > 0 THEN pow(2.0, 600) ELSE 1.0 END AS scale
  FROM windows WHERE n >= 10),
scaled AS (SELECT * REPLACE (list_transform(prices, lambda x: x * scale) AS prices) FROM sized),
summed AS (SELECT *, {total("prices")} AS s FROM scaled),
means AS (SELECT *, (s.h + s.l) / n AS mean FROM summed),
spreads AS (
  SELECT *, {total("list_transform(prices, lambda x: x - mean)")} AS d,
    {total("list_transform(prices, lambda x: (x - mean) * (x - mean))")} AS q FROM means),
signals AS (
  SELECT symbol, price, ingested_at, seq, mean / scale AS ma, CASE WHEN mean <> 0 THEN (price * scale - mean) / mean * 100.0 END AS deviation_pct,
    sqrt(greatest((q.h + q.l) - (d.h + d.l) * (d.h + d.l) / n, 0.0) / n) / scale AS volatility FROM spreads),
banded AS (SELECT *, CASE WHEN abs(deviation_pct) > 0.5 THEN 'CRITICAL' WHEN abs(deviation_pct) > 0.3 THEN 'ALERT'
  WHEN abs(deviation_pct) > 0.1 THEN 'WATCH' ELSE 'NORMAL' END AS severity FROM signals)
"""


_SIGNALS = _signals_over(_TICKS)

_FAULTY = f"""
SELECT CASE WHEN seq % 139 <> 0 THEN symbol END AS symbol, ingested_at, seq,
  CASE WHEN seq % 113 = 0 THEN NULL WHEN seq % 127 = 0 THEN CAST('nan' AS DOUBLE) WHEN seq % 131 = 0 THEN CAST('inf' AS DOUBLE)
       WHEN seq % 137 = 0 THEN CAST(1e15 AS DOUBLE) WHEN seq % 149 = 0 THEN CAST(4.2e-9 AS DOUBLE) WHEN seq % 151 = 0 THEN CAST(1e9 AS DOUBLE)
       WHEN seq % 1009 = 0 THEN CAST(1e300 AS DOUBLE) WHEN seq > 3000 AND seq < 3400 THEN price * CAST(1e-9 AS DOUBLE)
       WHEN seq > 3600 AND seq < 3900 THEN price * CAST(1e-200 AS DOUBLE) ELSE price END AS price FROM ({_TICKS})"""
_SIGNALS_FAULTY = _signals_over(f"SELECT * FROM ({_FAULTY}) WHERE symbol IS NOT NULL AND isfinite(price)")

_PRODUCT_VERSIONS = """
SELECT *, lead(valid_from) OVER (PARTITION BY event_type ORDER BY valid_from) AS valid_to FROM (
  SELECT event_type, TIMESTAMP '2024-01-01' + to_days(CAST(2 + 10 * least(k, 2) AS INTEGER)) AS valid_from,
    CASE WHEN k = 1 AND event_type = 'view' THEN NULL ELSE concat('T', (length(event_type) + k) % 4) END AS tier,
    CAST(length(event_type) * 10 + k AS DOUBLE) AS score
  FROM (SELECT DISTINCT event_type FROM events), (SELECT unnest([0, 1, 3]) AS k))"""

_STATES = """
SELECT user_id AS entity, user_id % 10 AS grp, ts, event_id AS seq,
  CASE event_type WHEN 'purchase' THEN 'Pending' WHEN 'error' THEN 'Failed' ELSE 'Running' END AS phase,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS restarts FROM events"""
_LATEST = f"""
SELECT grp, entity, phase FROM ({_STATES})
QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC, seq DESC) = 1"""

def _counter_rates(step: int, widths: dict[str, int]) -> str:
    """Growth between the first and the last sample of every look-back, from one running total; NULL below two samples."""
    figures = ",\n    ".join(
        f"""CASE WHEN count(*) FILTER (WHERE ts > evaluated_at - INTERVAL {w} SECOND) >= 2 THEN CAST(arg_max(r, (ts, seq))
      - arg_min(r, (ts, seq)) FILTER (WHERE ts > evaluated_at - INTERVAL {w} SECOND) AS BIGINT) END AS {n}"""
        for n, w in widths.items()
    )
    return f"""
WITH samples AS (SELECT CAST(user_id % 10 AS VARCHAR) AS series, ts, event_id AS seq, event_id % 500 AS v FROM events),
stepped AS (SELECT *, lag(v) OVER (PARTITION BY series ORDER BY ts, seq) AS p FROM samples),
totals AS (
  SELECT series, ts, seq, sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) OVER (PARTITION BY series ORDER BY ts, seq) AS r
  FROM stepped),
shown AS (
  SELECT *, unnest(range((epoch_us(ts) + {step * 1_000_000 - 1}) // {step * 1_000_000}, (epoch_us(ts) + {max(widths.values()) * 1_000_000 + step * 1_000_000 - 1}) // {step * 1_000_000})) AS k
  FROM totals),
timed AS (SELECT *, make_timestamp(k * {step * 1_000_000}) AS evaluated_at FROM shown),
looked AS (SELECT series, evaluated_at,
    {figures}
  FROM timed GROUP BY series, evaluated_at)"""


_STREAM_DECISIONS = """
SELECT 'fraud-decisions' AS sink, transaction_id AS row_id, decision AS detail FROM decided
UNION ALL SELECT 'audit-trail', transaction_id, decision FROM decided
UNION ALL SELECT 'dead-letter', log_offset, CASE WHEN broken THEN 'decode_failed' ELSE reject_reason END
  FROM checked WHERE broken OR reject_reason IS NOT NULL"""


def _readable_only(last: str, body: str) -> str:
    """The decision path over the messages that can be read."""
    names = list(_CTES)
    text = dict(_CTES)
    text["accepted"] = "SELECT * FROM checked WHERE reject_reason IS NULL AND NOT broken"
    parts = [f"{n} AS ({text[n].strip()})" for n in names[: names.index(last) + 1]]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def _rule(i: int) -> str:
    return _with("scored", f"SELECT transaction_id, r{i} AS score FROM scored")


RULE_ORDER = (
    "rule_high_amount_new_uid",
    "rule_anonymous_email_amount",
    "rule_product_h_cnp",
    "rule_velocity_breach",
    "rule_night_foreign_email",
    "rule_m_mismatch",
    "rule_c13_spike",
    "rule_v258_v257_threshold",
)
_RULE_COLUMNS = ", ".join(f"r{i + 1} AS {name}" for i, name in enumerate(RULE_ORDER))
_SCORE_COLUMNS = ", ".join(f"r{i + 1} AS {name.replace('rule_', 'score_', 1)}" for i, name in enumerate(RULE_ORDER))

_PCT = "floor({} * 1000 + 0.5) / 1000"
_FRAUD_VIEW = """count(*) AS total_transactions, CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
  floor(CAST(sum(is_fraud) AS DOUBLE) / nullif(count(is_fraud), 0) * CAST(100 AS DOUBLE) * 1000 + 0.5) / 1000 AS fraud_rate_pct,
  floor(CAST(sum(units) AS DOUBLE) / 10000.0 / count(*) * 100 + 0.5) / 100 AS """

ORACLES: dict[str, str] = {
    "csv_scan_cast": _with(
        "raw_tx",
        """SELECT transaction_id, transaction_dt, transaction_amt, is_fraud, product_cd,
  CASE WHEN transaction_id IS NOT NULL THEN id_01 END AS id_01,
  TIMESTAMP '2017-11-30' + to_seconds(transaction_dt) AS event_ts, DATE '2024-02-01' AS ingestion_date FROM raw_tx""",
    ),
    "log_bounded_read": _LOG,
    "stream_ingest": _LOG,
    "log_keyed_write": _with(
        "valid_tx",
        """SELECT coalesce(uid, CAST(transaction_id AS VARCHAR)) AS message_key, count(*) AS messages,
  CAST(1 AS BIGINT) AS partitions FROM valid_tx GROUP BY 1""",
    ),
    "stream_fanout": _with(
        "decided",
        """SELECT 'fraud-decisions' AS sink, transaction_id AS row_id, decision AS detail FROM decided WHERE log_offset % 61 <> 0
UNION ALL SELECT 'audit-trail', transaction_id, decision FROM decided WHERE log_offset % 61 <> 0
UNION ALL SELECT 'dead-letter', log_offset, 'decode_failed' FROM decided WHERE log_offset % 61 = 0""",
    ),
    "table_replace": _with("valid_tx", _SILVER + " FROM valid_tx"),
    "table_append": _with("valid_tx", _SILVER + " FROM valid_tx UNION ALL " + _SILVER + " FROM valid_tx"),
    "partition_prune": """
SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, count(*) AS line_items, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-11' AND l_shipdate < TIMESTAMP '1996-06-21' GROUP BY 1""",
    "calendar_prune": """
SELECT CAST(l_shipdate AS DATE) AS ship_day, CAST(isodow(l_shipdate) AS INTEGER) AS weekday, count(*) AS line_items,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem WHERE l_orderkey % 211 <> 0 AND isodow(l_shipdate) >= 6
  AND concat(year(l_shipdate), '-Q', quarter(l_shipdate)) IN ('1995-Q4', '1996-Q2') GROUP BY 1, 2""",
    "undated_rows": """
SELECT l_orderkey % 211 = 0 AS undated, count(*) AS line_items,
  count(DISTINCT CASE WHEN l_orderkey % 211 <> 0 THEN strftime(l_shipdate, '%Y-%m') END) AS months
FROM lineitem GROUP BY 1""",
    "gold_refresh": _with("performance", _gold_values()),
    "csv_rejects": """
SELECT CASE WHEN event_id % 37 = 0 THEN concat_ws(',', event_id, event_type) ELSE concat_ws(',', event_id, event_type, user_id, 'extra') END AS line,
  CASE WHEN event_id % 37 = 0 THEN 'too_few_fields' ELSE 'too_many_fields' END AS reason, concat('part-', event_id % 3) AS folder
FROM events WHERE event_id % 37 = 0 OR event_id % 41 = 0""",
    "csv_lineage": """
SELECT concat('part-', event_id % 3) AS source_file, 'bronze_bootstrap' AS pipeline_phase, DATE '2024-02-01' AS ingestion_date,
  count(*) AS records, count(*) AS ingestion_ids, CAST(sum(event_id) AS BIGINT) AS event_ids, true AS sized
FROM events WHERE event_id % 37 <> 0 AND event_id % 41 <> 0 GROUP BY 1""",
    "replay_positions": _with(
        "raw_tx",
        """SELECT concat(coalesce(CAST(card1 AS VARCHAR), 'unknown'), '_', coalesce(CAST(addr1 AS VARCHAR), 'unknown')) AS message_key, log_offset,
  CAST(row_number() OVER (PARTITION BY message_key ORDER BY transaction_dt, log_offset) AS INTEGER) AS place FROM raw_tx""",
    ),
    "frame_versions": _with(
        "raw_tx",
        """SELECT log_offset, CASE WHEN n % 53 = 0 THEN 999 WHEN n % 59 <> 0 AND n % 61 = 0 THEN NULL ELSE 101 + n % 3 END AS schema_id,
  CASE WHEN n % 53 = 0 THEN 'unknown_schema:999' WHEN n % 59 = 0 THEN 'unreadable' WHEN n % 61 = 0 THEN 'not_framed' END AS reason,
  CASE WHEN good THEN n END AS transaction_id,
  CASE WHEN good AND NOT (n % 3 = 1 AND n % 31 = 0) THEN transaction_amt END AS amount,
  CASE WHEN good THEN coalesce(product_cd, 'unknown') END AS product,
  CASE WHEN good THEN CASE n % 3 WHEN 0 THEN 'web' WHEN 1 THEN CASE WHEN n % 5 = 0 THEN 'app' ELSE 'web' END ELSE 'pos' END END AS channel,
  CASE WHEN good THEN CASE WHEN n % 3 = 2 THEN CAST(n % 4 AS INTEGER) ELSE 1 END END AS risk,
  CASE WHEN good AND n % 3 = 2 THEN 'new' END AS note
FROM (SELECT *, log_offset AS n, log_offset % 53 <> 0 AND log_offset % 59 <> 0 AND log_offset % 61 <> 0 AS good FROM raw_tx)""",
    ),
    "dimension_versions": f"""
WITH d AS ({_PRODUCT_VERSIONS})
SELECT event_id, tier, score AS tier_score, valid_from AS since
FROM events e LEFT JOIN d ON d.event_type = e.event_type AND e.ts >= d.valid_from AND (d.valid_to IS NULL OR e.ts < d.valid_to)""",
    "stream_dimension_versions": f"""
WITH d AS ({_PRODUCT_VERSIONS})
SELECT event_id, tier, valid_from AS since
FROM events e LEFT JOIN d ON d.event_type = e.event_type AND e.ts >= d.valid_from AND (d.valid_to IS NULL OR e.ts < d.valid_to)""",
    "stream_trigger": """
SELECT CASE WHEN event_id % 4 = 0 THEN 1 ELSE 2 END AS growth, count(*) AS input_rows, count(*) AS written_rows, max(event_id) AS last_seq
FROM events GROUP BY 1""",
    "archive_jsonl": _TICKS,
    "json_roundtrip": _TICKS,
    "replay_ordered": _with(
        "raw_tx",
        """SELECT concat(coalesce(CAST(card1 AS VARCHAR), 'unknown'), '_', coalesce(CAST(addr1 AS VARCHAR), 'unknown')) AS message_key,
  log_offset, coalesce(transaction_id, 0) AS transaction_id, transaction_dt FROM raw_tx""",
    ),
    "frame_decode": _with(
        "checked",
        """SELECT log_offset, NOT broken AS decoded,
  CASE WHEN NOT (log_offset % 41 = 0 OR log_offset % 43 = 0 OR log_offset % 47 = 0) THEN CAST(1 AS BIGINT) END AS schema_id,
  CASE WHEN NOT broken THEN transaction_id END AS transaction_id, CASE WHEN NOT broken THEN transaction_amt END AS transaction_amt,
  CASE WHEN NOT broken THEN product_cd END AS product_cd, CASE WHEN NOT broken THEN p_emaildomain END AS p_emaildomain,
  CASE WHEN NOT broken THEN is_fraud END AS is_fraud FROM checked""",
    ),
    "frame_roundtrip": """
SELECT p_partkey, CAST(octet_length(encode(p_name)) + 5 AS INTEGER) AS frame_bytes, CAST(7 AS BIGINT) AS schema_id, p_name FROM part""",
    "null_normalize": f"SELECT c_custkey, v AS cleaned FROM ({_CLEAN})",
    "cast_contract": f"""
SELECT c_custkey, v AS as_string, {_WHOLE.format("INTEGER")} AS as_int, {_WHOLE.format("BIGINT")} AS as_long,
  TRY_CAST(v AS DOUBLE) AS as_double, {_FLAG} AS as_boolean FROM ({_CLEAN})""",
    "default_fill": f"""
SELECT c_custkey, TRY_CAST(v AS DOUBLE) AS nullable_double, coalesce(v, '') AS required_string,
  coalesce({_WHOLE.format("INTEGER")}, 0) AS required_int, coalesce(TRY_CAST(v AS DOUBLE), 0) AS required_double,
  coalesce({_FLAG}, false) AS required_boolean, coalesce({_WHOLE.format("INTEGER")}, 7) AS declared_default FROM ({_CLEAN})""",
    "conform": _with(
        "raw_tx",
        """SELECT log_offset, 439 AS field_count, coalesce(transaction_id, 0) AS transactionid, is_fraud AS isfraud,
  transaction_dt AS transactiondt, coalesce(transaction_amt, 0) AS transactionamt, coalesce(product_cd, '') AS productcd,
  card1, CAST(NULL AS DOUBLE) AS card2, card4, nullif(trim(p_emaildomain), '') AS p_emaildomain, c13, v258,
  CAST(NULL AS DOUBLE) AS v339, m1, m4, id_01, CAST(NULL AS VARCHAR) AS id_38, CAST(0 AS BIGINT) AS kafka_offset,
  CAST(NULL AS VARCHAR) AS devicetype FROM raw_tx""",
    ),
    "map_project": _with(
        "decided",
        """SELECT transaction_id AS transactionid, uid, transaction_amt AS transactionamt, product_cd AS productcd, card4, card6,
  p_emaildomain, transaction_hour, fraud_score, decision, decision_reason, rules_triggered, is_fraud AS isfraud, ingestion_id,
  CAST(transaction_date AS VARCHAR) AS transaction_date FROM decided""",
    ),
    "time_features": _with(
        "raw_tx",
        """SELECT log_offset, t AS event_ts, CAST(t AS DATE) AS transaction_date, CAST(extract(hour FROM t) AS INTEGER) AS transaction_hour,
  CAST(isodow(t) - 1 AS INTEGER) AS transaction_dow
FROM (SELECT log_offset, TIMESTAMP '2017-11-30' + to_seconds(transaction_dt) AS t FROM raw_tx)""",
    ),
    "cent_amt": """
SELECT o_orderkey, o_totalprice,
  CAST(((CAST(o_totalprice AS DECIMAL(18,4)) % 1) + 1) % 1 AS DOUBLE) AS cent_amt FROM orders""",
    "uid_keys": _with(
        "raw_tx",
        """SELECT log_offset, concat(coalesce(card4, 'unknown'), '_', coalesce(CAST(CAST(addr1 AS BIGINT) AS VARCHAR), 'unknown')) AS replay_key,
  CASE WHEN card1 IS NULL OR addr1 IS NULL OR log_offset % 113 = 0 THEN NULL
       ELSE concat(CAST(CAST(card1 AS BIGINT) AS VARCHAR), '_', CAST(CAST(addr1 AS BIGINT) AS VARCHAR)) END AS uid FROM raw_tx""",
    ),
    "flag_parse": _with("raw_tx", "SELECT log_offset, upper(m1) = 'T' AS m1, m4 FROM raw_tx"),
    "has_identity": _with("valid_tx", "SELECT log_offset, id_01 IS NOT NULL AS has_identity FROM valid_tx"),
    "email_norm": _with("raw_tx", "SELECT log_offset, trim(lower(coalesce(p_emaildomain, ''))) AS domain FROM raw_tx"),
    "message_key": _with(
        "valid_tx", "SELECT log_offset, coalesce(uid, CAST(transaction_id AS VARCHAR)) AS message_key FROM valid_tx"
    ),
    "rules_triggered": _with("scored", "SELECT transaction_id, rule_count, rules_triggered FROM scored"),
    "validate_reason": _with("checked", "SELECT log_offset, reject_reason FROM checked"),
    "dlq_split": _with(
        "checked",
        """SELECT 'validation' AS stage, log_offset, reason AS message_key, reason, log_offset AS payload_offset
FROM (SELECT log_offset, CASE WHEN broken THEN 'decode_failed' ELSE reject_reason END AS reason FROM checked)
WHERE reason IS NOT NULL""",
    ),
    "silver_decisions": _with(
        "decided",
        f"""SELECT transaction_id AS transactionid, uid, transaction_amt AS transactionamt, product_cd AS productcd, card4, card6,
  p_emaildomain, transaction_hour, fraud_score, decision, decision_reason, 'rules-v1.0' AS model_version, rules_triggered,
  is_fraud AS isfraud, ingestion_id, transaction_date, confidence, event_ts AS event_at, {_SCORE_COLUMNS} FROM decided""",
    ),
    "silver_transactions": _with(
        "valid_tx", _SILVER + ", event_ts AS event_timestamp, ingestion_id FROM valid_tx"
    ),
    "expect_counts": "SELECT 'bronze' AS table_name, count(*) AS written, count(*) AS stored FROM events",
    "load_audit": _with(
        "valid_tx",
        """SELECT t AS table_name, k * n AS rows_before, n AS rows_written, (k + 1) * n AS rows_after
FROM (SELECT count(*) AS n FROM valid_tx), (VALUES ('silver_decisions'), ('silver_transactions')) AS a(t),
  (VALUES (CAST(0 AS BIGINT)), (1)) AS b(k)""",
    ),
    "identity_left_join": _with(
        "raw_tx",
        """SELECT log_offset, transaction_id, transaction_amt, CASE WHEN transaction_id IS NOT NULL THEN id_01 END AS id_01 FROM raw_tx""",
    ),
    "dimension_enrich": _with(
        "enriched",
        """SELECT log_offset, product_risk_tier, p_email_risk_score, p_email_is_anonymous, hour_risk_level, hour_risk_score FROM enriched""",
    ),
    "rule_unpivot": _with(
        "rule_rows", "SELECT transaction_id AS transactionid, rule_name, rule_score, is_fraud AS isfraud FROM rule_rows"
    ),
    "velocity_windows": _with("velocity", f"SELECT log_offset, uid, {_VELOCITY} FROM velocity"),
    "velocity_windows_tied": _velocity_over(
        "SELECT * REPLACE (transaction_dt - transaction_dt % 3600 AS transaction_dt) FROM plain_tx"
    ),
    "velocity_windows_dense": _velocity_over("SELECT * REPLACE (split_part(uid, '_', 2) AS uid) FROM plain_tx"),
    "velocity_flag": _with("enriched", "SELECT log_offset, velocity_flag FROM enriched"),
    "price_signals": _SIGNALS + "SELECT symbol, price, ingested_at, seq, ma, deviation_pct, volatility, severity FROM banded",
    "price_alerts": _SIGNALS
    + "SELECT symbol, severity, deviation_pct, price, ingested_at FROM banded WHERE severity IN ('ALERT', 'CRITICAL')",
    "price_signals_faulty": _SIGNALS_FAULTY
    + "SELECT symbol, price, ingested_at, seq, ma, deviation_pct, volatility, severity FROM banded",
    "price_rejects": f"""
SELECT seq, symbol, CASE WHEN symbol IS NULL THEN 'null_symbol' WHEN price IS NULL THEN 'null_price'
  WHEN isnan(price) THEN 'nan_price' ELSE 'infinite_price' END AS reason
FROM ({_FAULTY}) WHERE symbol IS NULL OR price IS NULL OR NOT isfinite(price)""",
    "row_numbers": """
SELECT event_type AS symbol, event_id AS seq, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS row_no FROM events""",
    **{name: _rule(i + 1) for i, name in enumerate(RULE_ORDER)},
    "fraud_scores": _with(
        "scored",
        f"""SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, fraud_score, 'rules-v1.0' AS model_version,
  {_RULE_COLUMNS}, id_01 IS NOT NULL AS has_identity, spend_1hr, txn_count_1hr, velocity_flag FROM scored""",
    ),
    "fraud_decisions": _with(
        "decided",
        f"""SELECT transaction_id, uid, fraud_score, decision, decision_reason, confidence, {_SCORE_COLUMNS}, is_fraud FROM decided""",
    ),
    "audit_trail": _with(
        "decided",
        """SELECT 'DECIDED' AS event_type, '2024-02-01 00:00:00' AS event_timestamp, CAST(transaction_date AS VARCHAR) AS transaction_date,
  transaction_id, uid, transaction_amt, product_cd, fraud_score, decision, rules_triggered, 'rules-v1.0' AS model_version, is_fraud,
  CAST(NULL AS BIGINT) AS pipeline_latency_ms, ingestion_id FROM decided""",
    ),
    "daily_fraud_summary": _with("daily", "SELECT * FROM daily"),
    "rule_performance": _with("performance", "SELECT * FROM performance"),
    "rule_performance_by_rule": _with("performance_own", "SELECT * FROM performance_own"),
    "uid_risk_profile": _with("profile", "SELECT * FROM profile"),
    "hourly_fraud_pattern": _with("hourly", "SELECT * FROM hourly"),
    "hourly_weekday_pattern": _with(
        "decided",
        """SELECT DATE '2024-02-01' AS summary_date, transaction_hour, CAST(isodow(transaction_date) - 1 AS INTEGER) AS transaction_dow,
  count(*) AS total_transactions, count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
  CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS fraud_rate,
  CAST(sum(units) AS DOUBLE) / 10000.0 / count(*) AS avg_amount,
  CASE WHEN transaction_hour <= 5 THEN 'HIGH' WHEN transaction_hour <= 9 OR transaction_hour >= 22 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM decided GROUP BY transaction_hour, isodow(transaction_date)""",
    ),
    "product_fraud_stats": _with("product_days", "SELECT * FROM product_days"),
    "fraud_rate_by_product": _with(
        "valid_tx",
        f"""SELECT product_cd AS productcd, {_FRAUD_VIEW} avg_transaction_amt,
  floor(coalesce(CAST(sum(units) FILTER (WHERE is_fraud = 1) AS DOUBLE), 0) / 10000.0 * 100 + 0.5) / 100 AS total_fraud_amt
FROM valid_tx GROUP BY product_cd""",
    ),
    "hourly_fraud_trend": _with(
        "valid_tx", f"SELECT transaction_hour, {_FRAUD_VIEW} avg_transaction_amt FROM valid_tx GROUP BY transaction_hour ORDER BY 1"
    ),
    "top_risky_uids": _with(
        "valid_tx",
        f"""SELECT uid, {_FRAUD_VIEW} avg_amount, floor(CAST(sum(units) AS DOUBLE) / 10000.0 * 100 + 0.5) / 100 AS total_amount,
  max(transaction_date) AS last_seen FROM valid_tx WHERE uid IS NOT NULL GROUP BY uid HAVING count(*) >= 3
ORDER BY fraud_rate_pct DESC, uid""",
    ),
    "rule_effectiveness_ranking": _with(
        "performance_own",
        """SELECT rule_name, rule_type, CAST(sum(triggers_count) AS BIGINT) AS total_triggers, CAST(sum(true_positive) AS BIGINT) AS total_tp,
  CAST(sum(false_positive) AS BIGINT) AS total_fp, floor(avg(precision_score) * CAST(100 AS DOUBLE) * 100 + 0.5) / 100 AS avg_precision_pct,
  floor(avg(recall_score) * CAST(100 AS DOUBLE) * 100 + 0.5) / 100 AS avg_recall_pct,
  floor(avg(f1_score) * CAST(100 AS DOUBLE) * 100 + 0.5) / 100 AS avg_f1_pct,
  floor(sum(blocked_amount) * 100 + 0.5) / 100 AS total_blocked_amount
FROM performance_own GROUP BY rule_name, rule_type ORDER BY avg_f1_pct DESC""",
    ),
    "daily_blocked_amount": _with(
        "daily",
        """SELECT summary_date, total_transactions, fraud_count, floor(fraud_rate * CAST(100 AS DOUBLE) * 1000 + 0.5) / 1000 AS fraud_rate_pct,
  blocked_count, floor(blocked_amount * 100 + 0.5) / 100 AS blocked_amount, floor(fraud_amount * 100 + 0.5) / 100 AS fraud_amount,
  floor(blocked_amount / nullif(fraud_amount, 0) * CAST(100 AS DOUBLE) * 100 + 0.5) / 100 AS capture_rate_pct
FROM daily ORDER BY summary_date DESC""",
    ),
    "fraud_totals": _with("totals", "SELECT * FROM totals"),
    "risk_tier_rollup": _with("tiers", "SELECT * FROM tiers"),
    "latest_daily": _with("daily", "SELECT * FROM daily ORDER BY summary_date DESC LIMIT 1"),
    "top_days": _with(
        "daily",
        """SELECT summary_date, total_transactions, fraud_count, fraud_rate FROM daily
ORDER BY fraud_count DESC, summary_date DESC LIMIT 5""",
    ),
    "table_counts": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    ),
    "metrics_long": _with("metrics", "SELECT metric, labels, value FROM metrics"),
    "alert_threshold": _with(
        "metrics",
        """SELECT alert, severity, m.metric, labels, value, threshold,
  CASE op WHEN '>' THEN value > threshold ELSE value = threshold END AS active
FROM metrics m JOIN (VALUES
  ('FraudRateSpikeDetected', 'fraud_daily_fraud_rate', '>', CAST(0.08 AS DOUBLE), 'critical', NULL),
  ('FraudPipelineDLQNonZero', 'fraud_silver_decisions_count', '==', 0, 'critical', NULL),
  ('FraudRateElevated', 'fraud_daily_fraud_rate', '>', 0.05, 'warning', NULL),
  ('HighRiskProductCFraudRate', 'fraud_product_fraud_rate', '>', 0.15, 'warning', 'product=C')
) AS r(alert, metric, op, threshold, severity, wanted) ON m.metric = r.metric AND (wanted IS NULL OR wanted = labels)""",
    ),
    "alert_sustained": """
WITH scraped AS (SELECT concat('m_', event_type) AS metric, concat('user=', user_id % 10) AS labels,
    date_trunc('minute', ts) AS ts, max(value) AS value FROM events GROUP BY 1, 2, 3),
marked AS (SELECT *, value > 60 AS is_on, lag(value > 60) OVER w AS was_on, lag(ts) OVER w AS prev
  FROM scraped WINDOW w AS (PARTITION BY metric, labels ORDER BY ts)),
numbered AS (SELECT *, sum(CASE WHEN is_on AND (prev IS NULL OR NOT was_on OR date_diff('second', prev, ts) > 43200) THEN 1 ELSE 0 END)
  OVER (PARTITION BY metric, labels ORDER BY ts) AS stretch FROM marked),
spans AS (SELECT *, min(ts) OVER (PARTITION BY metric, labels, stretch) AS since FROM numbered WHERE is_on)
SELECT metric, labels, min(since) AS active_since, min(ts) FILTER (WHERE date_diff('second', since, ts) >= 21600) AS fired_at,
  max(ts) AS active_until, count(*) AS samples
FROM spans GROUP BY metric, labels, stretch HAVING min(ts) FILTER (WHERE date_diff('second', since, ts) >= 21600) IS NOT NULL""",
    "alert_firing": _with(
        "valid_tx",
        """, minutes AS (SELECT transaction_date, product_cd, date_trunc('minute', event_ts) AS ts, count(*) AS n,
    count(*) FILTER (WHERE is_fraud = 1) AS f FROM valid_tx GROUP BY 1, 2, 3),
samples AS (SELECT 'fraud_daily_fraud_rate' AS metric, '' AS labels, ts,
    CAST(sum(sum(f)) OVER w AS DOUBLE) / CAST(sum(sum(n)) OVER w AS DOUBLE) AS value
  FROM minutes GROUP BY transaction_date, ts WINDOW w AS (PARTITION BY transaction_date ORDER BY ts)
  UNION ALL SELECT 'fraud_product_fraud_rate', concat('product=', product_cd), ts,
    CAST(sum(f) OVER w AS DOUBLE) / CAST(sum(n) OVER w AS DOUBLE)
  FROM minutes WINDOW w AS (PARTITION BY transaction_date, product_cd ORDER BY ts)),
judged AS (SELECT alert, severity, labels, hold, ts, value > threshold AS is_on FROM samples s JOIN (VALUES
    ('FraudRateSpikeDetected', 'critical', 'fraud_daily_fraud_rate', '', 0.08::DOUBLE, 300),
    ('FraudRateElevated', 'warning', 'fraud_daily_fraud_rate', '', 0.05::DOUBLE, 600),
    ('HighRiskProductCFraudRate', 'warning', 'fraud_product_fraud_rate', 'product=C', 0.15::DOUBLE, 300)) AS r(alert, severity, m, l, threshold, hold)
  ON s.metric = r.m AND s.labels = r.l),
marked AS (SELECT *, lag(is_on) OVER w AS was_on, lag(ts) OVER w AS prev FROM judged WINDOW w AS (PARTITION BY alert ORDER BY ts)),
numbered AS (SELECT *, sum(CASE WHEN is_on AND (prev IS NULL OR NOT was_on OR date_diff('second', prev, ts) > 43200) THEN 1 ELSE 0 END)
  OVER (PARTITION BY alert ORDER BY ts) AS stretch FROM marked),
spans AS (SELECT *, min(ts) OVER (PARTITION BY alert, stretch) AS since FROM numbered WHERE is_on)
SELECT alert, severity, labels, min(since) AS active_since, min(ts) FILTER (WHERE date_diff('second', since, ts) >= hold) AS fired_at,
  max(ts) AS active_until, count(*) AS samples FROM spans GROUP BY alert, severity, labels, stretch""",
    ),
    "group_health": f"""
SELECT grp, running, bad, CASE WHEN running = 0 OR bad >= 3 THEN 'critical' WHEN bad > 0 THEN 'warning' ELSE 'healthy' END AS status
FROM (SELECT grp, count(*) FILTER (WHERE phase = 'Running') AS running,
  count(*) FILTER (WHERE phase IN ('Failed', 'Pending', 'Unknown')) AS bad FROM ({_LATEST}) GROUP BY grp)""",
    "health_score": f"""
WITH l AS (SELECT grp, count(*) FILTER (WHERE phase <> 'Running') AS bad,
    CAST(count(*) FILTER (WHERE phase = 'Failed') AS DOUBLE) / count(*) AS cpu,
    CAST(count(*) FILTER (WHERE phase = 'Pending') AS DOUBLE) / count(*) AS memory FROM ({_LATEST}) GROUP BY grp),
s AS (SELECT grp, CAST(sum(restarts) AS BIGINT) AS restarts FROM ({_STATES}) GROUP BY grp)
SELECT l.grp, bad, restarts,
  floor(least(100, greatest(0, CAST(100 AS DOUBLE) - bad * CAST(0.02 AS DOUBLE) - cpu * CAST(10 AS DOUBLE) - memory * CAST(8 AS DOUBLE))) * 10 + 0.5) / 10 AS overview_score,
  floor(least(100, greatest(0, CAST(100 AS DOUBLE) - bad * CAST(0.15 AS DOUBLE) - restarts * CAST(0.5 AS DOUBLE))) * 10 + 0.5) / 10 AS dashboard_score,
  floor(least(100, greatest(0, CAST(100 AS DOUBLE) - bad * CAST(3 AS DOUBLE) - restarts * CAST(0.05 AS DOUBLE))) * 10 + 0.5) / 10 AS strict_score
FROM l JOIN s ON l.grp = s.grp""",
    "status_band": """
SELECT metric, day, peak, CASE WHEN peak >= 300 THEN 'critical' WHEN peak >= 200 THEN 'warning' ELSE 'healthy' END AS status
FROM (SELECT event_type AS metric, CAST(ts AS DATE) AS day, max(value) AS peak FROM events GROUP BY 1, 2)""",
    "incident_classify": """
WITH d AS (SELECT CAST(ts AS DATE) AS day,
    count(*) FILTER (WHERE event_type = 'error' AND extract(hour FROM ts) < 3) % 60 AS bad_pods,
    70 + count(*) FILTER (WHERE event_type = 'view') % 25 AS memory, 65 + count(*) FILTER (WHERE event_type = 'click') % 25 AS cpu
  FROM events GROUP BY 1)
SELECT *, CASE WHEN bad_pods > 40 OR memory >= 85 THEN 'critical' WHEN cpu >= 80 THEN 'warning' ELSE 'healthy' END AS severity,
  CASE WHEN bad_pods > 40 THEN 'Workload instability detected' WHEN memory >= 85 THEN 'Cluster memory pressure detected'
       WHEN cpu >= 80 THEN 'High CPU utilization detected' ELSE 'No active incident detected' END AS title,
  CASE WHEN bad_pods > 40 THEN concat(bad_pods, ' pods are currently non-running.')
       WHEN memory >= 85 THEN concat('Cluster memory utilization is at ', memory, '%.')
       WHEN cpu >= 80 THEN concat('Cluster CPU utilization is at ', cpu, '%.')
       ELSE 'Platform telemetry is within normal operating range.' END AS root_cause,
  CASE WHEN bad_pods > 40 THEN 'Possible impact on Spark jobs, Airflow tasks, or platform services.'
       WHEN memory >= 85 THEN 'Scheduling delays, pod evictions, and Spark executor instability may occur.'
       WHEN cpu >= 80 THEN 'Batch jobs and query workloads may slow down.'
       ELSE 'No immediate user-facing or data-platform impact detected.' END AS impact,
  CASE WHEN bad_pods > 40 THEN 'Open Namespace Health Matrix and inspect namespaces with bad pods.'
       WHEN memory >= 85 THEN 'Check high-memory namespaces and worker node pressure.'
       WHEN cpu >= 80 THEN 'Check Spark, Trino, and Kafka workload activity.'
       ELSE 'Continue monitoring namespace health and pod restarts.' END AS suggestion
FROM d""",
    "counter_increase": """
WITH c AS (SELECT CAST(user_id % 10 AS VARCHAR) AS series, ts, event_id AS seq, event_id % 500 AS v,
    CAST(floor(epoch(ts) / 21600) AS BIGINT) * 21600 AS b FROM events),
d AS (SELECT *, lag(v) OVER (PARTITION BY series, b ORDER BY ts, seq) AS p FROM c)
SELECT series, make_timestamp(b * 1000000) AS bucket_start,
  CAST(sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) AS BIGINT) AS increase,
  CAST(sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) AS DOUBLE) / CAST(21600 AS DOUBLE) AS rate_per_sec,
  count(*) AS samples FROM d GROUP BY series, b""",
    "counter_rates": _counter_rates(300, {"i5": 300, "increase_1h": 3600, "increase_6h": 21600})
    + "SELECT series, evaluated_at, increase_1h, increase_6h, CAST(i5 AS DOUBLE) / CAST(300 AS DOUBLE) AS rate_5m FROM looked",
    "health_timeline": _counter_rates(3600, {"i1": 3600})
    + f""",
cpu AS (SELECT CAST(series AS BIGINT) AS grp, evaluated_at, CAST(1 AS DOUBLE) - least(1.0, greatest(0.0, CAST(i1 AS DOUBLE) / CAST(3600 AS DOUBLE))) AS cpu
  FROM looked WHERE i1 IS NOT NULL),
hours AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts) + INTERVAL 2 DAY, INTERVAL 1 HOUR)) AS evaluated_at FROM events),
pods AS (
  SELECT evaluated_at, grp, entity, arg_max(phase, (ts, seq)) AS phase, max(ts) AS ts FROM hours JOIN ({_STATES}) s ON s.ts <= evaluated_at AND s.ts >= evaluated_at - INTERVAL 24 HOUR
  GROUP BY ALL),
nodes AS (
  SELECT evaluated_at, user_id % 10 AS grp, user_id, arg_max(event_id % 97, (ts, event_id)) AS available, 100 + user_id % 3 AS total
  FROM hours JOIN events ON ts <= evaluated_at AND ts >= evaluated_at - INTERVAL 12 HOUR GROUP BY ALL),
bad AS (SELECT grp, evaluated_at, count(*) FILTER (WHERE phase <> 'Running') AS bad_pods FROM pods GROUP BY ALL),
memory AS (SELECT grp, evaluated_at, CAST(1 AS DOUBLE) - CAST(sum(available) AS DOUBLE) / CAST(sum(total) AS DOUBLE) AS memory FROM nodes GROUP BY ALL)
SELECT grp, evaluated_at, bad_pods, cpu, memory, floor(least(100, greatest(0, CAST(100 AS DOUBLE) - bad_pods * CAST(0.02 AS DOUBLE)
  - cpu * CAST(10 AS DOUBLE) - memory * CAST(8 AS DOUBLE))) * 10 + 0.5) / 10 AS health_score
FROM bad JOIN memory USING (grp, evaluated_at) JOIN cpu USING (grp, evaluated_at)""",
    "ratio_of_sums": """
SELECT l_returnflag, CAST(1 AS DOUBLE) - CAST(p AS DOUBLE) / CAST(w AS DOUBLE) AS used_ratio,
  CAST(1 AS DOUBLE) - CAST(p AS DOUBLE) / CAST(w AS DOUBLE) > 0.05 AS breached
FROM (SELECT l_returnflag, sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS p,
  sum(CAST(round(l_extendedprice * 100) AS BIGINT) * 100) AS w FROM lineitem GROUP BY l_returnflag)""",
    "entity_latest_state": f"""
WITH s AS ({_STATES}),
latest AS (SELECT entity, phase FROM s QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC, seq DESC) = 1),
total AS (SELECT entity, CAST(sum(restarts) AS BIGINT) AS restarts FROM s GROUP BY entity)
SELECT c_custkey AS entity, coalesce(phase, 'Unknown') AS phase, coalesce(restarts, 0) AS restarts, c_nationkey AS node
FROM customer LEFT JOIN latest ON c_custkey = latest.entity LEFT JOIN total ON c_custkey = total.entity""",
    "severity_sort": """
SELECT *, CASE WHEN coalesce(health_status, 'Unknown') <> 'Healthy' THEN 'critical' WHEN sync_status <> 'Synced' THEN 'warning'
  ELSE 'healthy' END AS severity
FROM (SELECT s_name AS name,
  CASE WHEN s_suppkey % 4 = 0 THEN 'Degraded' WHEN s_suppkey % 11 = 0 THEN NULL ELSE 'Healthy' END AS health_status,
  CASE WHEN s_suppkey % 3 = 0 THEN 'OutOfSync' ELSE 'Synced' END AS sync_status FROM supplier)
ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END, name""",
    "telemetry_topk": """
SELECT user_id, CAST(sum(CAST(round(value * 10000.0) AS BIGINT)) AS DOUBLE) / 10000.0 AS total FROM events
GROUP BY user_id ORDER BY total DESC, user_id LIMIT 10""",
    "dedup_transactions": _with(
        "valid_tx", "SELECT transaction_id, transaction_amt, uid, 0 AS copy FROM valid_tx"
    ),
    "late_split": _with(
        "valid_tx",
        """, b AS (SELECT log_offset, transaction_dt,
  CAST(floor(transaction_dt / 259200) AS INTEGER) + CASE WHEN log_offset % 50 = 0 THEN 1 ELSE 0 END AS batch FROM valid_tx),
m AS (SELECT batch, max(max(transaction_dt)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 86400 AS mark
  FROM b GROUP BY batch)
SELECT log_offset, batch, coalesce(transaction_dt < mark, false) AS is_late FROM b JOIN m USING (batch)""",
    ),
    "stream_decisions": _readable_only("decided", _STREAM_DECISIONS),
    "stream_stage_chain": _readable_only(
        "decided", "SELECT transaction_id, uid, fraud_score, decision, rules_triggered FROM decided"
    ),
    "stream_velocity": _with(
        "enriched", f"SELECT log_offset, uid, {_VELOCITY}, velocity_flag, false AS is_late FROM enriched"
    ),
    "stream_late": _with(
        "checked",
        """, v AS (SELECT *, CASE WHEN card1 IS NULL OR addr1 IS NULL THEN NULL
    ELSE concat(CAST(CAST(card1 AS BIGINT) AS VARCHAR), '_', CAST(CAST(addr1 AS BIGINT) AS VARCHAR)) END AS uid,
  transaction_dt >= 1296000 OR log_offset % 50 = 0 AS second FROM checked WHERE reject_reason IS NULL AND NOT broken),
m AS (SELECT uid, max(transaction_dt) AS newest FROM v WHERE NOT second AND uid IS NOT NULL GROUP BY uid)
SELECT CASE WHEN second AND transaction_dt < newest - 86400 THEN 'late' ELSE 'decision' END AS sink, transaction_id
FROM v LEFT JOIN m ON v.uid = m.uid""",
    ),
    "stream_dedup": _with("valid_tx", "SELECT transaction_id, transaction_amt, uid FROM valid_tx"),
    "stream_price_signals": _SIGNALS_FAULTY
    + "SELECT symbol, price, ingested_at, seq, ma, deviation_pct, volatility, severity FROM banded",
}


def _view_values() -> str:
    """Every figure of the five views; the ranking reads the gold table, whose rules share the composite score."""
    parts = []
    for name, (keys, metrics) in VIEW_VALUES.items():
        text = ORACLES[name]
        if name == "rule_effectiveness_ranking":
            text = _with("performance", text[text.rindex("SELECT rule_name, rule_type, CAST(sum") :].replace("performance_own", "performance"))
        key = "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + ")"
        pairs = [f"SELECT '{name}' AS table_name, {key} AS row_key, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM v" for m in metrics]
        parts.append(f"SELECT * FROM (WITH v AS ({text}) " + " UNION ALL ".join(pairs) + ")")
    return "\nUNION ALL ".join(parts)


ORACLES["views"] = _view_values()
