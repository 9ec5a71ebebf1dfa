"""Independent ANSI SQL definitions of the registered queries, for DuckDB.

Written once from the operator semantics (not generated from the Spark plans). The tables
``events orders embeddings documents benchmark ...`` are views over the same Parquet files.
"""

from __future__ import annotations

# The integer inside ``props`` (DuckDB spelling).
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

TX = f"""
SELECT 'TXN-' || lpad(CAST(event_id AS VARCHAR), 8, '0') AS transaction_id,
       'USER-' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS user_id,
       value * 200.0 AS amount,
       'MERCHANT-' || lpad(CAST({_K} % 50 AS VARCHAR), 3, '0') AS merchant_id,
       CASE {_K} % 4 WHEN 0 THEN 'wire' WHEN 1 THEN 'ach' WHEN 2 THEN 'pos' ELSE 'card' END
         AS transaction_type,
       ts AS transaction_time
FROM events WHERE event_type = 'purchase'
"""

LG = f"""
SELECT 'LOGIN-' || lpad(CAST(event_id AS VARCHAR), 8, '0') AS login_id,
       'USER-' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS user_id,
       '10.0.0.' || CAST({_K} % 8 AS VARCHAR) AS ip_address,
       ts AS login_time,
       event_type = 'signup' AS mfa_changed,
       CASE event_id % 5 WHEN 0 THEN 38.72e0 WHEN 1 THEN -1.29e0 WHEN 2 THEN 43.65e0
            WHEN 3 THEN 34.69e0 ELSE -12.05e0 END AS latitude,
       CASE event_id % 5 WHEN 0 THEN -9.14e0 WHEN 1 THEN 36.82e0 WHEN 2 THEN -79.38e0
            WHEN 3 THEN 135.5e0 ELSE -77.04e0 END AS longitude,
       CASE event_id % 5 WHEN 0 THEN 'Lisbon' WHEN 1 THEN 'Nairobi' WHEN 2 THEN 'Toronto'
            WHEN 3 THEN 'Osaka' ELSE 'Lima' END AS city,
       'device-' || lpad(CAST({_K} % 20 AS VARCHAR), 3, '0') AS device_id
FROM events WHERE event_type <> 'purchase'
"""

TRIAGE = """
SELECT 'TXN-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS transaction_id,
       'USER-' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS user_id,
       o_totalprice / 5000.0 AS risk_score,
       CASE WHEN o_totalprice >= 425000 THEN 'CRITICAL' WHEN o_totalprice >= 350000 THEN 'HIGH'
            WHEN o_totalprice >= 250000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       CASE WHEN o_totalprice >= 425000 THEN 'BLOCK' WHEN o_totalprice >= 350000 THEN 'CHALLENGE'
            WHEN o_totalprice >= 250000 THEN 'MONITOR' ELSE 'APPROVE' END AS automated_action,
       o_orderpriority AS action_reason,
       o_orderdate AS action_timestamp,
       CASE WHEN o_orderkey % 7 = 0 THEN 'ESCALATED' WHEN o_orderstatus = 'F' THEN 'APPROVED'
            WHEN o_orderstatus = 'O' THEN 'REJECTED' ELSE 'PENDING' END AS review_status,
       CAST(NULL AS VARCHAR) AS reviewed_by,
       CAST(NULL AS TIMESTAMP) AS review_timestamp,
       o_orderdate AS created_at
FROM orders
"""

# Whole-second minutes between two timestamps.
def _minutes(later: str, earlier: str) -> str:
    return f"((floor(epoch({later})) - floor(epoch({earlier}))) / 60.0)"


SEQ = f"""
lg_seq AS (
  SELECT *, lag(ip_address) OVER (PARTITION BY user_id ORDER BY login_time, login_id) AS prev_ip,
            lag(latitude) OVER (PARTITION BY user_id ORDER BY login_time, login_id) AS prev_lat,
            lag(longitude) OVER (PARTITION BY user_id ORDER BY login_time, login_id) AS prev_lon,
            lag(login_time) OVER (PARTITION BY user_id ORDER BY login_time, login_id) AS prev_time
  FROM lg),
ipc AS (
  SELECT user_id, ip_address AS new_ip, login_time AS ip_change_time, latitude AS ip_lat,
         longitude AS ip_lon, login_id
  FROM lg_seq WHERE prev_ip IS NOT NULL AND ip_address <> prev_ip),
latest AS (
  SELECT user_id, ip_address, device_id, login_time AS last_login_time FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY login_time DESC, login_id DESC) AS rn
    FROM lg) WHERE rn = 1),
mfa AS (SELECT user_id, max(login_time) AS last_mfa_change FROM lg WHERE mfa_changed GROUP BY user_id)
"""

_FLAGS = f"""
  SELECT transaction_id, user_id, amount, merchant_id, transaction_type, transaction_time,
         ip_address, device_id,
         CASE WHEN ip_change_time IS NOT NULL AND minutes_since_ip_change <= 60 THEN true ELSE false END
           AS ip_changed_recently,
         minutes_since_ip_change,
         CASE WHEN last_mfa_change IS NOT NULL
               AND date_diff('day', CAST(last_mfa_change AS DATE), CAST(transaction_time AS DATE)) <= 1
              THEN true ELSE false END AS mfa_change_flag,
         (transaction_type = 'wire' AND amount >= 10000) AS high_value_wire,
         ((transaction_type = 'wire' AND amount >= 10000)
          AND (CASE WHEN ip_change_time IS NOT NULL AND minutes_since_ip_change <= 60 THEN true ELSE false END))
           AS wire_over_10k_within_1h_ip_change,
         ip_lat AS ip_latitude, ip_lon AS ip_longitude
  FROM (SELECT *, CASE WHEN ip_change_time IS NOT NULL
                       THEN round({_minutes('transaction_time', 'ip_change_time')}, 2) END
                    AS minutes_since_ip_change FROM {{src}})
"""

# Base CTE chain ending in ``silver`` (as-of form).
BASE = f"""
WITH tx AS ({TX}), lg AS ({LG}), {SEQ},
j_asof AS (
  SELECT tx.*, ipc.ip_change_time, ipc.ip_lat, ipc.ip_lon
  FROM tx ASOF LEFT JOIN ipc ON tx.user_id = ipc.user_id AND tx.transaction_time >= ipc.ip_change_time),
j AS (
  SELECT a.*, l.ip_address, l.device_id, m.last_mfa_change
  FROM j_asof a LEFT JOIN latest l ON a.user_id = l.user_id LEFT JOIN mfa m ON a.user_id = m.user_id),
silver AS ({_FLAGS.format(src='j')}),
pairs AS (
  SELECT user_id, login_id, login_time, prev_time,
         {_minutes('login_time', 'prev_time')} AS minutes_diff,
         CASE WHEN prev_lat IS NULL OR prev_lon IS NULL OR latitude IS NULL OR longitude IS NULL THEN NULL
              ELSE 3959.0 * 2 * atan2(sqrt(hav), sqrt(1 - hav)) END AS miles_diff,
         ip_address, city
  FROM (SELECT *, greatest(0.0, least(1.0,
          pow(sin(radians(latitude - prev_lat) / 2), 2)
          + cos(radians(prev_lat)) * cos(radians(latitude)) * pow(sin(radians(longitude - prev_lon) / 2), 2)))
          AS hav FROM lg_seq)),
travel AS (
  SELECT user_id, login_time, prev_time, round(minutes_diff, 2) AS minutes_between_logins,
         round(miles_diff, 2) AS miles_traveled, ip_address, city
  FROM pairs WHERE minutes_diff IS NOT NULL AND minutes_diff <= 10 AND miles_diff >= 500)
"""

FANOUT = f"""
WITH tx AS ({TX}), lg AS ({LG}), {SEQ},
j AS (
  SELECT tx.*, l.ip_address, l.device_id, m.last_mfa_change, c.ip_change_time, c.ip_lat, c.ip_lon
  FROM tx LEFT JOIN latest l ON tx.user_id = l.user_id
          LEFT JOIN ipc c ON tx.user_id = c.user_id AND tx.transaction_time >= c.ip_change_time
          LEFT JOIN mfa m ON tx.user_id = m.user_id)
{_FLAGS.format(src='j')}
"""

# ---- triage, scoring and similarity ---------------------------------------------------------------

AS_OF = "2024-02-01 00:00:00"
_AS_OF = f"TIMESTAMP '{AS_OF}'"

DECISIONS = """
SELECT 'TXN-' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS transaction_id,
       CASE l_returnflag WHEN 'A' THEN 'ALLOW' WHEN 'R' THEN 'BLOCK' ELSE 'ESCALATE' END AS action,
       CASE WHEN l_linestatus = 'F' THEN 'clerk-' || lpad(CAST(l_suppkey AS VARCHAR), 3, '0') END AS reviewed_by,
       'line ' || CAST(l_linenumber AS VARCHAR) AS notes,
       l_shipdate AS decided_at,
       CAST(l_linenumber AS BIGINT) AS decision_id
FROM lineitem
"""


def _signature_values() -> str:
    from riskflow.constants import FRAUD_SIGNATURE_ROWS

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    rows = ", ".join(f"({q(a)}, {q(b)}, {q(c)}, CAST({d!r} AS DOUBLE))" for a, b, c, d in FRAUD_SIGNATURE_ROWS)
    return f"SELECT * FROM (VALUES {rows}) AS v(signature_id, signature_type, description, risk_weight)"


def _weight_case(var: str) -> str:
    from riskflow.constants import FRAUD_SIGNATURE_ROWS

    whens = " ".join(f"WHEN '{t}' THEN CAST({w!r} AS DOUBLE)" for _, t, _, w in FRAUD_SIGNATURE_ROWS)
    return f"CASE {var} {whens} END"


LEVEL = "CASE WHEN {s} >= 85 THEN 'CRITICAL' WHEN {s} >= 70 THEN 'HIGH' WHEN {s} >= 50 THEN 'MEDIUM' ELSE 'LOW' END"
LADDER = (
    "CASE WHEN {l} = 'CRITICAL' OR {s} >= 85 THEN 'BLOCK' WHEN {l} = 'HIGH' OR {s} >= 70 THEN 'CHALLENGE' "
    "WHEN {l} = 'MEDIUM' OR {s} >= 50 THEN 'MONITOR' ELSE 'APPROVE' END"
)

SUMMARY = """coalesce(nullif(concat_ws(' ',
    CASE WHEN coalesce(transaction_type, '') <> '' THEN 'Transaction type: ' || transaction_type END,
    CASE WHEN amount IS NOT NULL THEN 'Amount: ' || printf('%.2f', amount) END,
    CASE WHEN coalesce(mfa_change_flag, false) THEN 'MFA or security changed recently.' END,
    CASE WHEN coalesce(ip_changed_recently, false) THEN 'IP address changed recently.' END,
    CASE WHEN coalesce(high_value_wire, false) THEN 'High-value wire transfer.' END), ''),
  'Transaction with no extra signals.')"""

SCORED = f""",
m AS (
  SELECT s.*, list_filter([
      CASE WHEN coalesce(wire_over_10k_within_1h_ip_change, false) THEN 'high_value_wire_ip_change' END,
      CASE WHEN coalesce(mfa_change_flag, false) AND coalesce(amount >= 10000, false)
                AND coalesce(transaction_type IN ('wire', 'ach'), false) THEN 'mfa_change_high_value' END,
      CASE WHEN s.user_id IN (SELECT user_id FROM travel) THEN 'impossible_travel' END],
      lambda x: x IS NOT NULL) AS matched_signatures
  FROM silver s),
sc AS (
  SELECT *, round(greatest(
      (CASE WHEN coalesce(high_value_wire, false) THEN 30.0 ELSE 0.0 END
       + CASE WHEN coalesce(ip_changed_recently, false) THEN 15.0 ELSE 0.0 END
       + CASE WHEN coalesce(mfa_change_flag, false) THEN 5.0 ELSE 0.0 END)::DOUBLE,
      coalesce(list_max(list_transform(matched_signatures, lambda t: {_weight_case('t')})), 0.0) * 100.0), 2) AS risk_score,
    coalesce(nullif(concat_ws(' ',
      CASE WHEN len(matched_signatures) > 0
           THEN 'Matched signatures: ' || array_to_string(matched_signatures, ', ') || '.' END,
      CASE WHEN coalesce(high_value_wire, false) THEN 'High-value wire.' END,
      CASE WHEN coalesce(ip_changed_recently, false) THEN 'New IP within the last hour.' END,
      CASE WHEN coalesce(mfa_change_flag, false) THEN 'Recent MFA change.' END), ''), 'No risk signals.') AS reason
  FROM m),
scored AS (
  SELECT *, {LADDER.format(l='risk_level', s='risk_score')} AS automated_action
  FROM (SELECT *, {LEVEL.format(s='risk_score')} AS risk_level FROM sc)),
gold_new AS (
  SELECT transaction_id, user_id, risk_score, risk_level, automated_action, reason AS action_reason,
         {_AS_OF} AS action_timestamp, 'PENDING' AS review_status, CAST(NULL AS VARCHAR) AS reviewed_by,
         CAST(NULL AS TIMESTAMP) AS review_timestamp, {_AS_OF} AS created_at
  FROM scored),
tr AS ({TRIAGE}),
dec AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY decided_at DESC, decision_id DESC, action DESC,
                                reviewed_by DESC NULLS LAST, notes DESC) AS rn
                 FROM ({DECISIONS})) WHERE rn = 1),
reviewed AS (
  SELECT t.transaction_id, t.user_id, t.risk_score, t.risk_level, t.automated_action, t.action_reason,
         t.action_timestamp,
         CASE WHEN d.transaction_id IS NULL THEN t.review_status
              WHEN d.action = 'ALLOW' THEN 'APPROVED' WHEN d.action = 'BLOCK' THEN 'REJECTED' ELSE 'ESCALATED' END
           AS review_status,
         CASE WHEN d.transaction_id IS NULL THEN t.reviewed_by ELSE coalesce(nullif(d.reviewed_by, ''), 'analyst') END
           AS reviewed_by,
         CASE WHEN d.transaction_id IS NULL THEN t.review_timestamp ELSE coalesce(d.decided_at, {_AS_OF}) END
           AS review_timestamp,
         t.created_at,
         CASE WHEN d.transaction_id IS NULL THEN NULL ELSE d.notes END AS review_notes
  FROM tr t LEFT JOIN dec d ON t.transaction_id = d.transaction_id)
"""

FULL = BASE + SCORED
