"""DuckDB SQL fragments that repeat the adapter rules of ``tessera.sources.adapters``.

Used only to build the oracle SQL that checks the Spark queries; the engine
itself never runs these strings.
"""

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
MICROS_PER_DAY = "CAST(86400000000.0 AS DOUBLE)"

SOURCE_CASE = (
    "CASE event_type WHEN 'view' THEN 'website' WHEN 'click' THEN 'app' WHEN 'purchase' THEN 'crm' "
    "WHEN 'signup' THEN 'email' WHEN 'error' THEN 'whatsapp' END"
)
LEAD_CASE = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'inquiry' WHEN 'BUILDING' THEN 'application' "
    "WHEN 'FURNITURE' THEN 'enrollment' WHEN 'HOUSEHOLD' THEN 'active' WHEN 'MACHINERY' THEN 'alumni' END"
)


def email(u: str = "user_id") -> str:
    return f"('u' || CAST({u} AS VARCHAR) || '@example.com')"


def phone(u: str = "user_id") -> str:
    return f"('+49' || lpad(CAST(CASE WHEN {u} % 10 = 1 THEN {u} - 1 ELSE {u} END AS VARCHAR), 9, '0'))"


# Canonical events (no invalid rows, no duplicates).
EV = f"""ev AS (
  SELECT event_id, ts, user_id, CAST(user_id AS VARCHAR) AS student_id, event_type, value, props,
         {SOURCE_CASE} AS source
  FROM events)"""

# Bronze: duplicates of event_id % 20 = 0 one second later, unknown source for event_id % 97 = 0.
BRONZE = f"""bronze AS (
  SELECT event_id, ts, user_id, CAST(user_id AS VARCHAR) AS student_id, event_type, value, props,
         CASE WHEN event_id % 97 = 0 THEN 'unknown' ELSE {SOURCE_CASE} END AS source
  FROM events
  UNION ALL
  SELECT event_id, ts + INTERVAL 1 SECOND, user_id, CAST(user_id AS VARCHAR), event_type, value, props,
         CASE WHEN event_id % 97 = 0 THEN 'unknown' ELSE {SOURCE_CASE} END
  FROM events WHERE event_id % 20 = 0)"""

# Identifier rows (event_id, pos, id_type, id_value) in list order per source.
IDS = f"""ids AS (
  SELECT event_id, 0 AS pos, 'session_id' AS id_type, 's_' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 5 AS VARCHAR) AS id_value FROM ev WHERE source = 'website'
  UNION ALL SELECT event_id, 1, 'email', {email()} FROM ev WHERE source = 'website' AND event_id % 4 = 0
  UNION ALL SELECT event_id, 0, 'device_id', 'd_' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 2 AS VARCHAR) FROM ev WHERE source = 'app'
  UNION ALL SELECT event_id, 1, 'email', {email()} FROM ev WHERE source = 'app' AND event_id % 3 = 0
  UNION ALL SELECT event_id, 0, 'email', {email()} FROM ev WHERE source = 'crm'
  UNION ALL SELECT event_id, 1, 'phone', {phone()} FROM ev WHERE source = 'crm'
  UNION ALL SELECT event_id, 2, 'salesforce_id', 'sf_' || CAST(user_id AS VARCHAR) FROM ev WHERE source = 'crm'
  UNION ALL SELECT event_id, 0, 'email', {email()} FROM ev WHERE source = 'email'
  UNION ALL SELECT event_id, 0, 'phone', {phone()} FROM ev WHERE source = 'whatsapp')"""

CHANNELS = """channels AS (
  SELECT * FROM (VALUES (0, 'email'), (1, 'whatsapp'), (2, 'push'), (3, 'sms'), (4, 'analytics'), (5, 'profiling')) t(ch_idx, channel))"""

# Long consent table from customer.
CONSENT = f"""{CHANNELS},
consent AS (
  SELECT CAST(c_custkey AS VARCHAR) AS student_id, channel, ((c_custkey * 31 + ch_idx) % 3 <> 0) AS consented
  FROM customer CROSS JOIN channels WHERE c_custkey % 7 <> 0)"""


def round2(x: str) -> str:
    return f"(floor(({x}) * 100.0 + 0.5) / 100.0)"


def score(last: str, total: str, as_of: str = AS_OF) -> str:
    days = f"greatest((epoch_us({as_of}) - epoch_us({last})) / {MICROS_PER_DAY}, 0.0)"
    rec = f"(CASE WHEN {last} IS NULL THEN 0.0 ELSE 100.0 * exp(-0.693 * {days} / 14.0) END)"
    freq = f"least(100.0, CAST({total} AS DOUBLE) * 2.5)"
    return round2(f"0.55 * {rec} + 0.45 * {freq}")


def band(s: str) -> str:
    return (
        f"(CASE WHEN {s} >= 70.0 AND {s} < 100.0 THEN 'highly_engaged' "
        f"WHEN {s} >= 40.0 AND {s} < 70.0 THEN 'moderately_engaged' "
        f"WHEN {s} >= 15.0 AND {s} < 40.0 THEN 'at_risk' "
        f"WHEN {s} >= 0.0 AND {s} < 15.0 THEN 'dormant' END)"
    )


def ts_str(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"
