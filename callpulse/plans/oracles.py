"""The named queries as DuckDB SQL over the same tables.

Written from the definitions, not from the Spark plans: snapshots are generated
from hour bounds and filtered, envelopes are spelt as hexadecimal text, and
averages are taken directly.
"""

from callpulse.plans.fixtures import TENANT

_CALLS = """
e AS (
  SELECT event_id, user_id, event_type,
         date_trunc('millisecond', ts) AS dt_offered,
         CAST(round(value * 100) AS BIGINT) * 100 AS wait_ms,
         60000 + CAST(json_extract_string(props, '$.k') AS BIGINT) * 5000 AS talk_ms
  FROM events
), q AS (
  SELECT *, event_type = 'error' AS abandoned,
         dt_offered + INTERVAL 10 SECOND AS dt_offered_queue,
         dt_offered + INTERVAL 10 SECOND + to_milliseconds(wait_ms) AS q_end
  FROM e
), staged AS (
  SELECT CAST(event_id AS VARCHAR) AS caseId, dt_offered,
         CASE WHEN NOT abandoned THEN q_end + to_milliseconds(talk_ms) END AS dt_handled,
         dt_offered + INTERVAL 5 SECOND AS dt_offered_service,
         dt_offered_queue,
         CASE WHEN NOT abandoned THEN q_end END AS dt_start,
         CASE WHEN abandoned THEN q_end
              ELSE q_end + to_milliseconds(talk_ms + 600000) END AS dt_end,
         'service-' || (user_id % 8) AS services_name,
         CASE WHEN user_id % 3 = 0 THEN '1' ELSE '0' END AS ind_forward_service_previous,
         event_type AS area,
         event_type || '-' || (user_id % 4) AS subarea
  FROM q
), snapshots AS (
  SELECT *, unnest(generate_series(date_trunc('hour', dt_offered),
                                   date_trunc('hour', dt_end) + INTERVAL 1 HOUR,
                                   INTERVAL 5 MINUTE)) AS pubTime
  FROM staged
), calls AS (
  SELECT pubTime, caseId, dt_offered, dt_handled, dt_offered_service, dt_offered_queue,
         dt_start, dt_end, services_name, ind_forward_service_previous, area, subarea
  FROM snapshots WHERE pubTime BETWEEN dt_offered AND dt_end
)"""


def _time_text(name: str) -> str:
    return f"coalesce(strftime({name}, '%Y-%m-%d %H:%M:%S.%g'), '')"


_LINES = f"""
lines AS (
  SELECT *, concat_ws(',', {_time_text('pubTime')}, caseId, {_time_text('dt_offered')},
    {_time_text('dt_handled')}, {_time_text('dt_offered_service')},
    {_time_text('dt_offered_queue')}, {_time_text('dt_start')}, {_time_text('dt_end')},
    services_name, ind_forward_service_previous, area, subarea) AS line,
    CAST(caseId AS BIGINT) AS number
  FROM calls
)"""

_DAMAGED = f"""
damaged AS (
  SELECT *, CASE WHEN number % 97 = 0 THEN 'x,' || line
                 WHEN number % 101 = 0 THEN replace(line, '.', '.9')
                 WHEN number % 103 = 0 THEN substr(line, 24) ELSE line END AS sent,
    CASE WHEN number % 107 = 0 THEN 'bad_envelope' WHEN number % 97 = 0 THEN 'field_count'
         WHEN number % 101 = 0 THEN 'bad_timestamp'
         WHEN number % 103 = 0 THEN 'missing_pub_time' END AS reason
  FROM lines
), framed AS (
  SELECT *, strlen(sent) AS n,
    '0A' || printf('%02X', {len(TENANT)}) || hex('{TENANT}')
      || '12' || printf('%02X', strlen(services_name)) || hex(services_name) AS identity
  FROM damaged
)"""

_HANDLED = "dt_handled <= pubTime"
_SERVED = "dt_start <= pubTime"
_WAITING = "(dt_start IS NULL OR dt_start > pubTime)"
_QUEUED = f"(dt_offered_queue <= pubTime AND {_WAITING})"
_HANDLING_MS = "date_diff('millisecond', dt_offered, dt_handled)"
_QUEUE_MS = "date_diff('millisecond', dt_offered, dt_start)"


def _mean(millis: str, condition: str) -> str:
    total = f"CAST(sum({millis}) FILTER (WHERE {condition}) AS DOUBLE)"
    return f"{total} / count(*) FILTER (WHERE {condition}) / 60000"


_AVG_HANDLING = _mean(_HANDLING_MS, _HANDLED)
_AVG_QUEUE = _mean(_QUEUE_MS, _SERVED)
_QUEUE_SIZE = f"count(*) FILTER (WHERE {_WAITING})"
_RATIO = f"1 - CAST({_QUEUE_SIZE} AS DOUBLE) / count(*)"

_ALL_FIGURES = f"""{_AVG_HANDLING} AS avgCallDuration, {_QUEUE_SIZE} AS queueSize,
  count(*) AS callsAmt, {_RATIO} AS ratioServed, {_AVG_QUEUE} AS queueDuration"""

_KPI_AHT = f"""SELECT pubTime, {_AVG_HANDLING} AS avgCallDuration
FROM calls WHERE {_HANDLED} GROUP BY pubTime"""
_KPI_QAC = f"""SELECT pubTime, {_QUEUE_SIZE} AS queueSize, count(*) AS callsAmt,
  {_RATIO} AS ratioServed FROM calls GROUP BY pubTime"""
_KPI_WT = f"""SELECT pubTime, {_AVG_QUEUE} AS queueDuration
FROM calls WHERE {_SERVED} GROUP BY pubTime"""
_KPI_QPS = f"""SELECT pubTime, services_name AS serviceName,
  CAST(count(*) AS INTEGER) AS amtOfQueuersInService
FROM calls WHERE {_QUEUED} GROUP BY pubTime, services_name"""
_PER_PUB_TIME = f"SELECT pubTime, {_ALL_FIGURES} FROM calls GROUP BY pubTime"

_SERVICE_MESSAGES = f"""
qps AS ({_KPI_QPS}),
service_messages AS (
  SELECT s.pubTime, 'queuers-per-service' AS key,
    '[' || coalesce(string_agg('{{"pubTime":' || epoch_ms(s.pubTime) || ',"serviceName":"'
      || serviceName || '","amtOfQueuersInService":' || amtOfQueuersInService || '}}',
      ',' ORDER BY serviceName) FILTER (WHERE serviceName IS NOT NULL), '') || ']' AS value
  FROM (SELECT DISTINCT pubTime FROM calls) s LEFT JOIN qps ON qps.pubTime = s.pubTime
  GROUP BY s.pubTime
)"""


_FRAMES = f"""
aht AS ({_KPI_AHT}), qac AS ({_KPI_QAC}), wt AS ({_KPI_WT}), messages AS (
  SELECT 'average-handling-time' AS key, '[{{"pubTime":' || epoch_ms(pubTime)
    || ',"avgCallDuration":' || avgCallDuration || '}}]' AS value FROM aht
  UNION ALL SELECT 'queuers-and-callers', '[{{"pubTime":' || epoch_ms(pubTime)
    || ',"queueSize":' || queueSize || ',"callsAmt":' || callsAmt
    || ',"ratioServed":' || ratioServed || '}}]' FROM qac
  UNION ALL SELECT 'wait-time', '[{{"pubTime":' || epoch_ms(pubTime)
    || ',"queueDuration":' || queueDuration || '}}]' FROM wt
  UNION ALL SELECT key, value FROM service_messages
), sized AS (
  SELECT hex(key) AS key_text, hex(value) AS value_text, strlen(value) AS n,
    printf('%02X', strlen(key)) AS key_size,
    '0A' || printf('%02X', {len(TENANT)}) || hex('{TENANT}')
      || '12' || printf('%02X', strlen(key)) || hex(key) AS identity
  FROM messages
), headed AS (
  SELECT *, '0A' || printf('%02X', length(identity) // 2) || identity AS header FROM sized
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join((_CALLS, *parts)) + "\n" + select


def _message(kpi: str, key: str, fields: str) -> str:
    return _with(
        select=f"SELECT '{key}' AS key, epoch_ms(pubTime) AS pubTime, {fields} FROM ({kpi})"
    )


_ORACLES = {
    "call_observations": _with(
        select="""SELECT * FROM calls
WHERE CAST(caseId AS BIGINT) % 97 <> 0 AND CAST(caseId AS BIGINT) % 101 <> 0"""
    ),
    "quarantined_lines": _with(
        _LINES,
        select="""SELECT 'x,' || line AS line, 'field_count' AS reason
FROM lines WHERE number % 97 = 0
UNION ALL SELECT replace(line, '.', '.9'), 'bad_timestamp'
FROM lines WHERE number % 97 <> 0 AND number % 101 = 0""",
    ),
    "call_records_with_metadata": _with(
        _LINES,
        select=f"""SELECT 'calls' AS topic, CAST(number % 4 AS INTEGER) AS partition,
  epoch_ms(pubTime) // 300000 * 1000000000000 + number AS "offset",
  pubTime AS timestamp, caseId AS key, '{TENANT}' AS tenant,
  services_name AS publisher, line FROM lines""",
    ),
    "envelope_key_roundtrip": _with(
        select="""SELECT pubTime, caseId, area AS tenant, services_name AS publisher,
  ind_forward_service_previous = '1' AS retained,
  CASE WHEN area = 'error' THEN 'RELIABLE' ELSE 'BEST_EFFORT' END AS qos FROM calls"""
    ),
    "envelope_data_roundtrip": _with(
        _LINES,
        select="""SELECT pubTime, line,
  CASE WHEN area = 'error' THEN area END AS traced_area FROM lines""",
    ),
    "kpi_frames": _with(
        _SERVICE_MESSAGES,
        _FRAMES,
        select="""SELECT '0A' || printf('%02X', length(header) // 2) || header
    || '12' || key_size || key_text AS key_hex,
  '0A' || CASE WHEN n < 128 THEN printf('%02X', n)
    WHEN n < 16384 THEN printf('%02X%02X', n % 128 + 128, n // 128)
    ELSE printf('%02X%02X%02X', n % 128 + 128, n // 128 % 128 + 128, n // 16384) END
    || value_text AS value_hex FROM headed""",
    ),
    "publisher_identity": _with(
        select=f"""SELECT '{TENANT}' AS tenant, key AS publisher, key, count(*) AS frames
FROM (
  SELECT DISTINCT pubTime, 'average-handling-time' AS key FROM calls WHERE {_HANDLED}
  UNION ALL SELECT DISTINCT pubTime, 'queuers-and-callers' FROM calls
  UNION ALL SELECT DISTINCT pubTime, 'wait-time' FROM calls WHERE {_SERVED}
  UNION ALL SELECT DISTINCT pubTime, 'queuers-per-service' FROM calls
) GROUP BY key"""
    ),
    "handled_calls": _with(
        select=f"SELECT pubTime, caseId, {_HANDLING_MS} AS handlingMs FROM calls WHERE {_HANDLED}"
    ),
    "waiting_calls": _with(
        select=f"SELECT pubTime, caseId, dt_start FROM calls WHERE {_WAITING}"
    ),
    "served_calls": _with(
        select=f"SELECT pubTime, caseId, {_QUEUE_MS} AS queueMs FROM calls WHERE {_SERVED}"
    ),
    "calls_in_service_queue": _with(
        select=f"SELECT pubTime, caseId, services_name FROM calls WHERE {_QUEUED}"
    ),
    "kpi_average_handling_time": _with(select=_KPI_AHT),
    "kpi_queuers_and_callers": _with(select=_KPI_QAC),
    "kpi_wait_time": _with(select=_KPI_WT),
    "kpi_queuers_per_service": _with(select=_KPI_QPS),
    "kpi_combined": _with(
        f"f AS ({_PER_PUB_TIME})",
        f"s AS ({_KPI_QPS})",
        select="""SELECT pubTime, 'avgCallDuration' AS kpi, CAST(NULL AS VARCHAR) AS dimension,
  avgCallDuration AS value FROM f WHERE avgCallDuration IS NOT NULL
UNION ALL SELECT pubTime, 'queueSize', NULL, CAST(queueSize AS DOUBLE) FROM f
UNION ALL SELECT pubTime, 'callsAmt', NULL, CAST(callsAmt AS DOUBLE) FROM f
UNION ALL SELECT pubTime, 'ratioServed', NULL, ratioServed FROM f
UNION ALL SELECT pubTime, 'queueDuration', NULL, queueDuration FROM f
  WHERE queueDuration IS NOT NULL
UNION ALL SELECT pubTime, 'amtOfQueuersInService', serviceName,
  CAST(amtOfQueuersInService AS DOUBLE) FROM s""",
    ),
    "kpi_per_batch_total": _with(
        select=f"SELECT max(pubTime) AS pubTime, {_ALL_FIGURES} FROM calls"
    ),
    "kpi_empty_input": _with(
        select=f"""SELECT max(pubTime) AS pubTime, {_ALL_FIGURES} FROM calls
WHERE dt_end < dt_offered HAVING count(*) > 0"""
    ),
    "message_average_handling_time": _message(
        _KPI_AHT, "average-handling-time", "avgCallDuration"
    ),
    "message_queuers_and_callers": _message(
        _KPI_QAC, "queuers-and-callers", "queueSize, callsAmt, ratioServed"
    ),
    "message_wait_time": _message(_KPI_WT, "wait-time", "queueDuration"),
    "message_queuers_per_service": _with(
        _SERVICE_MESSAGES, select="SELECT key, value FROM service_messages"
    ),
    "stream_call_observations": _with(select="SELECT * FROM calls"),
    "stream_kpi_per_batch": _with(select=_PER_PUB_TIME),
    "stream_kpi_windowed": _with(
        "w AS (SELECT *, time_bucket(INTERVAL 15 MINUTE, pubTime) AS windowStart FROM calls)",
        """l AS (SELECT *, max(pubTime) OVER (PARTITION BY windowStart) AS last FROM w)""",
        select=f"""SELECT windowStart, windowStart + INTERVAL 15 MINUTE AS windowEnd, pubTime,
  {_ALL_FIGURES} FROM l WHERE pubTime = last GROUP BY windowStart, pubTime""",
    ),
    "stream_publish_figures": _with(
        _SERVICE_MESSAGES,
        f"f AS ({_PER_PUB_TIME})",
        select="""SELECT 'average-handling-time' AS key, epoch_ms(pubTime) AS pubTime,
  avgCallDuration, CAST(NULL AS BIGINT) AS queueSize, CAST(NULL AS BIGINT) AS callsAmt,
  CAST(NULL AS DOUBLE) AS ratioServed, CAST(NULL AS DOUBLE) AS queueDuration,
  CAST(NULL AS VARCHAR) AS services FROM f WHERE avgCallDuration IS NOT NULL
UNION ALL SELECT 'queuers-and-callers', epoch_ms(pubTime), NULL, queueSize, callsAmt,
  ratioServed, NULL, NULL FROM f
UNION ALL SELECT 'wait-time', epoch_ms(pubTime), NULL, NULL, NULL, NULL, queueDuration, NULL
FROM f WHERE queueDuration IS NOT NULL
UNION ALL SELECT key, epoch_ms(pubTime), NULL, NULL, NULL, NULL, NULL, value
FROM service_messages WHERE value <> '[]'""",
    ),
    "stream_quarantine": _with(
        _LINES,
        _DAMAGED,
        select=f"""SELECT 'calls' AS topic, CAST(number % 4 AS INTEGER) AS partition,
  epoch_ms(pubTime) // 300000 * 1000000000000 + number AS "offset",
  pubTime AS timestamp,
  '0A' || printf('%02X', length(identity) // 2 + 2) || '0A'
    || printf('%02X', length(identity) // 2) || identity
    || '12' || printf('%02X', strlen(caseId)) || hex(caseId) AS key_hex,
  CASE WHEN reason = 'bad_envelope' THEN 'FF' ELSE '' END || '0A'
    || CASE WHEN n < 128 THEN printf('%02X', n)
       ELSE printf('%02X%02X', n % 128 + 128, n // 128) END || hex(sent) AS value_hex,
  reason FROM framed WHERE reason IS NOT NULL""",
    ),
    "stream_accounting": _with(
        _LINES,
        _DAMAGED,
        select="""SELECT 'read' AS records, count(*) AS n FROM framed
UNION ALL SELECT 'used', count(*) FROM framed WHERE reason IS NULL
UNION ALL SELECT 'set_aside', count(*) FROM framed WHERE reason IS NOT NULL""",
    ),
    "stream_replay": _with(select=_PER_PUB_TIME),
    "stream_outbox": _with(
        """d AS (
  SELECT *, (epoch_ms(pubTime) // 300000 * 1000000000000 + CAST(caseId AS BIGINT)) % 3
    AS delivery FROM calls
), versions AS (SELECT DISTINCT pubTime AS snapshot, delivery AS version FROM d
), known AS (SELECT d.*, version FROM d JOIN versions ON pubTime = snapshot AND delivery <= version)""",
        f"f AS (SELECT version, pubTime, {_ALL_FIGURES} FROM known GROUP BY version, pubTime)",
        f"""waiting AS (
  SELECT version, pubTime, services_name AS service, count(*) AS n
  FROM known WHERE {_QUEUED} GROUP BY version, pubTime, services_name
), lists AS (
  SELECT version, pubTime, '[' || string_agg('{{"pubTime":' || epoch_ms(pubTime)
    || ',"serviceName":"' || service || '","amtOfQueuersInService":' || n || '}}',
    ',' ORDER BY service) || ']' AS services FROM waiting GROUP BY version, pubTime
), m AS (
  SELECT 'average-handling-time' AS key, pubTime, version, avgCallDuration,
    CAST(NULL AS BIGINT) AS queueSize, CAST(NULL AS BIGINT) AS callsAmt,
    CAST(NULL AS DOUBLE) AS ratioServed, CAST(NULL AS DOUBLE) AS queueDuration,
    CAST(NULL AS VARCHAR) AS services FROM f WHERE avgCallDuration IS NOT NULL
  UNION ALL SELECT 'queuers-and-callers', pubTime, version, NULL, queueSize, callsAmt,
    ratioServed, NULL, NULL FROM f
  UNION ALL SELECT 'wait-time', pubTime, version, NULL, NULL, NULL, NULL, queueDuration, NULL
    FROM f WHERE queueDuration IS NOT NULL
  UNION ALL SELECT 'queuers-per-service', pubTime, version, NULL, NULL, NULL, NULL, NULL,
    services FROM lists
)""",
        select="""SELECT key, epoch_ms(pubTime) AS pubTime, version, CAST(1 AS BIGINT) AS sent,
  avgCallDuration, queueSize, callsAmt, ratioServed, queueDuration, services FROM m""",
    ),
    "stream_restart": _with(select=_PER_PUB_TIME),
    "stream_store_compaction": _with(select=_PER_PUB_TIME),
    "stream_lost_checkpoint": _with(select=_PER_PUB_TIME),
    "stream_windows_live": _with(
        """w AS (
  SELECT *, time_bucket(INTERVAL 15 MINUTE, pubTime) AS windowStart,
    windowStart + INTERVAL 15 MINUTE AS windowEnd,
    date_diff('day', DATE '1970-01-01', CAST(pubTime AS DATE)) % 2 AS delivery
  FROM calls
), marks AS (
  SELECT max(pubTime) FILTER (WHERE delivery = 0) - INTERVAL 1 HOUR AS first_mark,
    max(pubTime) - INTERVAL 1 HOUR AS last_mark FROM w
), k AS (
  SELECT *, CASE WHEN delivery = 1 AND windowEnd <= first_mark THEN 'late'
                 WHEN windowEnd <= last_mark THEN 'closed' ELSE 'open' END AS kind,
    max(pubTime) OVER (PARTITION BY windowStart) AS last
  FROM w, marks
)""",
        select=f"""SELECT 'late' AS kind, windowStart, windowEnd, max(pubTime) AS pubTime,
  count(*) AS observations, CAST(NULL AS DOUBLE) AS avgCallDuration,
  CAST(NULL AS BIGINT) AS queueSize, CAST(NULL AS BIGINT) AS callsAmt,
  CAST(NULL AS DOUBLE) AS ratioServed, CAST(NULL AS DOUBLE) AS queueDuration
FROM k WHERE kind = 'late' GROUP BY windowStart, windowEnd
UNION ALL SELECT kind, windowStart, windowEnd, pubTime,
  any_value(observed), {_ALL_FIGURES}
FROM (SELECT *, count(*) OVER (PARTITION BY windowStart) AS observed FROM k)
WHERE kind <> 'late' AND pubTime = last GROUP BY kind, windowStart, windowEnd, pubTime""",
    ),
}
_ORACLES["stream_snapshot_state"] = _ORACLES["stream_publish_figures"]
_ORACLES["stream_kpi_combined"] = _ORACLES["kpi_combined"]
_ORACLES["stream_kpi_current"] = f"""SELECT * FROM ({_ORACLES['kpi_combined']})
WHERE pubTime = (SELECT max(pubTime) FROM ({_ORACLES['kpi_combined']}))"""


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
