"""DuckDB equivalents of the registered queries, stated on the given tables.

Raw lines are rendered and matched again in SQL. Structured rows are not: what their counts
must be follows from the events.
"""

from __future__ import annotations

_EVENT = """
event AS (
  SELECT *,
    strftime(ts, '%Y-%m-%d %H') AS date_hour,
    strftime(ts, '%Y-%m-%d') AS day,
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS error_type,
    CASE WHEN value < 30 THEN 'HDFS' ELSE 'BGL' END AS source
  FROM events
)"""

_COUNTS = _EVENT + """,
counts AS (
  SELECT date_hour, error_type, source, count(*) AS total_count FROM event GROUP BY ALL
)"""


def _features(counts: str = "counts", bucket: str = "source, date_hour") -> str:
    """Features as window functions over the counts."""
    return f"""
measured AS (
  SELECT date_hour, error_type, source, total_count::DOUBLE AS f,
    sum(total_count::DOUBLE) OVER (PARTITION BY {bucket}) AS total,
    lag(total_count::DOUBLE, 1, 0.0) OVER (PARTITION BY source, error_type ORDER BY date_hour) AS before,
    avg(total_count::DOUBLE) OVER (PARTITION BY source, error_type)
      + coalesce(stddev_samp(total_count::DOUBLE) OVER (PARTITION BY source, error_type), 0.0) AS level
  FROM {counts}
),
flagged AS (
  SELECT date_hour, error_type, source, f AS error_frequency,
    round(f / total, 4) AS error_distribution,
    CASE WHEN before = 0 THEN 0.0 ELSE round((f - before) / before, 4) END AS rate_of_change,
    CASE WHEN f > level THEN 1 ELSE 0 END AS high_error_flag
  FROM measured
),
features AS (
  SELECT *, CASE WHEN high_error_flag = 1 AND error_distribution > 0.4 THEN 1 ELSE 0 END AS label
  FROM flagged
)"""


_FEATURES = _COUNTS + "," + _features()


def _whole_number_flags(counts: str, frame: str) -> str:
    """Flags decided in whole numbers of 128 bits."""
    over = f"OVER (PARTITION BY source, error_type {frame})"
    return f"""
exact AS (
  SELECT date_hour, error_type, source, total_count::HUGEINT AS f, count(*) {over} AS n,
    sum(total_count::HUGEINT) {over} AS s, sum(total_count::HUGEINT * total_count::HUGEINT) {over} AS q
  FROM {counts}
),
high AS (
  SELECT date_hour, error_type, source, f::DOUBLE AS error_frequency,
    CASE WHEN n > 1 AND n * f > s AND (n * f - s) * (n * f - s) * (n - 1) > n * (n * q - s * s) THEN 1 ELSE 0 END AS high_error_flag
  FROM exact
)"""


_SO_FAR = "ORDER BY date_hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_AS_OF = _FEATURES.replace("features AS (", "known AS (") + "," + _whole_number_flags("counts", _SO_FAR) + """,
features AS (
  SELECT known.* REPLACE (high.high_error_flag AS high_error_flag,
    CASE WHEN high.high_error_flag = 1 AND error_distribution > 0.4 THEN 1 ELSE 0 END AS label)
  FROM known JOIN high USING (date_hour, error_type, source)
)"""

_BLANKS = r" \t\n\x0B\f\r"
_TOKEN, _GAP = f"([^{_BLANKS}]+)", f"[{_BLANKS}]+"
_REST = rf"[{_BLANKS}]*([^\n\r\x{{85}}\x{{2028}}\x{{2029}}]*)$"
_HDFS_PATTERN = f"^{(_TOKEN + _GAP) * 4}([^:]+):{_REST}"
_FIVE = "(" + _GAP.join([f"[^{_BLANKS}]+"] * 5) + ")"
_BGL_PATTERN = f"^{(_TOKEN + _GAP) * 2}{_FIVE}{_GAP}{_TOKEN}{_GAP}{_TOKEN}{_REST}"

_HDFS_LINES = _EVENT + """,
start AS (
  SELECT *, strftime(ts, '%y%m%d %H%M%S') || ' ' || user_id || ' ' || error_type AS head FROM event
),
good AS (
  SELECT *, head || ' svc.' || event_type || ': value=' || event_id || ', props ' || props AS line FROM start
),
lines AS (
  SELECT line AS value FROM good
  UNION ALL
  SELECT CASE event_type
    WHEN 'click' THEN ' ' || chr(9) || ' '
    WHEN 'error' THEN 'corrupted'
    WHEN 'purchase' THEN head || ' no separator'
    WHEN 'signup' THEN ' ' || line
    ELSE line || chr(133) END
  FROM good
)"""

_BGL_LINES = _EVENT + """,
start AS (
  SELECT *, '- ' || floor(epoch(ts))::BIGINT || ' ' || strftime(ts, '%Y.%m.%d') || ' R' || user_id || ' '
    || strftime(ts, '%Y-%m-%d-%H.%M.%S.%f') || ' R' || user_id || ' RAS ' || upper(event_type) AS head
  FROM event
),
good AS (SELECT *, head || ' ' || error_type || '  props ' || props AS line FROM start),
lines AS (
  SELECT line AS value FROM good
  UNION ALL
  SELECT CASE event_type
    WHEN 'click' THEN chr(9)
    WHEN 'error' THEN head
    WHEN 'purchase' THEN head || ' ' || error_type
    WHEN 'signup' THEN ' ' || line
    ELSE line || chr(133) END
  FROM good
)"""

_HDFS_FIELDS = ("log_date", "log_time", "pid", "log_level", "component", "message")
_BGL_FIELDS = ("alert_flag", "timestamp_raw", "log_date", "node", "component", "message")


def _parsed(pattern: str, fields: tuple[str, ...]) -> str:
    names = ", ".join(f"'{name}'" for name in fields)
    return f"""
parsed AS (
  SELECT unnest(regexp_extract(value, '{pattern}', [{names}]))
  FROM lines WHERE regexp_matches(value, '{pattern}')
)"""


def _status(pattern: str) -> str:
    return (
        f"CASE WHEN regexp_matches(value, '{pattern}') THEN 'parsed' "
        r"WHEN regexp_matches(value, '[^\x00-\x20]') THEN 'malformed' ELSE 'blank' END"
    )


_BGL_CSV_COUNTS = _EVENT + """,
counts AS (
  SELECT date_hour, error_type, 'BGL' AS source, count(*) AS total_count FROM event GROUP BY ALL
  UNION ALL
  SELECT day, 'DAILY', 'BGL', count(*) FROM event WHERE event_type = 'view' GROUP BY ALL
)"""

_HDFS_CSV_COUNTS = _EVENT + """,
counts AS (
  SELECT day AS date_hour, error_type, 'HDFS' AS source, count(*) AS total_count FROM event GROUP BY ALL
)"""

_ALL = "SELECT date_hour, error_type, source, total_count FROM counts"

_RAISED = "FROM features WHERE high_error_flag = 1"

_ORDER = "error_frequency DESC, date_hour, error_type, source"


def _prompt(velocity: str = "") -> str:
    return f"""'A monitored cluster shows an unusual number of errors.' || chr(10)
    || 'Log source: ' || source || chr(10)
    || 'Error signature: "' || error_type || '"' || chr(10)
    || 'Occurrences in the window: ' || error_frequency::DECIMAL(20,1)::VARCHAR || chr(10)
    {velocity}|| 'Answer with:' || chr(10)
    || '1. the most likely root cause in ' || source || ';' || chr(10)
    || '2. two concrete steps for the administrator on duty.'"""


_VELOCITY = (
    "|| 'Change against the previous window: ' || printf('%.4f', rate_of_change) || chr(10)\n    "
)


def _feature(name: str) -> str:
    return f"WITH {_FEATURES} SELECT date_hour, error_type, source, error_frequency, {name} FROM features"


_IN_TRAINING = (
    "('0x' || substr(md5(date_hour || ',' || error_type || ',' || source), 1, 8))::BIGINT % 10 < 8"
)

_PART_OF_DAY = "strftime(ts, '%y%m%d')"
_PART_OF_TIME = "strftime(ts, '%H%M%S')"

ORACLES: dict[str, str] = {
    "hdfs_parse": f"WITH {_HDFS_LINES},{_parsed(_HDFS_PATTERN, _HDFS_FIELDS)} SELECT * FROM parsed",
    "hdfs_rejects": f"""WITH {_HDFS_LINES}
SELECT value, {_status(_HDFS_PATTERN)} AS reason FROM lines
WHERE NOT regexp_matches(value, '{_HDFS_PATTERN}')""",
    "bgl_parse": f"WITH {_BGL_LINES},{_parsed(_BGL_PATTERN, _BGL_FIELDS)} SELECT * FROM parsed",
    "bgl_details": f"""WITH {_BGL_LINES},{_parsed(_BGL_PATTERN, _BGL_FIELDS)}
SELECT alert_flag, timestamp_raw, component AS severity, node AS facility,
  split_part(log_date, ' ', 2) AS node_id, split_part(log_date, ' ', 3) AS event_time, message
FROM parsed""",
    "parse_rejects": f"""
WITH hdfs AS (WITH {_HDFS_LINES} SELECT 'HDFS' AS source, {_status(_HDFS_PATTERN)} AS status FROM lines),
bgl AS (WITH {_BGL_LINES} SELECT 'BGL' AS source, {_status(_BGL_PATTERN)} AS status FROM lines)
SELECT source, status, count(*) AS total_lines
FROM (SELECT * FROM hdfs UNION ALL SELECT * FROM bgl) GROUP BY ALL""",
    "document_lines": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS value FROM documents
),
classified AS (
  SELECT doc_id, value, {_status(_HDFS_PATTERN)} AS status FROM lines
)
SELECT doc_id,
  count(*) FILTER (status = 'parsed') AS parsed_lines,
  count(*) FILTER (status = 'blank') AS blank_lines,
  count(*) FILTER (status = 'malformed') AS malformed_lines,
  sum(length(regexp_extract(value, '{_HDFS_PATTERN}', 5))) FILTER (status = 'parsed')::BIGINT AS component_chars,
  sum(length(regexp_extract(value, '{_HDFS_PATTERN}', 6))) FILTER (status = 'parsed')::BIGINT AS message_chars
FROM classified GROUP BY doc_id""",
    "records_from_files": f"WITH {_HDFS_LINES},{_parsed(_HDFS_PATTERN, _HDFS_FIELDS)} SELECT * FROM parsed",
    "records_text": f"""WITH {_BGL_LINES},{_parsed(_BGL_PATTERN, _BGL_FIELDS)}
SELECT alert_flag || ',' || timestamp_raw || ',' || log_date || ',' || node || ',' || component || ',' || message
  AS value FROM parsed""",
    "hourly_counts": f"WITH {_COUNTS} {_ALL}",
    "csv_split": f"""
WITH {_EVENT},
content AS (
  SELECT *, '"m, ' || event_type || ' ' || replace(props, '"', '""') || '"' AS content,
    {_PART_OF_DAY} AS d, {_PART_OF_TIME} AS t
  FROM event
)
SELECT event_id || ', ' || d || ' ,' || t || ',"' || user_id || ',x",x, ' || error_type || ' ,' || content AS value,
  7 AS token_count,
  event_id || '| ' || d || ' |' || t || '|"' || user_id || ',x"|x| ' || error_type || ' |' || content AS tokens
FROM content
UNION ALL
SELECT CASE event_type
    WHEN 'click' THEN 'LineId,Date,Time,Pid,x,Level,Content'
    WHEN 'error' THEN '1,2'
    WHEN 'purchase' THEN '7,' || d || ',' || t || ',q,,,,'
    WHEN 'signup' THEN ' ' || chr(9)
    ELSE '8,' || d || ',' || t || ',p,"x,ERROR,m' END,
  CASE event_type WHEN 'click' THEN 7 WHEN 'error' THEN 2 WHEN 'purchase' THEN 4 WHEN 'signup' THEN 1 ELSE 3 END,
  CASE event_type
    WHEN 'click' THEN 'LineId|Date|Time|Pid|x|Level|Content'
    WHEN 'error' THEN '1|2'
    WHEN 'purchase' THEN '7|' || d || '|' || t || '|q'
    WHEN 'signup' THEN ' ' || chr(9)
    ELSE '8,' || d || ',' || t || ',p,"x|ERROR|m' END
FROM content""",
    "counts_hdfs_csv": f"WITH {_HDFS_CSV_COUNTS} {_ALL}",
    "counts_bgl_csv": f"WITH {_BGL_CSV_COUNTS} {_ALL}",
    "csv_rejects": """
SELECT 'HDFS' AS source,
  CASE event_type WHEN 'click' THEN 'header' WHEN 'signup' THEN 'blank' ELSE 'short' END AS reason,
  count(*) AS total_lines
FROM events GROUP BY ALL
UNION ALL
SELECT 'BGL',
  CASE event_type WHEN 'click' THEN 'header' WHEN 'signup' THEN 'blank' ELSE 'short' END,
  count(*)
FROM events WHERE event_type <> 'view' GROUP BY ALL""",
    "counts_by_path": f"""WITH {_EVENT}
SELECT CASE source WHEN 'HDFS' THEN day ELSE date_hour END AS date_hour, error_type, source,
  count(*) AS total_count FROM event GROUP BY ALL
UNION ALL
SELECT 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', count(*) FROM event WHERE event_type = 'signup'""",
    "counts_by_header": f"WITH {_COUNTS} {_ALL}",
    "hourly_hdfs": f"""WITH {_EVENT}
SELECT strftime(ts, '%Y-%m-%d-%H') AS date_hour, error_type, 'HDFS' AS source, count(*) AS total_count
FROM event GROUP BY ALL""",
    "counts_from_records": f"""WITH {_EVENT}
SELECT day AS date_hour, error_type, 'HDFS' AS source, count(*) AS total_count FROM event GROUP BY ALL
UNION ALL
SELECT date_hour, error_type, 'BGL', count(*) FROM
  (SELECT date_hour, error_type FROM event
   UNION ALL SELECT date_hour, error_type FROM event WHERE event_type = 'purchase')
GROUP BY ALL""",
    "bucket_times": f"""WITH {_BGL_CSV_COUNTS},
both_counts AS (
  SELECT date_hour, total_count FROM counts
  UNION ALL
  SELECT date_hour, count(*) FROM event GROUP BY date_hour, error_type, source
)
SELECT date_hour, sum(total_count)::BIGINT AS total_count,
  CASE WHEN length(date_hour) = 13 THEN date_hour || ':00:00'
       WHEN length(date_hour) = 10 THEN date_hour || ' 00:00:00' END AS starts_at
FROM both_counts GROUP BY date_hour""",
    "counts_wire": f"""WITH {_COUNTS}
SELECT date_hour || ',' || error_type || ',' || source || ',' || total_count AS value FROM counts""",
    "counts_from_wire": f"""WITH {_COUNTS}
SELECT date_hour, error_type, source, total_count FROM counts""",
    "wire_rejects": f"""WITH {_COUNTS}
SELECT 'bad_count' AS status, count(*) AS total_lines FROM events
UNION ALL SELECT 'short', count(*) FROM events WHERE event_type = 'signup'
UNION ALL SELECT 'counted', count(*) FROM counts""",
    "counts_preview": f"""WITH {_COUNTS} {_ALL}
ORDER BY date_hour || ',' || error_type || ',' || source LIMIT 20""",
    "features_full": f"WITH {_FEATURES} SELECT * FROM features",
    "feat_distribution": _feature("error_distribution"),
    "feat_rate_of_change": _feature("rate_of_change"),
    "feat_high_flag": _feature("high_error_flag"),
    "risk_label": _feature("label"),
    "features_daily": f"WITH {_HDFS_CSV_COUNTS},{_features()} SELECT * FROM features",
    "features_from_files": f"WITH {_FEATURES} SELECT * FROM features",
    "distribution_cluster": f"WITH {_COUNTS},{_features(bucket='date_hour')} SELECT * FROM features",
    "label_horizon": f"""WITH {_FEATURES},
hours AS (
  SELECT * EXCLUDE (label), epoch(strptime(date_hour, '%Y-%m-%d %H'))::BIGINT // 3600 AS hour_no FROM features
)
SELECT * EXCLUDE (hour_no), coalesce(max(high_error_flag) OVER (
    PARTITION BY source, error_type ORDER BY hour_no RANGE BETWEEN 1 FOLLOWING AND 2 FOLLOWING), 0) AS label
FROM hours""",
    "features_preview": f"""WITH {_FEATURES}
SELECT * EXCLUDE (label) FROM features ORDER BY date_hour, source, error_type LIMIT 20""",
    "source_index": f"""WITH {_COUNTS}
SELECT source, (row_number() OVER (ORDER BY count(*) DESC, source) - 1)::DOUBLE AS source_index,
  count(*) AS total_rows FROM counts GROUP BY source""",
    "split_assignment": f"""WITH {_COUNTS}
SELECT date_hour, error_type, source, CASE WHEN {_IN_TRAINING} THEN 1 ELSE 0 END AS in_training
FROM counts""",
    "scored_rows": f"""WITH {_FEATURES}
SELECT date_hour, error_type, source, error_frequency, label, 1 AS sound
FROM features WHERE NOT {_IN_TRAINING}""",
    "feature_rows": f"""WITH {_FEATURES},
ranks AS (
  SELECT source, (row_number() OVER (ORDER BY count(*) DESC, source) - 1)::DOUBLE AS source_index
  FROM features GROUP BY source
)
SELECT date_hour, error_type, source, error_frequency, error_distribution, rate_of_change,
  high_error_flag, source_index, label
FROM features JOIN ranks USING (source)""",
    "metrics_flag_as_predictor": f"""WITH {_FEATURES},
classes AS (
  SELECT k, (SELECT count(*) FROM features WHERE label = k) AS s,
    (SELECT count(*) FROM features WHERE high_error_flag = k) AS p,
    (SELECT count(*) FROM features WHERE label = k AND high_error_flag = k) AS t,
    (SELECT count(*) FROM features) AS n
  FROM (VALUES (0), (1)) AS v(k)
)
SELECT round(sum(t / n), 10) AS accuracy,
  round(sum(s / n * CASE WHEN p = 0 THEN 0 ELSE t / p END), 10) AS weighted_precision,
  round(sum(s / n * CASE WHEN s = 0 THEN 0 ELSE t / s END), 10) AS weighted_recall,
  round(sum(s / n * CASE WHEN s + p = 0 THEN 0 ELSE 2 * t / (s + p) END), 10) AS f1
FROM classes""",
    "alerts_topk": f"WITH {_FEATURES} SELECT * {_RAISED} ORDER BY {_ORDER} LIMIT 3",
    "alerts_topk_per_source": f"""WITH {_FEATURES}
SELECT * {_RAISED} QUALIFY row_number() OVER (PARTITION BY source ORDER BY {_ORDER}) <= 3""",
    "alert_display": f"""WITH {_FEATURES}
SELECT date_hour, source, error_type AS error_pattern,
  error_frequency::DECIMAL(20,1)::VARCHAR || ' hits/hr' AS frequency,
  printf('%.2f%%', error_distribution * 100) AS distribution
{_RAISED}""",
    "alert_prompts": f"WITH {_FEATURES} SELECT date_hour, error_type, source, {_prompt()} AS prompt {_RAISED}",
    "alert_prompts_velocity": f"""WITH {_FEATURES}
SELECT date_hour, error_type, source, {_prompt(_VELOCITY)} AS prompt {_RAISED}""",
    "alerts_stored": f"""WITH {_FEATURES}
SELECT *, error_frequency::DECIMAL(20,1)::VARCHAR || ' hits/hr' AS frequency,
  printf('%.2f%%', error_distribution * 100) AS distribution, {_prompt()} AS prompt {_RAISED}
QUALIFY row_number() OVER (PARTITION BY source ORDER BY {_ORDER}) <= 3""",
    "alerts_enriched": f"""WITH {_FEATURES}
SELECT date_hour, error_type, source,
  CASE WHEN error_type <> 'WARN' THEN 'Log source: ' || source || ' / 400' END AS answer,
  CASE WHEN error_type = 'WARN' THEN 'ValueError: refused' END AS error
{_RAISED}""",
}
ORACLES["counts_from_files"] = ORACLES["counts_by_path"]
ORACLES["counts_from_path_list"] = f"""WITH {_EVENT}
SELECT CASE source WHEN 'HDFS' THEN day ELSE date_hour END AS date_hour, error_type, source,
  count(*) AS total_count FROM event GROUP BY ALL"""
ORACLES["bgl_records_from_files"] = ORACLES["bgl_parse"]
ORACLES["counts_and_rejects_from_files"] = """
SELECT 'HDFS' AS source, 'counted' AS status, count(*) AS total_lines FROM events
UNION ALL SELECT 'BGL', 'counted', count(*) + count(*) FILTER (event_type = 'view') FROM events
UNION ALL SELECT * FROM (""" + ORACLES["csv_rejects"] + ")"
ORACLES["counts_by_file_header"] = ORACLES["counts_by_header"]
ORACLES["counts_of_odd_times"] = f"""WITH {_EVENT}
SELECT CASE event_type
    WHEN 'click' THEN ''
    WHEN 'error' THEN 'n/a'
    WHEN 'purchase' THEN {_PART_OF_DAY}
    WHEN 'signup' THEN day || ' 00'
    ELSE printf('%06d', {_PART_OF_DAY}::INT) END AS date_hour,
  error_type, 'HDFS' AS source, count(*) AS total_count
FROM event GROUP BY ALL"""
ORACLES["wire_round_trip"] = f"""WITH {_EVENT}
SELECT date_hour, CASE event_type WHEN 'click' THEN '"a,b"' WHEN 'error' THEN 'x,,y,' WHEN 'purchase' THEN ',z'
    WHEN 'signup' THEN '7,HDFS,9' ELSE 'plain' END AS error_type,
  source, count(*) AS total_count FROM event GROUP BY ALL"""
ORACLES["wire_counts_checked"] = """
SELECT 'bad_count' AS reason, 2 * count(*) - count(*) FILTER (event_type = 'click') AS total_lines FROM events
UNION ALL SELECT 'short', count(*) FROM events WHERE event_type = 'view'
UNION ALL SELECT 'empty_key', count(*) FROM events WHERE event_type = 'click'
UNION ALL SELECT 'sum of counts', sum(event_id)::BIGINT FROM events WHERE event_type = 'click'"""
ORACLES["wire_counts_exact"] = f"""WITH {_EVENT}
SELECT date_hour, error_type, sum(9007199254740992 + event_id)::VARCHAR AS total,
  max(9007199254740992 + event_id) AS largest
FROM event GROUP BY ALL"""
ORACLES["counts_by_own_headers_from_files"] = ORACLES["counts_by_header"]
ORACLES["rejects_located"] = f"""WITH {_HDFS_LINES}
SELECT {_status(_HDFS_PATTERN)} AS reason, count(*) AS total_lines, true AS in_place FROM lines
WHERE NOT regexp_matches(value, '{_HDFS_PATTERN}') GROUP BY ALL"""


def _horizon(counts: str) -> str:
    """Labels by comparing each row with all flagged ones of its key."""
    return f"""WITH {counts},{_features()},
timed AS (
  SELECT *, epoch(strptime(date_hour || CASE length(date_hour) WHEN 10 THEN ' 00' ELSE '' END, '%Y-%m-%d %H'))::BIGINT
      // 3600 AS starts, CASE length(date_hour) WHEN 10 THEN 24 ELSE 1 END AS hours
  FROM features
)
SELECT * EXCLUDE (starts, hours, label), CASE WHEN EXISTS (
    SELECT 1 FROM timed b WHERE b.source = a.source AND b.error_type = a.error_type AND b.high_error_flag = 1
      AND b.starts >= a.starts + a.hours AND b.starts < a.starts + a.hours + 2) THEN 1 ELSE 0 END AS label
FROM timed a"""


ORACLES["label_horizon_daily"] = _horizon(_HDFS_CSV_COUNTS)
ORACLES["label_horizon_mixed"] = _horizon(_EVENT + """,
counts AS (
  SELECT day AS date_hour, error_type, 'HDFS' AS source, count(*) AS total_count FROM event GROUP BY ALL
  UNION ALL
  SELECT date_hour, error_type, 'HDFS', count(*) FROM event GROUP BY ALL
)""")
ORACLES["risk_metrics_checked"] = f"""WITH {_FEATURES}
SELECT count(*) AS scored_rows, sum(label)::BIGINT AS positives, true AS accurate,
  true AS no_worse_than_the_majority, true AS recall_is_accuracy
FROM features WHERE NOT {_IN_TRAINING}"""
ORACLES["predictions_preview_keys"] = f"""WITH {_FEATURES}
SELECT date_hour, error_type, source, error_frequency, label FROM features WHERE NOT {_IN_TRAINING}
ORDER BY date_hour, error_type, source LIMIT 10"""
ORACLES["alerts_by_stated_model"] = f"""WITH {_FEATURES}
SELECT date_hour, error_type, source, error_frequency, label::DOUBLE AS prediction, error_distribution AS risk
FROM features WHERE label = 1 ORDER BY error_distribution DESC, {_ORDER} LIMIT 10"""
ORACLES["features_ranged"] = ORACLES["features_full"]
ORACLES["features_of_large_counts"] = f"""WITH {_COUNTS},
large AS (SELECT * REPLACE (1099511627776 + total_count AS total_count) FROM counts),{_whole_number_flags("large", "")}
SELECT * FROM high"""
ORACLES["features_as_of"] = f"WITH {_AS_OF} SELECT * FROM features"
ORACLES["label_horizon_as_of"] = f"""WITH {_AS_OF},
hours AS (
  SELECT * EXCLUDE (label), epoch(strptime(date_hour, '%Y-%m-%d %H'))::BIGINT // 3600 AS hour_no FROM features
)
SELECT * EXCLUDE (hour_no), coalesce(max(high_error_flag) OVER (
    PARTITION BY source, error_type ORDER BY hour_no RANGE BETWEEN 1 FOLLOWING AND 2 FOLLOWING), 0) AS label
FROM hours"""
_SIDES = """
timed AS (SELECT *, epoch(strptime(date_hour, '%Y-%m-%d %H'))::BIGINT // 3600 AS hour_no FROM {table}),
cuts AS (SELECT min(hour_no) + (max(hour_no) - min(hour_no) + 1) * 8 // 10 AS cut FROM timed),
sides AS (
  SELECT timed.*, CASE WHEN hour_no >= cut THEN 'test' WHEN hour_no + 3 <= cut THEN 'train' ELSE 'gap' END AS side
  FROM timed, cuts
)"""
ORACLES["time_split_assignment"] = f"""WITH {_COUNTS},{_SIDES.format(table="counts")}
SELECT date_hour, error_type, source, side FROM sides"""
ORACLES["risk_metrics_by_split_checked"] = f"""WITH labelled AS ({ORACLES["label_horizon_as_of"]}),{_SIDES.format(table="labelled")}
SELECT 'key' AS split, count(*) AS scored_rows, sum(label)::BIGINT AS positives,
  true AS near_the_majority_or_better, true AS recall_is_accuracy FROM sides WHERE NOT {_IN_TRAINING}
UNION ALL
SELECT 'time', count(*), sum(label)::BIGINT, true, true FROM sides WHERE side = 'test'"""
ORACLES["risk_by_columns"] = f"""WITH {_COUNTS}
SELECT date_hour, error_type, source, true AS scored, true AS same FROM counts"""
ORACLES["alerts_answered_once"] = ORACLES["alerts_enriched"]
