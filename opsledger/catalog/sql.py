"""SQL of the test-table mappings, written independently of the Spark expressions for the oracle."""

from __future__ import annotations

# the rendered device-log lines
DEVICE_LINES = r"""
ev AS (
  SELECT event_id, ts, user_id AS u, event_type AS kind, CAST(floor(value) AS BIGINT) AS v FROM events
),
ev2 AS (
  SELECT *, chr(CAST(97 + v % 26 AS INTEGER)) || chr(CAST(97 + (v // 26) % 26 AS INTEGER)) AS stage,
         strftime(ts, '%m-%d %H:%M:%S.%f') AS full_stamp
  FROM ev
),
device_lines AS (
  SELECT event_id AS "key", ts AS event_ts, u, 'device_' || (u % 30) AS topic,
    (CASE WHEN v % 11 = 3 THEN 'no-stamp' WHEN u % 3 = 0 THEN left(full_stamp, 18) ELSE full_stamp END)
    || ' ' || (10000 + u) || ' 12345 '
    || (CASE kind WHEN 'error' THEN 'E' WHEN 'signup' THEN 'W' WHEN 'purchase' THEN 'D' ELSE 'I' END)
    || ' ' ||
    (CASE WHEN v % 13 = 5 THEN 'truncated' ELSE 'svc_' || kind || ': ' ||
      CASE kind
        WHEN 'error' THEN 'error code:' || v || ' stage ' || stage
        WHEN 'signup' THEN 'warning: retry ' || v || ' pair id: p' || u || ' stage ' || stage
        WHEN 'purchase' THEN ':: session_id: s' || u || ' commit ' || stage
        WHEN 'click' THEN '[::' || v || '] crash dump ' || stage || ' info'
        ELSE 'frame ' || v || ' rendered' END END) AS value
  FROM ev2
)"""

# lines with their parsed instant and raw message
DEVICE_PARSED = DEVICE_LINES + r""",
matched AS (
  SELECT *,
    regexp_extract(value, '(\d{2}-\d{2}\s\d{2}:\d{2}:\d{2}\.\d{0,6})', 1) AS stamp,
    CASE WHEN regexp_matches(value, '[IDEW]\D{0,100}?:') THEN regexp_extract(value, '[IDEW]\D{0,100}?:(.*)', 1) END AS raw
  FROM device_lines
),
parsed AS (
  SELECT "key", event_ts, u, topic, value, raw,
    CASE WHEN stamp <> '' THEN strptime('2024-' || rpad(stamp, 21, '0'), '%Y-%m-%d %H:%M:%S.%f') END AS ts,
    trim(regexp_replace(raw, '\d', '', 'g')) AS message
  FROM matched
),
good AS (SELECT *, length(message) AS char_count FROM parsed WHERE ts IS NOT NULL AND message IS NOT NULL)"""

CODES = """
codes(message, code) AS (VALUES
  ('error code: stage aa', 100009), ('error code: stage ba', 100002),
  ('warning: retry  pair id: p stage ca', 100003), ('frame  rendered', 100004))"""

DEVICES = """
devices AS (
  SELECT 'device_' || n_nationkey AS topic, '10.0.' || n_nationkey || '.1' AS ip, r_name AS realm, n_name AS model
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

NORMAL_MESSAGE = r"""trim(regexp_replace(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace({raw}, '\d', '', 'g'),
    '(\s):{{0,2}}', '\1 ', 'g'), '(\W):+', '\1', 'g'), '\s{{2,}}', ' ', 'g'),
  'session_id:\s\S*| pair\sid:\s\S*| notification_id:\s\S*| event_id:\s\S*| action_queue:\s\S', '', 'g'))"""

ACCESS_LINES = r"""
ev AS (
  SELECT event_id, ts, user_id AS u, event_type AS kind, CAST(floor(value) AS BIGINT) AS v,
    event_id % (SELECT count(*) FROM pages) AS visited
  FROM events
),
access_lines AS (
  SELECT event_id AS "key", ts AS event_ts, u, v, kind, url,
    (CASE WHEN u % 10 = 0 THEN '' ELSE '10.0.' || (u // 256) || '.' || (u % 256) END)
    || ' - user' || u
    || (CASE WHEN v % 19 = 6 THEN '' ELSE ' [' ||
         (CASE WHEN v % 23 = 7 THEN 'bad date' ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000' END) || ']' END)
    || ' "' || (CASE WHEN v % 29 = 8 THEN 'GET' ELSE 'GET ' || url || ' HTTP/1.1' END) || '" '
    || (CASE WHEN v % 17 = 4 THEN '404' ELSE CASE kind WHEN 'error' THEN '500' WHEN 'signup' THEN '302'
         WHEN 'purchase' THEN '201' ELSE '200' END END)
    || ' ' || (CASE WHEN v % 9 = 0 THEN '-' ELSE CAST(v * 100 AS VARCHAR) END)
    || ' "-" "Browser/' || (u % 5) || ' (test)"' AS value
  FROM ev JOIN pages ON page_id = visited
),
access_fields AS (
  SELECT "key", value,
    regexp_matches(value, '^((?:\d{1,3}\.){3}\d{1,3})? \S+ \S+ \[.+?\] ".*?" \d{3} \S+ ".*?" ".*?"$') AS ok,
    regexp_extract(value, '^((?:\d{1,3}\.){3}\d{1,3})? ', 1) AS ip,
    regexp_extract(value, '\[(.*?) .+\]', 1) AS date_text,
    regexp_extract(value, '"(.*?)" \d{3} ', 1) AS request,
    regexp_extract(value, '" (\d{3}) ', 1) AS status_text,
    regexp_extract(value, '" \d{3} (\S+) "', 1) AS bytes_text,
    regexp_extract(value, '"([^"]*)"$', 1) AS agent
  FROM access_lines
),
access_parsed AS (
  SELECT "key", value, ok, ip,
    try_strptime(date_text, '%d/%b/%Y:%H:%M:%S') AS ts,
    CASE WHEN len(string_split(request, ' ')) = 3 THEN split_part(request, ' ', 2) END AS url,
    CAST(status_text AS INTEGER) AS status, TRY_CAST(bytes_text AS BIGINT) AS bytes, agent
  FROM access_fields
),
entries AS (SELECT * FROM access_parsed WHERE ok AND ts IS NOT NULL)"""

RETURNS = r"""
described AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_linenumber || '-' || l_partkey || '-' || l_suppkey AS internal_id,
    'RMA' || l_orderkey AS document_number,
    CASE o_orderstatus || l_linestatus WHEN 'FF' THEN 'Pending Receipt' WHEN 'FO' THEN 'Pending Approval'
      WHEN 'OF' THEN 'Pending Receive' WHEN 'OO' THEN 'Closed' WHEN 'PF' THEN 'RMA Cancelled' ELSE 'Received' END AS status,
    CASE l_returnflag || left(o_orderpriority, 1)
      WHEN 'R1' THEN 'Failed Unit' WHEN 'R2' THEN 'Failed Unit' WHEN 'R3' THEN 'Loaner / Failed Unit'
      WHEN 'R4' THEN 'Loaner Return' WHEN 'R5' THEN 'Eval Unit' WHEN 'A1' THEN 'Unopened Return'
      WHEN 'A2' THEN 'Preemptive Return' WHEN 'A3' THEN 'Return for Upgrade' WHEN 'A4' THEN 'Below Spec'
      WHEN 'A5' THEN 'Retrofit' WHEN 'N1' THEN 'Recalibration' WHEN 'N2' THEN 'wrong sensor sent'
      WHEN 'N3' THEN 'None' WHEN 'N4' THEN 'Swap Program'
      ELSE CASE WHEN l_linestatus = 'F' THEN 'Did not meet customer req' ELSE 'Cancelled' END END AS category,
    p_brand || (CASE WHEN p_size % 2 = 1 THEN ' GEN2' ELSE '' END) AS description,
    CASE p_type WHEN 'ECONOMY' THEN 'ODU ' || p_name WHEN 'SMALL' THEN 'SINBON ' || p_name
      WHEN 'MEDIUM' THEN 'OS-1 Sensor' WHEN 'PROMO' THEN 'OS1-64 No iBox' WHEN 'STANDARD' THEN 'GEN2 ' || p_name
      ELSE 'Sinbon ' || p_name END AS display_name,
    -l_quantity AS quantity, l_shipdate AS created_at, c_name AS customer,
    p_name || ' ' || replace(o_orderpriority, '-', ' ') AS clean_reason,
    p_name || ', ' || replace(o_orderpriority, '-', '') AS row_reason
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY document_number ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
  FROM described
),
documents_kept AS (SELECT * FROM ranked WHERE rn = 1)"""

RATINGS = """
ratings AS (
  SELECT o_custkey AS "user", l_partkey AS item, CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

GRAPH = """
links AS (
  SELECT -1 - l_orderkey AS o, l_partkey AS p, 1000000000000 + l_suppkey AS s, l_returnflag = 'R' AS returned
  FROM lineitem
),
graph_edges AS (
  SELECT src, dst, count(*) AS n FROM (
    SELECT o AS src, p AS dst FROM links UNION ALL SELECT p, o FROM links
    UNION ALL SELECT o, s FROM links WHERE returned UNION ALL SELECT s, o FROM links WHERE returned
  ) GROUP BY src, dst
),
line_degrees AS (
  SELECT o AS node, CASE WHEN returned THEN 2 ELSE 1 END AS degree FROM links
  UNION ALL SELECT p, 1 FROM links
  UNION ALL SELECT s, 1 FROM links WHERE returned
)"""


def window_starts(time: str, size: int, slide: int) -> str:
    """Lateral list of the epoch-aligned window starts (seconds) holding ``time``."""
    last = f"CAST(floor(epoch_us({time}) / ({slide} * 1000000.0)) AS BIGINT) * {slide}"
    back = (size // slide - 1) * slide
    return f"unnest(range({last} - {back}, {last} + {slide}, {slide}))"


def instant(seconds: str) -> str:
    return f"make_timestamp(CAST({seconds} AS BIGINT) * 1000000)"
