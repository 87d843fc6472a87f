"""Common table expressions that the SQL of several queries starts from."""

SESSIONS = """sessions AS (SELECT event_id AS session_id,
 '10.0.' || (user_id % 16) || '.' || ((user_id // 16) % 250 + 1) AS source_ip, '172.16.' || (k % 8) || '.' || (k + 1) AS destination_ip,
 CAST(40000 + event_id % 1000 AS INTEGER) AS source_port, CAST([22,53,80,443,445,389,3306,3389][k % 8 + 1] AS INTEGER) AS destination_port,
 ts AS event_start, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS event_end,
 CASE WHEN event_id % 37 = 0 THEN -1.0 ELSE floor(value * 100) END::DOUBLE AS source_bytes,
 CASE WHEN event_id % 10 <> 0 THEN floor(value * 50) END::DOUBLE AS destination_bytes,
 CASE event_type WHEN 'error' THEN 'drop' WHEN 'signup' THEN 'alert' ELSE 'allow' END AS event_action,
 CASE event_type WHEN 'error' THEN 'tcp-rst-from-server' WHEN 'click' THEN 'aged-out' ELSE 'tcp-fin' END AS event_reason,
 CASE event_type WHEN 'error' THEN 'THREAT' ELSE 'TRAFFIC' END AS event_name, ['TCP','UDP','ICMP'][k % 3 + 1] AS network_transport
 FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events))"""

CLEAN = SESSIONS + """, clean AS (SELECT * REPLACE (CASE WHEN source_bytes >= 0 THEN source_bytes END AS source_bytes, CASE WHEN destination_bytes >= 0 THEN destination_bytes END AS destination_bytes),
 greatest(coalesce((epoch_us(event_end) - epoch_us(event_start)) / 1000000.0, 0), 0)::DOUBLE AS duration_sec FROM sessions
 WHERE coalesce(source_bytes, destination_bytes, source_port, destination_port) IS NOT NULL)"""

ROLES = CLEAN + """, roles AS (SELECT c.*, 'outbound' AS role, source_ip AS host_ip, destination_ip AS peer_ip, destination_port AS peer_port, source_bytes AS bytes_sent, destination_bytes AS bytes_recv FROM clean c
 UNION ALL SELECT c.*, 'inbound', destination_ip, source_ip, destination_port, destination_bytes, source_bytes FROM clean c)"""


def sliced(minutes: int) -> str:
    return ROLES + f""", sliced AS (SELECT *, make_timestamp((epoch_us(event_start) // {minutes * 60_000_000}) * {minutes * 60_000_000}) AS slice_start_ts,
 make_timestamp((epoch_us(event_start) // {minutes * 60_000_000} + 1) * {minutes * 60_000_000}) AS slice_end_ts FROM roles)"""


def counters(minutes: int) -> str:
    return sliced(minutes) + """, slices AS (SELECT host_ip, role, slice_start_ts, slice_end_ts, count(*) AS sessions_cnt, sum(coalesce(bytes_sent, 0)) AS bytes_sent_sum, sum(coalesce(bytes_recv, 0)) AS bytes_recv_sum,
 sum(coalesce(duration_sec, 0)) AS duration_sum, count(*) FILTER (event_action = 'allow') AS allow_cnt, count(*) FILTER (event_action = 'drop') AS drop_cnt, count(*) FILTER (event_action = 'alert') AS alert_cnt,
 count(*) FILTER (event_reason LIKE 'tcp-rst%') AS rst_cnt, count(*) FILTER (event_reason = 'aged-out') AS aged_out_cnt, count(*) FILTER (event_name = 'THREAT') AS threat_cnt, count(*) FILTER (event_name = 'TRAFFIC') AS traffic_cnt,
 count(*) FILTER (network_transport = 'TCP') AS tcp_cnt, count(*) FILTER (network_transport = 'UDP') AS udp_cnt, count(*) FILTER (network_transport = 'ICMP') AS icmp_cnt,
 count(*) FILTER (peer_port IN (445, 3389)) AS high_risk_port_sessions_cnt, count(*) FILTER (peer_port IN (22, 3389)) AS admin_port_sessions_cnt, count(*) FILTER (peer_port = 445) AS fileshare_port_sessions_cnt,
 count(*) FILTER (peer_port = 389) AS directory_port_sessions_cnt, count(*) FILTER (peer_port = 3306) AS db_port_sessions_cnt
 FROM sliced GROUP BY ALL)"""


PAIRS = """, pairs AS (SELECT host_ip, role, slice_start_ts, slice_end_ts, peer_ip, peer_port, count(*) AS sessions_cnt, max(event_start) AS event_ts, host_ip || '|' || peer_ip || '|' || peer_port AS pair_key FROM sliced GROUP BY ALL)"""

SEGMENT = "regexp_replace({ip}, '^([0-9]+)[.]([0-9]+)[.]([0-9]+)[.][0-9]+$', '\\1.\\2.\\3.0/24')"

#: Windows (label, minutes) before the anchor, for sliced history of a month.
LONG_WINDOWS = {"w_1h": 60, "w_24h": 1440, "w_7d": 10080, "w_30d": 43200}
ANCHOR = "2024-01-30 12:00:00"


def in_windows(table: str, name: str, windows: dict[str, int] = LONG_WINDOWS) -> str:
    values = ", ".join(f"('{k}', {m})" for k, m in windows.items())
    return f""", {name} AS (SELECT t.*, window_label, TIMESTAMP '{ANCHOR}' - to_minutes(m) AS window_start_ts, TIMESTAMP '{ANCHOR}' AS window_end_ts
 FROM {table} t, (VALUES {values}) w(window_label, m) WHERE slice_end_ts > TIMESTAMP '{ANCHOR}' - to_minutes(m) AND slice_end_ts <= TIMESTAMP '{ANCHOR}')"""


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"
