"""DuckDB CTEs for findings, phases and tool logs (see sources/findings.py)."""

from __future__ import annotations

from surfacekit.plans import sqlbits as S
from surfacekit.sources import findings as FD


def _lst(values) -> str:
    return "[" + ", ".join(S.lit(v) for v in values) + "]"


SEV = f"{_lst(FD.SEVERITIES)}[event_id % 5 + 1]"

FINDINGS = f"""
findings AS (
  SELECT event_id, '[' || event_type || '] [' || sev || '] ' || target AS finding, target AS url,
    {_lst(FD.FINDING_CLASSES)}[(event_id // 5) % {len(FD.FINDING_CLASSES)} + 1] AS vuln_class,
    sev AS severity, 'sweep-' || event_type AS phase, CAST(event_id // {FD.CHUNK} AS BIGINT) AS batch_id, ts, value
  FROM (SELECT e.*, {SEV} AS sev, coalesce(s.url, 'user-' || CAST(e.user_id AS VARCHAR)) AS target
        FROM events e LEFT JOIN seed_urls s ON s.page_id = e.user_id)
)"""

PHASES = f"""
phase_results AS (
  SELECT event_type || '@' || hour AS phase, event_type <> 'error' AS success, CAST(n AS BIGINT) AS findings,
    CAST(trunc(v) AS INTEGER) AS elapsed,
    CASE WHEN event_type = 'error' THEN '[WRN] retry budget spent' || chr(10) || 'exit status 1: props ' || p END AS error
  FROM (SELECT event_type, strftime(ts, '%Y-%m-%d %H') AS hour, sum(value) AS v,
          sum(CASE WHEN {SEV} IN ('high', 'critical') THEN 1 ELSE 0 END) AS n, min(props) AS p
        FROM events GROUP BY 1, 2)
)"""

TOOL_LOGS = """
tool_logs AS (
  SELECT phase AS stage, CASE
    WHEN severity = 'info' AND value > 45 THEN '[ERR] HTTP 429 Too Many Requests'
    WHEN severity = 'info' THEN '[INF] scanning ' || url
    WHEN severity = 'low' THEN '[WRN] Rate Limit reached for ' || url
    WHEN value < 1 THEN 'invalid semicolon in query'
    WHEN value < 2 THEN '   '
    ELSE finding END AS line
  FROM findings
)"""


def first_token(col: str) -> str:
    return f"string_split_regex(trim({col}), '[ \\t]+')[1]"


def last_token(col: str) -> str:
    toks = f"string_split_regex(trim({col}), '[ \\t]+')"
    return f"CASE WHEN contains({col}, '[') AND len({toks}) >= 3 THEN {toks}[-1] END"


def fmt_duration(s: str) -> str:
    return (f"CASE WHEN {s} < 60 THEN CAST({s} AS VARCHAR) || 's' "
            f"WHEN {s} < 3600 THEN CAST({s} // 60 AS VARCHAR) || 'm' || CAST({s} % 60 AS VARCHAR) || 's' "
            f"ELSE CAST({s} // 3600 AS VARCHAR) || 'h' || CAST(({s} % 3600) // 60 AS VARCHAR) || 'm' END")
