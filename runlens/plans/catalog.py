"""Query catalogue: every operator as a query over the driver's tables, with its DuckDB oracle.

Each entry is (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL or None). Outputs are flat
scalar columns with the same names on both sides. The oracle SQL restates each rule in plain
SQL (windows and joins over the whole tables); it is an independent check, not the plan Spark runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.columns import K
from runlens.sources.adapters import SESSIONS_SQL, TRACES_SQL, load_sessions, load_traces, with_sql

CATALOG: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        CATALOG[name] = (fn, sql)
        return fn
    return deco


def _inputs(spark: SparkSession, sf_dir: str):
    return load_traces(spark, sf_dir), load_sessions(spark, sf_dir)


# ── detectors ────────────────────────────────────────────────────────────────────────────────

INCIDENT_COLS = ["tenant_id", "session_id", "pattern_name", "severity", "root_cause", "cost_wasted",
                 "tokens_wasted", "frame_count"]

S_SQL = """
s AS (
  SELECT tenant_id, session_id, workflow_id, started_at, coalesce(total_cost_usd, 0.0) AS cost,
         CAST(coalesce(total_tokens_input, 0) + coalesce(total_tokens_output, 0) AS BIGINT) AS tokens,
         coalesce(trades_executed, 0) AS trades, coalesce(terminal_reason, '') AS reason
  FROM sessions
)"""


def _detector_query(pattern: str, round_cost: int | None = None, drop_root: bool = False):
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        from runlens.operators.detectors import run_detectors
        traces, sessions = _inputs(spark, sf_dir)
        inc = run_detectors(traces, sessions, patterns=[pattern]).incidents
        cols = [c for c in INCIDENT_COLS if not (drop_root and c == "root_cause")]
        if pattern == "Tool Timeout Loop":
            cols.append("root_tool")
        out = inc.select(*cols)
        if round_cost is not None:
            out = out.withColumn("cost_wasted", F.round("cost_wasted", round_cost))
        return out
    return fn


def _sql(body: str) -> str:
    return with_sql(TRACES_SQL, SESSIONS_SQL, S_SQL, body)


DET_BODIES: dict[str, str] = {}


def _det(pattern: str, body: str) -> str:
    """Keep each detector's SQL body so that later oracles can reuse it as a subquery."""
    DET_BODIES[pattern] = body
    return _sql(body)


def incidents_sql(cols: str = "tenant_id, session_id, pattern_name") -> str:
    """Every detector's incidents as one UNION ALL (subqueries see the outer traces/sessions/s)."""
    return "\nUNION ALL\n".join(f"SELECT {cols} FROM (WITH {b.strip()})" for b in DET_BODIES.values())


ERR_SQL = "(outcome IS NOT DISTINCT FROM 'error' OR nullif(trim(error), '') IS NOT NULL)"
TOOL_SQL = "coalesce(step_type, '') = 'tool_call'"

D1_SQL = _det("Tool Timeout Loop", f"""
e AS (SELECT *, coalesce(nullif(tool_name, ''), 'unknown_tool') AS tool FROM traces WHERE {TOOL_SQL} AND {ERR_SQL}),
e2 AS (SELECT *, count(*) OVER (PARTITION BY tenant_id, session_id, tool) AS n,
              row_number() OVER (PARTITION BY tenant_id, session_id, tool ORDER BY created_at, seq) AS rn FROM e),
f AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY created_at, seq) AS wr
      FROM e2 WHERE rn = 1 AND n >= 3)
SELECT f.tenant_id, f.session_id, 'Tool Timeout Loop' AS pattern_name, 'critical' AS severity,
       f.tool || ' failed ' || f.n || ' times in ' || coalesce(f.agent, 'None') || ' agent. Error: '
         || substr(coalesce(nullif(f.error, ''), 'unknown error'), 1, 120) AS root_cause,
       s.cost AS cost_wasted, s.tokens AS tokens_wasted, f.n AS frame_count, f.tool_name AS root_tool
FROM f JOIN s USING (tenant_id, session_id) WHERE f.wr = 1""")

D2_SQL = _det("Context Spiral", """
a AS (SELECT tenant_id, session_id, CAST(sum(coalesce(tokens_input, 0) + coalesce(tokens_output, 0)) AS BIGINT) AS at,
             count(*) AS n FROM traces WHERE lower(coalesce(agent, '')) = 'research' GROUP BY ALL)
SELECT a.tenant_id, a.session_id, 'Context Spiral' AS pattern_name, 'warning' AS severity,
       'Research agent consumed ' || format('{:,}', a.at) || ' tokens with 0 trades produced. '
         || 'Agent gathered context without reaching a decision.' AS root_cause,
       s.cost AS cost_wasted, a.at AS tokens_wasted, least(a.n, 20) AS frame_count
FROM a JOIN s USING (tenant_id, session_id) WHERE a.at > 40000 AND s.trades = 0""")

D3_SQL = _det("Pipeline Break", """
ag AS (SELECT tenant_id, session_id,
              bool_or(lower(coalesce(agent, '')) = 'research' OR starts_with(lower(coalesce(agent, '')), 'research_')) AS first_ran,
              bool_or(lower(coalesce(agent, '')) = 'orchestrator' OR starts_with(lower(coalesce(agent, '')), 'orchestrator_')) AS last_ran,
              count(*) FILTER (WHERE lower(coalesce(agent, '')) = 'research') AS nf
       FROM traces GROUP BY ALL),
lastf AS (SELECT * FROM (SELECT tenant_id, session_id, step_type, outcome,
              row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY created_at DESC, seq DESC) AS r
              FROM traces WHERE lower(coalesce(agent, '')) = 'research') WHERE r = 1)
SELECT ag.tenant_id, ag.session_id, 'Pipeline Break' AS pattern_name, 'critical' AS severity,
       'Research agent completed but orchestrator never started. Last research step: '
         || CASE WHEN l.r IS NULL THEN 'unknown' ELSE coalesce(l.step_type, 'None') END || ' (outcome: '
         || CASE WHEN l.r IS NULL THEN 'unknown' ELSE coalesce(l.outcome, 'None') END || ')' AS root_cause,
       s.cost AS cost_wasted, s.tokens AS tokens_wasted, least(ag.nf, 10) AS frame_count
FROM ag JOIN s USING (tenant_id, session_id) LEFT JOIN lastf l USING (tenant_id, session_id)
WHERE ag.first_ran AND NOT ag.last_ran""")

D4_SQL = _det("Empty Result Loop", f"""
ok AS (SELECT *, coalesce(nullif(tool_name, ''), 'unknown') AS tool FROM traces
       WHERE {TOOL_SQL} AND coalesce(outcome, '') = 'success'),
g AS (SELECT tenant_id, session_id, tool, count(*) AS n, min(seq) AS fs,
             count(*) FILTER (WHERE tool_name = tool) AS named FROM ok GROUP BY ALL HAVING count(*) >= 3),
w AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY fs) AS wr FROM g)
SELECT w.tenant_id, w.session_id, 'Empty Result Loop' AS pattern_name, 'warning' AS severity,
       w.tool || ' called ' || w.n || ' times successfully but produced no actionable output (0 trades). '
         || 'Tool may be returning empty or low-quality results.' AS root_cause,
       s.cost AS cost_wasted, s.tokens AS tokens_wasted, w.named AS frame_count
FROM w JOIN s USING (tenant_id, session_id) WHERE w.wr = 1 AND s.trades = 0""")

D5_SQL = _det("Silent Exit", f"""
g AS (SELECT tenant_id, session_id, count(*) AS n, coalesce(bool_or({TOOL_SQL} AND {ERR_SQL}), false) AS te
      FROM traces GROUP BY ALL)
SELECT g.tenant_id, g.session_id, 'Silent Exit' AS pattern_name, 'info' AS severity,
       'Session ended with 0 trades and no terminal reason logged. No tool errors detected. '
         || 'Likely a logic path that skips both trade entry and explicit rejection.' AS root_cause,
       s.cost AS cost_wasted, s.tokens AS tokens_wasted, least(g.n, 10) AS frame_count
FROM g JOIN s USING (tenant_id, session_id) WHERE s.trades = 0 AND s.reason = '' AND NOT g.te AND g.n > 0""")

D6_SQL = _det("Hyperactive Polling Loop", f"""
c AS (SELECT *, coalesce(nullif(tool_name, ''), 'unknown') AS tool FROM traces
      WHERE {TOOL_SQL} AND outcome IS DISTINCT FROM 'error'),
c2 AS (SELECT *, count(*) OVER (PARTITION BY tenant_id, session_id, tool) AS n,
              sum(coalesce(latency_ms, 0)) OVER (PARTITION BY tenant_id, session_id, tool) AS lat,
              row_number() OVER (PARTITION BY tenant_id, session_id, tool ORDER BY created_at, seq) AS rn FROM c),
f AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY created_at, seq) AS wr
      FROM c2 WHERE rn = 1 AND n >= 6)
SELECT f.tenant_id, f.session_id, 'Hyperactive Polling Loop' AS pattern_name, 'warning' AS severity,
       f.tool || ' called ' || f.n || ' times successfully by ' || coalesce(f.agent, 'None')
         || ' agent. Agent is polling without reaching a decision threshold. Total time in tool calls: '
         || format('{{:,}}', CAST(f.lat AS BIGINT)) || 'ms.' AS root_cause,
       s.cost AS cost_wasted, s.tokens AS tokens_wasted, f.n AS frame_count
FROM f JOIN s USING (tenant_id, session_id) WHERE f.wr = 1""")

D7_SQL = _det("Tool Call Fabrication", f"""
sus AS (SELECT * FROM traces WHERE {TOOL_SQL} AND outcome IS DISTINCT FROM 'error'
        AND coalesce(latency_ms, 0) > 0 AND coalesce(latency_ms, 0) < 10.0
        AND coalesce(tool_name, '') NOT IN ('read_session_context', 'write_learning', 'get_candidates',
                                            'get_position_history', 'filter_and_rank', 'get_scan_results')),
da AS (SELECT tenant_id, session_id, '[' || string_agg('''' || agent || '''', ', ' ORDER BY agent) || ']' AS agents
       FROM (SELECT DISTINCT tenant_id, session_id, agent FROM sus) GROUP BY ALL),
dt AS (SELECT tenant_id, session_id, '[' || string_agg('''' || tool_name || '''', ', ' ORDER BY tool_name) || ']' AS tools
       FROM (SELECT DISTINCT tenant_id, session_id, tool_name FROM sus) GROUP BY ALL),
g AS (SELECT tenant_id, session_id, count(*) AS n FROM sus GROUP BY ALL HAVING count(*) >= 3)
SELECT g.tenant_id, g.session_id, 'Tool Call Fabrication' AS pattern_name, 'critical' AS severity,
       g.n || ' tool call(s) completed in under 10.0ms with success status. External API calls take 100ms+. '
         || 'Affected agents: ' || da.agents || '. Tools: ' || dt.tools || '.' AS root_cause,
       s.cost AS cost_wasted, CAST(0 AS BIGINT) AS tokens_wasted, g.n AS frame_count
FROM g JOIN s USING (tenant_id, session_id) JOIN da USING (tenant_id, session_id) JOIN dt USING (tenant_id, session_id)""")

D8_SQL = _det("Handoff Schema Break", f"""
src AS (SELECT tenant_id, session_id, count(*) AS sn,
               bool_or(coalesce(step_type, '') IN ('llm_call', 'agent_message', 'decision')
                       AND outcome IS DISTINCT FROM 'error') AS ok
        FROM traces WHERE starts_with(lower(coalesce(agent, '')), 'research') GROUP BY ALL),
tg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY created_at, seq) AS r
       FROM traces WHERE lower(coalesce(agent, '')) = 'risk') WHERE r = 1)
SELECT src.tenant_id, src.session_id, 'Handoff Schema Break' AS pattern_name, 'critical' AS severity,
       'Research agent completed successfully but risk agent errored on its first trace. Research output did not '
         || 'match risk agent''s expected schema. Error at handoff: '
         || substr(coalesce(nullif(tg.error, ''), 'unknown schema error'), 1, 120) AS root_cause,
       s.cost AS cost_wasted, s.tokens AS tokens_wasted, least(src.sn, 5) + 1 AS frame_count
FROM src JOIN tg USING (tenant_id, session_id) JOIN s USING (tenant_id, session_id)
WHERE src.ok AND (tg.outcome IS NOT DISTINCT FROM 'error' OR nullif(trim(tg.error), '') IS NOT NULL)""")

D9_SQL = _det("Error Misinterpretation", f"""
cand AS (SELECT * FROM traces WHERE {TOOL_SQL}
         AND (contains(coalesce(error, ''), '400') OR contains(coalesce(error, ''), '401')
              OR contains(coalesce(error, ''), '403') OR contains(coalesce(error, ''), '429')
              OR contains(coalesce(error, ''), '500') OR contains(coalesce(error, ''), '502')
              OR contains(coalesce(error, ''), '503'))),
mis AS (SELECT c.* FROM cand c WHERE EXISTS (
          SELECT 1 FROM traces l WHERE l.tenant_id = c.tenant_id AND l.session_id = c.session_id
            AND l.agent IS NOT DISTINCT FROM c.agent AND coalesce(l.step_type, '') = 'llm_call'
            AND (l.created_at > c.created_at OR (l.created_at = c.created_at AND l.seq > c.seq)))),
g AS (SELECT tenant_id, session_id, count(*) AS n FROM mis GROUP BY ALL HAVING count(*) >= 2),
ag AS (SELECT tenant_id, session_id, '[' || string_agg('''' || agent || '''', ', ' ORDER BY agent) || ']' AS agents
       FROM (SELECT DISTINCT tenant_id, session_id, agent FROM mis) GROUP BY ALL),
er AS (SELECT tenant_id, session_id, '[' || string_agg('''' || substr(coalesce(error, ''), 1, 60) || '''', ', '
              ORDER BY created_at, seq) || ']' AS errs
       FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, session_id ORDER BY created_at, seq) AS r FROM mis)
       WHERE r <= 3 GROUP BY ALL)
SELECT g.tenant_id, g.session_id, 'Error Misinterpretation' AS pattern_name, 'warning' AS severity,
       g.n || ' HTTP error(s) received but agent(s) ' || ag.agents
         || ' continued processing instead of aborting or retrying correctly. Errors: ' || er.errs AS root_cause,
       s.cost AS cost_wasted, s.tokens AS tokens_wasted, g.n AS frame_count
FROM g JOIN ag USING (tenant_id, session_id) JOIN er USING (tenant_id, session_id) JOIN s USING (tenant_id, session_id)""")

D10_SQL = _det("Cost Anomaly", """
h AS (SELECT *, count(cost) OVER w AS hn, avg(cost) OVER w AS hm, stddev_samp(cost) OVER w AS hsd
      FROM s WINDOW w AS (PARTITION BY tenant_id, workflow_id ORDER BY started_at, session_id
                          ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, CASE WHEN hsd > 0 THEN (cost - hm) / hsd ELSE 0.0 END AS z FROM h),
n AS (SELECT tenant_id, session_id, count(*) AS n FROM traces GROUP BY ALL)
SELECT z.tenant_id, z.session_id, 'Cost Anomaly' AS pattern_name, 'warning' AS severity,
       round(greatest(0.0, z.cost - z.hm), 8) AS cost_wasted, CAST(0 AS BIGINT) AS tokens_wasted,
       least(coalesce(n.n, 0), 15) AS frame_count
FROM z LEFT JOIN n USING (tenant_id, session_id) WHERE z.hn >= 5 AND z.z > 2.0""")

query("detect_tool_timeout_loop", D1_SQL)(_detector_query("Tool Timeout Loop"))
query("detect_context_spiral", D2_SQL)(_detector_query("Context Spiral"))
query("detect_pipeline_break", D3_SQL)(_detector_query("Pipeline Break"))
query("detect_empty_result_loop", D4_SQL)(_detector_query("Empty Result Loop"))
query("detect_silent_exit", D5_SQL)(_detector_query("Silent Exit"))
query("detect_hyperactive_polling", D6_SQL.replace("{{:,}}", "{:,}"))(_detector_query("Hyperactive Polling Loop"))
query("detect_tool_fabrication", D7_SQL)(_detector_query("Tool Call Fabrication"))
query("detect_handoff_schema_break", D8_SQL)(_detector_query("Handoff Schema Break"))
query("detect_error_misinterpretation", D9_SQL)(_detector_query("Error Misinterpretation"))
query("detect_cost_anomaly", D10_SQL)(_detector_query("Cost Anomaly", round_cost=8, drop_root=True))
