"""Rule-eval queries (C1-C17) over the adapted `events` traces, with DuckDB oracles.

The eval configuration is a small inline table (FIXTURES §2.4). Each oracle fragment restates one
metric rule in SQL for one config row; a configured run is the UNION ALL of its rows' fragments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.columns import py_round2_sql
from runlens.operators.config import EVAL_CONFIG_SCHEMA, load_pipeline_config, pipeline_config_rows
from runlens.plans.catalog import S_SQL, _inputs, query
from runlens.sources.adapters import SESSIONS_SQL, TRACES_SQL, with_sql

EVAL_OUT = ["tenant_id", "session_id", "eval_name", "agent", "score", "passed", "threshold"]


@dataclass
class Cfg:
    eval_name: str
    metric: str
    agent: str | None = "session"
    threshold: float | None = 0.5
    pattern: str | None = None
    match: str | None = None
    threshold_key: str | None = None
    num: str | None = None
    den: str | None = None
    workflow_id: str | None = None
    layer: int = 3
    eval_type: str = "rule"
    enabled: bool | None = True
    extra: dict = field(default_factory=dict)


# Per-workflow settings used by the configured run (FIXTURES §2.4).
PIPELINE = {
    "w1": {"tool_retry_threshold": 4},
    "w2": {"required_agents": ["market", "research", "risk", "orchestrator"], "pipeline_order": ["market", "risk"]},
    "w3": {"handoff_pairs": [["market", "risk"], ["research", "orchestrator"]], "cost_anomaly_sigma": 1.5},
}

STANDARD = [
    Cfg("research_presence", "agent_presence", "research", 0.5),
    Cfg("research_tools", "tool_success_rate", "research", 0.8, match="prefix"),
    Cfg("tool_diversity", "tool_diversity", "session", 0.5, match="any"),
    Cfg("research_budget", "token_budget", "research", 0.5),
    Cfg("session_budget", "token_budget", "session", 0.5),
    Cfg("risk_freshness", "data_freshness", "risk", 0.5),
    Cfg("exit_quality", "exit_quality", "session", 0.5),
    Cfg("cost_check", "cost_anomaly", "session", 0.5),
    Cfg("coverage", "pipeline_coverage", "session", 0.8),
    Cfg("research_completion", "agent_completion", "research", 0.7, pattern="research", match="prefix"),
    Cfg("trade_ratio", "session_field_ratio", "session", 0.5, num="trades_executed", den="trades_proposed"),
    Cfg("market_contains", "agent_presence", "market", 0.9, pattern="ark", match="contains"),
    Cfg("all_tools", "tool_success_rate", None, 0.0, match="any"),                  # threshold 0 -> 0.5
    Cfg("spiral_budget", "token_budget", "research", 0.5, threshold_key="token_spiral_threshold"),
    Cfg("orchestrator_presence", "agent_presence", "orchestrator", 0.8, threshold_key="tool_success_min_rate"),
    Cfg("disabled_one", "agent_presence", "research", 0.5, enabled=False),
    Cfg("judge_one", "agent_presence", "research", 0.5, layer=4),
    Cfg("no_rule", "unknown_rule", "research", 0.5),
    Cfg("unregistered_custom", "custom", "research", 0.5),
    Cfg("w1_risk_completion", "agent_completion", "risk", 0.5, workflow_id="w1"),
]


def config_df(spark: SparkSession, cfgs: list[Cfg]) -> DataFrame:
    rows = []
    for i, c in enumerate(cfgs):
        rows.append((f"c{i}", None, c.workflow_id, c.eval_name, c.agent, c.threshold, c.layer, c.eval_type, c.enabled,
                     (c.metric, c.pattern, c.match, c.threshold_key, c.num, c.den, None), i))
    return spark.createDataFrame(rows, EVAL_CONFIG_SCHEMA)


def params_df(spark: SparkSession, pipeline: dict | None):
    return load_pipeline_config(pipeline_config_rows(spark, pipeline)) if pipeline else None


def _spark_evals(cfgs: list[Cfg], pipeline: dict | None = None):
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        from runlens.operators.evals import run_rule_evals
        traces, sessions = _inputs(spark, sf_dir)
        ev = run_rule_evals(sessions, traces, config_df(spark, cfgs), params_df(spark, pipeline))
        return ev.select(*EVAL_OUT)
    return fn


# ── oracle fragments ───────────────────────────────────────────────────────────────────────────

def _q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _setting(pipeline: dict, wf: str, key: str, default):
    return (pipeline.get(wf) or {}).get(key, default)


DEFAULTS = {"token_spiral_threshold": 40000, "token_efficiency_threshold": 30000, "tool_success_min_rate": 0.8,
            "cost_anomaly_sigma": 2.0, "data_freshness_minutes": 10, "tool_diversity_min": 2,
            "cost_per_unit_threshold": 0.5}


def _fragment(c: Cfg, pipeline: dict, wfs: list[str]) -> str | None:
    """SQL for one config row over the sessions of `wfs` (workflows sharing the same settings)."""
    if not (c.enabled and c.layer == 3 and c.eval_type == "rule"):
        return None
    agent = c.agent or "session"
    pattern = (c.pattern or agent).lower()
    match = c.match or "exact"
    thr = float(c.threshold or 0.5)
    wf0 = wfs[0]
    if c.threshold_key:
        v = _setting(pipeline, wf0, c.threshold_key, DEFAULTS.get(c.threshold_key))
        if v is not None:
            thr = float(v)
    a = "lower(coalesce(agent, ''))"
    cond = {"exact": f"{a} = {_q(pattern)}", "prefix": f"starts_with({a}, {_q(pattern)})",
            "contains": f"contains({a}, {_q(pattern)})", "any": "TRUE"}.get(match, "FALSE")
    if match == "any" or pattern == "":
        cond = "TRUE"
    R = py_round2_sql
    m = c.metric
    if m == "agent_presence":
        score = f"CASE WHEN a.n > 0 THEN {R('CAST(a.n_ok AS DOUBLE) / a.n')} ELSE 0.0 END"
    elif m == "tool_success_rate":
        score = f"CASE WHEN a.nt > 0 THEN {R('CAST(a.nto AS DOUBLE) / a.nt')} ELSE 1.0 END"
    elif m == "tool_diversity":
        mn = int(_setting(pipeline, wf0, "tool_diversity_min", 2))
        d = "coalesce(a.d, 0)"
        score = (f"CASE WHEN {d} >= {mn + 1} THEN 1.0 WHEN {d} = {mn} THEN 0.7 "
                 f"WHEN {d} = {mn - 1} AND {mn} > 1 THEN 0.3 WHEN {d} = 0 THEN 0.0 ELSE 0.3 END")
    elif m == "token_budget":
        key = c.threshold_key or "token_efficiency_threshold"
        budget = int(_setting(pipeline, wf0, key, DEFAULTS.get(key, _setting(pipeline, wf0, "token_efficiency_threshold",
                                                                             30000))))
        if budget == 0:
            return None
        used = ("CASE WHEN a.n > 0 THEN a.tokens WHEN s.trades > 0 THEN s.tokens // s.trades ELSE s.tokens END")
        score = R(f"greatest(0.0, 1.0 - ({used}) / {budget * 2}.0)")
        thr = 0.5
    elif m == "data_freshness":
        mins = int(_setting(pipeline, wf0, "data_freshness_minutes", 10))
        lag = "abs(epoch_us(a.first_at) - epoch_us(s.started_at)) / 60e6"
        body = "1.0" if mins == 0 else R(f"greatest(0.0, 1.0 - ({lag}) / {mins * 2}.0)")
        score = (f"CASE WHEN coalesce(a.n, 0) = 0 THEN 0.0 WHEN s.started_at IS NULL OR a.ts_missing THEN 1.0 "
                 f"ELSE {body} END")
    elif m == "exit_quality":
        lists = {k: _setting(pipeline, wf0, k, d) for k, d in
                 [("good_exits", ["completed", "converged", "no_opportunity"]),
                  ("partial_exits", ["partial", "circuit_breaker"]), ("bad_exits", ["error", "in_progress"])]}
        inl = lambda xs: "(" + ", ".join(_q(x) for x in xs) + ")" if xs else "(NULL)"
        r = "lower(s.reason)"
        score = (f"CASE WHEN s.trades > 0 OR {r} IN {inl(lists['good_exits'])} THEN 1.0 "
                 f"WHEN {r} IN {inl(lists['partial_exits'])} THEN 0.5 WHEN {r} IN {inl(lists['bad_exits'])} THEN 0.2 "
                 f"WHEN s.trades = 0 AND {r} = '' THEN 0.0 ELSE 0.2 END")
    elif m == "cost_anomaly":
        z = "CASE WHEN h.hsd > 0 THEN (s.cost - h.hm) / h.hsd ELSE 0.0 END"
        score = f"CASE WHEN coalesce(h.hn, 0) < 5 THEN 1.0 ELSE {R(f'greatest(0.0, 1.0 - greatest(0.0, ({z}) - 1) / 2)')} END"
    elif m == "pipeline_coverage":
        req = _setting(pipeline, wf0, "required_agents", [])
        if not req:
            score = "1.0"
        else:
            hits = " + ".join(f"CASE WHEN coalesce(ag.has_{i}, false) THEN 1 ELSE 0 END" for i in range(len(req)))
            score = R(f"CAST({hits} AS DOUBLE) / {len(req)}")
    elif m == "agent_completion":
        score = ("CASE WHEN NOT coalesce(a.llm_ok, false) THEN 0.0 "
                 "WHEN coalesce(a.nt, 0) > 0 AND coalesce(a.nto, 0) = 0 THEN 0.3 ELSE 1.0 END")
    elif m == "session_field_ratio":
        num = f"CAST(coalesce(s.{c.num}, 0) AS DOUBLE)"
        den = f"CAST(coalesce(s.{c.den}, 0) AS DOUBLE)"
        body = R(f"least(1.0, ({num} / {den}) / {thr})") if thr > 0 else "1.0"
        score = f"CASE WHEN {den} = 0 THEN (CASE WHEN {num} = 0 THEN 1.0 ELSE 0.0 END) ELSE {body} END"
    else:
        return None
    req = _setting(pipeline, wf0, "required_agents", [])
    has_cols = ", ".join(
        f"bool_or(lower(coalesce(agent, '')) = {_q(r.lower())} OR starts_with(lower(coalesce(agent, '')), {_q(r.lower() + '_')})) AS has_{i}"
        for i, r in enumerate(req)) or "TRUE AS has_none"
    wf_in = "(" + ", ".join(_q(w) for w in wfs) + ")"
    return f"""
SELECT s.tenant_id, s.session_id, {_q(c.eval_name)} AS eval_name, {_q(agent)} AS agent,
       CAST({score} AS DOUBLE) AS score, CAST({thr} AS DOUBLE) AS threshold
FROM s
LEFT JOIN (SELECT tenant_id, session_id, count(*) AS n,
                  count(*) FILTER (WHERE outcome IS DISTINCT FROM 'error' AND step_type IS DISTINCT FROM 'error') AS n_ok,
                  count(*) FILTER (WHERE coalesce(step_type, '') = 'tool_call') AS nt,
                  count(*) FILTER (WHERE coalesce(step_type, '') = 'tool_call' AND outcome IS DISTINCT FROM 'error') AS nto,
                  count(DISTINCT CASE WHEN coalesce(step_type, '') = 'tool_call' AND trim(coalesce(tool_name, '')) <> ''
                                      THEN trim(tool_name) END) AS d,
                  sum(coalesce(tokens_input, 0) + coalesce(tokens_output, 0)) AS tokens,
                  min(created_at) AS first_at, bool_or(created_at IS NULL) AS ts_missing,
                  bool_or((coalesce(step_type, '') = 'llm_call' AND coalesce(outcome, '') = 'success')
                          OR (coalesce(step_type, '') IN ('agent_message', 'decision')
                              AND coalesce(outcome, '') NOT IN ('', 'error'))) AS llm_ok
           FROM traces WHERE {cond} GROUP BY ALL) a USING (tenant_id, session_id)
LEFT JOIN (SELECT tenant_id, session_id, {has_cols} FROM traces GROUP BY ALL) ag USING (tenant_id, session_id)
LEFT JOIN h USING (tenant_id, session_id)
WHERE s.workflow_id IN {wf_in}"""


H_SQL = """
h AS (SELECT tenant_id, session_id, count(cost) OVER w AS hn, avg(cost) OVER w AS hm, stddev_samp(cost) OVER w AS hsd
      FROM s WINDOW w AS (PARTITION BY tenant_id, workflow_id ORDER BY started_at, session_id
                          ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))"""

WORKFLOWS = ["w0", "w1", "w2", "w3"]


def evals_sql(cfgs: list[Cfg], pipeline: dict | None = None) -> str:
    pipeline = pipeline or {}
    parts = []
    for c in cfgs:
        wfs = [c.workflow_id] if c.workflow_id else WORKFLOWS
        for wf in wfs:
            frag = _fragment(c, pipeline, [wf])
            if frag:
                parts.append(frag)
    body = "\nUNION ALL\n".join(parts)
    return with_sql(TRACES_SQL, SESSIONS_SQL, S_SQL.replace("coalesce(terminal_reason, '') AS reason",
                                                              "coalesce(terminal_reason, '') AS reason, "
                                                              "trades_executed, trades_proposed"), H_SQL,
                    f"u AS ({body})") + "\nSELECT u.*, u.score >= u.threshold AS passed FROM u"


def _register(name: str, cfgs: list[Cfg], pipeline: dict | None = None):
    query(name, evals_sql(cfgs, pipeline))(_spark_evals(cfgs, pipeline))


_register("eval_agent_presence", [STANDARD[0], STANDARD[11]])
_register("eval_tool_success_rate", [STANDARD[1], STANDARD[12]])
_register("eval_tool_diversity", [STANDARD[2]])
_register("eval_token_budget", [STANDARD[3], STANDARD[4], STANDARD[13]])
_register("eval_data_freshness", [STANDARD[5]])
_register("eval_exit_quality", [STANDARD[6]])
_register("eval_cost_anomaly", [STANDARD[7]])
_register("eval_pipeline_coverage", [STANDARD[8]], {"w2": PIPELINE["w2"]})
_register("eval_agent_completion", [STANDARD[9]])
_register("eval_session_field_ratio", [STANDARD[10]])
_register("run_rule_evals", STANDARD, PIPELINE)


TEXT_FIELD_SQL = with_sql(TRACES_SQL, SESSIONS_SQL, f"""
x AS (SELECT *, CASE trades_proposed % 4 WHEN 0 THEN 0.0 WHEN 1 THEN 3.0 WHEN 2 THEN 10.0 END AS den FROM sessions),
y AS (SELECT tenant_id, session_id, CASE WHEN den = 0 THEN (CASE WHEN trades_executed = 0 THEN 1.0 ELSE 0.0 END)
             ELSE {py_round2_sql("least(1.0, (CAST(trades_executed AS DOUBLE) / den) / 0.5)")} END AS score FROM x WHERE den IS NOT NULL)
SELECT tenant_id, session_id, 'ratio_text' AS eval_name, 'session' AS agent, score, score >= 0.5 AS passed, CAST(0.5 AS DOUBLE) AS threshold FROM y""")


@query("eval_session_field_text", TEXT_FIELD_SQL)
def text_field_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10 over a text field: an empty text is 0, a numeric one a number, and any other gives no row."""
    from runlens.operators.evals import run_rule_evals
    traces, sessions = _inputs(spark, sf_dir)
    kind = F.col("trades_proposed") % 4
    s = sessions.withColumn("plan", F.when(kind == 0, "").when(kind == 1, "3").when(kind == 2, " 1e1 ").otherwise("n/a"))
    cfg = [Cfg("ratio_text", "session_field_ratio", num="trades_executed", den="plan")]
    return run_rule_evals(s, traces, config_df(spark, cfg)).select(*EVAL_OUT)
