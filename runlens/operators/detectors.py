"""Failure-pattern detectors (D1-D16), for every session at once.

The ten detectors run as four passes over the traces instead of ten:

  tool pass     one aggregate over tool calls keyed on (session, detector, tool): D1, D4, D6
  session pass  one aggregate per session, left-joined to the session row: D2, D3, D5, D7, D10
  handoff pass  traces x the workflow's handoff pairs (bounded fan-out): D8
  error pass    HTTP-error tool calls vs the agent's last llm_call: D9

Each pass builds, per session, an array of candidate incident structs (one per pattern, null when
the pattern does not fire) and explodes it, so one aggregate serves several patterns. Every
aggregate combines partially before its shuffle, so a very large session costs one row per map
task, not all its traces. At most one incident per pattern and session.

Evidence ("call stack") can grow with the session (all failed calls of a tool, say), so it is a
separate frames table with one row per frame, never a collected list. It comes from one join of
the traces with the incidents' selection keys; the bounded "last N traces" evidence is a ranked
window whose constant limit Spark turns into a map-side group limit.

Outputs:
  incidents: tenant_id, session_id, workflow_id, pattern_rank, pattern_name, severity, root_cause,
             fix_suggestion, cost_wasted, tokens_wasted, frame_count, is_simulated, root_tool
  frames:    tenant_id, session_id, pattern_name, agent, step_type, tool_name, outcome, error,
             latency_ms, tokens, created_at, seq
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.functions.columns import (K, agent_seen, capitalize, frame_columns, is_err, is_tool, lower_agent,
                                       outcome_is, py_round, py_string, thousands, toks)
from runlens.operators.config import attach_params
from runlens.operators.history import preceding_stats
from runlens.operators.texts import INCIDENTS

# Pattern names, severities and runner order.
PATTERNS = [
    ("Tool Timeout Loop", "critical"),
    ("Context Spiral", "warning"),
    ("Pipeline Break", "critical"),
    ("Empty Result Loop", "warning"),
    ("Silent Exit", "info"),
    ("Hyperactive Polling Loop", "warning"),
    ("Tool Call Fabrication", "critical"),
    ("Handoff Schema Break", "critical"),
    ("Error Misinterpretation", "warning"),
    ("Cost Anomaly", "warning"),
]
RANK = {name: i + 1 for i, (name, _) in enumerate(PATTERNS)}
SEVERITY = dict(PATTERNS)
# HTTP status codes looked for in tool errors.
HTTP_ERROR_CODES = ["400", "401", "403", "429", "500", "502", "503"]
HISTORY_SESSIONS = 20
ERROR_CHARS = 120       # of an error text in a root cause, as in the reference
# Evidence kept as "the last N traces" (per pattern); the others keep every matching trace.
LAST_N = {"Context Spiral": 20, "Pipeline Break": 10, "Silent Exit": 10, "Handoff Schema Break": 5, "Cost Anomaly": 15}

TOOL_PASS = ["Tool Timeout Loop", "Empty Result Loop", "Hyperactive Polling Loop"]
SESSION_PASS = ["Context Spiral", "Pipeline Break", "Silent Exit", "Tool Call Fabrication", "Cost Anomaly"]


@dataclass
class Detected:
    incidents: DataFrame
    frames: DataFrame


def _none(c: Column) -> Column:
    """How Python's f-string shows a value that may be None."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def _order() -> Column:
    return F.struct(F.col("created_at"), F.col("seq"))


def _session_facts(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        *K, "workflow_id",
        F.coalesce(F.col("total_cost_usd").cast("double"), F.lit(0.0)).alias("_cost"),
        (F.coalesce(F.col("total_tokens_input"), F.lit(0)) + F.coalesce(F.col("total_tokens_output"), F.lit(0)))
        .cast("long").alias("_tokens"),
        F.coalesce(F.col("trades_executed"), F.lit(0)).cast("long").alias("_trades"),
        F.coalesce(F.col("terminal_reason"), F.lit("")).alias("_reason"),
    )


def _say(pattern: str, part: int, *values: Column) -> Column:
    """A pattern's root cause (0) or fix (1) with its values; null without one of them."""
    text = INCIDENTS[pattern][part]
    if not values:
        return F.lit(text)
    known = values[0].isNotNull()
    for v in values[1:]:
        known = known & v.isNotNull()
    return F.when(known, F.format_string(text, *values))


def _py_set_text(values: Column, has_null: Column) -> Column:
    """Python's repr of a list of names (sorted here; the reference's set order is arbitrary)."""
    quoted = F.transform(F.array_sort(values), py_string)
    items = F.when(has_null, F.concat(quoted, F.array(F.lit("None")))).otherwise(quoted)
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def _incident(pattern: str, root: Column, fix: Column, cost: Column, tokens: Column, frame_count: Column,
              root_tool: Column | None = None, key: Column | None = None, agent: Column | None = None,
              src: Column | None = None, tseq: Column | None = None) -> Column:
    """One incident as a struct; the `_f_*` fields tell the frames pass which traces to keep."""
    def s(c):
        return (c if c is not None else F.lit(None)).cast("string")
    return F.struct(
        F.col("workflow_id").alias("workflow_id"),
        F.lit(RANK[pattern]).alias("pattern_rank"), F.lit(pattern).alias("pattern_name"),
        F.lit(SEVERITY[pattern]).alias("severity"), root.alias("root_cause"), fix.alias("fix_suggestion"),
        cost.cast("double").alias("cost_wasted"), tokens.cast("long").alias("tokens_wasted"),
        frame_count.cast("long").alias("frame_count"), F.lit(False).alias("is_simulated"),
        s(root_tool).alias("root_tool"), s(key).alias("_f_key"), s(agent).alias("_f_agent"), s(src).alias("_f_src"),
        (tseq if tseq is not None else F.lit(None)).cast("long").alias("_f_tseq"))


def _explode(df: DataFrame, items: list[tuple[Column, Column]]) -> DataFrame:
    arr = F.filter(F.array(*[F.when(cond, inc) for cond, inc in items]), lambda x: x.isNotNull())
    # workflow_id travels inside the struct: a pass-through column next to a generator can be
    # lost when the result is self-joined (incidents with their own frames)
    return df.select(*K, F.inline(arr))


class DetectorInputs:
    """Traces and sessions with their workflow's parameters attached."""

    def __init__(self, traces: DataFrame, sessions: DataFrame, params: DataFrame | None = None):
        if "workflow_id" not in traces.columns:
            traces = traces.join(sessions.select(*K, "workflow_id"), K, "left")
        self.traces = attach_params(traces, params)
        self.sessions = attach_params(_session_facts(sessions), params)


# ── tool pass: D1, D4, D6 ─────────────────────────────────────────────────────────────────────

def _tool_pass(x: DetectorInputs, wanted: set[str]) -> DataFrame:
    from runlens.functions.columns import cached
    tags, keys, aggs, order, items = cached(("tool_pass", frozenset(wanted)), lambda: _tool_exprs(wanted))
    tc = x.traces.filter(is_tool()).select(
        *K, "agent", "error", "tool_name", "latency_ms", "created_at", "seq", "tool_retry_threshold",
        "hyperactive_poll_threshold", tags.alias("_t"))
    g = tc.groupBy(*K, *keys).agg(*aggs)
    g = g.filter(F.col("n") >= F.col("thr"))
    w = g.groupBy(*K, "det").agg(F.min(F.struct(order.alias("o"), "key", "n", "named", "lat", "first")).alias("w"))
    j = w.select(*K, "det", "w.*").join(x.sessions, K)
    return _explode(j, items)


def _tool_exprs(wanted: set[str]):
    """The tool pass's expressions: call tags, grouping keys, aggregates, winner order, incidents."""
    ttl_key = F.coalesce(F.nullif(F.col("tool_name"), F.lit("")), F.lit("unknown_tool"))
    unk_key = F.coalesce(F.nullif(F.col("tool_name"), F.lit("")), F.lit("unknown"))
    tags = []
    if "Tool Timeout Loop" in wanted:         # D1: failed calls (outcome error or real error text)
        tags.append(F.when(is_err(), F.struct(F.lit(1).alias("det"), ttl_key.alias("key"))))
    if "Empty Result Loop" in wanted:         # D4: successful calls
        tags.append(F.when(F.coalesce(F.col("outcome"), F.lit("")) == "success",
                           F.struct(F.lit(4).alias("det"), unk_key.alias("key"))))
    if "Hyperactive Polling Loop" in wanted:  # D6: calls whose outcome is not error (null counts)
        tags.append(F.when(~outcome_is("error"), F.struct(F.lit(6).alias("det"), unk_key.alias("key"))))
    tag_col = F.explode(F.filter(F.array(*tags), lambda t: t.isNotNull()))
    det = F.col("_t.det")
    keys = [det.alias("det"), F.col("_t.key").alias("key")]
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(F.col("created_at"), F.col("seq"), F.col("agent"), F.col("error"), F.col("tool_name")))
        .alias("first"),
        F.min("seq").alias("first_seq"),
        F.count_if(F.col("tool_name") == F.col("_t.key")).alias("named"),
        F.sum(F.coalesce(F.col("latency_ms"), F.lit(0))).alias("lat"),
        F.max(F.when(det == 6, F.col("hyperactive_poll_threshold")).otherwise(F.col("tool_retry_threshold")))
        .alias("thr")]
    # First tool by the time of its first call; D4: first tool in input order
    order = (F.when(F.col("det") == 4, F.struct(F.lit(None).cast("timestamp").alias("t"), F.col("first_seq").alias("s")))
             .otherwise(F.struct(F.col("first.created_at").alias("t"), F.col("first.seq").alias("s"))))
    d = F.col("det")
    tool, n = F.col("key"), F.col("n")
    agent = _none(F.col("first.agent"))
    items = [
        (d == 1, _incident(
            "Tool Timeout Loop",
            _say("Tool Timeout Loop", 0, tool, n, agent,
                 F.substring(F.coalesce(F.nullif(F.col("first.error"), F.lit("")), F.lit("unknown error")), 1, ERROR_CHARS)),
            _say("Tool Timeout Loop", 1, tool, agent),
            F.col("_cost"), F.col("_tokens"), n, root_tool=F.col("first.tool_name"), key=tool)),
        ((d == 4) & (F.col("_trades") == 0), _incident(
            "Empty Result Loop",
            _say("Empty Result Loop", 0, tool, n),
            _say("Empty Result Loop", 1, tool),
            F.col("_cost"), F.col("_tokens"), F.col("named"), key=tool)),
        (d == 6, _incident(
            "Hyperactive Polling Loop",
            _say("Hyperactive Polling Loop", 0, tool, n, agent, thousands(F.col("lat"))),
            _say("Hyperactive Polling Loop", 1, agent, tool),
            F.col("_cost"), F.col("_tokens"), n, key=tool)),
    ]
    return tag_col, keys, aggs, order, items


# ── session pass: D2, D3, D5, D7, D10 ─────────────────────────────────────────────────────────

def _suspect() -> Column:
    """A non-error tool call faster than the workflow's limit on a tool that is not exempt."""
    lat = F.coalesce(F.col("latency_ms"), F.lit(0))
    return (is_tool() & ~outcome_is("error") & (lat > 0) & (lat < F.col("fabrication_latency_ms"))
            & ~F.array_contains(F.col("fabrication_exempt_tools"), F.coalesce(F.col("tool_name"), F.lit(""))))


def cost_history(sessions: DataFrame, n: int = HISTORY_SESSIONS, bucket_seconds: int | None = 86_400) -> DataFrame:
    """Previous-n-sessions cost statistics per (tenant, workflow), by (started_at, session_id), in the bucketed halo
    window (one day per bucket), so that no workflow is one task. `bucket_seconds=None` is the plain window
    with the same result, for tests."""
    s = sessions.withColumn("_hist_cost", F.coalesce(F.col("total_cost_usd").cast("double"), F.lit(0.0)))
    out = preceding_stats(s, ["tenant_id", "workflow_id"], ["started_at", "session_id"], "_hist_cost", n=n,
                          bucket_seconds=bucket_seconds)
    return out.drop("_hist_cost")


def _session_pass(x: DetectorInputs, wanted: set[str], history: DataFrame | None) -> DataFrame:
    from runlens.functions.columns import cached
    aggs, items = cached(("session_pass", frozenset(wanted)), lambda: _session_exprs(wanted))
    g = x.traces.groupBy(*K).agg(*aggs)
    s = x.sessions
    if "Cost Anomaly" in wanted:
        s = s.join(history.select(*K, "hist_n", "hist_mean", "hist_sd"), K, "left")
    else:
        s = s.select("*", F.lit(None).cast("long").alias("hist_n"), F.lit(None).cast("double").alias("hist_mean"),
                     F.lit(None).cast("double").alias("hist_sd"))
    j = s.join(g, K, "left")   # sessions without traces still get a cost check
    return _explode(j, items)


def _session_exprs(wanted: set[str]):
    """The session pass's aggregate list and candidate incidents (Column expressions only)."""
    first_agent = F.lower(F.element_at("pipeline_order", 1))
    is_first = lower_agent() == first_agent
    is_an = lower_agent() == F.lower(F.col("analysis_agent"))
    sus = _suspect()
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bool_or(is_tool() & is_err()), F.lit(False)).alias("tool_err"),
        F.coalesce(F.sum(F.when(is_an, toks())), F.lit(0)).alias("sp_tokens"),
        F.count_if(is_an).alias("sp_n"),
        F.coalesce(F.bool_or(agent_seen(F.array(lower_agent()), first_agent)), F.lit(False)).alias("seen_first"),
        F.coalesce(F.bool_or(agent_seen(F.array(lower_agent()), F.lower(F.element_at("pipeline_order", -1)))), F.lit(False)).alias("seen_last"),
        F.count_if(is_first).alias("nf"),
        F.max(F.when(is_first, F.struct(_order().alias("o"), F.col("step_type"), F.col("outcome")))).alias("last_first"),
        F.count_if(sus).alias("sus_n"),
        F.collect_set(F.when(sus, F.col("agent"))).alias("sus_agents"),
        F.coalesce(F.bool_or(sus & F.col("agent").isNull()), F.lit(False)).alias("sus_agent_null"),
        F.collect_set(F.when(sus, F.col("tool_name"))).alias("sus_tools"),
        F.coalesce(F.bool_or(sus & F.col("tool_name").isNull()), F.lit(False)).alias("sus_tool_null")]

    n = F.coalesce(F.col("n"), F.lit(0))
    trades0 = F.col("_trades") == 0
    aa = F.col("analysis_agent")
    order = F.transform("pipeline_order", lambda a: F.lower(a))
    fa, la = F.element_at(order, 1), F.element_at(order, -1)
    last = F.col("last_first")
    st = F.when(last.isNull(), F.lit("unknown")).otherwise(_none(last["step_type"]))
    oc = F.when(last.isNull(), F.lit("unknown")).otherwise(_none(last["outcome"]))
    z = F.when(F.col("hist_sd") > 0, (F.col("_cost") - F.col("hist_mean")) / F.col("hist_sd")).otherwise(F.lit(0.0))
    items = []

    def add(cond: Column, inc: Column) -> None:
        items.append((cond, inc))

    if "Context Spiral" in wanted:
        add((F.col("sp_tokens") > F.col("token_spiral_threshold")) & trades0, _incident(
            "Context Spiral",
            _say("Context Spiral", 0, capitalize(aa), thousands(F.col("sp_tokens"))),
            _say("Context Spiral", 1, aa, F.floor(F.col("token_spiral_threshold") / 2).cast("long")),
            F.col("_cost"), F.col("sp_tokens"), F.least(F.col("sp_n"), F.lit(20)), agent=F.lower(aa)))
    if "Pipeline Break" in wanted:
        add((F.size(order) >= 2) & F.coalesce("seen_first", F.lit(False)) & ~F.coalesce("seen_last", F.lit(False)), _incident(
            "Pipeline Break",
            _say("Pipeline Break", 0, capitalize(fa), la, fa, st, oc),
            _say("Pipeline Break", 1, fa, la, fa, la, fa),
            F.col("_cost"), F.col("_tokens"), F.least(F.coalesce(F.col("nf"), F.lit(0)), F.lit(10)), agent=fa))
    if "Silent Exit" in wanted:
        add(trades0 & (F.col("_reason") == "") & ~F.coalesce(F.col("tool_err"), F.lit(False)) & (n > 0),
                     _incident(
            "Silent Exit",
            _say("Silent Exit", 0), _say("Silent Exit", 1),
            F.col("_cost"), F.col("_tokens"), F.least(n, F.lit(10))))
    if "Tool Call Fabrication" in wanted:
        add(F.coalesce(F.col("sus_n"), F.lit(0)) >= F.col("fabrication_min_count"), _incident(
            "Tool Call Fabrication",
            _say("Tool Call Fabrication", 0, F.col("sus_n"), F.col("fabrication_latency_ms").cast("string"),
                 _py_set_text(F.col("sus_agents"), F.col("sus_agent_null")), _py_set_text(F.col("sus_tools"), F.col("sus_tool_null"))),
            _say("Tool Call Fabrication", 1),
            F.col("_cost"), F.lit(0), F.col("sus_n")))
    if "Cost Anomaly" in wanted:
        add((F.coalesce(F.col("hist_n"), F.lit(0)) >= 5) & (z > F.col("cost_anomaly_sigma")), _incident(
            "Cost Anomaly",
            _say("Cost Anomaly", 0, py_round(F.col("_cost"), 4), py_round(z, 1), py_round(F.col("hist_mean"), 4)),
            _say("Cost Anomaly", 1, py_round(F.col("hist_mean"), 4)),
            F.greatest(F.lit(0.0), F.col("_cost") - F.col("hist_mean")), F.lit(0), F.least(n, F.lit(15))))
    return aggs, items


# ── handoff pass: D8 ──────────────────────────────────────────────────────────────────────────

def _handoff_pass(x: DetectorInputs) -> DataFrame:
    pairs = (x.traces.select("*", F.posexplode("handoff_pairs").alias("_pos", "_pair"))
             .filter(F.size("_pair") >= 2)
             .withColumn("_src", F.lower(F.col("_pair")[0])).withColumn("_tgt", F.lower(F.col("_pair")[1])))
    is_src = F.startswith(lower_agent(), F.col("_src"))
    is_tgt = lower_agent() == F.col("_tgt")
    src_ok = (is_src & F.coalesce(F.col("step_type"), F.lit("")).isin("llm_call", "agent_message", "decision")
              & ~outcome_is("error"))
    g = pairs.filter(is_src | is_tgt).groupBy(*K, "_pos", "_src", "_tgt").agg(
        F.count_if(is_src).alias("sn"), F.count_if(is_tgt).alias("tn"), F.bool_or(src_ok).alias("src_ok"),
        F.min(F.when(is_tgt, F.struct(_order().alias("o"), is_err().alias("err"), F.col("error")))).alias("ft"))
    g = g.filter((F.col("sn") > 0) & (F.col("tn") > 0) & F.col("src_ok") & F.col("ft.err"))
    w = g.groupBy(*K).agg(F.min(F.struct("_pos", "_src", "_tgt", "sn", "ft")).alias("w"))
    j = w.select(*K, "w.*").join(x.sessions, K)
    src, tgt = F.col("_src"), F.col("_tgt")
    err = F.substring(F.coalesce(F.nullif(F.col("ft.error"), F.lit("")), F.lit("unknown schema error")), 1, ERROR_CHARS)
    inc = _incident(
        "Handoff Schema Break",
        _say("Handoff Schema Break", 0, capitalize(src), tgt, capitalize(src), tgt, err),
        _say("Handoff Schema Break", 1, src, tgt, src, tgt, tgt),
        F.col("_cost"), F.col("_tokens"), F.least(F.col("sn"), F.lit(5)) + 1, src=src, tseq=F.col("ft.o.seq"))
    return _explode(j, [(F.lit(True), inc)])


# ── error pass: D9 ────────────────────────────────────────────────────────────────────────────

def _first_n(rows: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy(*K).orderBy(F.col("created_at").asc_nulls_first(), F.col("seq"))
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def _error_pass(x: DetectorInputs) -> tuple[DataFrame, DataFrame]:
    p = "Error Misinterpretation"
    codes = F.array(*[F.lit(c) for c in HTTP_ERROR_CODES])
    err_txt = F.coalesce(F.col("error"), F.lit(""))
    step = F.coalesce(F.col("step_type"), F.lit(""))
    cand = x.traces.filter((step == "tool_call") & F.exists(codes, lambda c: F.contains(err_txt, c)))
    # "a later llm_call by the same agent": the agent's last llm_call, an aggregate instead of a
    # per-session sort or the reference's scan of every later trace
    llm = (x.traces.filter(step == "llm_call").groupBy(*K, "agent").agg(F.max(_order()).alias("_last_llm"))
           .select(*[F.col(c).alias("_l_" + c) for c in K], F.col("agent").alias("_l_agent"), "_last_llm"))
    cond = [cand[c] == llm["_l_" + c] for c in K] + [cand["agent"].eqNullSafe(llm["_l_agent"])]
    mis = cand.join(llm, cond).filter(_order() < F.col("_last_llm")).drop("_l_tenant_id", "_l_session_id",
                                                                          "_l_agent", "_last_llm")
    g = mis.groupBy(*K).agg(F.count(F.lit(1)).alias("_n"), F.collect_set("agent").alias("_agents"),
                            F.bool_or(F.col("agent").isNull()).alias("_agent_null"))
    g = g.filter(F.col("_n") >= 2)
    fired = mis.join(g.select(*K), K, "left_semi")
    first3 = (_first_n(fired, 3).groupBy(*K)
              .agg(F.sort_array(F.collect_list(F.struct(_order().alias("o"), F.substring(err_txt, 1, 60).alias("e"))))
                   .alias("_errs")))
    j = g.join(first3, K).join(x.sessions, K)
    errs = F.concat(F.lit("["), F.array_join(F.transform("_errs", lambda s: py_string(s["e"])), ", "), F.lit("]"))
    inc = _incident(
        p,
        _say("Error Misinterpretation", 0, F.col("_n"), _py_set_text(F.col("_agents"), F.col("_agent_null")), errs),
        _say("Error Misinterpretation", 1),
        F.col("_cost"), F.col("_tokens"), F.col("_n"))
    frames = fired.select(*K, F.lit(p).alias("pattern_name"), *frame_columns())
    return _explode(j, [(F.lit(True), inc)]), frames


# ── frames ────────────────────────────────────────────────────────────────────────────────────

def _frames(x: DetectorInputs, spec: DataFrame, last_n: dict[str, int]) -> DataFrame:
    """Evidence of every incident but D9 in one join of the traces with the incidents' keys; of the patterns in `last_n`
    the last so many traces."""
    s = spec.select(*K, "pattern_name", "_f_key", "_f_agent", "_f_src", "_f_tseq")
    j = x.traces.join(s, K)
    pat = F.col("pattern_name")
    ttl_key = F.coalesce(F.nullif(F.col("tool_name"), F.lit("")), F.lit("unknown_tool"))
    unk_key = F.coalesce(F.nullif(F.col("tool_name"), F.lit("")), F.lit("unknown"))
    member = (
        F.when(pat == "Tool Timeout Loop", is_tool() & is_err() & (ttl_key == F.col("_f_key")))
        .when(pat.isin("Context Spiral", "Pipeline Break"), lower_agent() == F.col("_f_agent"))
        .when(pat == "Empty Result Loop", is_tool() & (F.coalesce(F.col("outcome"), F.lit("")) == "success")
              & (F.col("tool_name") == F.col("_f_key")))
        .when(pat.isin("Silent Exit", "Cost Anomaly"), F.lit(True))
        .when(pat == "Hyperactive Polling Loop", is_tool() & ~outcome_is("error") & (unk_key == F.col("_f_key")))
        .when(pat == "Tool Call Fabrication", _suspect())
        .otherwise(F.lit(False)))
    # Handoff Schema Break keeps the last 5 source traces plus the first target trace (which may
    # also be one of the source traces, as in the reference)
    hsb = pat == "Handoff Schema Break"
    parts = (F.when(hsb, F.filter(F.array(F.when(F.startswith(lower_agent(), F.col("_f_src")), F.lit("src")),
                                          F.when(F.col("seq") == F.col("_f_tseq"), F.lit("tgt"))),
                                  lambda p: p.isNotNull()))
             .otherwise(F.when(F.coalesce(member, F.lit(False)), F.array(F.lit("all"))).otherwise(F.array())))
    c = j.select("*", F.explode(parts).alias("_part"))
    if not last_n:
        return c.select(*K, "pattern_name", *frame_columns())
    limit = F.create_map(*[F.lit(v) for kv in last_n.items() for v in kv])
    c = c.withColumn("_n", F.when(F.col("_part") == "tgt", F.lit(None).cast("int"))
                     .otherwise(F.try_element_at(limit, pat)))
    cols = [*K, "pattern_name", *frame_columns()]
    everything = c.filter(F.col("_n").isNull()).select(*cols)
    w = (Window.partitionBy(*K, "pattern_name", "_part")
         .orderBy(F.col("created_at").desc_nulls_last(), F.col("seq").desc()))
    ranked = c.filter(F.col("_n").isNotNull()).withColumn("_rn", F.row_number().over(w))
    last = ranked.filter(F.col("_rn") <= max(last_n.values())).filter(F.col("_rn") <= F.col("_n")).select(*cols)
    return everything.unionByName(last)


# ── D12-D15 ───────────────────────────────────────────────────────────────────────────────────

def failed_eval_rows(evals: DataFrame) -> DataFrame:
    """Failed evals of each session, in config order, each with role 'cause'. Bounded by the
    number of eval configs of the workflow."""
    f = evals.filter(~F.col("passed"))
    order = F.col("config_ord") if "config_ord" in evals.columns else F.lit(0)
    return f.groupBy(*K).agg(F.transform(
        F.sort_array(F.collect_list(F.struct(order.alias("o"), F.col("agent"), F.col("eval_name"), F.col("score"),
                                             F.col("threshold")))),
        lambda e: F.struct(e["agent"].alias("agent"), e["eval_name"].alias("eval_name"), e["score"].alias("score"),
                           e["threshold"].alias("threshold"), F.lit("cause").alias("role"))).alias("failed_evals"))


INCIDENT_COLUMNS = [*K, "workflow_id", "pattern_rank", "pattern_name", "severity", "root_cause", "fix_suggestion",
                    "cost_wasted", "tokens_wasted", "frame_count", "is_simulated", "root_tool"]


def run_detectors(traces: DataFrame, sessions: DataFrame, params: DataFrame | None = None,
                  evals: DataFrame | None = None, patterns: list[str] | None = None,
                  history_bucket_seconds: int | None = 86_400, history: DataFrame | None = None,
                  materialize: bool = True, last_n: dict[str, int] | None = None) -> Detected:
    """All detectors (or `patterns`) for all sessions. Returns (incidents, frames). `last_n` limits the evidence of
    some patterns to the last traces (default: LAST_N, as the reference's stacks; {} keeps every matching trace).
    `history` (see `cost_history`) may be computed over a larger set of sessions than judged.

    With `materialize` the incident table (one row per incident, small next to the traces) is
    checkpointed once into the shared checkpoint folder, so the frames join and any later use of
    the incidents read it instead of running the four detector passes again."""
    x = DetectorInputs(traces, sessions, params)
    wanted = set(patterns) if patterns else set(RANK)
    parts = []
    if wanted & set(TOOL_PASS):
        parts.append(_tool_pass(x, wanted))
    if wanted & set(SESSION_PASS):
        if "Cost Anomaly" in wanted and history is None:
            history = cost_history(sessions, bucket_seconds=history_bucket_seconds)
        parts.append(_session_pass(x, wanted, history))
    if "Handoff Schema Break" in wanted:
        parts.append(_handoff_pass(x))
    d9_frames = None
    if "Error Misinterpretation" in wanted:
        inc9, d9_frames = _error_pass(x)
        parts.append(inc9)
    spec = parts[0]
    for p in parts[1:]:
        spec = spec.unionByName(p)
    if materialize:
        from runlens.session import cut_lineage
        spec = cut_lineage(spec)
    frames = _frames(x, spec.filter(F.col("pattern_name") != "Error Misinterpretation"), LAST_N if last_n is None else last_n)
    if d9_frames is not None:
        frames = frames.unionByName(d9_frames)
    inc = spec.select(*INCIDENT_COLUMNS)
    if evals is not None:
        fe = failed_eval_rows(evals)
        inc = inc.join(fe, K, "left").withColumn(
            "failed_evals", F.coalesce(F.col("failed_evals"), F.array().cast(fe.schema["failed_evals"].dataType)))
    return Detected(inc, frames)


def incident_rows(incidents: DataFrame, tenant_id: str | None = None) -> DataFrame:
    """Stored form. Cost rounded to 4 places; tenant and status 'open' only when a tenant is given."""
    out = incidents.withColumn("cost_wasted", py_round(F.col("cost_wasted"), 4))
    if tenant_id:
        out = out.withColumn("tenant_id", F.lit(tenant_id)).withColumn("status", F.lit("open"))
    return out


def shadow_cb_fires(evals: DataFrame, cb_config: DataFrame) -> DataFrame:
    """Evals whose (agent, eval_name) has a breaker threshold and scored below it. Exact case."""
    from runlens.operators.config import config_table
    cb = config_table(cb_config).select(F.col("agent").alias("_a"), F.col("eval_name").alias("_e"), F.col("threshold").alias("_t"))
    j = evals.join(cb, (evals["agent"] == cb["_a"]) & (evals["eval_name"] == cb["_e"]))
    return j.filter(F.col("score") < F.col("_t")).select(
        *[c for c in K if c in evals.columns], "agent", "eval_name", py_round(F.col("score"), 3).alias("score"),
        F.col("_t").alias("threshold"))
