"""Rule evals, layer 3 (C1-C17), for every session and every enabled config at once.

Plan: configs are data. Each scope (tenant and workflow, one of them, or neither) holds the array of its distinct filter
groups (agent pattern, match strategy). Traces are first summed per (session, agent, tool); such a row looks its scopes
up in broadcast tables and is expanded by their groups, of which a compiled filter keeps those that its agent matches. ONE aggregate per
(session, filter group) computes every statistic any metric needs (C8's agents included, under a group of their own).
A session then meets its statistics once and gives them to its configs, found by the same scope lookup, and a
`when(metric = ...)` chain gives the raw score, which is rounded once, pass mark and detail. No per-config scan.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.columns import K, agent_matches, agent_seen, outcome_is, py_round, py_round2, real_error, toks
from runlens.operators.config import attach_params, config_rows, setting_value
from runlens.operators.registry import Registry

# Metric names understood by the engine.
KNOWN_METRICS = ["agent_presence", "tool_success_rate", "tool_diversity", "token_budget", "data_freshness",
                 "exit_quality", "cost_anomaly", "pipeline_coverage", "agent_completion", "session_field_ratio"]


def eval_config_filter(configs: DataFrame, registry: Registry | None = None) -> DataFrame:
    """Enabled (a missing column counts as enabled, a null as disabled), layer 3, type 'rule',
    a known metric, or 'custom' with a registered function."""
    c = configs
    enabled = F.coalesce(F.col("enabled"), F.lit(False)) if "enabled" in c.columns else F.lit(True)
    known = F.col("config.metric").isin(KNOWN_METRICS)
    if registry is not None and registry.has_any():
        known = known | (F.col("config.metric") == "custom")
    return c.filter(enabled & (F.col("layer") == 3) & (F.col("eval_type") == "rule") & known)


def resolve_configs(configs: DataFrame) -> DataFrame:
    """Eval name, agent, pattern and match defaults; threshold 0/null -> 0.5."""
    cfg = F.col("config")
    agent = F.coalesce(F.nullif(F.col("agent"), F.lit("")), F.lit("session"))
    ordc = F.col("config_ord") if "config_ord" in configs.columns else F.lit(0)
    return configs.select(
        F.col("workflow_id").alias("_cfg_wf"),
        (F.col("tenant_id") if "tenant_id" in configs.columns else F.lit(None)).cast("string").alias("_cfg_tenant"),
        ordc.alias("config_ord"),
        F.coalesce(F.nullif(F.col("eval_name"), F.lit("")), F.lit("unknown")).alias("eval_name"),
        agent.alias("agent"),
        F.coalesce(F.nullif(F.col("threshold").cast("double"), F.lit(0.0)), F.lit(0.5)).alias("_thr0"),
        cfg["metric"].alias("metric"),
        F.nullif(cfg["threshold_key"], F.lit("")).alias("threshold_key"),
        cfg["threshold_key"].alias("_raw_tkey"),
        F.lower(F.coalesce(F.nullif(cfg["agent_pattern"], F.lit("")), agent)).alias("pattern"),
        F.coalesce(F.nullif(cfg["agent_match"], F.lit("")), F.lit("exact")).alias("match"),
        F.coalesce(cfg["numerator_field"], F.lit("")).alias("num_field"),
        F.coalesce(cfg["denominator_field"], F.lit("")).alias("den_field"),
    )


COVERAGE = 0      # the filter group of C8: every trace, for the required agents only


def _scoped_items(df: DataFrame, scopes: list[tuple[str | None, str | None, list]], item: str, name: str = "_items") -> DataFrame:
    """`df` with the array of the items of all scopes (tenant, workflow, items) that apply to a row; a null tenant or
    workflow of a scope stands for every one. Scopes come from config rows, so their tables are bounded and broadcast."""
    found = []
    for k, keys in enumerate([[], ["workflow_id"], ["tenant_id"], ["tenant_id", "workflow_id"]]):
        own = [(t, w, items) for t, w, items in scopes if (t is not None) == ("tenant_id" in keys) and (w is not None) == ("workflow_id" in keys)]
        if not own:
            continue
        if not keys:
            text = json.dumps([dict(zip(_fields(item), i)) for _, _, items in own for i in items])
            found.append(F.from_json(F.lit(text), f"array<struct<{item}>>"))
            continue
        table = df.sparkSession.createDataFrame(own, f"_t string, _w string, _found{k} array<struct<{item}>>")
        same = [df[c] == table["_t" if c == "tenant_id" else "_w"] for c in keys]
        df = df.join(F.broadcast(table), same, "left").drop("_t", "_w")
        found.append(F.coalesce(f"_found{k}", F.array().cast(f"array<struct<{item}>>")))
    none = F.array().cast(f"array<struct<{item}>>")
    return df.withColumn(name, F.concat(none, *found)).drop(*[f"_found{k}" for k in range(4)])


def _fields(item: str) -> list[str]:
    return [x.split(":")[0] for x in item.split(",")]


def trace_stats(traces: DataFrame, groups: list[tuple], extra: list[Column] | None = None, params: DataFrame | None = None,
                coverage: bool = False) -> DataFrame:
    """One aggregate per (session, filter group) with everything C1-C5, C8, C9 and custom metrics need. `groups` are
    (tenant, workflow, gid, pattern, match).

    A filter group asks for a trace's agent only, so the traces are summed per (session, agent, tool) before they meet the
    groups; these sums are dealt by session, and the joins and aggregates by session that follow need no other shuffle.
    The aggregates of custom metrics (`extra`) need the traces themselves, so these are expanded where there are any."""
    step = F.coalesce(F.col("step_type"), F.lit(""))
    out = F.coalesce(F.col("outcome"), F.lit(""))
    tool = step == "tool_call"
    tname = F.regexp_replace(F.coalesce(F.col("tool_name"), F.lit("")), r"^\s+|\s+$", "")
    llm_ok = (((step == "llm_call") & (out == "success"))
              | (step.isin("agent_message", "decision") & ~out.isin("", "error")))
    counted = {"n": F.lit(True), "n_ok": ~outcome_is("error") & ~F.col("step_type").eqNullSafe(F.lit("error")),
               "n_tool": tool, "n_tool_ok": tool & ~outcome_is("error")}
    named = F.when(tool & (tname != ""), tname).alias("_p_tool")
    if extra:
        t = traces.select("*", named, *[F.when(c, 1).otherwise(0).cast("long").alias(f"_p_{k}") for k, c in counted.items()],
                          toks().alias("_p_tokens"), F.col("created_at").isNull().alias("_p_missing"),
                          F.col("created_at").alias("_p_first"), llm_ok.alias("_p_llm"))
    else:
        t = traces.groupBy(*K, "workflow_id", "agent", named).agg(
            *[F.count_if(c).alias(f"_p_{k}") for k, c in counted.items()], F.sum(toks()).alias("_p_tokens"),
            F.bool_or(F.col("created_at").isNull()).alias("_p_missing"), F.min("created_at").alias("_p_first"),
            F.bool_or(llm_ok).alias("_p_llm")).repartition(*K)

    item = "gid:bigint,pattern:string,match:string"
    scopes: dict = {}
    for tenant, workflow, *group in groups:
        scopes.setdefault((tenant, workflow), []).append(tuple(group))
    t = _scoped_items(t, [(*k, v) for k, v in scopes.items()], item)
    groups_of = F.col("_items")
    if coverage:
        t = attach_params(t, params)
        every = F.array(F.struct(F.lit(COVERAGE).cast("long").alias("gid"), F.lit("").alias("pattern"), F.lit("any").alias("match")))
        groups_of = F.when(F.size("required_agents") > 0, F.concat(groups_of, every)).otherwise(groups_of)
    # the match is a filter on the expanded rows, which compiled code makes one by one and drops at once
    m = t.withColumn("_g", F.explode(groups_of)).where(agent_matches(F.col("agent"), F.col("_g.pattern"), F.col("_g.match")))
    m = m.withColumn("_gid", F.col("_g.gid"))
    seen = F.lit(None).cast("array<string>").alias("_agents")
    if coverage:     # only required names are collected, so the set is bounded by the config, not by the agents of a session
        name = F.array(F.lower(F.coalesce(F.col("agent"), F.lit(""))))
        seen = F.array_distinct(F.flatten(F.collect_set(F.when(
            F.col("_gid") == COVERAGE, F.filter("required_agents", lambda a: agent_seen(name, a)))))).alias("_agents")
    return m.groupBy(*K, "_gid").agg(
        *[F.sum(f"_p_{k}").alias(k) for k in counted],
        F.sort_array(F.collect_set("_p_tool")).alias("tool_names"),
        F.sum("_p_tokens").alias("tokens"),
        F.coalesce(F.bool_or("_p_missing"), F.lit(False)).alias("ts_missing"),
        F.min("_p_first").alias("first_at"),
        F.coalesce(F.bool_or("_p_llm"), F.lit(False)).alias("llm_ok"), seen,
        *(extra or []),
    )


# Texts that Python's float() reads as a number.
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|inf(inity)?|nan)\s*$"


def session_numbers(sessions: DataFrame, asked: set[str]) -> tuple[Column, Column]:
    """A name -> value map over the session columns in `asked`, and the names whose value is no number. Text is read as a number where it is one; null, empty and false count as 0; a time, a list or
    other text is no number."""
    values, bad = [], []
    for f in sessions.schema.fields:
        c, kind = F.col(f.name), f.dataType
        if f.name not in asked:
            continue
        if isinstance(kind, (T.NumericType, T.BooleanType)):
            values.append((f.name, c.cast("double")))
        elif isinstance(kind, T.StringType):
            number = F.regexp_like(c, F.lit(NUMBER_TEXT))
            values.append((f.name, F.when(number, F.replace(F.trim(c), F.lit("_"), F.lit("")).try_cast("double"))))
            bad.append(F.when((c != "") & ~number, F.lit(f.name)))
        else:
            filled = F.size(c) > 0 if isinstance(kind, (T.ArrayType, T.MapType)) else c.isNotNull()
            bad.append(F.when(filled, F.lit(f.name)))
    numbers = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in values]), F.array(*[v for _, v in values])) if values \
        else F.create_map().cast(T.MapType(T.StringType(), T.DoubleType()))
    return numbers, F.array_compact(F.array(*bad).cast("array<string>"))


@dataclass
class EvalParts:
    score: Column
    detail: Column


def _detail(**fields) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def _json_obj(pairs: list[tuple[Column, Column]]) -> Column:
    """JSON object text with keys taken from data (config-named fields); a repeated key keeps
    its last value when parsed, as a Python dict would."""
    def enc(v: Column) -> Column:
        return F.regexp_extract(F.to_json(F.array(v)), r"^\[(.*)\]$", 1)
    items = [F.concat(enc(k), F.lit(":"), enc(v)) for k, v in pairs]
    return F.concat(F.lit("{"), F.concat_ws(",", *items), F.lit("}"))


def _figures() -> dict[str, list[tuple[Column, int]]]:
    """Figures that a metric's detail shows rounded: (value, places)."""
    first, started = F.unix_micros(F.col("first_at")), F.unix_micros(F.col("_started").cast("timestamp"))
    num, den = (F.coalesce(F.try_element_at("_nums", F.col(c)), F.lit(0.0)) for c in ("num_field", "den_field"))
    return {"data_freshness": [(F.abs(first - started) / 60e6, 1)],
            "cost_anomaly": [(F.col("hist_mean"), 4), (F.col("hist_sd"), 4), (_z_score(), 2)],
            "session_field_ratio": [(F.when(den != 0, num / den), 3)]}


def _z_score() -> Column:
    return F.when(F.col("hist_sd") > 0, (F.col("_cost") - F.col("hist_mean")) / F.col("hist_sd")).otherwise(F.lit(0.0))


def _metric_parts(wanted: set[str] | None = None) -> dict[str, EvalParts]:
    """Raw score (rounded to 2 places afterwards) and detail of each metric; a detail reads the rounded score from
    `score` and its figures (see `_figures`), rounded, from `_fig0`, `_fig1`, ..."""
    def want(m: str) -> bool:
        return wanted is None or m in wanted

    n, n_ok = F.col("n"), F.col("n_ok")
    has = n > 0
    reason = lambda s: _detail(reason=F.lit(s))
    figure = lambda k: F.col(f"_fig{k}")
    parts = {}

    # C1
    if want("agent_presence"):
        parts["agent_presence"] = EvalParts(
            F.when(has, n_ok / n).otherwise(0.0),
            F.when(has, _detail(total=n, success=n_ok)).otherwise(reason("no agent traces found")))

    # C2
    nt, nto = F.col("n_tool"), F.col("n_tool_ok")
    if want("tool_success_rate"):
        parts["tool_success_rate"] = EvalParts(
            F.when(nt > 0, nto / nt).otherwise(1.0),
            F.when(nt > 0, _detail(total=nt, success=nto, failed=nt - nto, rate=F.col("score")))
            .otherwise(reason("no tool calls made")))

    # C3
    d, mn = F.size("tool_names").cast("long"), F.col("tool_diversity_min")
    if want("tool_diversity"):
        parts["tool_diversity"] = EvalParts(
            F.when(d >= mn + 1, 1.0).when(d == mn, 0.7).when((d == mn - 1) & (mn > 1), 0.3)
            .when(d == 0, 0.0).otherwise(0.3),
            _detail(distinct_tools=d, min_required=mn, tool_names=F.col("tool_names")))

    # C4
    sess_tok = F.col("_sess_tokens")
    trades = F.col("_trades")
    used = F.when(has, F.col("tokens")).when(trades > 0, F.expr("_sess_tokens div _trades")).otherwise(sess_tok)
    tthr = F.col("_tok_thr")
    if want("token_budget"):
        parts["token_budget"] = EvalParts(
            F.greatest(F.lit(0.0), 1.0 - used / (tthr * 2)), _detail(tokens_used=used, threshold=tthr))

    # C5
    mins = F.col("data_freshness_minutes")
    unknown = F.col("_started").isNull() | F.col("ts_missing")
    if want("data_freshness"):
        lag = _figures()["data_freshness"][0][0]
        parts["data_freshness"] = EvalParts(
            F.when(~has, 0.0).when(unknown, 1.0).when(mins == 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - lag / (mins * 2))),
            F.when(~has, reason("no agent traces"))
            .when(unknown, reason("timestamps unavailable — assuming fresh"))
            .when(mins == 0, reason("parse error: float division by zero"))
            .otherwise(_detail(lag_minutes=figure(0), threshold_minutes=mins)))

    # C6
    r = F.lower(F.coalesce(F.col("_reason"), F.lit("")))
    good, partial, bad = (F.array_contains(F.col(c), r) for c in ("good_exits", "partial_exits", "bad_exits"))
    if want("exit_quality"):
        parts["exit_quality"] = EvalParts(
            F.when((trades > 0) | good, 1.0).when(partial, 0.5).when(bad, 0.2)
            .when((trades == 0) & (r == ""), 0.0).otherwise(0.2),
            F.when((trades > 0) | good, _detail(terminal_reason=r, trades_executed=trades))
            .when(partial, _detail(terminal_reason=r, reason=F.lit("pipeline partially completed")))
            .when(bad, _detail(terminal_reason=r, reason=F.lit("bad exit state")))
            .when((trades == 0) & (r == ""), reason("0 trades and no terminal_reason — silent exit"))
            .otherwise(_detail(terminal_reason=r, reason=F.lit("unclassified exit"))))

    # C7
    few, cost = F.coalesce(F.col("hist_n"), F.lit(0)) < 5, F.col("_cost")
    if want("cost_anomaly"):
        parts["cost_anomaly"] = EvalParts(
            F.when(few, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - F.greatest(F.lit(0.0), _z_score() - 1) / 2)),
            F.when(few, _detail(reason=F.lit("insufficient history"), cost_usd=cost))
            .otherwise(_detail(cost_usd=cost, mean=figure(0), stdev=figure(1), z_score=figure(2),
                               threshold_sigma=F.col("cost_anomaly_sigma"))))

    # C8 (all traces of the session, not only the agent's)
    req = F.col("required_agents")
    seen = F.coalesce(F.col("_agents"), F.array().cast("array<string>"))       # the required agents that were seen
    hit = F.filter(req, lambda a: F.array_contains(seen, a))
    miss = F.filter(req, lambda a: ~F.array_contains(seen, a))
    if want("pipeline_coverage"):
        parts["pipeline_coverage"] = EvalParts(
            F.when(F.size(req) == 0, 1.0).otherwise(F.size(hit) / F.size(req)),
            F.when(F.size(req) == 0, reason("no required_agents configured")).otherwise(_detail(present=hit, missing=miss)))

    # C9
    llm = F.coalesce(F.col("llm_ok"), F.lit(False))
    all_failed = (F.coalesce(nt, F.lit(0)) > 0) & (F.coalesce(nto, F.lit(0)) == 0)
    if want("agent_completion"):
        parts["agent_completion"] = EvalParts(
            F.when(~llm, 0.0).when(all_failed, 0.3).otherwise(1.0),
            F.when(~llm, reason("no successful llm_call or decision trace"))
            .when(all_failed, _detail(reason=F.lit("llm ran but all tool calls failed"), tool_calls=nt))
            .otherwise(_detail(llm_ok=F.lit(True), tool_calls_ok=F.lit(True))))

    # C10
    nums = F.col("_nums")
    num = F.coalesce(F.try_element_at(nums, F.col("num_field")), F.lit(0.0))
    den = F.coalesce(F.try_element_at(nums, F.col("den_field")), F.lit(0.0))
    thr = F.col("threshold")
    if want("session_field_ratio"):
        parts["session_field_ratio"] = EvalParts(
            F.when(den == 0, F.when(num == 0, 1.0).otherwise(0.0))
            .when(thr > 0, F.least(F.lit(1.0), num / den / thr)).otherwise(1.0),
            F.when(den == 0, _json_obj([(F.col("num_field"), num), (F.col("den_field"), F.lit(0)),
                                        (F.lit("reason"), F.concat(F.col("den_field"), F.lit(" is 0")))]))
            .otherwise(_json_obj([(F.col("num_field"), num), (F.col("den_field"), den),
                                  (F.lit("ratio"), figure(0)), (F.lit("threshold"), thr)])))
    return parts


EVAL_COLS = ["tenant_id", "session_id", "workflow_id", "config_ord", "eval_name", "agent", "metric", "score",
             "passed", "threshold", "detail"]


def run_rule_evals(sessions: DataFrame, traces: DataFrame, eval_configs: DataFrame,
                   params: DataFrame | None = None, registry: Registry | None = None,
                   history: DataFrame | None = None) -> DataFrame:
    """C17: every enabled rule config of a session's workflow, for every session.

    `history` (from detectors.cost_history) supplies the recent-cost statistics for C7;
    it is computed here when a cost_anomaly config is present and none is given."""
    # The config table is read once (bounded, see config_rows), so that the plan only carries the metrics and scopes
    # that are configured.
    spark = sessions.sparkSession
    cfgs = resolve_configs(eval_config_filter(spark.createDataFrame(config_rows(eval_configs), eval_configs.schema), registry))
    rows = cfgs.collect()
    metrics = {r.metric for r in rows}
    gids = {g: i for i, g in enumerate(sorted({(r._cfg_tenant, r._cfg_wf, r.pattern, r.match) for r in rows}, key=str), 1)}
    groups = [(t, w, i, pattern, match) for (t, w, pattern, match), i in gids.items()]

    if "workflow_id" not in traces.columns:
        traces = traces.join(sessions.select(*K, "workflow_id"), K, "left")
    stats = trace_stats(traces, groups, registry.trace_aggregates() if registry is not None else None, params,
                        "pipeline_coverage" in metrics)

    s = sessions
    if "cost_anomaly" in metrics:
        if history is None:
            from runlens.operators.detectors import cost_history
            history = cost_history(sessions)
        s = s.join(history.select(*K, "hist_n", "hist_mean", "hist_sd"), K, "left")
        hist_cols = [F.col("hist_n"), F.col("hist_mean"), F.col("hist_sd")]
    else:
        hist_cols = [F.lit(None).cast(t).alias(c) for c, t in
                     [("hist_n", "long"), ("hist_mean", "double"), ("hist_sd", "double")]]
    custom = registry is not None and registry.has_any()
    asked = {f for r in rows for f in (r.num_field, r.den_field)}
    numbers, not_numbers = session_numbers(sessions, asked | (_numeric(sessions) if custom else set()))
    s = s.select(
        *K, "workflow_id", *hist_cols,
        F.col("started_at").alias("_started"),
        F.coalesce(F.col("total_cost_usd").cast("double"), F.lit(0.0)).alias("_cost"),
        (F.coalesce(F.col("total_tokens_input"), F.lit(0)) + F.coalesce(F.col("total_tokens_output"), F.lit(0)))
        .cast("long").alias("_sess_tokens"),
        F.coalesce(F.col("trades_executed"), F.lit(0)).cast("long").alias("_trades"),
        F.col("terminal_reason").alias("_reason"),
        numbers.alias("_nums"), not_numbers.alias("_no_numbers"))

    # the configs of a session's scopes; C8 reads the group of its own
    scopes: dict = {}
    for r in rows:
        gid = COVERAGE if r.metric == "pipeline_coverage" else gids[r._cfg_tenant, r._cfg_wf, r.pattern, r.match]
        scopes.setdefault((r._cfg_tenant, r._cfg_wf), []).append((
            r.config_ord, r.eval_name, r.agent, r._thr0, r.metric, r.threshold_key, r._raw_tkey, r.num_field, r.den_field, gid))
    item = ("config_ord:int,eval_name:string,agent:string,_thr0:double,metric:string,threshold_key:string,_raw_tkey:string,"
            "num_field:string,den_field:string,_gid:bigint")
    sc = _scoped_items(s, [(*k, v) for k, v in scopes.items()], item)
    # a session's statistics (one for each filter group, so bounded by the configs) meet it once; its configs look theirs up
    figures_of = F.struct(*[c for c in stats.columns if c not in (*K, "_gid")])
    by_session = stats.groupBy(*K).agg(F.map_from_entries(F.collect_list(F.struct("_gid", figures_of))).alias("_stats"))
    sc = sc.join(by_session, K, "left")
    sc = sc.select(*[c for c in sc.columns if c != "_items"], F.inline("_items")).withColumn("_stat", F.try_element_at("_stats", F.col("_gid")))
    sc = attach_params(sc.select(*[c for c in sc.columns if c not in ("_stats", "_gid", "_stat")], "_stat.*"), params)

    # threshold_key override from the workflow's settings (defaults included)
    tval = setting_value(F.col("threshold_key"))
    override = F.when(F.col("threshold_key").isNotNull() & tval.isNotNull(), tval.try_cast("double"))
    # token_budget reads its budget from the key (default token_efficiency_threshold)
    tok_key = F.coalesce(F.col("_raw_tkey"), F.lit("token_efficiency_threshold"))
    tok_raw = F.coalesce(setting_value(tok_key), setting_value(F.lit("token_efficiency_threshold")))
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in ["n", "n_ok", "n_tool", "n_tool_ok", "tokens"]}
    filled["tool_names"] = F.coalesce(F.col("tool_names"), F.array().cast("array<string>"))
    filled["ts_missing"] = F.coalesce(F.col("ts_missing"), F.lit(False))
    keep = [c for c in sc.columns if c not in filled]
    sc = sc.select(*keep, *[v.alias(k) for k, v in filled.items()],
                   (F.col("threshold_key").isNotNull() & tval.isNotNull() & override.isNull()).alias("_bad_override"),
                   F.coalesce(override, F.col("_thr0")).alias("threshold"),
                   tok_raw.try_cast("double").try_cast("long").alias("_tok_thr"))
    # a zero budget, a field that is no number or an override that is none raise in the reference, so no row
    field = lambda c: F.array_contains("_no_numbers", F.col(c))
    sc = sc.filter(~F.col("_bad_override")
                   & ~((F.col("metric") == "token_budget") & (F.coalesce(F.col("_tok_thr"), F.lit(0)) == 0))
                   & ~((F.col("metric") == "session_field_ratio") & (field("num_field") | field("den_field"))))

    from runlens.functions.columns import cached
    parts = cached(("metric_parts", frozenset(metrics)), lambda: _metric_parts(metrics))
    metric = F.col("metric")
    raw = detail = None
    for name, p in parts.items():
        if name in metrics:
            raw = F.when(metric == name, p.score) if raw is None else raw.when(metric == name, p.score)
            detail = F.when(metric == name, p.detail) if detail is None else detail.when(metric == name, p.detail)
    own = registry.branches(F.col("workflow_id"), F.col("eval_name")) if custom else []
    own_score = F.lit(None).cast("double")
    for cond, (score, text) in reversed(own):
        own_score = F.when((metric == "custom") & cond, score).otherwise(own_score)
    for cond, (_, text) in own:
        c2 = (metric == "custom") & cond
        detail = F.when(c2, text) if detail is None else detail.when(c2, text)
    none = F.lit(None)
    sc = sc.withColumn("_raw", (none if raw is None else raw).cast("double")).withColumn("_own", own_score)
    figures = {m: f for m, f in _figures().items() if m in metrics}
    shown = max([len(f) for f in figures.values()], default=0)
    places = [[(m, f[k]) for m, f in figures.items() if k < len(f)] for k in range(shown)]
    for k, values in enumerate(places):
        c = none.cast("double")
        for m, (v, _) in values:
            c = F.when(metric == m, v).otherwise(c)
        sc = sc.withColumn(f"_show{k}", c)
    rounded = {"score": F.coalesce("_own", py_round2(F.col("_raw")))}
    for k, values in enumerate(places):
        c = none.cast("double")
        for m, (_, digits) in values:
            c = F.when(metric == m, py_round(F.col(f"_show{k}"), digits)).otherwise(c)
        rounded[f"_fig{k}"] = c
    # known metrics always have a score; a filter on the rounded one would be pushed down with all of its expression
    sc = sc.filter((metric != "custom") | F.col("_own").isNotNull()).withColumns(rounded)
    thr = F.when(metric == "token_budget", F.lit(0.5)).otherwise(F.col("threshold"))       # token_budget passes at 0.5
    out = sc.select(*K, "workflow_id", "config_ord", "eval_name", "agent", "metric", "score", thr.alias("threshold"),
                    (none if detail is None else detail).cast("string").alias("detail"))
    return out.select(*K, "workflow_id", "config_ord", "eval_name", "agent", "metric", "score",
                      (F.col("score") >= F.col("threshold")).alias("passed"), "threshold", "detail")


def _numeric(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))}


def eval_rows(evals: DataFrame, tenant_id: str | None = None, workflow_id: str | None = None) -> DataFrame:
    """Stored form; score rounded to 3, layer 3, tenant/workflow only when given."""
    out = evals.withColumn("score", py_round(F.col("score"), 3)).withColumn("layer", F.lit(3))
    if tenant_id:
        out = out.withColumn("tenant_id", F.lit(tenant_id))
    if workflow_id:
        out = out.withColumn("workflow_id", F.lit(workflow_id))
    return out
