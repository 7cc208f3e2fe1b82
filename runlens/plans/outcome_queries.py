"""Outcome, eval-table, circuit-breaker and quality-trend queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.columns import K
from runlens.plans.catalog import _inputs, query
from runlens.plans.eval_queries import PIPELINE, STANDARD, config_df, evals_sql, params_df
from runlens.plans.judge_queries import VERDICTS_SQL
from runlens.sources.adapters import (OUTCOMES_SQL, SESSIONS_SQL, TRACES_SQL, load_traces, outcomes_from_events,
                                      read_table, with_sql)


def _business(spark: SparkSession, sf_dir: str) -> DataFrame:
    from runlens.operators.outcomes import approval_rate, business_evals, research_yield
    _, s = _inputs(spark, sf_dir)
    s = s.withColumn("trades_approved", F.col("trades_executed"))
    return business_evals(research_yield(s).unionByName(approval_rate(s)))


BUSINESS_SQL = with_sql(TRACES_SQL, SESSIONS_SQL, """
y AS (SELECT tenant_id, session_id, 'research_yield' AS eval_name, 'research' AS agent, 5 AS layer,
             CASE WHEN trades_proposed > 0 THEN 1.0 ELSE 0.0 END AS score,
             CASE WHEN trades_proposed > 0 THEN true ELSE false END AS passed, 0.9 AS threshold,
             'Pipeline generated ' || trades_proposed || ' proposals' AS reasoning FROM sessions),
a AS (SELECT tenant_id, session_id, 'approval_rate', 'risk', 5,
             CAST(printf('%.4f', CAST(trades_executed AS DOUBLE) / trades_proposed) AS DOUBLE),
             CAST(trades_executed AS DOUBLE) / trades_proposed >= 0.20, 0.20,
             trades_executed || ' of ' || trades_proposed || ' proposals approved' FROM sessions WHERE trades_proposed > 0),
u AS (SELECT * FROM y UNION ALL SELECT * FROM a)
SELECT tenant_id, session_id, eval_name, agent, layer, CAST(score AS DOUBLE) AS score, passed,
       CAST(threshold AS DOUBLE) AS threshold, CAST(json_object('reasoning', reasoning) AS VARCHAR) AS detail FROM u""")


@query("business_evals", BUSINESS_SQL)
def business_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Research yield and approval rate as layer-5 evals."""
    return _business(spark, sf_dir).drop("entity_id")


NORM_SQL = with_sql(OUTCOMES_SQL, """
SELECT entity_id, event_id, coalesce(label, CASE WHEN value > 0 THEN 'success' WHEN value < 0 THEN 'fail' END) AS realized,
       'confirmed' AS source, value, TRY_CAST(amount_txt AS DOUBLE) AS amount, channel FROM outcomes""")


@query("normalize_outcomes", NORM_SQL)
def normalize_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Realised result from label or value sign; numeric signals as numbers."""
    from runlens.operators.outcomes import normalize_outcomes
    o = normalize_outcomes(outcomes_from_events(read_table(spark, sf_dir, "events")))
    return o.select("entity_id", "event_id", "realized", "source", "value",
                    F.element_at("signals_num", F.lit("amount")).alias("amount"),
                    F.element_at("signals", F.lit("channel")).alias("channel"))


LINK_SQL = with_sql(TRACES_SQL, OUTCOMES_SQL, """
w AS (SELECT tenant_id, 'u' || user_id AS entity_id, count(*) AS n_traces, count(DISTINCT session_id) AS n_sessions,
             sum(tokens_input + tokens_output) AS tokens, count(*) FILTER (WHERE outcome = 'error') AS n_errors
      FROM traces GROUP BY ALL)
SELECT o.entity_id, o.event_id, coalesce(o.label, CASE WHEN o.value > 0 THEN 'success' WHEN o.value < 0 THEN 'fail' END) AS realized,
       w.n_traces, w.n_sessions, CAST(w.tokens AS BIGINT) AS tokens, w.n_errors
FROM outcomes o JOIN w USING (tenant_id, entity_id)""")


@query("link_outcomes", LINK_SQL)
def link_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each outcome with the work done for its entity (no trace-pair fan-out)."""
    from runlens.operators.outcomes import link_outcomes, normalize_outcomes
    events = read_table(spark, sf_dir, "events")
    t = load_traces(spark, sf_dir).withColumn("entity_id", F.concat(F.lit("u"), F.col("user_id")))
    o = normalize_outcomes(outcomes_from_events(events))
    return link_outcomes(o, t).select("entity_id", "event_id", "realized", "n_traces", "n_sessions",
                                      F.col("tokens").cast("long").alias("tokens"), "n_errors")


ALL_EVALS_SQL = (
    "SELECT tenant_id, session_id, eval_name, agent, 3 AS layer, score, passed FROM (" + evals_sql(STANDARD, PIPELINE) + ")\n"
    "UNION ALL SELECT tenant_id, session_id, eval_name, agent, 4 AS layer, score, passed FROM (" + VERDICTS_SQL + ")\n"
    "UNION ALL SELECT tenant_id, session_id, eval_name, agent, layer, score, passed FROM (" + BUSINESS_SQL + ")")


@query("all_evals", ALL_EVALS_SQL)
def all_evals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule (3), judge (4) and business (5) evals in one table."""
    from runlens.operators.evals import run_rule_evals
    from runlens.operators.judge import judge_evals
    from runlens.operators.outcomes import all_evals
    from runlens.plans.judge_queries import _pipeline
    traces, sessions = _inputs(spark, sf_dir)
    l3 = run_rule_evals(sessions, traces, config_df(spark, STANDARD), params_df(spark, PIPELINE)).withColumn("layer", F.lit(3))
    _, _, res = _pipeline(spark, sf_dir)
    out = all_evals(l3, judge_evals(res), _business(spark, sf_dir))
    return out.select(*K, "eval_name", "agent", "layer", "score", "passed")


CB = [("research", "research_tools", 0.8), ("research", "research_completion", 0.7), ("risk", "risk_freshness", 1.0),
      ("research", "tool_success_rate", 0.80), ("research", "completion", 0.70), ("risk", "assessment_complete", 1.0)]

CB_SQL = ("WITH ev AS (" + evals_sql(STANDARD, PIPELINE) + "),\ncb AS (SELECT * FROM (VALUES "
          + ", ".join(f"('{a}', '{e}', {t})" for a, e, t in CB) + ") v(a, e, t))\n"
          "SELECT ev.tenant_id, ev.session_id, ev.agent, ev.eval_name, CAST(printf('%.3f', ev.score) AS DOUBLE) AS score, CAST(cb.t AS DOUBLE) AS threshold\n"
          "FROM ev JOIN cb ON ev.agent = cb.a AND ev.eval_name = cb.e WHERE ev.score < cb.t")


@query("shadow_cb_fires", CB_SQL)
def cb_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule evals that fall below a shadow circuit-breaker threshold."""
    from runlens.operators.config import cb_config_rows
    from runlens.operators.detectors import shadow_cb_fires
    from runlens.operators.evals import run_rule_evals
    traces, sessions = _inputs(spark, sf_dir)
    ev = run_rule_evals(sessions, traces, config_df(spark, STANDARD), params_df(spark, PIPELINE))
    return shadow_cb_fires(ev, cb_config_rows(spark, CB)).select(*K, "agent", "eval_name", "score", "threshold")


def _qscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from runlens.plans.judge_queries import _pipeline
    _, _, res = _pipeline(spark, sf_dir)
    q = res.filter(F.col("eval_name") == F.concat(F.col("agent"), F.lit("_quality")))
    q = q.select("tenant_id", "session_id", "agent", F.col("output_id").cast("long").alias("doc_id"),
                 F.col("score").alias("qscore"))
    # the rolling windows read their input three times (buckets, tails, rows): score once
    from runlens.session import cut_lineage
    return cut_lineage(q)


QS_SQL = VERDICTS_SQL.replace(
    "SELECT tenant_id, session_id, agent, eval_name, score, passed, CAST(threshold AS DOUBLE) AS threshold, reasoning FROM res",
    "SELECT tenant_id, session_id, agent, CAST(substr(session_id, 2) AS BIGINT) AS doc_id, score AS qscore FROM res "
    "WHERE eval_name = agent || '_quality'")

TREND_SQL = ("WITH q AS (" + QS_SQL + ")\nSELECT tenant_id, session_id, agent, qscore, "
             "round(CASE WHEN count(*) OVER w < 2 THEN 0.0 ELSE coalesce(regr_slope(qscore, idx) OVER w, 0.0) END, 6) AS slope FROM "
             "(SELECT *, CAST(row_number() OVER (PARTITION BY tenant_id, agent ORDER BY doc_id) AS DOUBLE) AS idx FROM q) "
             "WINDOW w AS (PARTITION BY tenant_id, agent ORDER BY doc_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")


@query("quality_trend", TREND_SQL)
def trend_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1-H2 (extension): per agent, the judge quality score of each session and its slope over
    the last five sessions."""
    from runlens.operators.outcomes import quality_slope
    # buckets of 1,000 documents split each (tenant, agent) partition; exact thanks to the halo
    s = quality_slope(_qscores(spark, sf_dir), ["tenant_id", "agent"], ["doc_id"], n=5,
                      bucket=F.floor(F.col("doc_id") / 1000))
    return s.select("tenant_id", "session_id", "agent", "qscore", F.round("slope", 6).alias("slope"))


GROUNDING_SQL = ("WITH q AS (" + QS_SQL + ")\nSELECT tenant_id, agent, session_id, 'Proactive: Grounding Failure' AS pattern_name, "
                 "'warning' AS severity, CAST(printf('%.3f', qscore) AS DOUBLE) AS last_score FROM (SELECT *, count(*) OVER w AS n, "
                 "count(qscore) OVER w AS nv, max(qscore) OVER w AS mx FROM q "
                 "WINDOW w AS (PARTITION BY tenant_id, agent ORDER BY doc_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) "
                 "WHERE n = 3 AND nv = 3 AND mx < 0.40")


@query("grounding_failure", GROUNDING_SQL)
def grounding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 (extension): three sessions in a row with a quality score under 0.40."""
    from runlens.operators.outcomes import grounding_failure
    return grounding_failure(_qscores(spark, sf_dir), ["tenant_id", "agent"], ["doc_id"],
                             bucket=F.floor(F.col("doc_id") / 1000))
