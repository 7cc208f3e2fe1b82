"""Root-cause annotation (E1-E3): annotated call stacks, fix texts and incident summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.functions.columns import K, is_err, lower_agent, thousands, toks
from runlens.operators.texts import FIXES

# Severity colours and the fallback.
SEVERITY_COLORS = {"critical": "#EF4444", "warning": "#F59E0B", "info": "#3B82F6"}
DEFAULT_COLOR = "#94A3B8"


def annotate_call_stack(incidents: DataFrame, traces: DataFrame) -> DataFrame:
    """Every trace of each incident's session with `is_relevant`, `is_root` and `tokens`.
    Relevance per pattern: Tool Timeout Loop - the root tool (raw name of the first failed call;
    a null name marks nothing); Context Spiral - agent research; Pipeline Break - research or
    orchestrator; Cost Anomaly / Silent Exit / Empty Result Loop - error rows. Only a Tool Timeout
    Loop has a root: its first failing relevant step. Agent names are fixed, as in the reference.
    Extra trace columns pass through."""
    inc = incidents.select(*K, "pattern_name", "root_tool")
    j = traces.join(inc, K)
    pat = F.col("pattern_name")
    err = is_err()
    relevant = (F.when(pat == "Tool Timeout Loop", F.coalesce(F.col("tool_name") == F.col("root_tool"), F.lit(False)))
                .when(pat == "Context Spiral", lower_agent() == "research")
                .when(pat == "Pipeline Break", lower_agent().isin("research", "orchestrator"))
                .when(pat.isin("Cost Anomaly", "Silent Exit", "Empty Result Loop"), err)
                .otherwise(F.lit(False)))
    j = j.withColumn("is_relevant", relevant).withColumn("_err", err)
    # the root: first erroring relevant step, found with an aggregate (no per-session sort)
    roots = (j.filter((pat == "Tool Timeout Loop") & F.col("is_relevant") & F.col("_err"))
             .groupBy(*K, "pattern_name").agg(F.min(F.struct("created_at", "seq")).alias("_root")))
    j = j.join(roots, K + ["pattern_name"], "left")
    is_root = F.coalesce(F.col("is_relevant") & F.col("_err") & (F.struct("created_at", "seq") == F.col("_root")),
                         F.lit(False))
    return j.withColumn("is_root", is_root).withColumn("tokens", toks()).drop("_err", "_root", "root_tool")


def _first_named(frames: DataFrame) -> DataFrame:
    """First non-empty tool and agent of each incident's frames (deterministic stand-in for
    the reference's arbitrary set element), plus the distinct frame agents."""
    tool = F.nullif(F.col("tool_name"), F.lit(""))
    agent = F.nullif(F.col("agent"), F.lit(""))
    return frames.groupBy(*K, "pattern_name").agg(
        F.min(F.when(tool.isNotNull(), F.struct("created_at", "seq", tool.alias("v")))).alias("_t"),
        F.min(F.when(agent.isNotNull(), F.struct("created_at", "seq", agent.alias("v")))).alias("_a"),
        F.array_sort(F.collect_set(agent)).alias("frame_agents"))


def fix_suggestions(incidents: DataFrame, frames: DataFrame) -> DataFrame:
    """The detailed fix text for six patterns; other patterns keep their own."""
    j = incidents.join(_first_named(frames), K + ["pattern_name"], "left")
    tool = F.coalesce(F.col("_t.v"), F.lit("the tool"))
    agent = F.coalesce(F.col("_a.v"), F.lit("the agent"))
    pat = F.col("pattern_name")
    values = {"Tool Timeout Loop": (tool, agent, tool), "Context Spiral": (thousands(F.floor(F.col("tokens_wasted") / 2)),),
              "Empty Result Loop": (tool, tool)}
    text = F.when(F.lit(False), F.lit(""))
    for name, words in FIXES.items():
        text = text.when(pat == name, F.format_string(words, *values[name]) if name in values else F.lit(words))
    text = text.otherwise(F.col("fix_suggestion"))
    return j.withColumn("fix_detail", text).drop("_t", "_a", "frame_agents")


def summarize_incidents(incidents: DataFrame, sessions: DataFrame, frames: DataFrame) -> DataFrame:
    """Display summary per incident."""
    colors = F.create_map(*[F.lit(x) for kv in SEVERITY_COLORS.items() for x in kv])
    s = sessions.select(*K, "started_at", "completed_at", "trades_executed")
    j = incidents.join(s, K, "left").join(_first_named(frames).select(*K, "pattern_name", "frame_agents"),
                                          K + ["pattern_name"], "left")
    dur = F.abs(F.unix_micros(F.col("completed_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp")))
    failed = F.size(F.col("failed_evals")) if "failed_evals" in incidents.columns else F.lit(0)
    return j.select(
        *K, F.col("pattern_name").alias("pattern"), "severity",
        F.coalesce(F.try_element_at(colors, F.col("severity")), F.lit(DEFAULT_COLOR)).alias("severity_color"),
        "root_cause", "fix_suggestion", "cost_wasted", "tokens_wasted",
        F.coalesce((dur / 1_000_000).cast("long"), F.lit(0)).alias("duration_s"),
        F.coalesce(F.col("trades_executed"), F.lit(0)).cast("long").alias("trades"),
        F.coalesce(F.col("frame_agents"), F.array().cast("array<string>")).alias("agents"),
        F.greatest(failed, F.lit(0)).cast("long").alias("failed_eval_count"))
