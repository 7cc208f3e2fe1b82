"""Judge, layer 4 (F1-F8), as a batch job over model replies.

The prompt side builds one request per (session, agent output, criterion); the calls to the
model are made elsewhere and come back as a `replies` table (request_id, raw_reply, call_error).
The verdict side parses and scores the replies, writes layer-4 eval rows and raises one
incident per (session, agent) with a failed criterion. Everything joins on keys; no row passes
through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.columns import K, py_round

# Judge model settings and prompt texts.
JUDGE_MODEL = "claude-haiku-4-5-20251001"
JUDGE_MAX_TOKENS = 256
REASONING_CHARS = 500        # of the stored `reasoning`; `reasoning_full` keeps all of it
PARSE_ERROR_CHARS = 100      # of a reply that can't be parsed, in `reasoning`
NO_REPLY = "no reply"        # our own wording: the request never came back
DEFAULT_THRESHOLD = 0.7
JUDGE_SYSTEM = ("You are an independent quality evaluator for AI agent outputs. "
                "Score the agent output against the given criterion. Be concise and precise. "
                "Respond with valid JSON only — no other text.")
JUDGE_PROMPT = """Agent: %s
Agent output%s:
%s

Criterion: %s
What to evaluate: %s

Score this output from 0 to 10:
  10 = fully meets the criterion
  7-9 = mostly meets, minor gaps
  4-6 = partially meets
  1-3 = mostly fails
  0 = completely fails or missing

Respond with JSON only:
{"score": <integer 0-10>, "passed": <bool>, "reasoning": "<one concise sentence>"}"""


def judge_criteria(eval_configs: DataFrame) -> DataFrame:
    """F1 (config side): enabled semantic criteria per tenant."""
    c = eval_configs.filter(F.coalesce(F.col("enabled"), F.lit(False)) & (F.col("eval_type") == "semantic")
                            & F.col("agent").isNotNull() & (F.col("agent") != ""))
    return c.select("tenant_id", "config_id", "eval_name", "agent", "threshold",
                    F.col("config.prompt").alias("criterion_prompt"),
                    F.coalesce(F.col("config_ord"), F.lit(0)).alias("config_ord"))


def judge_prompts(outputs: DataFrame, criteria: DataFrame, max_chars: int | None = None) -> DataFrame:
    """F1-F2: one request per (session, agent output, criterion) for agents (exact name) that have
    a non-empty output. The prompt holds the whole output; with `max_chars` (the online judge uses 3000)
    its first characters, which the prompt then says. `output_chars` is the full length. The criterion prompt falls back
    to the eval name."""
    c = criteria.withColumnRenamed("agent", "_c_agent").withColumnRenamed("tenant_id", "_c_tenant")
    note = f" (truncated to {max_chars} chars)" if max_chars else ""
    shown = F.substring("output", 1, max_chars) if max_chars else F.col("output")
    o = outputs.filter(F.col("output").isNotNull() & (F.col("output") != ""))
    j = o.join(c, (o["tenant_id"] == c["_c_tenant"]) & (o["agent"] == c["_c_agent"]))
    prompt = F.format_string(JUDGE_PROMPT, F.col("agent"), F.lit(note), shown, F.col("eval_name"),
                             F.coalesce(F.nullif(F.col("criterion_prompt"), F.lit("")), F.col("eval_name")))
    return j.select(
        *K, "agent", "output_id", "config_id", "config_ord", "eval_name",
        F.coalesce(F.nullif(F.col("threshold"), F.lit(0.0)), F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.sha2(F.concat_ws("|", "tenant_id", "session_id", "agent", "output_id", "config_id"), 256).alias("request_id"),
        F.lit(JUDGE_MODEL).alias("model"), F.lit(JUDGE_MAX_TOKENS).alias("max_tokens"),
        F.lit(JUDGE_SYSTEM).alias("system"), prompt.alias("prompt"),
        F.length("output").alias("output_chars"))


def _strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def parse_verdicts(replies: DataFrame) -> DataFrame:
    """reply text -> (score_raw, reasoning, error). Follows the judge step by step:
    strip a code fence, parse JSON (failure -> score 0 with 'Judge parse error: ' + the beginning
    of the reply), read `score` the way Python's float() would (missing -> 0), and turn
    the cases where the judge raises (a non-object reply, a null or non-numeric score, a failed
    call) into 'Judge error: ...' with score 0."""
    raw = F.coalesce(F.col("raw_reply"), F.lit("{}"))
    r = replies.withColumn("__s", _strip_ws(raw))
    s = F.col("__s")
    fenced = F.startswith(s, F.lit("```"))
    s1 = F.when(F.instr(s, "\n") > 0, F.expr("substr(__s, instr(__s, '\n') + 1)")).otherwise(s)
    r = r.withColumn("__s1", F.when(fenced, s1).otherwise(s))
    s2 = F.when(F.instr(F.col("__s1"), "```") > 0, F.expr("substr(__s1, 1, length(__s1) - length(substring_index(__s1, '```', -1)) - 3)")).otherwise(F.col("__s1"))
    r = r.withColumn("__txt", F.when(fenced, _strip_ws(s2)).otherwise(s))
    r = r.withColumn("__v", F.try_parse_json("__txt"))
    kind = F.schema_of_variant("__v")
    pytype = (F.when(F.startswith(kind, F.lit("OBJECT")), "dict").when(F.startswith(kind, F.lit("ARRAY")), "list")
              .when(kind == "BOOLEAN", "bool").when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int")
              .when(kind == "STRING", "str").when(kind == "VOID", "NoneType").otherwise("float"))
    sv = F.expr("variant_get(__v, '$.score')")
    s_kind = F.schema_of_variant(sv)
    s_str = F.try_variant_get(sv, "$", "string")
    s_num = (F.when(s_kind == "BOOLEAN", F.when(F.try_variant_get(sv, "$", "boolean"), 1.0).otherwise(0.0))
             .otherwise(F.try_variant_get(sv, "$", "double")))
    s_type = (F.when(F.startswith(s_kind, F.lit("OBJECT")), "dict").when(F.startswith(s_kind, F.lit("ARRAY")), "list")
              .when(s_kind == "VOID", "NoneType"))
    rv = F.expr("variant_get(__v, '$.reasoning')")
    reasoning = (F.when(rv.isNull(), F.lit("")).when(F.schema_of_variant(rv) == "VOID", F.lit("None"))
                 .when(F.schema_of_variant(rv) == "BOOLEAN",
                       F.when(F.try_variant_get(rv, "$", "boolean"), "True").otherwise("False"))
                 .otherwise(F.coalesce(F.try_variant_get(rv, "$", "string"), F.to_json(rv))))
    error = (F.when(F.col("call_error").isNotNull(), F.col("call_error"))
             .when(F.col("__v").isNull(), F.lit(None))
             .when(pytype != "dict", F.format_string("'%s' object has no attribute 'get'", pytype))
             .when(sv.isNull(), F.lit(None))
             .when(s_type.isNotNull(),
                   F.format_string("float() argument must be a string or a real number, not '%s'", s_type))
             .when(s_num.isNull(), F.format_string("could not convert string to float: '%s'", s_str)))
    parse_failed = F.col("__v").isNull() & F.col("call_error").isNull()
    score_raw = (F.when(parse_failed, F.lit(0.0)).when(error.isNotNull(), F.lit(0.0))
                 .when(sv.isNull(), F.lit(0.0)).otherwise(s_num))
    def text(parse_chars: int | None, chars: int | None) -> Column:
        cut = lambda c, n: F.substring(c, 1, n) if n else c
        return (F.when(parse_failed, F.concat(F.lit("Judge parse error: "), cut(raw, parse_chars)))
                .when(error.isNotNull(), F.concat(F.lit("Judge error: "), error))
                .otherwise(cut(reasoning, chars)))

    return r.select("*", score_raw.alias("score_raw"), text(PARSE_ERROR_CHARS, REASONING_CHARS).alias("reasoning"),
                    text(None, None).alias("reasoning_full"), error.isNotNull().alias("judge_error")).drop("__s", "__s1", "__txt", "__v")


def score_verdicts(prompts: DataFrame, replies: DataFrame) -> DataFrame:
    """clamp the score to 0..10, /10, round 3; passed = score >= threshold (the model's own
    flag is ignored); an erroring request scores 0 and fails, and so does a request without a reply. One row
    for each request."""
    v = parse_verdicts(replies).select("request_id", "score_raw", "reasoning", "reasoning_full", "judge_error")
    j = prompts.join(v.withColumn("_replied", F.lit(True)), "request_id", "left")
    lost = F.lit(f"Judge error: {NO_REPLY}")
    for c in ("reasoning", "reasoning_full"):
        j = j.withColumn(c, F.when(F.col("_replied").isNull(), lost).otherwise(F.col(c)))
    j = j.withColumn("judge_error", F.coalesce("judge_error", F.lit(True)))
    score = py_round(F.greatest(F.lit(0.0), F.least(F.lit(10.0), F.col("score_raw"))) / 10.0, 3)
    score = F.when(F.col("judge_error"), F.lit(0.0)).otherwise(score)
    passed = F.when(F.col("judge_error"), F.lit(False)).otherwise(score >= F.col("threshold"))
    return j.select(*K, "agent", "output_id", "config_id", "config_ord", "eval_name", score.alias("score"),
                    passed.alias("passed"), "threshold", "reasoning", "reasoning_full")


def judge_evals(results: DataFrame) -> DataFrame:
    """stored layer-4 eval rows with the reasoning in `detail`."""
    return results.select(*K, "eval_name", "agent", F.lit(4).alias("layer"), "score", "passed", "threshold",
                          F.to_json(F.struct(F.col("reasoning"))).alias("detail"))


def judge_incidents(results: DataFrame) -> DataFrame:
    """per (session, agent) with a failed criterion: severity by the mean shortfall of the
    failures (> 0.3 high, else medium), 'failed n of m' text, failed criteria in config order.
    The lists are bounded by the number of criteria of the agent."""
    failed = ~F.col("passed")
    g = results.groupBy(*K, "agent").agg(
        F.count(F.lit(1)).alias("n_results"), F.count_if(failed).alias("n_failed"),
        F.avg(F.when(failed, F.col("threshold") - F.col("score"))).alias("avg_shortfall"),
        F.sort_array(F.collect_list(F.when(failed, F.struct("config_ord", "eval_name", "score", "threshold",
                                                             "reasoning")))).alias("_f"))
    g = g.filter(F.col("n_failed") > 0)
    names = F.array_join(F.transform("_f", lambda x: x["eval_name"]), ", ")
    return g.select(
        *K, "agent", F.lit("semantic_quality_failure").alias("pattern_name"),
        F.when(F.col("avg_shortfall") > 0.3, "high").otherwise("medium").alias("severity"),
        F.format_string("%s output failed %d of %d quality criteria (semantic eval)", F.col("agent"),
                        F.col("n_failed"), F.col("n_results")).alias("root_cause"),
        F.transform("_f", lambda x: F.struct(F.col("agent").alias("agent"), x["eval_name"].alias("eval_name"),
                                             x["score"].alias("score"), x["threshold"].alias("threshold"),
                                             x["reasoning"].alias("reasoning"))).alias("failed_evals"),
        F.concat(F.lit("Review "), F.col("agent"), F.lit(" output quality. Failing: "), names,
                 F.lit(". Adjust criteria or agent prompt in the eval manager.")).alias("fix_suggestion"),
        F.lit("open").alias("status"), "n_failed", "n_results", "avg_shortfall")


def evaluate_session_outputs(outputs: DataFrame, eval_configs: DataFrame, replies: DataFrame):
    """F8: criteria -> prompts | replies -> scored results -> (layer-4 evals, incidents)."""
    prompts = judge_prompts(outputs, judge_criteria(eval_configs))
    results = score_verdicts(prompts, replies)
    return judge_evals(results), judge_incidents(results)
