"""Judge queries (F1-F8) over documents and labels, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.columns import K
from runlens.plans.catalog import query
from runlens.sources.adapters import judge_configs, judge_outputs, judge_replies, read_table, with_sql


def _pipeline(spark: SparkSession, sf_dir: str):
    """Prompts are built once; the verdict side needs only their keys, which are stored (a narrow
    table) so the document text is read a single time."""
    from runlens.operators.judge import judge_criteria, judge_prompts, score_verdicts
    from runlens.session import cut_lineage
    outputs = judge_outputs(read_table(spark, sf_dir, "documents"))
    prompts = judge_prompts(outputs, judge_criteria(judge_configs(outputs)))
    keys = cut_lineage(prompts.drop("prompt", "system"))
    replies = judge_replies(keys, read_table(spark, sf_dir, "labels"))
    return prompts, replies, score_verdicts(keys, replies)


NL = "chr(10)"
PROMPT_SQL = (f"'Agent: ' || agent || {NL} || 'Agent output:' || {NL} || output"
              f" || {NL} || {NL} || 'Criterion: ' || eval_name || {NL} || 'What to evaluate: ' || coalesce(cprompt, eval_name)"
              f" || {NL} || {NL} || 'Score this output from 0 to 10:' || {NL} || '  10 = fully meets the criterion' || {NL}"
              f" || '  7-9 = mostly meets, minor gaps' || {NL} || '  4-6 = partially meets' || {NL}"
              f" || '  1-3 = mostly fails' || {NL} || '  0 = completely fails or missing' || {NL} || {NL}"
              f" || 'Respond with JSON only:' || {NL}"
              """ || '{"score": <integer 0-10>, "passed": <bool>, "reasoning": "<one concise sentence>"}'""")

BASE_SQL = """
o AS (SELECT 't' || (doc_id % 3) AS tenant_id, 'd' || doc_id AS session_id, source AS agent, doc_id, text AS output
      FROM documents WHERE text IS NOT NULL AND text <> ''),
c AS (SELECT * FROM (VALUES (0, 'quality', 0.7, 'Is the text well written and on topic?'),
                            (1, 'safety', NULL, NULL)) v(ord, name, thr, cprompt)),
p AS (SELECT o.*, c.ord, o.agent || '_' || c.name AS eval_name, coalesce(nullif(c.thr, 0), 0.7) AS threshold,
             c.cprompt FROM o CROSS JOIN c)"""


PROMPTS_SQL = with_sql(BASE_SQL, f"""
SELECT tenant_id, session_id, agent, eval_name, CAST(threshold AS DOUBLE) AS threshold,
       md5({PROMPT_SQL}) AS prompt_md5, CAST(length(output) AS INTEGER) AS output_chars
FROM p""")


@query("judge_prompts", PROMPTS_SQL)
def prompts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F2: one judge request per (session, agent output, criterion)."""
    prompts, _, _ = _pipeline(spark, sf_dir)
    return prompts.select(*K, "agent", "eval_name", "threshold", F.md5("prompt").alias("prompt_md5"), "output_chars")


VERDICT_BODY = """,
l AS (SELECT p.*, lb.quality, lb.toxic, lb.doc_id IS NOT NULL AS replied FROM p LEFT JOIN labels lb USING (doc_id)),
sc AS (SELECT *, CASE WHEN ord = 0 THEN quality * 6 + doc_id % 5 ELSE (1 - toxic) * 8 + doc_id % 3 END AS sraw FROM l),
obj AS (SELECT *, '{"score": ' || CASE doc_id % 17 WHEN 5 THEN '"high"' WHEN 7 THEN 'null' ELSE CAST(sraw AS VARCHAR) END
                  || ', "passed": ' || CASE WHEN sraw >= 7 THEN 'true' ELSE 'false' END
                  || ', "reasoning": "quality ' || quality || ', toxic ' || toxic || ' for doc ' || doc_id || '"}' AS o_json
        FROM sc),
rr AS (SELECT *, CASE WHEN doc_id % 11 = 0 THEN 'no json here' WHEN doc_id % 11 = 1 THEN '[1]'
                      WHEN doc_id % 5 = 0 THEN '```json' || chr(10) || o_json || chr(10) || '```' ELSE o_json END AS raw
       FROM obj),
st AS (SELECT *, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS s FROM rr),
s1 AS (SELECT *, CASE WHEN starts_with(s, '```') THEN
                   CASE WHEN strpos(s, chr(10)) > 0 THEN substr(s, strpos(s, chr(10)) + 1) ELSE s END END AS a FROM st),
s2 AS (SELECT *, CASE WHEN a IS NULL THEN s
                      WHEN strpos(a, '```') > 0 THEN regexp_replace(
                         left(a, length(a) - strpos(reverse(a), '```') - 3 + 1), '^\\s+|\\s+$', '', 'g')
                      ELSE regexp_replace(a, '^\\s+|\\s+$', '', 'g') END AS txt FROM s1),
v AS (SELECT *, json_valid(txt) AS ok, CASE WHEN json_valid(txt) THEN json_type(txt::JSON) END AS jt FROM s2),
k AS (SELECT *, CASE WHEN NOT replied THEN 'no reply' WHEN doc_id % 17 = 3 THEN 'connection reset'
                     WHEN NOT ok THEN NULL
                     WHEN jt <> 'OBJECT' THEN '''' || CASE jt WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str'
                       WHEN 'BIGINT' THEN 'int' WHEN 'UBIGINT' THEN 'int' WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType'
                       ELSE 'float' END || ''' object has no attribute ''get'''
                     WHEN json_type(txt::JSON, '$.score') = 'NULL'
                       THEN 'float() argument must be a string or a real number, not ''NoneType'''
                     WHEN json_type(txt::JSON, '$.score') = 'VARCHAR'
                       THEN 'could not convert string to float: ''' || json_extract_string(txt::JSON, '$.score') || '''' END AS err FROM v),
r AS (SELECT tenant_id, session_id, agent, ord, eval_name, threshold,
             CASE WHEN err IS NOT NULL OR NOT ok THEN 0.0
                  ELSE CAST(printf('%.3f', greatest(0.0, least(10.0, coalesce(TRY_CAST(json_extract_string(txt::JSON, '$.score') AS DOUBLE), 0.0))) / 10e0) AS DOUBLE)
             END AS score,
             CASE WHEN err IS NOT NULL THEN 'Judge error: ' || err
                  WHEN NOT ok THEN 'Judge parse error: ' || substr(raw, 1, 100)
                  ELSE substr(coalesce(json_extract_string(txt::JSON, '$.reasoning'), ''), 1, 500) END AS reasoning,
             err IS NULL AND ok AS good
      FROM k),
res AS (SELECT *, CASE WHEN good THEN score >= threshold ELSE false END AS passed FROM r)"""

VERDICTS_SQL = with_sql(BASE_SQL + VERDICT_BODY, """
SELECT tenant_id, session_id, agent, eval_name, score, passed, CAST(threshold AS DOUBLE) AS threshold, reasoning FROM res""")


@query("judge_verdicts", VERDICTS_SQL)
def verdicts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies parsed and scored; parse failures and judge errors score 0."""
    _, _, res = _pipeline(spark, sf_dir)
    return res.select(*K, "agent", "eval_name", "score", "passed", "threshold", "reasoning")


EVALS_SQL = with_sql(BASE_SQL + VERDICT_BODY, """
SELECT tenant_id, session_id, eval_name, agent, 4 AS layer, score, passed, CAST(threshold AS DOUBLE) AS threshold,
       CAST(json_object('reasoning', reasoning) AS VARCHAR) AS detail FROM res""")


@query("judge_evals", EVALS_SQL)
def judge_evals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """layer-4 eval rows."""
    from runlens.operators.judge import judge_evals
    _, _, res = _pipeline(spark, sf_dir)
    return judge_evals(res)


INCIDENTS_SQL = with_sql(BASE_SQL + VERDICT_BODY, """
SELECT tenant_id, session_id, agent,
       CASE WHEN avg(threshold - score) FILTER (WHERE NOT passed) > 0.3 THEN 'high' ELSE 'medium' END AS severity,
       agent || ' output failed ' || count(*) FILTER (WHERE NOT passed) || ' of ' || count(*)
         || ' quality criteria (semantic eval)' AS root_cause,
       'Review ' || agent || ' output quality. Failing: '
         || string_agg(eval_name, ', ' ORDER BY ord) FILTER (WHERE NOT passed)
         || '. Adjust criteria or agent prompt in the eval manager.' AS fix_suggestion,
       string_agg(eval_name || '=' || printf('%.3f', score) || '/' || reasoning, '; ' ORDER BY ord) FILTER (WHERE NOT passed) AS failed_evals,
       count(*) FILTER (WHERE NOT passed) AS n_failed, count(*) AS n_results
FROM res GROUP BY tenant_id, session_id, agent HAVING count(*) FILTER (WHERE NOT passed) > 0""")


@query("judge_incidents", INCIDENTS_SQL)
def judge_incidents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per (session, agent) with a failed criterion."""
    from runlens.operators.judge import judge_incidents
    _, _, res = _pipeline(spark, sf_dir)
    return _incident_columns(judge_incidents(res))


def _incident_columns(incidents: DataFrame) -> DataFrame:
    shown = F.array_join(F.transform("failed_evals", lambda x: F.concat(
        x["eval_name"], F.lit("="), F.format_string("%.3f", x["score"]), F.lit("/"), x["reasoning"])), "; ")
    return incidents.select(*K, "agent", "severity", "root_cause", "fix_suggestion", shown.alias("failed_evals"), "n_failed", "n_results")


@query("evaluate_session_outputs", INCIDENTS_SQL)
def evaluate_outputs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: outputs, configs and replies in, evals and incidents out (the incidents are compared; the evals are judge_evals)."""
    from runlens.operators.judge import evaluate_session_outputs, judge_criteria, judge_prompts
    outputs = judge_outputs(read_table(spark, sf_dir, "documents"))
    configs = judge_configs(outputs)
    replies = judge_replies(judge_prompts(outputs, judge_criteria(configs)), read_table(spark, sf_dir, "labels"))
    _, incidents = evaluate_session_outputs(outputs, configs, replies)
    return _incident_columns(incidents)
