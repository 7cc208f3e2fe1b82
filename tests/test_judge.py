"""Judge (F1-F8): verdict parsing and scoring, incidents."""

from pyspark.sql import functions as F

from runlens.operators.judge import judge_incidents, parse_verdicts, score_verdicts


def test_parse_cases(spark):
    cases = [
        ('{"score": 8, "reasoning": "ok"}', 8.0, "ok"),
        ('```json\n{"score": 6, "reasoning": "fenced"}\n```', 6.0, "fenced"),
        ('{"score": "7", "reasoning": "string score"}', 7.0, "string score"),
        ('{"reasoning": "no score"}', 0.0, "no score"),
        ('{"score": null}', 0.0, "Judge error: float() argument must be a string or a real number, not 'NoneType'"),
        ('{"score": "high"}', 0.0, "Judge error: could not convert string to float: 'high'"),
        ("[1]", 0.0, "Judge error: 'list' object has no attribute 'get'"),
        ("no json here", 0.0, "Judge parse error: no json here"),
    ]
    df = spark.createDataFrame([(str(i), raw, None) for i, (raw, _, _) in enumerate(cases)],
                               "request_id string, raw_reply string, call_error string")
    got = {r.request_id: r for r in parse_verdicts(df).collect()}
    for i, (_, score, text) in enumerate(cases):
        assert (got[str(i)].score_raw, got[str(i)].reasoning) == (score, text)


def test_scores_and_incident(spark):
    prompts = spark.createDataFrame(
        [("t", "s", "research", "o", "c1", 0, "crit_a", 0.7, "r1"), ("t", "s", "research", "o", "c2", 1, "crit_b", 0.7, "r2"),
         ("t", "s", "research", "o", "c3", 2, "crit_c", 0.5, "r3")],
        "tenant_id string, session_id string, agent string, output_id string, config_id string, config_ord int, "
        "eval_name string, threshold double, request_id string")
    replies = spark.createDataFrame([("r1", '{"score": 12, "passed": false}', None), ("r2", '{"score": 2}', None),
                                     ("r3", None, "timeout")], "request_id string, raw_reply string, call_error string")
    res = {r.eval_name: r for r in score_verdicts(prompts, replies).collect()}
    assert (res["crit_a"].score, res["crit_a"].passed) == (1.0, True)      # clamped, model flag ignored
    assert (res["crit_b"].score, res["crit_b"].passed) == (0.2, False)
    assert res["crit_c"].reasoning == "Judge error: timeout" and not res["crit_c"].passed
    inc = judge_incidents(score_verdicts(prompts, replies)).first()
    assert inc.severity == "high" and inc.root_cause == "research output failed 2 of 3 quality criteria (semantic eval)"
    assert "Failing: crit_b, crit_c." in inc.fix_suggestion and len(inc.failed_evals) == 2
