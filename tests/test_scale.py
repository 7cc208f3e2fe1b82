"""Scale-related equivalences on the driver's tables: the bucketed history window equals the
plain window even when one partition holds every session (a hot key), and the detectors give
the same incidents either way."""

from pyspark.sql import functions as F

from conftest import SF_SMOKE
from runlens.operators.detectors import cost_history, run_detectors
from runlens.sources.adapters import load_sessions, load_traces


def test_bucketed_history_equals_plain_window_on_hot_key(spark):
    s = load_sessions(spark, SF_SMOKE).withColumn("workflow_id", F.lit("hot")).withColumn("tenant_id", F.lit("t"))
    for n in (3, 20):
        plain = {r.session_id: (r.hist_n, r.hist_mean, r.hist_sd)
                 for r in cost_history(s, n=n, bucket_seconds=None).collect()}
        for bucket in (3_600, 86_400, 7 * 86_400):
            got = {r.session_id: (r.hist_n, r.hist_mean, r.hist_sd)
                   for r in cost_history(s, n=n, bucket_seconds=bucket).collect()}
            assert got.keys() == plain.keys()
            for k, (cnt, mean, sd) in plain.items():
                c2, m2, s2 = got[k]
                assert c2 == cnt
                assert (mean is None and m2 is None) or abs(mean - m2) < 1e-12
                assert (sd is None and s2 is None) or abs(sd - s2) < 1e-12


def test_detectors_same_with_and_without_buckets(spark):
    t, s = load_traces(spark, SF_SMOKE), load_sessions(spark, SF_SMOKE)
    a = run_detectors(t, s, history_bucket_seconds=86_400).incidents.select("session_id", "pattern_name", "frame_count").collect()
    b = run_detectors(t, s, history_bucket_seconds=None).incidents.select(
        "session_id", "pattern_name", "frame_count").collect()
    assert sorted(a) == sorted(b) and len(a) > 0


def test_bucketed_step_numbers_equal_plain_window(spark):
    from runlens.operators.shaping import assign_sequence
    from runlens.sources.adapters import read_table, traces_from_events
    t = traces_from_events(read_table(spark, SF_SMOKE, "events")).drop("seq")
    # every trace in one session: the hot-session case
    hot = t.withColumn("session_id", F.lit("one")).withColumn("tenant_id", F.lit("t"))
    for df in (t, hot):
        a = {r.event_id: r.seq for r in assign_sequence(df, ["created_at", "event_id"], bucket_seconds=None).collect()}
        b = {r.event_id: r.seq for r in assign_sequence(df, ["created_at", "event_id"], bucket_seconds=600).collect()}
        assert a == b
