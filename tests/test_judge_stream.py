"""Late spans (S2) and the incremental cost history."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from runlens.operators.cost_ring import CostHistory
from runlens.operators.detectors import cost_history
from runlens.streaming.judge import SessionStates, track
from runlens.streaming.spans import scratch_path

SESSIONS = "tenant_id string, session_id string, workflow_id string, started_at timestamp, total_cost_usd double"


def sessions(n, seed):
    rng = random.Random(seed)
    start = datetime(2030, 1, 1)
    return [("t", f"s{i:03d}", rng.choice(["w", "w", None]), None if i == 5 else start + timedelta(hours=rng.randint(0, 90)),
             None if i == 7 else round(rng.random(), 6)) for i in range(n)]


@pytest.mark.parametrize("order", ["by time", "shuffled"])
def test_cost_history_by_micro_batch_equals_the_window(spark, order):
    rows = sessions(60, 1)
    rows.sort(key=lambda r: (r[3] or datetime(1970, 1, 1), r[1]))
    batches = [rows[k: k + 20] for k in range(0, 60, 20)]
    if order == "shuffled":
        mixed = rows[:]
        random.Random(2).shuffle(mixed)
        moved = [(*r[:3], r[3] + timedelta(hours=31) if r[3] else r[3], 9.0) for r in mixed[:3]]        # changed and moved afterwards
        batches = [mixed[:25], mixed[25:50], mixed[50:] + moved[:1], moved[1:]]
        rows = mixed[3:] + moved
    h, last = CostHistory(spark, scratch_path(spark, "t-ring"), n=4), {}
    for k, batch in enumerate(batches):
        df = spark.createDataFrame(batch, SESSIONS)
        for _ in range(2 if k == 1 else 1):                                                              # a retried batch
            for r in h.update(df, k).collect():
                last[r.session_id] = (r.hist_n, r.hist_mean, r.hist_sd)
    want = {r.session_id: (r.hist_n, r.hist_mean, r.hist_sd) for r in cost_history(spark.createDataFrame(rows, SESSIONS), n=4).collect()}
    assert last.keys() == want.keys()
    for s, values in want.items():
        assert last[s] == pytest.approx(values, abs=1e-12) if None not in values else last[s] == values, s
    rings = h.rings.read().collect()
    assert len(rings) == 2 and all(len(r.ring) <= 4 for r in rings)
    if order == "by time":                                                                               # one row per workflow is read
        assert h.ledger.read().count() == 60


def test_figures_and_followers_come_from_one_window(spark, monkeypatch):
    from runlens.operators import cost_ring, history
    passes, real = [], history.rolling
    for module in (cost_ring, history):
        monkeypatch.setattr(module, "rolling", lambda *a, **k: passes.append(1) or real(*a, **k))
    rows = sorted(sessions(12, 4), key=lambda r: (r[3] or datetime(1970, 1, 1), r[1]))
    h = CostHistory(spark, scratch_path(spark, "t-one"), n=3)
    for k, batch in enumerate((rows[:6], rows[6:])):                                                     # in order: only the rings are read
        assert {r.session_id for r in h.update(spark.createDataFrame(batch, SESSIONS), k).collect()} == {r[1] for r in batch}
    assert len(passes) == 2


class State:
    def __init__(self):
        self.value, self.timer, self.hasTimedOut = None, None, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def setTimeoutDuration(self, ms):
        self.timer = ms


def run(state, closes=0, spans=0, quiet=0, timeout=False):
    state.hasTimedOut, state.timer = timeout, None
    events = [] if timeout else [pd.DataFrame({"closes": [closes], "spans": [spans]})]
    return [r for df in track(("t", "s"), iter(events), state, quiet) for r in df["reason"]]


def test_a_session_is_asked_for_at_close_and_after_late_spans():
    s = State()
    assert run(s, spans=5) == [] and run(s, spans=1) == []
    assert run(s, closes=1, spans=2) == ["closed"] and run(s, closes=1) == ["closed"]
    assert run(s, spans=1) == ["late spans"] and s.value == (True, 0, 3)


def test_late_spans_are_gathered_during_the_quiet_time():
    s = State()
    assert run(s, closes=1, quiet=500) == ["closed"] and s.timer is None
    assert run(s, spans=1, quiet=500) == [] and s.timer == 500
    assert run(s, spans=4, quiet=500) == [] and s.timer == 500
    assert run(s, timeout=True, quiet=500) == ["late spans"] and s.value == (True, 0, 2)
    assert run(s, timeout=True, quiet=500) == []


def test_the_join_with_stored_states_follows_the_rule(spark):
    rng = random.Random(3)
    keys = [(rng.choice(["a", "b", None]), f"s{i}") for i in range(12)] + [(None, None)]
    states, want = SessionStates(spark, scratch_path(spark, "t-states"), buckets=4), {k: State() for k in keys}
    for batch in range(6):
        events = [(*rng.choice(keys), *e) for e in rng.choices([(1, 0), (0, 3), (0, 1), (0, 0)], [2, 3, 3, 1], k=10)] if batch != 4 else []
        expected = []
        for k in {e[:2] for e in events}:
            own = pd.DataFrame([e[2:] for e in events if e[:2] == k], columns=["closes", "spans"])
            expected += [(*k, r.revision, r.reason) for df in track(k, iter([own]), want[k]) for r in df.itertuples()]
        df = spark.createDataFrame(events, "tenant_id string, session_id string, closes long, spans long")
        for _ in range(2 if batch in (0, 3) else 1):                                                     # a retried batch
            got = [tuple(r) for r in states.requests(df, batch).collect()]
            assert sorted(got, key=str) == sorted(expected, key=str)


def test_without_a_quiet_time_no_session_goes_through_python(spark, monkeypatch):
    from types import SimpleNamespace

    from runlens.streaming import judge as module
    asked = []
    judge = SimpleNamespace(spans=SimpleNamespace(spark=spark), out=scratch_path(spark, "t-asked"), buckets=4,
                            judge=lambda rows, batch: asked.append(sorted((r.session_id, r.revision, r.reason) for r in rows.collect())))

    def refuse(*_):
        raise AssertionError("a stateful operator in Python")

    monkeypatch.setattr(module, "judge_requests", refuse)
    closes, arrivals, ckpt = (scratch_path(spark, f"t-{x}") for x in ("closes", "arrivals", "ckpt"))
    for closed, came in ((["x", "y"], ["x", "z"]), (["x"], ["y", "z"]), ([], ["z"])):
        spark.createDataFrame([("t", s) for s in closed], "tenant_id string, session_id string").coalesce(1).write.mode("append").parquet(closes)
        spark.createDataFrame([("t", s, 2) for s in came], "tenant_id string, session_id string, spans long").coalesce(1).write.mode("append").parquet(arrivals)
        src = [spark.readStream.schema(f"tenant_id string, session_id string{x}").parquet(p) for x, p in (("", closes), (", spans long", arrivals))]
        module.stream_judge(*src, judge, ckpt)
    assert asked == [[("x", 1, "closed"), ("y", 1, "closed")], [("x", 2, "closed"), ("y", 2, "late spans")]]


def test_the_passes_of_a_judgement_read_stored_spans(spark, monkeypatch):
    from conftest import SF_SMOKE
    from runlens.operators import detectors
    from runlens.sources.adapters import load_traces, sessions_from_traces
    from runlens.streaming.judge import SessionJudge
    from runlens.streaming.spans import span_store
    t = load_traces(spark, SF_SMOKE)
    store = span_store(spark, scratch_path(spark, "t-spans"), t.schema, 4)
    store.add_new(t)
    asked = sessions_from_traces(t).orderBy("session_id").limit(40).selectExpr("tenant_id", "session_id", "1 as revision")
    seen, real = [], detectors.run_detectors

    def spy(traces, sessions, **more):
        seen.append([{f.split("/")[-2].rsplit("-", 1)[0] for f in df.inputFiles()} for df in (traces, sessions)])
        return real(traces, sessions, **more)

    monkeypatch.setattr(detectors, "run_detectors", spy)
    judge = SessionJudge(store, scratch_path(spark, "t-judged"), sessions_from_traces, buckets=4)
    judge.judge(asked, 0)
    rest = sessions_from_traces(t).join(asked, ["tenant_id", "session_id"], "left_anti").selectExpr("tenant_id", "session_id", "1 as revision")
    judge.judge(rest, 1)                                                                                 # and those whose history changes by them
    assert seen == [[{"judged-spans"}, {"judged-sessions"}]] * 2
    columns = ["session_id", "pattern_name", "frame_count"]
    want = real(t, sessions_from_traces(t)).incidents.select(*columns).collect()
    assert sorted(judge.results("incidents").select(*columns).collect()) == sorted(want) and want


def test_spans_of_a_micro_batch_are_written_and_read_by_many_tasks(spark, monkeypatch):
    from conftest import SF_SMOKE
    from runlens.plans import stream_queries
    from runlens.streaming import spans
    paths, files, scratch, inputs = {}, [], spans.scratch_path, stream_queries._inputs

    class Enough(Exception):
        pass

    def path(spark, name):
        paths[name] = scratch(spark, name)
        return paths[name]

    def spy(*_, **__):
        files.append(len(spark.read.parquet(paths["late-spans"]).inputFiles()))
        if len(files) == 2:
            raise Enough

    def spread(spark, sf_dir):
        t, s = inputs(spark, sf_dir)
        return t.repartition(4), s

    monkeypatch.setattr(spans, "scratch_path", path)
    monkeypatch.setattr(spans, "stream_dedupe_spans", spy)
    monkeypatch.setattr(stream_queries, "_inputs", spread)
    with pytest.raises(Enough):
        stream_queries._run_late(spark, SF_SMOKE)
    assert files == [4, 8]
