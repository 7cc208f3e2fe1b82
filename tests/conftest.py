import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"

TRACE_SCHEMA = T.StructType([
    T.StructField("tenant_id", T.StringType()), T.StructField("session_id", T.StringType()),
    T.StructField("workflow_id", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("agent", T.StringType()), T.StructField("step_type", T.StringType()),
    T.StructField("tool_name", T.StringType()), T.StructField("outcome", T.StringType()),
    T.StructField("error", T.StringType()), T.StructField("latency_ms", T.LongType()),
    T.StructField("created_at", T.TimestampType()), T.StructField("tokens_input", T.LongType()),
    T.StructField("tokens_output", T.LongType()), T.StructField("span_id", T.StringType()),
])
SESSION_SCHEMA = T.StructType([
    T.StructField("tenant_id", T.StringType()), T.StructField("session_id", T.StringType()),
    T.StructField("workflow_id", T.StringType()), T.StructField("total_cost_usd", T.DoubleType()),
    T.StructField("total_tokens_input", T.LongType()), T.StructField("total_tokens_output", T.LongType()),
    T.StructField("trades_executed", T.LongType()), T.StructField("trades_proposed", T.LongType()),
    T.StructField("terminal_reason", T.StringType()), T.StructField("started_at", T.TimestampType()),
    T.StructField("completed_at", T.TimestampType()),
])


@pytest.fixture(scope="session")
def spark():
    from runlens.session import build_session
    s = build_session("local[4]", 4, app="runlens-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="runlens-test-ckpt-")})
    yield s
    s.stop()


# ── a small press-desk pipeline: market -> research -> risk -> orchestrator ────────────────────
# One step a line: agent, what it did (call/<tool>, llm, say, decide), outcome, clock, milliseconds, tokens in, tokens out,
# then an error text where there is one.

DAY = "2031-03-02"
KINDS = {"llm": "llm_call", "say": "agent_message", "decide": "decision"}

CLEAN_RUN = """
market       call/open_hours    success  09:00:04   90   70   20
market       say                noted    09:00:09   15    0    0
research     call/filings       success  09:00:31  410   30    5
research     call/ratios        success  09:01:02  220   25    5
research     llm                success  09:01:40 1300  900  260
risk         call/limits        success  09:03:15  120   60   35
risk         llm                success  09:03:20  700  310   90
risk         decide             approved 09:03:30   12    0    0
orchestrator decide             execute  09:05:01   25  140   60
"""

STUCK_RUN = """
market       call/open_hours    success  09:00:04   90   70   20
research     call/filings       error    09:00:40 20000   0    0  upstream gave up after 20 s
research     call/filings       error    09:01:25 20000   0    0  upstream gave up after 20 s
research     call/filings       error    09:02:10 20000   0    0  upstream gave up after 20 s
"""


def at(clock):
    from datetime import datetime
    return None if clock is None else datetime.fromisoformat(clock if "T" in clock else f"{DAY}T{clock}")


def step(agent, what, outcome="success", clock="09:01:00", ms=150, tokens=(12, 6), error=None):
    kind, _, tool = what.partition("/")
    return {"agent": agent, "step_type": "tool_call" if tool else KINDS.get(kind, kind), "tool_name": tool or None, "outcome": outcome,
            "error": error, "latency_ms": ms, "created_at": clock, "tokens_input": tokens[0], "tokens_output": tokens[1]}


def _run(table):
    out = []
    for line in table.strip().splitlines():
        agent, what, outcome, clock, ms, t_in, t_out, *error = line.split(maxsplit=7)
        out.append(step(agent, what, outcome, clock, int(ms), (int(t_in), int(t_out)), error[0] if error else None))
    return out


def healthy():
    return _run(CLEAN_RUN)


def timeouts():
    return _run(STUCK_RUN)


def tool_trace(agent, tool, outcome="success", error=None, latency_ms=150):
    return step(agent, f"call/{tool}", outcome, ms=latency_ms, error=error)


def llm_trace(agent, outcome="success"):
    return step(agent, "llm", outcome, "09:00:20", 640, (80, 45))


def make_traces(spark, rows, session_id="run-1", tenant="desk-a", workflow="press"):
    defaults = {"tenant_id": tenant, "session_id": session_id, "workflow_id": workflow}
    out = []
    for n, r in enumerate(rows, 1):
        full = {**defaults, "seq": n, "span_id": f"{n:016x}", **r}
        out.append(tuple(at(full.get(f.name)) if f.name == "created_at" else full.get(f.name) for f in TRACE_SCHEMA.fields))
    return spark.createDataFrame(out, TRACE_SCHEMA)


def make_session(spark, **changes):
    row = {"tenant_id": "desk-a", "session_id": "run-1", "workflow_id": "press", "total_cost_usd": 0.25, "total_tokens_input": 4100,
           "total_tokens_output": 900, "trades_executed": 1, "trades_proposed": 1, "terminal_reason": "order_placed",
           "started_at": "09:00:00", "completed_at": "09:06:40", **changes}
    return spark.createDataFrame([tuple(at(row[f.name]) if f.name.endswith("_at") else row[f.name] for f in SESSION_SCHEMA.fields)],
                                 SESSION_SCHEMA)
