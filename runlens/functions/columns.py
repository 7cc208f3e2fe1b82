"""Column helpers shared by every operator.

All of them are plain Catalyst expressions (no Python UDFs), so they stay inside
whole-stage codegen and can be pushed around by the optimizer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

K = ["tenant_id", "session_id"]
ORDER = ["created_at", "seq"]

_CACHE: dict = {}


def cached(key, build):
    """Reuse a constant Column within one Spark application (Columns are immutable expressions);
    building plans then needs far fewer JVM round trips."""
    from pyspark.sql import SparkSession
    session = SparkSession.getActiveSession()
    k = (session.sparkContext.applicationId if session is not None else None, key)   # unique per application
    c = _CACHE.get(k)
    if c is None:
        c = _CACHE[k] = build()
    return c


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ── trace predicates (B15 and the notation of the detectors) ─────────────────────────────────

def real_error(c: str | Column = "error") -> Column:
    """Null / blank error text is no error; otherwise the trimmed text.
    Java's \\s matches Python's ASCII whitespace set used by str.strip()."""
    return F.nullif(F.regexp_replace(col(c).cast("string"), r"^\s+|\s+$", ""), F.lit(""))


def is_tool() -> Column:
    return cached("is_tool", lambda: F.expr("coalesce(step_type, '') = 'tool_call'"))


def outcome_is(value: str) -> Column:
    """Null-safe equality: a null outcome is *not* the value (Python `None == 'x'` is False)."""
    return cached(("outcome_is", value), lambda: F.col("outcome").eqNullSafe(F.lit(value)))


def is_err() -> Column:
    """Outcome 'error' or a real error text."""
    return cached("is_err", lambda: outcome_is("error") | real_error("error").isNotNull())


def toks() -> Column:
    return cached("toks", lambda: F.expr("coalesce(tokens_input, 0) + coalesce(tokens_output, 0)"))


def lower_agent(c: str | Column = "agent") -> Column:
    if c == "agent":
        return cached("lower_agent", lambda: F.expr("lower(coalesce(agent, ''))"))
    return F.lower(F.coalesce(col(c), F.lit("")))


# ── agent matching (B16, B17) ───────────────────────────────────────────────────────────────

def agent_matches(agent: Column, pattern: Column, match: Column) -> Column:
    """Lower-cased comparison; `any` or empty pattern keeps everything; unknown strategy none.
    startswith/contains instead of LIKE, since agent names may contain `_` and `%`."""
    name = F.lower(F.coalesce(agent, F.lit("")))
    pat = F.lower(pattern)
    return (F.when((match == "any") | pat.isNull() | (pat == ""), F.lit(True))
            .when(match == "exact", name == pat)
            .when(match == "prefix", F.startswith(name, pat))
            .when(match == "contains", F.contains(name, pat))
            .otherwise(F.lit(False)))


def agent_seen(agents: Column, required: Column) -> Column:
    """A required agent counts as present if a lower-cased agent equals it or starts with
    `<name>_` (covers `research_AAPL` and `market_shadow`). `agents` must already be lower-case."""
    r = F.lower(required)
    return F.exists(agents, lambda a: (a == r) | F.startswith(a, F.concat(r, F.lit("_"))))


# ── frames (B14) ──────────────────────────────────────────────────────────────────────────────

def frame_columns() -> list[Column]:
    """The eight stack-frame fields as flat columns (plus `seq` for ordering)."""
    return [F.col("agent"), F.col("step_type"), F.col("tool_name"), F.col("outcome"), F.col("error"),
            F.col("latency_ms"), toks().alias("tokens"), F.col("created_at"), F.col("seq")]


# ── Python-compatible rounding and text (C16, D16) ─────────────────────────────────────────────

def py_round(c: Column, digits: int) -> Column:
    """round(x, digits) as Python computes it: the exact binary value to the nearest, half to even.

    Rounding the shortest decimal form (what Spark does) is the same unless that form lies exactly half-way, that is,
    unless x is the double nearest to k / (2 * 10^digits) with k odd. Then the side on which the binary value lies
    decides; it is the sign of x * (2 * 10^digits) - k, computed without error by splitting x in two halves."""
    x = F.abs(c.cast("double"))
    scale = 2.0 * 10 ** digits
    k = F.floor(x * scale + 0.5).cast("double")
    odd = F.pmod(k, F.lit(2.0)) == 1
    big = x * 134217729.0
    high = big - (big - x)
    rest = (high * scale - k) + (x - high) * scale
    low = (k - 1) / 2
    even = low + F.pmod(low, F.lit(2.0))
    tie = F.when(rest > 0, low + 1).when(rest < 0, low).otherwise(even) / F.lit(float(10 ** digits))
    return F.signum(c.cast("double")) * F.when(odd & (x == k / scale), tie).otherwise(F.round(x, digits))


def py_round2(c: Column) -> Column:
    """round(x, 2) for scores (decides `passed`)."""
    return py_round(c, 2)


def py_round_sql(x: str, digits: int) -> str:
    """The same rule in DuckDB: printf rounds the exact binary value, half to even."""
    return f"CAST(printf('%.{digits}f', CAST({x} AS DOUBLE)) AS DOUBLE)"


def py_round2_sql(x: str) -> str:
    return py_round_sql(x, 2)


def py_string(c: Column) -> Column:
    """Python's repr of a text: backslashes doubled, in double quotes when it holds an apostrophe but no double
    quote, else in single quotes with apostrophes escaped."""
    escaped = F.replace(F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")),
                                  F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    return F.when(double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))


def capitalize(c: Column) -> Column:
    """Python str.capitalize(): first letter upper, the rest lower (initcap would touch every word)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def thousands(c: Column) -> Column:
    """Python f'{n:,}' for integers."""
    return F.format_number(c.cast("long"), 0)
