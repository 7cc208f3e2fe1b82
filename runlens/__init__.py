"""runlens: analytics over AI-agent run traces on Apache Spark.

Reads span and session records, removes retried duplicates, prices and rolls up token use,
scores every session against rule evals, detects failure patterns, annotates incidents with
their root step, turns judge replies into quality scores, and links business outcomes to the
work that produced them. Every operator takes and returns DataFrames keyed on
(tenant_id, session_id) and runs for all sessions at once.
"""

__version__ = "0.1.0"
