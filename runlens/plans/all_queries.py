"""Import every query module so that the catalogue is complete."""

from runlens.plans import (eval_queries, ingest_queries, judge_queries, otlp_queries,  # noqa: F401
                           extra_queries, outcome_queries, rca_queries, stream_queries)
from runlens.plans.catalog import CATALOG  # noqa: F401
