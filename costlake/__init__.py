"""costlake: cloud billing line items -> priced silver frame -> gold/serve tables, on Spark.

Layout
------
sources/    read raw billing exports, conform both layouts, seeds, period filter, sinks
functions/  Column-level helpers (NULL/'' rules, safe division, ARN parsing) and the
            usage classification rule sets
operators/  reusable DataFrame -> DataFrame operators (pricing stages, period-over-period,
            pivots, tag discovery, calendars, data-quality checks, SCD2 snapshot)
plans/      the models: silver, core, tag, serve, compute, database, network, storage, other
streaming/  micro-batch incremental refresh of billing partitions
oracle/     independent DuckDB SQL used as the correctness oracle in tests
"""

from costlake.session import get_session

__all__ = ["get_session"]
