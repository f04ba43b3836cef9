"""All queries of the library by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewright.plans import assignment_queries, call_queries, contract_queries, declaration_queries, duplicate_queries, event_queries, json_queries, log_queries, profile_queries, record_queries, report_queries, seed_queries, selection_queries, source_queries, state_queries, stream_queries, text_queries, trace_queries, training_queries, tree_queries, view_queries

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (trace_queries, record_queries, event_queries, text_queries, report_queries, call_queries, duplicate_queries, log_queries, training_queries, json_queries, contract_queries, state_queries, source_queries, selection_queries, assignment_queries, tree_queries, profile_queries, declaration_queries, seed_queries, view_queries, stream_queries)
QUERIES: dict[str, Query] = {k: q for m in _MODULES for k, q in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: q for m in _MODULES for k, q in m.ORACLE_SQL.items()}
FLAGSHIP: Query = trace_queries.conversation_windows
