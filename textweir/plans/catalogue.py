"""Every query of the engine with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textweir.plans import bundle_queries, chunk_queries, index_queries, ingest_queries, poll_queries, prepare_queries, render_queries, run_queries, search_queries, source_queries, speech_queries, stream_queries, text_queries

PARTS = (search_queries, chunk_queries, text_queries, ingest_queries, speech_queries, bundle_queries, render_queries, stream_queries, run_queries, source_queries, index_queries, prepare_queries, poll_queries)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for part in PARTS:
    QUERIES |= part.QUERIES
    ORACLE_SQL |= part.ORACLE_SQL
