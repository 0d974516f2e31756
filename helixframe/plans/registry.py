"""Every query by name, with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import file_queries, read_queries, report_queries, sample_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = read_queries.QUERIES | sample_queries.QUERIES | file_queries.QUERIES | report_queries.QUERIES
SQL: dict[str, str] = read_queries.SQL | sample_queries.SQL | file_queries.SQL | report_queries.SQL
