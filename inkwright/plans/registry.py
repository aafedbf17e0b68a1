"""All queries of the text-restoration operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkwright.plans import record_queries, report_queries, text_queries

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return text_queries.QUERIES | record_queries.QUERIES | report_queries.QUERIES


def oracles() -> dict[str, str]:
    return text_queries.ORACLES | record_queries.ORACLES | report_queries.ORACLES
