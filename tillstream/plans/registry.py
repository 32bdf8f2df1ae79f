"""Registered queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .oracle import sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, twin: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``twin`` is its SQL over the oracle's building blocks."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = function
        if twin is not None:
            ORACLES[name] = sql(twin)
        return function

    return register


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the oracle has them."""
    return df.select(*[
        F.col(c).cast("timestamp_ntz").alias(c) if kind == "timestamp" else F.col(c)
        for c, kind in df.dtypes
    ])


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Sums of doubles depend on row order in the last digits, so both sides
    round. The small shift moves exact halves, such as a sixteenth of a sum of
    prices, off the rounding edge where those digits would decide."""
    return df.withColumns({c: F.round(F.lit(1e-9) + F.col(c), places) for c in columns})
