"""Joins of a large table with a smaller one, broadcast only behind a size check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def within_rows(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``limit`` rows.

    A plain count is combined in every task; a limit would first gather rows in one.
    """
    return df.count() <= limit


def lookup(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", *, small: bool = False
) -> DataFrame:
    """Join ``fact`` with ``dim``.

    ``small=True`` is for a side whose row count is bounded by how it was made or was
    checked with :func:`within_rows`. Otherwise Spark chooses: it broadcasts below its own
    size threshold and beyond that shuffles both sides, where adaptive execution splits the
    partition of a hot key.
    """
    return fact.join(F.broadcast(dim) if small else dim, list(on), how)
