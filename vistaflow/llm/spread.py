"""Joins that stay even with hot keys, and broadcasts behind a measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16
BROADCAST_ROWS = 1_000_000


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], spread_by: Column,
                     salts: int = SALTS) -> DataFrame:
    """Left join on ``keys`` where the left side may hold a hot key.

    Left rows of one key go to ``salts`` places by ``spread_by``; each right row, of which
    there is one for each key, is copied to all of them.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    copies = right.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    joined = left.withColumn("_salt", salt).join(copies, [*keys, "_salt"], "left")
    return joined.drop("_salt")


def measured_join(large: DataFrame, small: DataFrame, on: str, rows: int | None = None,
                  limit: int = BROADCAST_ROWS, how: str = "inner") -> DataFrame:
    """Join that broadcasts ``small`` (narrow rows) only if it has at most ``limit`` rows.

    Beyond that both sides are shuffled. ``small`` should be a stored table, as it is counted.
    """
    rows = small.count() if rows is None else rows
    return large.join(F.broadcast(small) if rows <= limit else small, on, how)
