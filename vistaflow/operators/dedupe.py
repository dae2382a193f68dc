"""One row per key: last wins for documents, first wins for user references."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistaflow.operators.lookup import lookup, within_rows

# Rows whose keys one task counts, and the tasks that small tables are dealt to.
COUNTED_ROWS, LEAST_TASKS = 500_000, 8


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` makes Spark keep only the best row of each key in every map task
    (WindowGroupLimit, partial) before the shuffle. A key that holds a third of all rows
    thus sends one row per task, not the whole group.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(w))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def last_wins(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Keep the last row of each key; ``order`` lists columns from most to least important."""
    return pick_one(df, [key], [F.desc_nulls_last(c) for c in order])


def last_of_copies(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """As :func:`last_wins` for stored rows, which can be read more than once.

    Keys alone are counted first. Rows whose key is unique are never sorted or shuffled; only
    those of the other keys are compared, by an aggregate that starts before its shuffle.
    """
    keys = duplicate_keys(df.select(key), key).select(key)
    several = within_rows(keys)
    if several and keys.isEmpty():
        return df
    copies = lookup(df, keys, [key], "left_semi", small=several)
    best = copies.groupBy(key).agg(F.max_by(F.struct("*"), F.struct(*order)).alias("_row"))
    rest = lookup(df, keys, [key], "left_anti", small=several)
    return rest.unionByName(best.select("_row.*"))


def first_wins(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    return pick_one(df, [key], [F.asc_nulls_first(c) for c in order])


def tasks_for(rows: int) -> int:
    """Tasks that count the keys of ``rows`` rows, so that no task holds more as a table grows."""
    return max(LEAST_TASKS, -(-rows // COUNTED_ROWS))


def key_counts(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """Rows per key, combined before the shuffle, batch by batch.

    Keys are mostly unique: a hash table of all keys of a map task would grow with its split
    and combine next to nothing. A batch is small and still turns the copies of a hot key into
    one row. ``rows`` is about the number of rows, if known; without it the session's number
    of shuffle partitions counts.
    """
    keys = df.select(key)

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(key, use_threads=False)
            counts = found.aggregate([([], "count_all")])
            yield from counts.rename_columns([key, "copies"]).to_batches()

    schema = T.StructType([*keys.schema.fields, T.StructField("copies", T.LongType())])
    parts = keys.mapInArrow(combined, schema)
    dealt = parts.repartition(key) if rows is None else parts.repartition(tasks_for(rows), key)
    return dealt.groupBy(key).agg(F.sum("copies").alias("copies"))


def duplicate_report(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """One row: rows, distinct keys and rows that de-duplication drops."""
    return key_counts(df, key, rows).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_count"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("dropped"),
    )


def duplicate_keys(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """Keys that more than one row has, with their row counts."""
    return key_counts(df, key, rows).where(F.col("copies") > 1)
