"""Global row positions and upload pages without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaflow.session import staged

UPSERT_PAGE_CAP = 500
REPLACE_PAGE_SIZE = 1000

# monotonically_increasing_id(): partition number above, row in the partition below.
ROW_BITS = 33
ROW_MASK = (1 << ROW_BITS) - 1


def with_position(
    df: DataFrame, order: Sequence[str], name: str = "position", *, unique: bool = False
) -> DataFrame:
    """Add the 0-based position of each row in the order of ``order``.

    Rows are range-partitioned and sorted inside each partition; the partition sizes, one
    number per partition, give the offsets. The sorted rows are written to the shared
    folder once: sizes and positions then come from the same table even if an executor is
    lost between the two passes.

    Unless ``order`` is ``unique``, rows equal in it are told apart by a number written
    with them beforehand. It spreads a value that most rows share over many ranges, and as
    it is stored, a task that is run again sorts its rows the same way.
    """
    keys = list(order)
    if not unique:
        df = staged(df.withColumn("_spread", F.monotonically_increasing_id()), "rows")
        keys.append("_spread")
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    slotted = ranged.drop("_spread").withColumn("_slot", F.monotonically_increasing_id())
    table = staged(slotted, "position").withColumn("_part", F.shiftright("_slot", ROW_BITS))
    sizes = table.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    starts = list(accumulate([r["n"] for r in sizes], initial=0))
    offsets = df.sparkSession.createDataFrame(
        [(r["_part"], start) for r, start in zip(sizes, starts)], "_part long, _start long"
    )
    placed = table.join(F.broadcast(offsets), "_part")
    position = F.col("_start") + F.col("_slot").bitwiseAND(F.lit(ROW_MASK))
    return placed.withColumn(name, position).drop("_part", "_slot", "_start")


def page_size(requested: int, *, upsert: bool) -> int:
    """At least one; upsert pages hold at most 500 rows."""
    size = max(1, int(requested))
    return min(UPSERT_PAGE_CAP, size) if upsert else size


def with_pages(df: DataFrame, key: str, size: int) -> DataFrame:
    """Add the page number of each row in upload order, which is that of a unique key."""
    placed = with_position(df, [key], unique=True)
    return placed.withColumn("page", F.floor(F.col("position") / size).cast("long"))


def page_plan(paged: DataFrame, *, restart_first: bool = True) -> DataFrame:
    """One row per page: its size, and the first / last / restart flags of the upload."""
    pages = paged.groupBy("page").agg(F.count("*").alias("rows"))
    last = paged.agg(F.max("page").alias("last")).scalar()
    first = F.col("page") == 0
    return pages.select(
        "page",
        "rows",
        first.alias("is_first"),
        (F.col("page") == last).alias("is_last"),
        (first & F.lit(restart_first)).alias("restart"),
    )
