"""Sync state: one small row per view, saved as a new version after a successful run."""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vistaflow.sources.files import VersionedTable

STATE_SCHEMA = T.StructType(
    [
        T.StructField("view", T.StringType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("last_run", T.StringType()),
        T.StructField("base_batch", T.LongType()),
        T.StructField("last_batch", T.LongType()),
        T.StructField("base_buckets", T.LongType()),
        T.StructField("place", T.LongType()),
    ]
)


@dataclass(frozen=True)
class ViewState:
    """What is known about one view after its last good run.

    Index batches from ``base_batch`` to ``last_batch`` hold the view's documents; the first of
    them lies in ``base_buckets`` buckets by id (0: in none). ``place`` is the view's place in
    the catalog.
    """

    view: str
    watermark: str | None = None
    count: int | None = None
    last_run: str | None = None
    base_batch: int = 0
    last_batch: int = -1
    base_buckets: int = 0
    place: int = 0


class SyncState:
    """State of all views; it has one row per catalog entry and is read on the driver."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.table = VersionedTable(spark, path, STATE_SCHEMA, "json")

    def load(self) -> dict[str, ViewState]:
        """Saved state by view; empty if nothing was saved or it cannot be read."""
        rows = self.table.read().where("view IS NOT NULL").collect()
        found = [{k: v for k, v in r.asDict().items() if v is not None} for r in rows]
        return {r["view"]: ViewState(**r) for r in found}

    def save(self, views: dict[str, ViewState]) -> None:
        self.table.replace(state_frame(self.spark, views).coalesce(1))


def state_frame(spark: SparkSession, views: dict[str, ViewState]) -> DataFrame:
    return spark.createDataFrame([astuple(v) for v in views.values()], STATE_SCHEMA)


def merge_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """New rows, and the old rows of views that failed or returned no watermark."""
    fresh = new.where("watermark IS NOT NULL")
    return fresh.unionByName(old.join(fresh.select("view"), "view", "left_anti"))
