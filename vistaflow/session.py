"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from vistaflow.sources.files import remove

_made: ContextVar[list[str] | None] = ContextVar("staged tables of this scope", default=None)

# Spark decides partition counts and splits hot join partitions at run time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


SHUFFLE_BYTES = 128 * 1024 * 1024
# Beyond this the driver's bookkeeping may cost more than larger partitions that spill.
MAX_SHUFFLE_PARTITIONS = 100_000


def sized_settings(
    input_bytes: int, cores: int, max_partitions: int = MAX_SHUFFLE_PARTITIONS
) -> dict[str, str]:
    """Settings for a job over ``input_bytes``: shuffle partitions of about 128 MB.

    Spark starts with this many and merges small ones, so an estimate on the high side
    costs little while one on the low side spills.
    """
    wanted = max(2 * cores, -(-input_bytes // SHUFFLE_BYTES))
    partitions = min(wanted, max_partitions)
    if partitions < wanted:
        warnings.warn(
            f"{wanted} shuffle partitions of {SHUFFLE_BYTES} bytes are wanted, "
            f"max_partitions allows {partitions}; they get larger and may spill",
            stacklevel=2,
        )
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES),
    }


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the recommended settings; ``master`` is for tests and benchmarks."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary one only in local mode without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="vistaflow-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call has been given."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage at a table that survives lost executors, and lets the reader take
    only the columns it needs.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    made = _made.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Removes the tables staged inside at its end: what reads them must be written by then."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            remove(spark, path)
