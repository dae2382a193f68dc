"""Add-or-update by id, and the difference between two states of an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTENT = ("title", "view_url", "body", "custom_properties", "permissions")


def upsert(existing: DataFrame, changes: DataFrame, *, small: bool = False) -> DataFrame:
    """``changes`` plus the existing rows whose id is not among them.

    ``small=True`` (a change set of checked size) broadcasts the changed ids, so the
    existing rows are only read and filtered, not shuffled.
    """
    ids = changes.select("id")
    kept = existing.join(F.broadcast(ids) if small else ids, "id", "left_anti")
    return kept.unionByName(changes)


def content_digest(df: DataFrame) -> Column:
    """SHA-256 over what makes two versions of a document equal."""
    fields = [F.col(c) for c in CONTENT if c in df.columns]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Status of every id: inserted, updated, unchanged or deleted.

    Only ids and digests are shuffled, never the bodies.
    """
    o = old.select("id", content_digest(old).alias("old"))
    n = new.select("id", content_digest(new).alias("new"))
    status = (
        F.when(F.col("old").isNull(), "inserted")
        .when(F.col("new").isNull(), "deleted")
        .when(F.col("old") == F.col("new"), "unchanged")
        .otherwise("updated")
    )
    return o.join(n, "id", "full_outer").select("id", status.alias("status"))
