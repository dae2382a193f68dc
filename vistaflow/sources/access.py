"""Sources of the access jobs: group memberships, view grants and superuser lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaflow.functions.identity import emails_in_json, normalized, user_id
from vistaflow.functions.values import strip


def memberships(
    df: DataFrame, *, email: str, group: str, name: str | None = None, order: Column | None = None
) -> DataFrame:
    """Normalized (email, group, name) rows with the order they came in.

    Rows without an email are dropped. Repeats are folded to their first row before any
    shuffle, so an email that holds most of the rows stays cheap.
    """
    rows = df.select(
        normalized(F.col(email)).alias("email"),
        F.coalesce(strip(F.col(group).cast("string")), F.lit("")).alias("group"),
        (strip(F.col(name).cast("string")) if name else F.lit("")).alias("name"),
        (order if order is not None else F.lit(0)).cast("long").alias("ord"),
    )
    rows = rows.where(F.col("email") != "").withColumn("name", F.coalesce("name", F.lit("")))
    return rows.groupBy("email", "group", "name").agg(F.min("ord").alias("ord"))


def grants(df: DataFrame, *, view: str, email: str) -> DataFrame:
    """Normalized (view, email) rows, one per source row; blank parts are dropped."""
    pairs = df.select(
        normalized(F.col(view)).alias("view"), normalized(F.col(email)).alias("email")
    )
    return pairs.where((F.col("view") != "") & (F.col("email") != ""))


def superusers(texts: DataFrame, column: str) -> DataFrame:
    """Distinct superusers named by a column of JSON arrays of emails."""
    emails = texts.select(F.explode(emails_in_json(F.col(column))).alias("email")).distinct()
    return emails.select(user_id(F.col("email")).alias("datasource_user_id"), "email")
