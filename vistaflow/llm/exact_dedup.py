"""Exact duplicates: groups by a 128-bit hash, with bytes compared inside the groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaflow.llm.spread import measured_join, salted_left_join
from vistaflow.session import staged


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "smallest") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    The MD5 of each text is counted first. Only texts whose MD5 occurs twice go on; they are
    grouped by it and by the text itself, so two texts with one MD5 are never one group: the
    hash leads, the bytes decide. Each map task first combines its equal rows, so a text that
    makes up a third of the table sends one row per task. Groups are joined back by MD5 and
    SHA-256 and without texts; the rows of one group are spread over several tasks.

    ``keep`` names the id that stays: ``smallest`` or ``largest``. Null texts count as empty.
    Ids may be null: they never stay where another id exists, and a group of null ids keeps
    all its rows. Rows that repeat the id that stays all stay. An empty table gives no rows;
    other columns of ``docs`` are not read.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    pick = F.min if keep == "smallest" else F.max
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).select(
        "_id", "_text", F.unhex(F.md5("_text")).alias("_md5"),
        F.sha2("_text", 256).alias("text_sha256"),
    )
    hashes = rows.groupBy("_md5").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select("_md5")
    copies = measured_join(rows, staged(hashes, "hashes"), "_md5", how="left_semi")
    groups = (
        copies.groupBy("_md5", "_text")
        .agg(pick("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
        .filter("_size > 1")
        .select("_md5", F.sha2("_text", 256).alias("text_sha256"), "_keep", "_size")
    )
    joined = salted_left_join(
        rows.select("_id", "_md5", "text_sha256"), groups, ["_md5", "text_sha256"], F.col("_id")
    )
    keep_id = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return joined.select(
        F.col("_id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).alias("group_size"),
        F.col("_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
