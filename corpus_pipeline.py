"""Preparing documents for training: toxicity, duplicates, near duplicates, benchmarks, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents. All but the last keep the columns of their
documents. Rows with a null text count as empty and stay until a stage rejects them. A stage
decides on rows, not on ids: of rows that repeat an id, only those whose own text is rejected
go. Of rows equal in id and text one stays; a null id is smaller than any other. An empty table
passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaflow.llm import bpe, decontamination, exact_dedup, jaccard_join, toxicity
from vistaflow.llm import queries as llm
from vistaflow.llm.spread import measured_join
from vistaflow.session import staged

ORACLE_SQL = None  # a learned classifier and MinHash are not expressible in SQL


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents with a key of the id and a digest of the text, which tells rows of one id apart."""
    name = "_key"
    while name in docs.columns:
        name = f"_{name}"
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    return docs.withColumn(name, F.struct("doc_id", digest.alias("digest"))), name


def without(docs: DataFrame, key: str, dropped: DataFrame, label: str) -> DataFrame:
    """Documents whose key is not among the dropped ones, which are stored and counted first."""
    keys = staged(dropped.select(key).distinct(), label)
    return measured_join(docs, keys, key, how="left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, does not call toxic."""
    llm.ship_code(spark)
    model = toxicity.learn(docs, llm.table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep_columns=True).filter("_score < 0.5").drop("_score")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id; of equal rows, one."""
    rows, key = keyed(docs)
    groups = exact_dedup.exact_duplicates(rows, id_col=key, keep="largest")
    groups = staged(groups.filter("group_size > 1").select(key, "kept"), "groups")
    rows = without(rows, key, groups.filter("NOT kept"), "copies")
    repeated = groups.filter("kept").groupBy(key).count().filter("count > 1").select(key)
    repeated = staged(repeated, "repeated")
    if not repeated.isEmpty():
        once = measured_join(rows, repeated, key, how="left_semi").dropDuplicates([key])
        rows = measured_join(rows, repeated, key, how="left_anti").unionByName(once)
    return rows.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents, the one with the smallest id."""
    llm.ship_code(spark)
    rows, key = keyed(docs)
    classes = jaccard_join.similar_documents(rows, id_col=key)
    return without(rows, key, classes.filter(F.col("class_id") != F.col(key)), "near").select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    llm.ship_code(spark)
    rows, key = keyed(docs)
    found = decontamination.contamination(rows, llm.table(spark, sf_dir, "benchmark"), id_col=key)
    return without(rows, key, found.filter("contaminated"), "contaminated").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the remaining documents, encoded and decoded."""
    llm.ship_code(spark)
    return bpe.encode_decode(docs, llm.content(llm.RANK_FILE))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("byte_level_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = llm.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
