"""Registered queries of this package, each over its whole table, with their SQL."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaflow.llm import (
    bpe, decontamination, exact_dedup, hard_negatives, jaccard_join, language, packing,
    periodic_runs, pii, secret_scan, token_counts, toxicity, warc,
)

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.ORACLE_SQL,
    "op7_warc": warc.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
}
_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="vistaflow-code-")) / "vistaflow.zip"
    with zipfile.ZipFile(target, "w") as packed:
        for path in sorted(root.rglob("*.py")):
            packed.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def content(path: str) -> bytes:
    """A vocabulary file, read by the driver and sent along: its size is fixed."""
    return Path(path).read_bytes()


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_code(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_exact_dedup(spark, folder):
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"), keep="largest")


@query
def op2_byte_bpe(spark, folder):
    return bpe.encode_decode(table(spark, folder, "documents"), content(RANK_FILE))


@query
def op3_secrets(spark, folder):
    return secret_scan.scan_secrets(table(spark, folder, "documents"))


@query
def op4_token_counts(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), content(PIECE_FILE))


@query
def op5_language(spark, folder):
    return language.identify(table(spark, folder, "documents"))


@query
def op6_decontamination(spark, folder):
    return decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op7_warc(spark, folder):
    return warc.archived_pages(table(spark, folder, "pages"))


@query
def op8_pii(spark, folder):
    return pii.scan_personal_data(table(spark, folder, "documents"))


@query
def op9_ngram_jaccard(spark, folder):
    return jaccard_join.similar_documents(table(spark, folder, "documents"), count=True)


@query
def op10_toxicity(spark, folder):
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op11_hard_negatives(spark, folder):
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10)
    rows = rows.withColumn("label", moved.otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of which every tenth, by a checksum of the id, goes on repeating a stretch of itself."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    docs = docs.withColumn("g", F.floor(F.col("h") / 10))
    docs = docs.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    a = F.col("g") % F.col("n")
    p = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", F.when(F.col("n") > 0, p))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.element_at("words", (place(i.cast("long")) + 1).cast("int")))
    text = F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query
def op12_periodic_runs(spark, folder):
    found = periodic_runs.periodic_runs(with_planted_runs(table(spark, folder, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = F.col("best")
    return found.withColumn("best", periodic_runs.longest_power()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_best_fit_packing(spark, folder):
    return packing.packed_documents(table(spark, folder, "documents"), content(WORD_FILE))
