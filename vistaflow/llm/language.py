"""Language of texts by hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType,
)

from vistaflow.llm.arrow_text import record_batch, slices
from vistaflow.llm.bpe import classes

DIMENSIONS = 1024
SEED = 7_919
UNKNOWN = "und"
CACHE_GRAMS = 20_000
CELLS = 4_000_000


@lru_cache(maxsize=65_536)
def letter_vector(point: int) -> np.ndarray:
    """Random vector of -1 and 1 for a code point; 0 stands for the edge of a word."""
    return np.random.default_rng([SEED, point]).integers(0, 2, DIMENSIONS, np.int8) * 2 - 1


def gram_vector(key: int) -> np.ndarray:
    """Three letters bound into one vector: each permuted by its place, then multiplied."""
    a, b, c = (letter_vector((key >> shift) & 0x1FFFFF) for shift in (42, 21, 0))
    return np.roll(a, 2) * np.roll(b, 1) * c


class Grams:
    """Vectors of the trigrams met so far."""

    def __init__(self):
        self.row: dict[int, int] = {}
        self.vectors = np.empty((1024, DIMENSIONS), np.int8)

    def of(self, keys: np.ndarray) -> np.ndarray:
        if len(self.row) + len(keys) > max(CACHE_GRAMS, len(keys)):
            self.row = {}
        for key in keys.tolist():
            if key not in self.row:
                at = self.row[key] = len(self.row)
                if at == len(self.vectors):
                    self.vectors = np.concatenate((self.vectors, np.empty_like(self.vectors)))
                self.vectors[at] = gram_vector(key)
        return self.vectors[[self.row[k] for k in keys.tolist()]]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text, and packed letters, of every trigram inside a word.

    Words are runs of letters in lower case; the edges of a word count as letters.
    """
    lowered = [t.lower() for t in texts]
    joined = "\n".join(lowered) + "\n"
    points = np.frombuffer(("\n" + joined).encode("utf-32-le"), np.uint32).astype(np.int64)
    points[classes()[points] != 0] = 0
    middle = points[1:-1] != 0
    keys = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    at = np.flatnonzero(middle)
    return np.searchsorted(ends, at, "right"), keys[at]


class Profiler:
    """Vectors of texts: the sum of the vectors of their trigrams."""

    def __init__(self):
        self.grams = Grams()

    def sums(self, group: np.ndarray, groups: int, keys: np.ndarray) -> np.ndarray:
        """Bundled vectors of ``groups`` groups of trigrams."""
        total = np.zeros((groups, DIMENSIONS))
        codes, distinct = pd.factorize(keys)
        if not len(distinct):
            return total
        # A block of distinct trigrams at a time bounds the counts and the vectors.
        width = max(1, min(len(distinct), CELLS // max(groups, DIMENSIONS)))
        for low in range(0, len(distinct), width):
            high = min(low + width, len(distinct))
            inside = (codes >= low) & (codes < high) if len(distinct) > width else slice(None)
            cell = group[inside] * (high - low) + (codes[inside] - low)
            counts = np.bincount(cell, minlength=groups * (high - low)).reshape(groups, -1)
            total += counts.astype(np.float32) @ self.grams.of(distinct[low:high]).astype(np.float32)
        return total


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, list[int]]:
    """Prototype of each language: the bundle of all its trigrams, over all rows given.

    Every task sums its own rows, so what is shuffled and collected is one vector of
    DIMENSIONS numbers for each language and task. Rows without language or text are left out.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([StructField("lang", StringType()), StructField("vector", ArrayType(LongType()))])
    out = to_arrow_schema(schema)

    def run(batches):
        profiler, totals = Profiler(), {}
        for batch in slices(batches):
            names, langs = pd.factorize(batch.column("lang").to_numpy(zero_copy_only=False))
            owner, keys = trigrams(batch.column("text").to_pylist())
            sums = profiler.sums(names[owner], len(langs), keys)
            for lang, vector in zip(langs, sums):
                totals[lang] = totals.get(lang, 0) + np.rint(vector).astype(np.int64)
        if totals:
            yield record_batch({"lang": list(totals), "vector": [v.tolist() for v in totals.values()]}, out)

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    summed = (
        rows.dropna().mapInArrow(run, schema)
        .select("lang", F.posexplode("vector").alias("place", "part"))
        .groupBy("lang", "place").agg(F.sum("part").alias("part"))
    )
    prototypes: dict[str, list[int]] = {}
    for row in summed.collect():  # languages times DIMENSIONS
        prototypes.setdefault(row["lang"], [0] * DIMENSIONS)[row["place"]] = row["part"]
    return prototypes


def predict(docs: DataFrame, prototypes: dict[str, list[int]], held_out: Column,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score (cosine, at least 0).

    Null texts and texts without a letter give ``und`` and 0, as does every text if there is
    no prototype; equal cosines give the first language by name. Texts are taken whole.
    Repeated rows give repeated results, an empty table none; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names], np.float64).reshape(len(names), DIMENSIONS)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType), StructField("held_out", BooleanType()),
        StructField("lang_pred", StringType()), StructField("score", DoubleType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches):
        profiler = Profiler()
        for batch in slices(batches, text_col):
            count = batch.num_rows
            owner, keys = trigrams([t or "" for t in batch.column(text_col).to_pylist()])
            vectors = profiler.sums(owner, count, keys)
            norms = np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)
            some = np.bincount(owner, minlength=count) > 0
            if len(names):
                cosine = (vectors @ matrix.T) / norms[:, None]
                best = cosine.argmax(axis=1)
                score = np.where(some, np.clip(cosine[np.arange(count), best], 0, 1), 0.0)
            else:
                some, best, score = np.zeros(count, bool), np.zeros(count, int), np.zeros(count)
            yield record_batch({
                id_col: batch.column(id_col), "held_out": batch.column("held_out"),
                "lang_pred": [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), some.tolist())],
                "score": score,
            }, out)

    return docs.select(id_col, text_col, held_out.alias("held_out")).mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", folds: int = 3, held_fold: int = 1) -> DataFrame:
    """Learn from the rows outside the held-out fold and predict all rows.

    The fold is the CRC-32 of the id as text, modulo ``folds``; rows with a null id are held
    out. See ``predict`` for the result.
    """
    fold = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds))
    held_out = F.coalesce(fold == held_fold, F.lit(True))
    return predict(docs, learn(docs.filter(~held_out), lang_col, text_col), held_out, id_col, text_col)
