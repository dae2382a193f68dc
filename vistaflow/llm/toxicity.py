"""Toxic texts by non-negative positive-unlabelled learning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType,
)

from vistaflow.llm.arrow_text import GOLDEN, mix, record_batch, slices
from vistaflow.llm.bpe import classes
from vistaflow.llm.spread import measured_join
from vistaflow.session import staged

WIDTH = 5  # characters of a feature
BUCKETS = 1 << 18
FEATURES = 4_096  # at most 65,536: numbers of features travel in two bytes
TRAIN_ROWS = 24_000  # documented bound, of positives and of the unlabelled sample each
MIN_DOCUMENTS = 4
STEPS, RATE, DECAY = 400, 0.05, 1e-4
ENTRIES = 1 << 20  # pairs of row and feature that a step of the fit takes at once


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and bucket of every run of WIDTH characters; case and signs folded.

    Whatever is not a letter is one sign, so the edges of words are part of the runs.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    if len(points) < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    values = np.where(classes()[points] == 0, points, 32).astype(np.uint64)
    count = len(points) - WIDTH + 1
    total = values[:count].copy()
    for j in range(1, WIDTH):
        total *= GOLDEN
        total += values[j : j + count]
    ends = np.cumsum([len(t) for t in lowered])
    at = np.arange(count)
    owner = np.searchsorted(ends, at, "right")
    inside = at + WIDTH <= ends[owner]
    return owner[inside], (mix(total[inside]) >> np.uint64(46)).astype(np.int64)


def present(owner: np.ndarray, feature: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of text and feature."""
    pair = np.unique(owner * size + feature)
    return pair // size, pair % size


class Model:
    """Selected buckets, their weights and the bias."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float):
        self.buckets, self.weights, self.bias = buckets, weights, bias

    def scores(self, texts: list[str]) -> np.ndarray:
        place = np.full(BUCKETS, -1, np.int32)
        place[self.buckets] = np.arange(len(self.buckets))
        owner, bucket = features(texts)
        at = place[bucket]
        known = at >= 0
        owner, at = present(owner[known], at[known].astype(np.int64), max(len(self.buckets), 1))
        margin = self.bias + np.bincount(owner, self.weights[at], minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def fit(row: np.ndarray, feature: np.ndarray, positive: np.ndarray, drawn: np.ndarray, prior: float,
        size: int):
    """Weights and bias that minimise the non-negative risk for positive and unlabelled rows.

    ``positive`` marks the rows known to be positive, ``drawn`` the unlabelled sample: rows
    drawn with no regard to their labels. Each counts by its own number of rows. The risk of
    calling an unlabelled row negative holds the positives among them, which the class prior
    takes out again; where that difference falls below zero, the step goes against it instead (Kiryo et al. 2017). Logistic loss, Adam.
    """
    rows = len(positive)
    weights, bias = np.zeros(size), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    known = positive.astype(float) / max(positive.sum(), 1)
    every = drawn.astype(float) / max(drawn.sum(), 1)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    parts = [(row[a : a + ENTRIES], feature[a : a + ENTRIES]) for a in range(0, len(row), ENTRIES)]
    for step in range(1, STEPS + 1):
        margin = np.full(rows, bias)
        for r, f in parts:
            margin += np.bincount(r, weights[f], minlength=rows)
        share = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))
        as_negative = np.logaddexp(0, margin)
        rest = (every - prior * known) @ as_negative
        if rest >= 0:
            slope = prior * known * (share - 1) + (every - prior * known) * share
        else:
            slope = -(every - prior * known) * share
        gradient = np.append(DECAY * weights, slope.sum())
        for r, f in parts:
            gradient[:-1] += np.bincount(f, slope[r], minlength=size)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, bias


def strength(hits: np.ndarray, found: np.ndarray, positives: int, rows: int) -> np.ndarray:
    """Signed log-likelihood ratio of a bucket's presence among positives and all rows."""
    def part(k, n, p):
        p = np.clip(p, 1e-9, 1 - 1e-9)
        return k * np.log(p) + (n - k) * np.log(1 - p)

    others, rest = found - hits, max(rows - positives, 1)
    both = part(hits, positives, found / rows) + part(others, rest, found / rows)
    own = part(hits, positives, hits / max(positives, 1)) + part(others, rest, others / rest)
    return (own - both) * np.sign(hits / max(positives, 1) - found / rows)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", folds: int = 5, held_fold: int = 0,
          train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on labelled documents outside the held-out fold.

    The class prior is the share of positives among all those labels. The classifier is
    fitted on about ``train_rows`` of the positives and as many of all rows, each chosen by a
    hash of the id (all, if there are no more). A repeated label counts as positive if any of its rows is. Rows without id,
    label or text are left out; without positives every score is 0.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    fold = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds))
    known = (
        labels.filter((fold != held_fold) & F.col(label_col).isNotNull())
        .groupBy(id_col).agg(F.max(label_col).cast("int").alias("_label"))
    )
    total, positives = known.agg(F.count(F.lit(1)), F.sum("_label")).first()
    if not positives:
        return Model(np.zeros(0, np.int64), np.zeros(0), -500.0)
    prior = positives / total
    span = 1 << 30
    hashed = F.pmod(F.xxhash64(id_col), F.lit(span))
    drawn = hashed < F.lit(int(span * min(1, train_rows / total)))
    positive = (F.col("_label") == 1) & (hashed < F.lit(int(span * min(1, train_rows / positives))))
    chosen = staged(known.withColumn("_drawn", drawn.cast("int")).filter(drawn | positive), "labels")
    rows = measured_join(docs.select(id_col, F.col(text_col).alias("text")).dropna(), chosen, id_col)
    rows = staged(rows.select("text", "_label", "_drawn"), "training")
    counted = StructType([StructField("bucket", IntegerType()), StructField("found", LongType()),
                          StructField("hits", LongType())])
    counted_out = to_arrow_schema(counted)

    def count(batches):
        found, hits = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches):
            owner, bucket = features(batch.column("text").to_pylist())
            owner, bucket = present(owner, bucket, BUCKETS)
            label = batch.column("_label").to_numpy(zero_copy_only=False)
            found += np.bincount(bucket, minlength=BUCKETS)
            hits += np.bincount(bucket[label[owner] == 1], minlength=BUCKETS)
        at = np.flatnonzero(found)
        yield record_batch({"bucket": at, "found": found[at], "hits": hits[at]}, counted_out)

    table = (
        rows.mapInArrow(count, counted).groupBy("bucket")
        .agg(F.sum("found").alias("found"), F.sum("hits").alias("hits"))
        .filter(F.col("hits") >= MIN_DOCUMENTS).orderBy("bucket").toPandas()  # at most BUCKETS rows
    )
    size, marked = rows.agg(F.count(F.lit(1)), F.sum("_label")).first()
    if not marked or not len(table):
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / max(1 - prior, 1e-6))))
    power = strength(table["hits"].to_numpy(float), table["found"].to_numpy(float), marked, size)
    best = np.argsort(-power, kind="stable")[:FEATURES]
    buckets = np.sort(table["bucket"].to_numpy(np.int64)[best[power[best] > 0]])
    place = np.full(BUCKETS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    listed = StructType([StructField("label", IntegerType()), StructField("drawn", IntegerType()),
                         StructField("features", BinaryType())])
    listed_out = to_arrow_schema(listed)

    def select(batches):
        for batch in slices(batches):
            owner, bucket = features(batch.column("text").to_pylist())
            at = place[bucket]
            owner, at = present(owner[at >= 0], at[at >= 0].astype(np.int64), len(buckets))
            at = at.astype("<u2")
            bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            yield record_batch({
                "label": batch.column("_label"),
                "drawn": batch.column("_drawn"),
                "features": [at[a:b].tobytes() for a, b in zip(bounds, bounds[1:])],
            }, listed_out)

    sample = rows.mapInArrow(select, listed).toPandas()  # bounded by twice train_rows
    lengths = sample["features"].map(len).to_numpy(np.int64) // 2
    feature = np.frombuffer(b"".join(sample["features"]), "<u2")
    weights, bias = fit(np.repeat(np.arange(len(sample), dtype=np.int32), lengths), feature,
                        sample["label"].to_numpy() == 1, sample["drawn"].to_numpy() == 1, prior, len(buckets))
    return Model(buckets, weights, bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          folds: int = 5, held_fold: int = 0, keep_columns: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted (1 if score >= 0.5).

    With ``keep_columns`` the rows keep all their own columns and get ``_score`` only. Null
    and empty texts get the score of a text without features; texts are taken whole. Rows
    with a null id count as held out. Repeated rows give repeated results, an empty table
    none; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if keep_columns:
        schema = StructType([*docs.schema.fields, StructField("_score", DoubleType())])
        frame = docs
    else:
        fold = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds))
        schema = StructType([
            StructField(id_col, docs.schema[id_col].dataType), StructField("held_out", BooleanType()),
            StructField("score", DoubleType()), StructField("predicted", IntegerType()),
        ])
        frame = docs.select(id_col, text_col, F.coalesce(fold == held_fold, F.lit(True)).alias("held_out"))
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in slices(batches, text_col):
            scores = model.scores([t or "" for t in batch.column(text_col).to_pylist()])
            own = {"_score": scores} if keep_columns else {
                "score": scores, "predicted": (scores >= 0.5).astype(np.int32)}
            yield record_batch(
                {n: batch.column(n) for n in batch.schema.names if n in out.names} | own, out)

    return frame.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Learn from ``labels`` outside the held-out fold and score all documents."""
    return score(docs, learn(docs, labels, id_col, text_col), id_col, text_col)
