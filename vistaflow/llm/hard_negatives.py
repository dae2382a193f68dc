"""Hard negatives by exact inner products, with candidates pruned by lengths and coordinates."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vistaflow.llm.arrow_text import record_batch
from vistaflow.llm.jaccard_join import group_numbers, group_runs
from vistaflow.session import staged

BUCKET_ROWS, BUCKET_LEAST, BUCKET_RATIO = 2048, 64, 0.9
FOCUS = 6  # coordinates of an anchor whose value ranges are intersected
GROUP_ROWS, GROUP_BYTES = 8192, 64 << 20  # rows, or anchors, that meet in one step of a task
SLACK = 1e-6  # widens angles and ranges beyond the error of floating point
EXACT = 2.0**52  # products of lengths below this are exact as doubles
NO_ID = np.iinfo(np.int64).max

FOUND = StructType([
    StructField("anchor", LongType()), StructField("bound", LongType()),
    StructField("other", LongType()), StructField("score", LongType()),
])


class Bucket:
    """Vectors of similar length, with the ascending values of each coordinate of their directions."""

    def __init__(self, vectors: np.ndarray, lengths: np.ndarray):
        self.vectors, self.longest, self.shortest = vectors, lengths.max(), lengths.min()
        self.reals = vectors.astype(np.float64)
        self.directions = self.reals / np.where(lengths > 0, lengths, 1)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate_list(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows by the value of coordinate ``k``, and those values; sorted when first asked for."""
        if k not in self._lists:
            order = np.argsort(self.directions[:, k], kind="stable")
            self._lists[k] = order, self.directions[order, k]
        return self._lists[k]

    def candidates(self, direction: np.ndarray, length: float, focus: np.ndarray,
                   least: int | None) -> np.ndarray:
        """Rows whose inner product with the anchor may be ``least`` or more.

        Such a row lies within an angle of the anchor, so on each focus coordinate its value
        lies in a range. The shortest range is read from its list, the others thin it out.
        """
        every = np.arange(len(self.vectors))
        if least is None:
            return every
        reach = length * (self.longest if least > 0 else self.shortest)
        if reach == 0:
            return every[:0] if least > 0 else every
        cosine = least / reach
        if cosine > 1 + SLACK:
            return every[:0]
        if cosine <= -1:
            return every
        angle = np.arccos(min(cosine, 1.0)) + SLACK
        own = np.arccos(np.clip(direction[focus], -1, 1))
        low = np.cos(np.minimum(own + angle, np.pi)) - SLACK
        high = np.cos(np.maximum(own - angle, 0)) + SLACK
        ranges = []
        for k, a, b in zip(focus.tolist(), low.tolist(), high.tolist()):
            order, values = self.coordinate_list(k)
            first, last = np.searchsorted(values, a), np.searchsorted(values, b, "right")
            ranges.append((last - first, k, a, b, order[first:last]))
        ranges.sort(key=lambda r: r[0])
        rows = ranges[0][4] if ranges else every
        for size, k, a, b, _ in ranges[1:]:
            if size < len(every):
                value = self.directions[rows, k]
                rows = rows[(value >= a) & (value <= b)]
        return rows

    def scores(self, rows: np.ndarray, anchor: np.ndarray, length: float) -> np.ndarray:
        """Exact inner products of ``rows`` with an anchor; beyond a long, the nearest long."""
        if length * self.longest < EXACT:
            picked = self.reals if len(rows) == len(self.reals) else self.reals[rows]
            found = (picked @ anchor.astype(np.float64)).astype(np.int64)
            return found[rows] if picked is self.reals else found
        exact = self.vectors[rows].astype(object) @ anchor.astype(object)
        info = np.iinfo(np.int64)
        return np.array([min(max(int(s), info.min), info.max) for s in exact], np.int64)


def bucket_bounds(lengths: np.ndarray) -> list[int]:
    """Where buckets begin among descending lengths, and the end."""
    bounds = [0]
    while bounds[-1] < len(lengths):
        first = bounds[-1]
        similar = int(np.searchsorted(-lengths, -BUCKET_RATIO * lengths[first], "right"))
        bounds.append(min(len(lengths), max(first + BUCKET_LEAST, min(similar, first + BUCKET_ROWS))))
    return bounds


class Best:
    """The ``size`` best of the scores offered, equal scores by the smaller id."""

    def __init__(self, size: int):
        self.size = size
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    def least(self) -> int | None:
        """The smallest score that can still come in."""
        return int(self.scores[-1]) if len(self.scores) == self.size else None

    def offer(self, scores: np.ndarray, ids: np.ndarray):
        least = self.least()
        if least is not None:
            going = scores >= least
            scores, ids = scores[going], ids[going]
        if not len(scores):
            return
        if len(scores) > self.size:
            going = scores >= np.partition(scores, -self.size)[-self.size]
            scores, ids = scores[going], ids[going]
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        order = np.lexsort((ids, ~scores))[: self.size]
        self.scores, self.ids = scores[order], ids[order]


class Windows:
    """For one anchor, the best rows in each window [share of a positive's score, that score]."""

    def __init__(self, bounds: list[int], size: int, share: Fraction):
        self.parts = []
        for bound in sorted(set(bounds), reverse=True):
            low = -(-bound * share.numerator // share.denominator)
            if low <= bound:
                self.parts.append((low, bound, Best(size)))

    def least(self) -> int | None:
        kept = [(low, best.least()) for low, _, best in self.parts]
        return min(low if own is None else max(low, own) for low, own in kept)

    def offer(self, scores: np.ndarray, ids: np.ndarray):
        for low, high, best in self.parts:
            inside = (scores >= low) & (scores <= high)
            best.offer(scores[inside], ids[inside])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a list column as rows of ``width``; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    if len(values):
        row = np.repeat(np.arange(len(column)), lengths)
        out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _meet(rows: DataFrame, anchors: DataFrame, blocks: int, groups: int, width: int,
          make, same_label: bool) -> DataFrame:
    """The best rows for each anchor in each group of rows: (anchor, bound, other, score).

    Each block of anchors meets each group of rows once, in some task; ``make(bounds)`` gives
    what collects an anchor's best rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(FOUND)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    fields = ["kind", "handle", "id", "label", "vector", "length", "bounds"]
    left = anchors.withColumn("kind", F.lit(0)).withColumn(
        "block", F.pmod(F.xxhash64("handle"), F.lit(blocks)).cast("int")).select(
        "block", every(groups).alias("group"), *fields)
    right = rows.withColumn("kind", F.lit(1)).withColumn("bounds", F.lit(None).cast("array<bigint>")).select(
        every(blocks).alias("block"), "group", *fields)

    def search(batches):
        for table in group_runs(batches, ["block", "group"]):
            number = group_numbers(table, ["block", "group"])
            starts = np.flatnonzero(np.diff(number, prepend=-1, append=number[-1] + 1))
            for first, last in zip(starts.tolist(), starts[1:].tolist()):
                yield from one(table.slice(first, last - first))

    def one(table):
        split = int((table.column("kind").to_numpy() == 0).sum())
        if split in (0, table.num_rows):
            return
        vectors = _matrix(table.column("vector"), width)
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        handles = table.column("handle").to_numpy()
        labels = table.column("label").to_numpy()
        ids = table.column("id").fill_null(NO_ID).to_numpy()
        bounds = table.column("bounds").slice(0, split).to_pylist()
        best = [make(b) for b in bounds]
        focus = [np.argsort(-np.abs(v), kind="stable")[:FOCUS] for v in vectors[:split]]
        order = split + np.argsort(-lengths[split:], kind="stable")
        edges = bucket_bounds(lengths[order])
        for low, high in zip(edges, edges[1:]):
            part = order[low:high]
            bucket = Bucket(vectors[part], lengths[part])
            for i in range(split):
                direction = vectors[i] / (lengths[i] or 1)
                picked = bucket.candidates(direction, lengths[i], focus[i], best[i].least())
                at = part[picked]
                if same_label:
                    wanted = (labels[at] == labels[i]) & (handles[at] != handles[i])
                else:
                    wanted = labels[at] != labels[i]
                picked, at = picked[wanted], at[wanted]
                if len(picked):
                    best[i].offer(bucket.scores(picked, vectors[i], lengths[i]), ids[at])
        columns = {f.name: [] for f in out}
        for i in range(split):
            parts = [(None, best[i])] if same_label else [(high, b) for _, high, b in best[i].parts]
            for bound, kept in parts:
                columns["anchor"] += [int(handles[i])] * len(kept.ids)
                columns["bound"] += [bound] * len(kept.ids)
                columns["other"] += [None if k == NO_ID else k for k in kept.ids.tolist()]
                columns["score"] += kept.scores.tolist()
        yield record_batch(columns, out)

    keys = ["block", "group"]
    met = left.unionByName(right).repartition(*keys).sortWithinPartitions(*keys, "kind")
    return met.mapInArrow(search, FOUND)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5,
                   share: Fraction = Fraction(4, 5), scale: int = 256, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Each component x becomes floor(scale * x); a score is the inner product with the anchor.
    An anchor's positives are the ``positives`` best other rows of its label. For each of them,
    of the rows of another label with a score from ``share`` times the positive's score up to
    that score, the ``negatives`` best are returned. Higher scores come first, ties by smaller
    id (a null id last). A positive below zero has no such rows.

    Rows are range-partitioned by length into groups, anchors by a hash into blocks; each block
    meets each group in one task, so memory does not grow with the table. Inside, buckets of
    similar length are read from the longest down; once an anchor has its number of rows, or
    from the positives' scores, a bucket is skipped or its candidates are the intersection of
    value ranges on the anchor's largest coordinates. Candidates are checked exactly. The
    best rows of a task are the only ones that leave it.

    Rows with a null label, a null vector, or a null or non-finite component take no part.
    Shorter vectors count as if they ended in zeros. Components and scores beyond a long
    become the nearest long. A row that repeats an id, or a whole row, is a row of its own:
    it can be a positive of its copy. An empty table gives no rows; other columns are not read.
    """
    scaled = F.transform(F.col(vector_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    bad = F.exists("_scaled", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), scaled.alias("_scaled"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    ).filter(F.col("label").isNotNull() & F.col("_scaled").isNotNull() & ~bad)
    usable = usable.select("id", "label", "is_anchor", F.transform("_scaled", lambda x: F.floor(x)).alias("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = usable.withColumn("length", F.sqrt(squares))
    facts = usable.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_anchor").alias("anchors"),
        F.max(F.size("vector")).alias("width")).first()
    width = max(1, facts["width"] or 1)
    most = max(64, min(GROUP_ROWS, GROUP_BYTES // (8 * width)))
    groups, blocks = max(1, -(-facts["rows"] // most)), max(1, -(-facts["anchors"] // most))
    ranged = usable.repartitionByRange(groups, F.desc("length"), F.xxhash64("id"))
    ranged = staged(ranged.select(
        "*", F.spark_partition_id().alias("group"), F.monotonically_increasing_id().alias("handle")), "vectors")
    groups = 1 + (ranged.agg(F.max("group")).first()[0] or 0)
    anchors = ranged.filter("is_anchor")

    near = _meet(ranged, anchors.withColumn("bounds", F.lit(None).cast("array<bigint>")), blocks, groups,
                 width, lambda _: Best(positives), True)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("other"))
    near = near.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)
    near = staged(near.select("anchor", "place", F.col("other").alias("positive_id"), "score"), "positives")
    bounds = near.filter("score >= 0").groupBy("anchor").agg(F.collect_set("score").alias("bounds"))
    seeking = anchors.join(bounds.withColumnRenamed("anchor", "handle"), "handle")

    far = _meet(ranged, seeking, blocks, groups, width, lambda b: Windows(b, negatives, share), False)
    each = Window.partitionBy("anchor", "bound").orderBy(F.desc("score"), F.asc_nulls_last("other"))
    far = far.withColumn("rank", F.row_number().over(each)).filter(F.col("rank") <= negatives)
    far = far.select("anchor", F.col("bound").alias("positive_score"), "rank", F.col("other").alias("negative_id"),
                     F.col("score").alias("negative_score"))
    found = near.withColumnRenamed("score", "positive_score").join(far, ["anchor", "positive_score"])
    names = anchors.select(F.col("handle").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.vector, b.vector)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
 AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
