"""Hard negatives against brute force, ties, hot vectors and edge cases."""

import random
import sys
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from vistaflow.llm import hard_negatives  # noqa: E402
from vistaflow.llm.queries import ship_code  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int, score int, `group` string"


def brute(data, anchor, positives=5, negatives=5, share=Fraction(4, 5), scale=256):
    rows = [(i, [int(np.floor(scale * x)) for x in v], label) for i, v, label in data
            if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for k, (a, va, la) in enumerate(rows):
        if a is None or not anchor(a):
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), (i is None, i), label)
                  for n, (i, v, label) in enumerate(rows) if n != k]
        scored.sort(key=lambda s: (s[0], s[1][0], s[1][1] or 0))
        near = [s for s in scored if s[2] == la][:positives]
        for p in near:
            high = -p[0]
            far = [s for s in scored if s[2] != la and share * high <= -s[0] <= high][:negatives]
            out += [(a, p[1][1], r, s[1][1], high, -s[0]) for r, s in enumerate(far, 1)]
    return sorted(out, key=repr)


def found(spark, data, anchor, **options):
    frame = spark.createDataFrame([(i, v, label, 9, "g") for i, v, label in data], SCHEMA)
    return sorted((tuple(r) for r in hard_negatives.hard_negatives(frame, anchor, **options).collect()), key=repr)


@pytest.fixture(scope="module", autouse=True)
def code(spark):
    ship_code(spark)


def clustered(count, seed, dims=12):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (5, dims))
    return [(i, (centres[i % 5] * draw.choice([0.1, 1, 4]) + draw.normal(0, 0.3, dims)).tolist(), int(draw.integers(0, 3)))
            for i in range(count)]


@pytest.mark.parametrize("small", [True, False])
def test_like_brute_force(spark, monkeypatch, small):
    """Also where anchors take several blocks, rows several groups and buckets."""
    if small:
        for name, value in (("GROUP_ROWS", 64), ("BUCKET_ROWS", 20), ("BUCKET_LEAST", 4)):
            monkeypatch.setattr(hard_negatives, name, value)
    data = clustered(400, 5)
    got = found(spark, data, F.col("vec_id") % 4 == 0)
    assert got == brute(data, lambda i: i % 4 == 0) and len(got) > 300


def test_ties_hot_vectors_and_bad_rows(spark):
    hot = [1.0, 0.5, -0.25]
    data = [(i, hot, i % 2) for i in range(120)]
    data += [(200, None, 1), (201, hot, None), (202, [1.0, None, 1.0], 0), (203, [float("nan"), 1.0, 1.0], 0),
             (204, [float("inf"), 0.0, 0.0], 1), (205, [0.0, 0.0, 0.0], 0), (206, [-1.0, -1.0, 0.0], 1),
             (207, [], 1), (208, [1.0], 0), (None, hot, 0), (10, [2.0, 1.0, -0.5], 0), (10, [2.0, 1.0, -0.5], 0),
             (300, [1.9, 0.9, -0.5], 1)]
    got = found(spark, data, F.col("vec_id") % 5 == 0)
    padded = [(i, v if v is None else v + [0.0] * (3 - len(v)), label) for i, v, label in data]
    assert got == brute(padded, lambda i: i % 5 == 0)
    assert any(r[1] == 10 and r[0] == 10 for r in got)  # a repeated row is another row


def test_large_components(spark):
    data = [(i, [float(v) for v in (2**31 + i, -(2**30) - i, 7 * i)], i % 2) for i in range(24)]
    got = found(spark, data, F.col("vec_id") % 3 == 0, scale=1)
    assert got == brute(data, lambda i: i % 3 == 0, scale=1) and got


def test_few_rows_and_empty(spark):
    assert found(spark, [], F.lit(True)) == []
    assert found(spark, [(1, [1.0], 0), (2, [1.0], 0)], F.lit(True)) == []
    assert found(spark, [(1, [1.0], 0), (2, [1.0], 0), (3, [0.9], 1)], F.col("vec_id") == 1) == [(1, 2, 1, 3, 65536, 58880)]
    assert found(spark, [(1, [1.0], 0), (2, [1.0], 0), (3, [0.9], 1)], F.lit(False)) == []


def test_candidates_lose_nothing_and_prune():
    """A bucket's candidates hold every row that reaches the score, and far fewer than all."""
    draw = np.random.default_rng(8)
    centres = draw.normal(0, 60, (8, 16))
    vectors = centres[draw.integers(0, 8, 2000)] + draw.normal(0, 12, (2000, 16))
    vectors = np.floor(vectors * draw.uniform(230, 250, (2000, 1)) / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.int64)
    lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    bucket = hard_negatives.Bucket(vectors, lengths)
    seen = 0
    for i in range(0, 2000, 40):
        scores = vectors @ vectors[i]
        focus = np.argsort(-np.abs(vectors[i]))[: hard_negatives.FOCUS]
        for least in (int(np.sort(scores)[-20]), 1, 0, -1, int(scores.min()), int(scores.max()) + 1):
            rows = bucket.candidates(vectors[i] / lengths[i], lengths[i], focus, least)
            assert set(np.flatnonzero(scores >= least)) <= set(rows.tolist())
        seen += len(bucket.candidates(vectors[i] / lengths[i], lengths[i], focus, int(np.sort(scores)[-20])))
    assert seen < 0.35 * 2000 * 50


def test_bucket_bounds():
    random.seed(2)
    lengths = np.array(sorted((random.choice([1, 5, 5, 9]) * random.random() for _ in range(5000)), reverse=True))
    edges = hard_negatives.bucket_bounds(lengths)
    assert edges[0] == 0 and edges[-1] == 5000 and all(a < b for a, b in zip(edges, edges[1:]))
    assert all(b - a <= hard_negatives.BUCKET_ROWS for a, b in zip(edges, edges[1:]))
    assert hard_negatives.bucket_bounds(np.zeros(0)) == [0]
