"""Periodic runs against brute force, in pieces of any size, and the planted digests."""

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from vistaflow.llm import periodic_runs, queries  # noqa: E402
from vistaflow.llm.periodic_runs import Run  # noqa: E402


def hashes(words):
    return np.array([hash(w) for w in words], np.int64).view(np.uint64)


def brute(words):
    """Maximal stretches by comparing every pair of words that lie a period apart."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((Run(a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r.start, r.period))


def repetitive(k):
    words = []
    for _ in range(random.randint(0, 6)):
        base = [random.randrange(k) for _ in range(random.randint(1, random.choice([3, 10, 40])))]
        words += (base * random.randint(1, 9))[: random.randint(1, 300)]
    return [str(w) for w in words]


@pytest.mark.parametrize("appended", [1, 7, 64, 1 << 16])
def test_like_brute_force(monkeypatch, appended):
    monkeypatch.setattr(periodic_runs, "APPENDED", appended)
    random.seed(appended)
    for _ in range(20 if appended == 1 else 150):
        texts = [repetitive(random.choice([1, 2, 3, 5, 50])) for _ in range(random.randint(1, 5))]
        assert periodic_runs.find_runs([hashes(t) for t in texts]) == [brute(t) for t in texts]


def test_neighbouring_copies_are_no_run():
    text = [f"w{i}" for i in range(9)]
    assert periodic_runs.find_runs([hashes(text)] * 8) == [[]] * 8


def test_long_texts_stay_fast():
    word = ["a"] * 400_000
    assert periodic_runs.find_runs([hashes(word)]) == [[Run(0, 400_000, 1)]]
    period = [str(i % 999) for i in range(400_000)]
    assert periodic_runs.find_runs([hashes(period)]) == [[Run(0, 400_000, 999)]]


def test_words_decide_not_hashes():
    words = [b"a", b"b", b"c", b"d", b"e", b"f", b"g"]
    assert periodic_runs.exact_runs(words, [Run(0, 7, 1)]) == []
    assert periodic_runs.exact_runs([b"a"] * 7, [Run(0, 7, 1)]) == [Run(0, 7, 1)]


def test_edges(spark):
    queries.ship_code(spark)
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "a a a a a a", 0), (4, "a a a a a a", 0), (None, "a  b\tc", 0),
            (5, "x " + "é漢 ß " * 5 + "y", 0), (6, "a a a a a", 0), (7, "word " * 30_000, 0), (8, "a a a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.periodic_runs(docs).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"),
        (None, 3, [], "a b c"), (5, 12, [(1, 10, 2)], "x é漢 ß y"), (6, 5, [], "a a a a a"),
        (7, 30_000, [(0, 30_000, 1)], "word"), (8, 2, [], "a a a")], key=repr)
    assert periodic_runs.periodic_runs(docs.filter("doc_id > 99")).count() == 0


def test_query_like_brute_force(spark):
    """All columns of the registered query over the whole small table."""
    folder = "/root/testdata/sf0.001"
    want = set()
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    for row in table:
        words = re.findall(r"[^\x20\x09-\x0D]+", row["text"] or "")
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute(words)
        best = max(runs, key=lambda r: (r.length * 1_000_000_007 // r.period, -r.start, -r.period), default=None)
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n_ for s, n_, q in runs)]
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{n_},{q}\n" for s, n_, q in runs), " ".join(kept))]
        want.add((row["doc_id"], len(runs), *((*best, 1000 * best.length // best.period) if best else (None,) * 4), *sha))
    got = queries.QUERIES["op12_periodic_runs"](spark, folder).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(table)
    assert sum(r["n_runs"] > 0 for r in got) > 10
