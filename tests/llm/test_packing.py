"""Packing: the library's ids, gapless sequences, and no more of them than plain best fit needs."""

import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from vistaflow.llm import packing, queries  # noqa: E402
from vistaflow.llm.queries import WORD_FILE, content  # noqa: E402


def plain_best_fit(lengths, capacity):
    """Bins of best fit from the largest item down, one item at a time."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


def fewest(lengths, capacity):
    """The least number of bins, by trying."""
    best = len(lengths)
    order = sorted(lengths, reverse=True)

    def go(i, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if i == len(order):
            best = len(gaps)
            return
        for gap in {g for g in gaps if g >= order[i]}:
            rest = list(gaps)
            rest.remove(gap)
            go(i + 1, [*rest, gap - order[i]])
        go(i + 1, [*gaps, capacity - order[i]])

    go(0, [])
    return best


def bins_of(slots, counts):
    """The content of all bins, with every item placed once and no gaps."""
    bins = defaultdict(list)
    for length, (first, base, copies, begin) in slots.arrays().items():
        for rank in range(counts[length]):
            run = int(np.searchsorted(first, rank, "right")) - 1
            k = rank - first[run]
            bins[int(base[run] + k // copies[run])].append((int(begin[run] + k % copies[run] * length), length))
    for content_ in bins.values():
        at = 0
        for offset, length in sorted(content_):
            assert offset == at
            at += length
        assert at <= slots.capacity
    assert set(bins) == set(range(slots.bins))
    return bins


def test_fit_like_plain_best_fit():
    random.seed(6)
    for _ in range(400):
        capacity = random.choice([6, 10, 33, 100])
        lengths = [random.randint(1, capacity) for _ in range(random.randint(0, 150))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        slots = packing.fit(counts, capacity)
        bins_of(slots, counts)
        assert slots.bins <= plain_best_fit(lengths, capacity)


def test_large_items_match_as_well_as_can_be():
    random.seed(7)
    for _ in range(60):
        lengths = [random.randint(11, 30) for _ in range(random.randint(1, 9))]
        assert packing.fit({n: lengths.count(n) for n in set(lengths)}, 30).bins == fewest(lengths, 30)


def test_fit_of_huge_counts_depends_on_lengths_only():
    counts = {n: 10**9 + n for n in range(1, 2049)}
    slots = packing.fit(counts, 2048)
    total = sum(n * c for n, c in counts.items())
    assert slots.bins * 2048 - total < 0.001 * total
    assert sum(len(r) for r in slots.runs.values()) < 50_000
    with pytest.raises(ValueError):
        packing.fit({2049: 1}, 2048)


def test_chunked_ids_like_the_library(monkeypatch):
    random.seed(4)
    monkeypatch.setattr(packing, "CACHED_CHUNKS", 50)
    library = Tokenizer.from_file(WORD_FILE)
    alphabet = ["a", "B", "'s", "'", " ", "  ", "\n", "\t", "\x0b", " ", " ", "é", "́", "Σ", "ß", "漢", "1", "22",
                "<|endoftext|>", "<|startoftext|>", "!?", "ſ", "İ", "가", "x" * 90, "\r\n", " ", "\x1c", "\x85"]
    texts = ["", " ", "́", " ́a"] + ["".join(random.choices(alphabet, k=random.randint(1, 25))) for _ in range(5000)]
    encoder = packing.ChunkEncoder(content(WORD_FILE))
    got = [ids.tolist() for first in range(0, len(texts), 37) for ids in encoder.encode(texts[first : first + 37])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def checked(rows, texts, capacity):
    """Every document cut and placed as it must be."""
    library = Tokenizer.from_file(WORD_FILE)
    want = []
    for i, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), capacity):
            part = np.array(ids[start : start + capacity], "<u4")
            want.append((i, start // capacity, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    ends = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values(), default=0) <= capacity
    return len(ends)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_documents(spark, monkeypatch, limit):
    """Edge cases, by a broadcast and by a shuffle of the sums."""
    queries.ship_code(spark)
    monkeypatch.setattr(packing.measured_join, "__defaults__", (None, limit, "inner"))
    texts = [(1, None), (2, ""), (3, "same text here"), (3, "same text here"), (None, "no id"), (4, "word " * 5000), (5, "x" * 3000)]
    texts += [(10 + i, "one two three four five") for i in range(300)]
    docs = spark.createDataFrame([(i, t, 7, 8) for i, t in texts], "doc_id long, text string, length int, sequence_id int").repartition(5)
    rows = packing.packed_documents(docs, content(WORD_FILE), 256).collect()
    count = checked(rows, texts, 256)
    assert count <= plain_best_fit([r["length"] for r in rows], 256)
    assert packing.packed_documents(docs.filter("doc_id > 999"), content(WORD_FILE)).count() == 0


def test_sequences_hold_the_ids(spark):
    queries.ship_code(spark)
    docs = spark.createDataFrame([(i, f"text {'again ' * (i % 40)}") for i in range(200)], "doc_id long, text string")
    packed = packing.pack(packing.token_pieces(docs, content(WORD_FILE), 64), 64)
    parts = defaultdict(list)
    for r in packed.collect():
        parts[r["sequence_id"]].append((r["offset"], bytes(r["ids"])))
    got = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    assert got == {k: b"".join(b for _, b in sorted(v)) for k, v in parts.items()}


def test_items_of_wrong_length(spark):
    queries.ship_code(spark)
    with pytest.raises(Exception, match="lengths must be"):
        packing.pack(spark.createDataFrame([(1, 65)], "id int, length long"), 64)
