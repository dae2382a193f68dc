"""Periodic runs of words, by catching squares as words are appended."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from vistaflow.llm.arrow_text import GOLDEN, mix, record_batch, slices

LEAST_WORDS, LEAST_PERIODS = 6, 4
APPENDED = 1 << 16  # words that are appended together

RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


class Run(NamedTuple):
    """Words [start, start + length) repeat with smallest period ``period``."""

    start: int
    length: int
    period: int


class Catchers:
    """Catches repetitions while words are appended.

    Of each size b = 1, 2, 4, ..., every completed block [m b, (m + 1) b) has a catcher for the
    squares whose half is from 2 b to 4 b words (for b = 1 also one word). Each appended word
    ends one suffix of b words; the catchers whose block lies that far back compare it with
    theirs, by hashes that double with b. A half of that length holds a whole block, so no
    square is missed. Hits of neighbouring blocks at one distance are squares that merge: they
    are joined into a stretch, extended word by word to both sides, and kept if it is a run.
    The words of one call are appended together: one comparison of arrays for each size and
    distance instead of one for each word.
    """

    def __init__(self, longest: int):
        """``longest`` bounds a run's length: of the sizes, those it can need are kept."""
        self.words = np.zeros(0, np.uint64)
        self.sizes = [1]
        while 2 * LEAST_PERIODS * 2 * self.sizes[-1] <= longest:
            self.sizes.append(2 * self.sizes[-1])
        self._windows = {b: np.zeros(0, np.uint64) for b in self.sizes}  # the last hashes of b words
        self._first = dict.fromkeys(self.sizes, 0)  # where the first of them begins
        self._hits: dict[int, list[np.ndarray]] = {b: [] for b in self.sizes}

    def append(self, words: np.ndarray):
        """Advance all catchers by these words, given by 64-bit hashes."""
        self.words = np.concatenate((self.words, words))
        known, begin = words, len(self.words) - len(words)
        for b in self.sizes:
            if b > 1:
                # Hashes of b words from those of b / 2: of windows that end in the new words.
                half, first = self._windows[b // 2], self._first[b // 2]
                begin = self._first[b] + len(self._windows[b])
                count = max(0, len(half) + first - begin - b // 2)
                at = begin - first
                known = mix(half[at : at + count] * GOLDEN + half[at + b // 2 : at + b // 2 + count])
            windows = np.concatenate((self._windows[b], known))
            self._catch(b, windows, self._first[b], begin)
            self._windows[b] = windows
        for b in self.sizes:  # what later windows and blocks still need
            past = max(0, len(self._windows[b]) - 5 * b)
            self._windows[b] = self._windows[b][past:]
            self._first[b] += past

    def _catch(self, b: int, windows: np.ndarray, first: int, begin: int):
        """Compare the windows from ``begin`` on with the blocks 2 b to 4 b words before them."""
        starts = np.arange(begin, first + len(windows))
        for near in (2, 3) if b > 1 else (1, 2, 3):
            if b == 1:
                block = starts - near
            else:
                block = (starts // b - near) * b
            going = block >= first
            x, m = starts[going], block[going]
            hit = windows[x - first] == windows[m - first]
            if hit.any():
                self._hits[b].append(np.stack((x[hit] - m[hit], m[hit])))

    def runs(self) -> list[Run]:
        """All runs of what has been appended, by start and period."""
        found: dict[tuple[int, int], int] = {}
        cover = np.full(len(self.words), -1)
        kept: list[Run] = []
        for b in self.sizes:
            if not self._hits[b]:
                continue
            period, block = np.concatenate(self._hits[b], axis=1)
            if kept:  # squares of a longer period inside a run of which it is a multiple
                ends = np.array([r.start + r.length for r in kept])
                own = np.array([r.period for r in kept])
                at = cover[block]
                inside = (at >= 0) & (own[at] <= b) & (block + period + b <= ends[at]) & (period % own[at] == 0)
                period, block = period[~inside], block[~inside]
            if not len(period):
                continue
            order = np.lexsort((block, period))
            period, block = period[order], block[order]
            breaks = (np.diff(period) != 0) | (np.diff(block) != b)
            edges = np.flatnonzero(np.concatenate(([True], breaks, [True])))
            first, last = edges[:-1], edges[1:] - 1
            # Pairs of equal words that a run has, less those that lie in no whole block.
            pairs = np.maximum(LEAST_WORDS, LEAST_PERIODS * period[first]) - period[first] - 2 * (b - 1)
            going = block[last] - block[first] + b >= pairs
            new = []
            for i, j in zip(first[going].tolist(), last[going].tolist()):
                q = int(period[i])
                low, high = self._extended(int(block[i]), int(block[j]) + b, q)
                length = high - low + q
                if length >= max(LEAST_WORDS, LEAST_PERIODS * q):
                    if found.setdefault((low, low + length), q) == q:
                        new.append(Run(low, length, q))
            for run in dict.fromkeys(new):
                cover[run.start : run.start + run.length] = len(kept)
                kept.append(run)
        return sorted(kept, key=lambda r: (r.start, r.period))

    def _extended(self, low: int, high: int, period: int) -> tuple[int, int]:
        """The longest stretch around [low, high) of words equal to those ``period`` on."""
        words, step = self.words, 16
        while low:
            begin = max(0, low - step)
            other = words[begin:low] != words[begin + period : low + period]
            if other.any():
                low = begin + int(np.flatnonzero(other)[-1]) + 1
                break
            low, step = begin, 2 * step
        step = 16
        while high + period < len(words):
            stop = min(high + step, len(words) - period)
            other = words[high:stop] != words[high + period : stop + period]
            if other.any():
                high += int(np.argmax(other))
                break
            high, step = stop, 2 * step
        return low, high


def find_runs(hashes: list[np.ndarray]) -> list[list[Run]]:
    """The runs of each of several texts, given by the hashes of their words.

    All are appended to one set of catchers, each after a word of its own, which no run can
    contain.
    """
    lengths = np.array([len(h) for h in hashes])
    catchers = Catchers(int(lengths.max(initial=0)))
    marks = mix(np.arange(1, len(hashes) + 1, dtype=np.uint64) * GOLDEN)
    joined = np.concatenate([part for h, mark in zip(hashes, marks) for part in (h, [mark])] or [np.zeros(0, np.uint64)])
    for first in range(0, len(joined), APPENDED):
        catchers.append(joined[first : first + APPENDED].astype(np.uint64))
    begins = np.cumsum(lengths + 1) - lengths - 1
    found: list[list[Run]] = [[] for _ in hashes]
    for run in catchers.runs():
        text = int(np.searchsorted(begins, run.start, "right")) - 1
        found[text].append(run._replace(start=run.start - int(begins[text])))
    return found


def exact_runs(words: list[bytes], runs: list[Run]) -> list[Run]:
    """The runs, after a comparison of the words themselves in place of their hashes."""
    for start, length, period in runs:
        if words[start : start + length - period] != words[start + period : start + length]:
            number: dict[bytes, int] = {}
            codes = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
            return find_runs([mix((codes + np.uint64(1)) * GOLDEN)])[0]
    return runs


def kept_words(count: int, runs: list[Run]) -> np.ndarray:
    """Which of ``count`` words are in no run after its first period."""
    keep = np.ones(count, bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return keep


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, runs (start, length, period), collapsed.

    Words are what blanks (U+0020, U+0009 to U+000D) part, numbered from 0. A run is a longest
    stretch with smallest period q, of at least 4 q and 6 words; ``runs`` are ordered by start
    and period. ``collapsed`` holds, joined by one blank, the words that no run contains after
    its first period. Work grows with n log n words of a text; memory with a slice of texts or
    the longest one.

    A null or empty text has no words, no runs and an empty ``collapsed``. Repeated rows and
    null ids are rows of their own; an empty table gives no rows; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType), StructField("n_words", LongType()),
        StructField("runs", ArrayType(RUN, False)), StructField("collapsed", StringType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in slices(batches, text_col):
            texts = pa.array(batch.column(text_col)).cast(pa.large_binary())
            words = [(t or b"").split() for t in texts.to_pylist()]
            hashes = [np.fromiter(map(hash, w), np.int64, len(w)).view(np.uint64) for w in words]
            found = [exact_runs(w, r) if r else r for w, r in zip(words, find_runs(hashes))]
            collapsed = []
            for own, runs in zip(words, found):
                if runs:
                    own = [own[i] for i in np.flatnonzero(kept_words(len(own), runs)).tolist()]
                collapsed.append(b" ".join(own))
            yield record_batch({
                id_col: batch.column(id_col), "n_words": [len(w) for w in words],
                "runs": pa.array([[r._asdict() for r in runs] for runs in found], out.field("runs").type),
                "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
            }, out)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def longest_power(runs: str = "runs"):
    """The run with the greatest length / period, compared exactly; the first one of equals."""
    wins = lambda r, best: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(
        runs, F.lit(None).cast(RUN),
        lambda best, r: F.when(best.isNull() | wins(r, best), r).otherwise(best))
