"""Texts of Arrow batches as numpy arrays, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)

# A-Z to a-z, and the bytes of words: digits, letters and all bytes of non-ASCII characters.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True
BYTE_VALUE = np.random.default_rng(20_011).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def slices(batches, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds at most ``size`` bytes of text, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        total = np.concatenate(([0], np.cumsum(lengths.to_numpy(zero_copy_only=False))))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(total, total[first] + size, side="right")) - 1
            last = max(last, first + 1)
            yield batch.slice(first, last - first)
            first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and the offsets of the texts in them; null is empty."""
    texts = pc.fill_null(texts, pa.scalar("", texts.type))
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """Words of texts: lower-cased bytes, byte bounds, 64-bit hashes, words of each text."""

    def __init__(self, texts: pa.Array):
        data, self.text_at = text_bytes(texts)
        self.data = LOWER[data]
        inside = WORD_BYTE[self.data]
        size = len(data)
        edge = np.zeros(size + 1, dtype=bool)
        edge[self.text_at] = True
        begins = inside & edge[:-1]
        begins[1:] |= inside[1:] & ~inside[:-1]
        begins[:1] |= inside[:1]
        stops = inside & edge[1:]
        stops[:-1] |= inside[:-1] & ~inside[1:]
        stops[-1:] |= inside[-1:]
        self.start = np.flatnonzero(begins)
        self.stop = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, self.text_at)
        self.hash = self._hashes(inside)

    def _hashes(self, inside: np.ndarray) -> np.ndarray:
        lengths = self.stop - self.start
        if not len(lengths):
            return np.zeros(0, np.uint64)
        before = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
        powers = np.full(int(lengths.max()), WORD_BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        values = BYTE_VALUE[self.data[inside]] * powers[within]
        sums = np.add.reduceat(values, before)
        return mix(sums + lengths.astype(np.uint64) * GOLDEN)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.stop[i]].tobytes()

    def ends(self) -> np.ndarray:
        """For each word, the number of the word after the last one of its text."""
        return np.repeat(self.first[1:], np.diff(self.first))


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words that start at each word; shorter by ``width - 1``."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:count].copy()
    for j in range(1, width):
        total *= GOLDEN
        total += hashes[j : j + count]
    return mix(total + np.uint64(width))


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [
        columns[f.name] if isinstance(columns[f.name], pa.Array)
        else pa.array(columns[f.name], type=f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(
        [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema
    )
