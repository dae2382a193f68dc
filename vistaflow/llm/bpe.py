"""Byte-level BPE: boundaries by a scan of transition functions, cached pair merging."""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType,
)

from vistaflow.llm.arrow_text import record_batch, slices, text_bytes

# Symbols of the boundary scanner: what a character is, with what follows it where that matters.
LETTER, NUMBER, OTHER, JOINING_SPACE, LONE_SPACE, INNER_SPACE, SHORT_FORM, LONG_FORM = range(8)
# States: after a finished piece, in a run of letters, numbers, other characters, after a space
# that joins what follows, in a run of white space, with one or two letters of a contraction due.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOINED, IN_SPACE, ONE_LEFT, TWO_LEFT = range(8)
CACHE_PIECES = 200_000
MERGE_ROWS = 4_096
ENCODE_BYTES = 1 << 20  # of texts encoded at a time
LONG_PIECE = 64
BLOCK = 256


# Ranges of letters and numbers added to Unicode after version 16, which the
# tokenizer's pattern does not know and takes as other characters.
AFTER_UNICODE_16 = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC),
    (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)


@cache
def classes() -> np.ndarray:
    """0 letter, 1 number, 2 other, 3 white space for every code point.

    The table comes from a pattern library once, as its Unicode version is the newer one;
    texts are never matched against a pattern.
    """
    everything = "".join(map(chr, range(sys.maxunicode + 1)))
    found = np.full(len(everything), 2, np.uint8)
    for number, pattern in ((0, r"\p{L}+"), (1, r"\p{N}+"), (3, r"\p{White_Space}+")):
        for run in regex.finditer(pattern, everything):
            found[run.start() : run.end()] = number
    for low, high in AFTER_UNICODE_16:
        found[low : high + 1] = 2
    return found


@cache
def transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, for (symbol, state).

    Symbols from 8 on are the same characters at the start of a text: they act as in FRESH.
    """
    after = np.zeros((16, 8), np.uint8)
    begins = np.ones((16, 8), bool)
    plain = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, JOINING_SPACE: JOINED,
             LONE_SPACE: FRESH, INNER_SPACE: IN_SPACE, SHORT_FORM: ONE_LEFT, LONG_FORM: TWO_LEFT}
    for symbol, state in plain.items():
        after[symbol] = after[symbol + 8] = state
    for symbol, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        begins[symbol, [run, JOINED]] = False
    begins[INNER_SPACE, IN_SPACE] = False
    for symbol in (SHORT_FORM, LONG_FORM):  # not first in its run: an ordinary character
        begins[symbol, [IN_OTHERS, JOINED]] = False
        after[symbol, [IN_OTHERS, JOINED]] = IN_OTHERS
    begins[LETTER, [ONE_LEFT, TWO_LEFT]] = False
    after[LETTER, ONE_LEFT] = FRESH
    after[LETTER, TWO_LEFT] = ONE_LEFT
    return after, begins


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Scanner symbols of code points; ``first`` marks the first character of each text."""
    size = len(points)
    kind = classes()[points]
    last = np.ones(size, bool)
    last[:-1] = first[1:]
    following = np.full(size, 3, np.uint8)
    following[:-1] = kind[1:]
    following[last] = 3
    out = kind.copy()
    space = kind == 3
    out[space] = INNER_SPACE
    ends_run = space & (following != 3)
    out[ends_run] = LONE_SPACE
    out[ends_run & (points == 32)] = JOINING_SPACE
    for i in np.flatnonzero((points == 39) & ~last):
        one = points[i + 1]
        if one in (100, 109, 115, 116):  # 'd 'm 's 't
            out[i] = SHORT_FORM
        elif i + 2 < size and not last[i + 1]:
            pair = (one, points[i + 2])
            if pair in ((114, 101), (118, 101), (108, 108)):  # 're 've 'll
                out[i] = LONG_FORM
    out[first] += 8
    return out


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which characters begin a piece, by an associative scan of transition functions.

    Each character is a function from state to state. Blocks of characters are composed
    side by side, the composed functions give every block's entry state, and a second pass
    from those states marks the beginnings.
    """
    size = len(points)
    if not size:
        return np.zeros(0, bool)
    after, begins = transitions()
    blocks = -(-size // BLOCK)
    signs = np.full(blocks * BLOCK, LETTER + 8, np.uint8)
    signs[:size] = symbols(points, first)
    signs = np.ascontiguousarray(signs.reshape(blocks, BLOCK).T)
    flat = after.ravel()
    composed = np.broadcast_to(np.arange(8, dtype=np.uint8), (blocks, 8)).copy()
    for column in signs:
        composed = flat[(column[:, None].astype(np.intp) << 3) + composed]
    step = 1
    while step < blocks:  # prefix composition of the blocks' functions
        composed[step:] = np.take_along_axis(composed[step:], composed[:-step].astype(np.intp), 1)
        step *= 2
    state = np.zeros(blocks, np.uint8)
    state[1:] = composed[:-1, FRESH]
    marks = np.empty((BLOCK, blocks), bool)
    opens = begins.ravel()
    for i, column in enumerate(signs):
        at = (column.astype(np.intp) << 3) + state
        marks[i] = opens[at]
        state = flat[at]
    return marks.T.ravel()[:size]


def read_ranks(data: bytes) -> list[bytes]:
    """Tokens in order of rank from the text of a rank file."""
    rows = [line.split() for line in data.splitlines() if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in rows)
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [token for _, token in ranked]


class Merger:
    """Ids of pieces by repeated merging of the pair of lowest rank, leftmost first.

    All new pieces of a slice are merged side by side, one merge for each piece and round;
    results are kept for later slices, up to CACHE_PIECES of them.
    """

    NONE = np.int32(2**31 - 1)

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        rank = {token: i for i, token in enumerate(tokens)}
        self.byte_id = np.array([rank[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for i, token in enumerate(tokens):
            for cut in range(1, len(token)):
                left, right = rank.get(token[:cut]), rank.get(token[cut:])
                if left is not None and right is not None:
                    pairs[(left << 20) | right] = i
        self.pairs = pairs
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, np.int64(2**62))
        self.merged = np.append(
            np.array([pairs[k] for k in keys.tolist()], np.int32), self.NONE
        )
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.body = np.frombuffer(b"".join(tokens), np.uint8)
        self.at = np.cumsum(self.length) - self.length
        self._reset()

    def _reset(self):
        self.slot: dict[bytes, int] = {}
        self.store = np.zeros(1 << 20, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 16, np.int64)
        self.counts = np.zeros(1 << 16, np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left.astype(np.int64) << 20) | right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.merged[at], self.NONE)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces in any order, and where each piece's ids begin and how many it has.

        Pieces of similar length are merged together, MERGE_ROWS at a time, which bounds the
        tables of a round.
        """
        counts, starts = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order, found, used = np.argsort(lengths, kind="stable"), [], 0
        short = order[: np.searchsorted(lengths[order], LONG_PIECE, "right")]
        for first in range(0, len(short), MERGE_ROWS):
            part = short[first : first + MERGE_ROWS]
            ids, sizes = self._merge_short(b"".join(pieces[i] for i in part), lengths[part])
            starts[part], counts[part] = used + np.cumsum(sizes) - sizes, sizes
            found.append(ids)
            used += len(ids)
        for i in order[len(short) :]:
            ids = np.array(self.merge_long(pieces[i]), np.int32)
            starts[i], counts[i] = used, len(ids)
            found.append(ids)
            used += len(ids)
        return np.concatenate(found) if found else np.zeros(0, np.int32), starts, counts

    def _merge_short(self, joined: bytes, lengths: np.ndarray):
        """Rows of ids, one for each piece, with one merge in each live row and round."""
        width = int(lengths.max())
        rows = np.full((len(lengths), width + 1), -1, np.int32)
        rows[np.arange(width + 1) < lengths[:, None]] = self.byte_id[np.frombuffer(joined, np.uint8)]
        ranks = np.full((len(lengths), width), self.NONE, np.int32)
        ready = rows[:, 1:] >= 0
        ranks[ready] = self._rank(rows[:, :-1][ready], rows[:, 1:][ready])
        live = np.arange(len(lengths))
        sizes = lengths.copy()
        while len(live):
            part = ranks[live]
            at = part.argmin(axis=1)
            best = part[np.arange(len(live)), at]
            going = best < self.NONE
            live, at, best = live[going], at[going], best[going]
            if not len(live):
                break
            shift = np.arange(width + 1)[None, :]
            take = shift + (shift > at[:, None])
            np.minimum(take, width, out=take)
            own = np.take_along_axis(rows[live], take, 1)
            own[:, -1] = -1
            index = np.arange(len(live))
            own[index, at] = best
            new = np.take_along_axis(ranks[live], take[:, :-1].clip(max=width - 1), 1)
            new[:, -1] = self.NONE
            new[index, at] = self._next_rank(own[index, at], own[index, at + 1])
            back = at > 0
            new[index[back], at[back] - 1] = self._next_rank(
                own[index[back], at[back] - 1], own[index[back], at[back]])
            rows[live], ranks[live] = own, new
            sizes[live] -= 1
        return rows[rows >= 0], sizes

    def _next_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(right >= 0, self._rank(left, np.maximum(right, 0)), self.NONE)

    def merge_long(self, piece: bytes) -> list[int]:
        """One long piece, with a heap of pairs: time in proportion to n log n."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        size = len(ids)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        get = self.pairs.get
        heap = []
        for i in range(size - 1):
            rank = get((ids[i] << 20) | ids[i + 1])
            if rank is not None:
                heap.append((rank, i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else size
            if ids[i] != left or j >= size or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
                new = get((rank << 20) | ids[after[i]])
                if new is not None:
                    heapq.heappush(heap, (new, i, rank, ids[after[i]]))
            if before[i] >= 0:
                k = before[i]
                new = get((ids[k] << 20) | rank)
                if new is not None:
                    heapq.heappush(heap, (new, k, ids[k], rank))
        return [i for i in ids if i >= 0]

    def lookup(self, pieces: list[bytes]) -> np.ndarray:
        """Slots of pieces in the store, merging those that are not there yet."""
        if len(self.slot) + len(pieces) > CACHE_PIECES:
            self._reset()
        slot = self.slot
        missing = [p for p in pieces if p not in slot]
        if missing:
            ids, starts, counts = self.merge(missing)
            while self.used + len(ids) > len(self.store):
                self.store = np.concatenate((self.store, np.zeros_like(self.store)))
            known = len(slot)
            while known + len(missing) > len(self.starts):
                self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
                self.counts = np.concatenate((self.counts, np.zeros_like(self.counts)))
            self.store[self.used : self.used + len(ids)] = ids
            self.starts[known : known + len(missing)] = self.used + starts
            self.counts[known : known + len(missing)] = counts
            self.used += len(ids)
            slot.update(zip(missing, range(known, known + len(missing))))
        return np.fromiter(map(slot.__getitem__, pieces), np.int64, len(pieces))

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ids, and the offset of each id's bytes."""
        return ranges(self.body, self.at[ids], self.length[ids])


def ranges(values: np.ndarray, starts: np.ndarray, counts: np.ndarray):
    """``values`` of many ranges, one after the other, and where each range begins."""
    begins = np.cumsum(counts) - counts
    at = np.arange(int(counts.sum()), dtype=np.int64)
    at += np.repeat(starts - begins, counts)
    return values[at], begins


class Encoder:
    """Encodes slices of texts."""

    def __init__(self, tokens: list[bytes]):
        self.merger = Merger(tokens)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the offset of each text's ids."""
        data, text_at = text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        char_at = np.flatnonzero((data & 0xC0) != 0x80)
        first = np.zeros(len(data) + 1, bool)
        first[text_at[:-1]] = True
        starts = char_at[piece_starts(points, first[char_at])]
        bounds = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        ).dictionary_encode()
        slots = self.merger.lookup(pieces.dictionary.to_pylist())[pieces.indices.to_numpy()]
        counts = self.merger.counts[slots]
        ids, _ = ranges(self.merger.store, self.merger.starts[slots], counts)
        total = np.concatenate(([0], np.cumsum(counts)))
        return ids, total[np.searchsorted(starts, text_at)]


def _schema(docs: DataFrame, id_col: str, with_ids: bool) -> StructType:
    fields = [
        StructField(id_col, docs.schema[id_col].dataType), StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
    ]
    if with_ids:
        fields += [
            StructField("ids", ArrayType(IntegerType())), StructField("offsets", ArrayType(IntegerType())),
            StructField("decoded", BinaryType()),
        ]
    return StructType(fields)


def encode_decode(docs: DataFrame, rank_file: bytes, id_col: str = "doc_id",
                  text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every text by a rank file, decode the ids again, one row per row of ``docs``.

    Returns the id, n_tokens, ids_sha256 (ids as little-endian 32-bit integers) and
    decoded_sha256; with ``with_ids`` also ids, offsets (first byte of each token) and decoded.
    ``rank_file`` is the content of a rank file, so executors need no path; its size is fixed.

    A null or empty text has no ids. Texts are taken whole; a slice holds a few megabytes of
    texts or one text. Repeated rows give repeated results, an empty table none; other
    columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _schema(docs, id_col, with_ids)
    out = to_arrow_schema(schema)

    def run(batches):
        encoder = Encoder(read_ranks(rank_file))
        for batch in slices(batches, text_col, ENCODE_BYTES):
            ids, at = encoder.encode(batch.column(text_col))
            body, token_at = encoder.merger.decode(ids)
            byte_at = np.append(token_at, len(body))[at]
            packed, plain = memoryview(ids.astype("<u4").tobytes()), memoryview(body.tobytes())
            bounds, byte_bounds = at.tolist(), byte_at.tolist()
            columns = {
                id_col: batch.column(id_col),
                "n_tokens": np.diff(at),
                "ids_sha256": [hashlib.sha256(packed[4 * a : 4 * b]).hexdigest()
                               for a, b in zip(bounds, bounds[1:])],
                "decoded_sha256": [hashlib.sha256(plain[a:b]).hexdigest()
                                   for a, b in zip(byte_bounds, byte_bounds[1:])],
            }
            if with_ids:
                owner = np.repeat(byte_at[:-1], np.diff(at))
                columns |= {
                    "ids": pa.ListArray.from_arrays(at.astype(np.int32), ids),
                    "offsets": pa.ListArray.from_arrays(
                        at.astype(np.int32), (token_at - owner).astype(np.int32)),
                    "decoded": [plain[a:b].tobytes() for a, b in zip(byte_bounds, byte_bounds[1:])],
                }
            yield record_batch(columns, out)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
