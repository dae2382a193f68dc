"""Best-fit packing of tokenized documents into sequences of a fixed capacity."""

from __future__ import annotations

import os
import re
from array import array
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from vistaflow.llm.arrow_text import record_batch, slices
from vistaflow.llm.spread import measured_join
from vistaflow.session import staged

CAPACITY = 2048
END_ID = 0
CACHED_CHUNKS, CACHED_LENGTH = 800_000, 64


# Letters whose normal form and lower case stand alone, and ASCII signs that start no
# contraction: a chunk of these parts into runs of letters, single digits and runs of signs.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
PLAIN = re.compile(f"[!-&(-~{LETTERS}]+")
PART = re.compile(f"[{LETTERS}]+|[0-9]|[^0-9{LETTERS}]+")


class ChunkEncoder:
    """Token ids of texts, from the library's ids of their blank-separated chunks.

    White space parts tokens in this vocabulary and gives none itself, so a text's ids are
    those of its chunks in turn. A chunk of plain letters and signs goes part by part to the
    library's model, with each character as the library's own steps rewrite it; any other
    chunk, or one that may hold a special token, goes through the whole library. Ids of short
    chunks and parts are kept, up to a number of them.
    """

    def __init__(self, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model.decode())
        self.model = self.library.model
        before, step = self.library.normalizer, self.library.pre_tokenizer
        plain = [chr(c) for c in range(33, 256) if PLAIN.fullmatch(chr(c))]
        self.rewritten = {ord(c): step.pre_tokenize_str(before.normalize_str(c))[0][0] for c in plain}
        self.known: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}

    def _by_parts(self, chunk: str) -> bytes:
        out = []
        for part in PART.findall(chunk):
            ids = self.parts.get(part)
            if ids is None:
                found = self.model.tokenize(part.translate(self.rewritten))
                ids = array("I", [t.id for t in found]).tobytes()
                if len(part) <= CACHED_LENGTH:
                    self.parts[part] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        chunks = [text.replace("\n", " ").split(" ") for text in texts]
        new = set()
        for part in chunks:
            new.update(part)
        new = list(new.difference(self.known))
        hard = [c for c in new if "<|" in c or not PLAIN.fullmatch(c)]
        found = self.library.encode_batch_fast(hard, add_special_tokens=False)
        fresh = {c: array("I", e.ids).tobytes() for c, e in zip(hard, found)}
        self.known.update((c, fresh[c] if c in fresh else self._by_parts(c)) for c in new)
        ids = [np.frombuffer(b"".join([self.known[c] for c in part]), np.uint32) for part in chunks]
        for chunk in new:
            if len(chunk) > CACHED_LENGTH:
                del self.known[chunk]
        if len(self.known) + len(self.parts) > CACHED_CHUNKS:
            self.known, self.parts = {"": b""}, {}
        return ids


@lru_cache(maxsize=1)
def chunk_encoder(model: bytes) -> ChunkEncoder:
    """The encoder of a worker, which its tasks share."""
    return ChunkEncoder(model)


def token_pieces(docs: DataFrame, model: bytes, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, piece, start, length, ids) of each document's tokens and ``end_id`` after them.

    A document of more than ``capacity`` ids is cut into pieces of that many, the last one may
    be shorter. ``ids`` holds little-endian unsigned 32-bit integers. A null text is empty: one
    piece of the end id. Null and repeated ids stay rows of their own; an empty table gives no
    rows; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType), StructField("piece", IntegerType()),
        StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType()),
    ])
    out = to_arrow_schema(schema)

    def cut(batches):
        encoder = chunk_encoder(model)
        end = np.array([end_id], np.uint32)
        for batch in slices(batches, text_col):
            columns = {f.name: [] for f in out}
            rows = []
            texts = [text or "" for text in batch.column(text_col).to_pylist()]
            for row, ids in enumerate(encoder.encode(texts)):
                ids = np.concatenate((ids, end))
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    rows.append(row)
                    columns["piece"].append(start // capacity)
                    columns["start"].append(start)
                    columns["length"].append(len(part))
                    columns["ids"].append(part.tobytes())
            columns[id_col] = batch.column(id_col).take(pa.array(rows, pa.int64()))
            yield record_batch(columns, out)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


class Slots:
    """Where the items of each length go: runs of equal bins, by the items' rank in their length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins = 0
        self.runs: dict[int, list[tuple[int, int, int, int]]] = {}
        self._ranked: dict[int, int] = {}

    def add(self, pattern: tuple[tuple[int, int], ...], count: int):
        """``count`` bins that hold, in turn, so many items of each length of the pattern."""
        offset = 0
        for length, copies in pattern:
            rank = self._ranked.get(length, 0)
            self.runs.setdefault(length, []).append((rank, self.bins, copies, offset))
            self._ranked[length] = rank + copies * count
            offset += copies * length
        if offset > self.capacity:
            raise AssertionError("a bin overflows")
        self.bins += count

    def arrays(self) -> dict[int, np.ndarray]:
        return {length: np.array(runs, np.int64).T for length, runs in self.runs.items()}


def fit(counts: dict[int, int], capacity: int) -> Slots:
    """Bins for so many items of each length, found on the counts alone.

    Items over a third of the capacity fit at most twice into a bin: from the largest down,
    each takes the largest other one that fits. The rest, from the largest down, go to the
    bins with the smallest gap that takes them, and to new bins where none does. Bins of equal
    content are one class with a count, so the work depends on the number of lengths only.
    """
    left = {length: n for length, n in counts.items() if n}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("lengths must be from 1 to the capacity")
    classes: dict[int, list[tuple[tuple, int]]] = {}
    gaps: list[int] = []

    def keep(pattern: tuple, count: int, gap: int):
        if count:
            if gap not in classes:
                classes[gap] = []
                insort(gaps, gap)
            classes[gap].append((pattern, count))

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        a = large[-1]
        n = left[a]
        at = bisect_left(large, capacity - a + 1) - 1
        if at >= 0 and large[at] == a and n == 1:
            at -= 1
        if at < 0:
            keep(((a, 1),), n, capacity - a)
            left[a] = 0
        elif large[at] == a:
            keep(((a, 2),), n // 2, capacity - 2 * a)
            left[a] = n % 2
        else:
            b = large[at]
            pairs = min(n, left[b])
            keep(((a, 1), (b, 1)), pairs, capacity - a - b)
            left[a] -= pairs
            left[b] -= pairs
            if not left[b]:
                large.pop(at)
        if not left[a]:
            large.pop()

    for size in sorted((length for length in left if 3 * length <= capacity), reverse=True):
        n = left[size]
        while n:
            at = bisect_left(gaps, size)
            if at == len(gaps):
                most = capacity // size
                keep(((size, most),), n // most, capacity - most * size)
                keep(((size, n % most),), 1 if n % most else 0, capacity - n % most * size)
                break
            gap = gaps[at]
            pattern, bins = classes[gap].pop()
            if not classes[gap]:
                del classes[gap]
                gaps.pop(at)
            most = gap // size
            full = min(bins, n // most)
            keep((*pattern, (size, most)), full, gap - most * size)
            n, bins = n - full * most, bins - full
            if n and bins:
                keep((*pattern, (size, n)), 1, gap - n * size)
                n, bins = 0, bins - 1
            keep(pattern, bins, gap)

    slots = Slots(capacity)
    for gap in sorted(classes):
        for pattern, count in classes[gap]:
            slots.add(pattern, count)
    return slots


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` with sequence_id and offset: bins of at most ``capacity``, filled from 0 without gaps.

    ``items`` has a ``length`` from 1 to the capacity; any other length is an error. Each task
    numbers its items of each length; sums over tasks make that a rank. Only the number of
    items of each length, at most ``capacity`` numbers, comes to the driver, where ``fit``
    lays out the bins; ranks then tell tasks where their items go. A length that holds a third
    of all items is no group anywhere, only a number. Columns are kept, but for
    sequence_id and offset, which are replaced; an empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    items = items.drop("sequence_id", "offset")
    names = items.columns
    numbered = StructType([*items.schema.fields, StructField("_task", IntegerType()), StructField("_nth", LongType())])
    placed = StructType([*items.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    numbered_out, placed_out = to_arrow_schema(numbered), to_arrow_schema(placed)

    def number(batches):
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            if len(length) and not (length.min() > 0 and length.max() <= capacity):
                raise ValueError("lengths must be from 1 to the capacity")
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            first = np.searchsorted(ranked, ranked)
            nth = np.empty(len(length), np.int64)
            nth[order] = seen[ranked] + np.arange(len(length)) - first
            seen += np.bincount(length, minlength=capacity + 1)
            columns = {n: batch.column(n) for n in names}
            yield record_batch(columns | {"_task": np.full(len(length), task), "_nth": nth}, numbered_out)

    rows = staged(items.mapInArrow(number, numbered), "pieces")
    counts = staged(rows.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    slots = fit({r["length"]: r["n"] for r in totals}, capacity).arrays()
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    ranked = measured_join(rows, bases, ["_task", "length"], counts.count())
    ranked = ranked.select(*names, (F.col("_base") + F.col("_nth")).alias("_rank"))

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            bin_of, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for own in np.unique(length).tolist():
                at = np.flatnonzero(length == own)
                first, base, copies, begin = slots[own]
                run = np.searchsorted(first, rank[at], "right") - 1
                k = rank[at] - first[run]
                bin_of[at] = base[run] + k // copies[run]
                offset[at] = begin[run] + k % copies[run] * own
            columns = {n: batch.column(n) for n in names}
            yield record_batch(columns | {"sequence_id": bin_of, "offset": offset}, placed_out)

    return ranked.mapInArrow(place, placed)


def sequences(packed: DataFrame) -> DataFrame:
    """Rows (sequence_id, ids): the ids of each sequence's pieces in order, as in ``token_pieces``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def packed_documents(docs: DataFrame, model: bytes, capacity: int = CAPACITY, end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places of all documents' pieces, with a checksum in place of their ids."""
    pieces = token_pieces(docs, model, capacity, end_id, id_col, text_col)
    return pack(pieces.select(
        id_col, "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)
