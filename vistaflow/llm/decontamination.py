"""Benchmark passages in documents, found by winnowed fingerprints and extended hits."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

from vistaflow.llm.arrow_text import Words, grams, record_batch, slices
from vistaflow.session import staged

WINDOW = 10  # shared words that count as a passage
GRAM = 5
SPAN = WINDOW - GRAM + 1  # k-grams of a window; each has its smallest one picked
BROADCAST_BYTES = 64 << 20
PROBE_BITS = 20


def fingerprints(words: Words, window: int = WINDOW, gram: int = GRAM):
    """Picked k-grams: word numbers and hashes.

    In every run of ``window`` words of one text the smallest of its k-gram hashes is picked
    (all of them at a tie), so two texts that share such a run share a picked hash.
    """
    ends = words.ends()
    hashes = grams(words.hash, gram)
    count = len(words.hash) - window + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    span = window - gram + 1
    smallest = hashes[:count].copy()
    for j in range(1, span):
        np.minimum(smallest, hashes[j : j + count], out=smallest)
    whole = np.arange(count) + window <= ends[:count]
    picked = np.zeros(len(hashes), bool)
    for j in range(span):
        picked[j : j + count] |= whole & (hashes[j : j + count] == smallest)
    at = np.flatnonzero(picked)
    return at, hashes[at]


def short_grams(words: Words, width: int):
    """All runs of ``width`` words inside one text: word numbers and hashes."""
    hashes = grams(words.hash, width) ^ np.uint64(width)
    at = np.flatnonzero(np.arange(len(hashes)) + width <= words.ends()[: len(hashes)])
    return at, hashes[at]


def item_fingerprints(words: Words, window: int = WINDOW):
    """Of each text: word numbers, hashes and widths (0: winnowed; else a short item's length)."""
    at, hashes = fingerprints(words, window)
    found = [(at, hashes, np.zeros(len(at), np.int64))]
    lengths = np.diff(words.first)
    for width in range(1, window):
        own = words.first[:-1][lengths == width]
        if len(own):
            every = grams(words.hash, width) ^ np.uint64(width)
            found.append((own, every[own], np.full(len(own), width)))
    return tuple(np.concatenate(part) for part in zip(*found))


class Probe:
    """Fingerprints of benchmark items, looked up for slices of documents."""

    def __init__(self, ids: list, texts: pa.Array):
        self.words = Words(texts)
        self.ids = ids
        at, hashes, widths = item_fingerprints(self.words)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.at = hashes[order], at[order]
        self.widths = sorted(set(widths.tolist()) - {0})
        self.item = np.repeat(np.arange(len(ids)), np.diff(self.words.first))
        self.bits = np.zeros(1 << PROBE_BITS, bool)
        self.bits[self.hashes >> np.uint64(64 - PROBE_BITS)] = True

    def seeds(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of document word and item word where equal fingerprints begin."""
        found = [fingerprints(words)] + [short_grams(words, width) for width in self.widths]
        at = np.concatenate([a for a, _ in found])
        hashes = np.concatenate([h for _, h in found])
        maybe = self.bits[hashes >> np.uint64(64 - PROBE_BITS)]
        at, hashes = at[maybe], hashes[maybe]
        low = np.searchsorted(self.hashes, hashes, "left")
        counts = np.searchsorted(self.hashes, hashes, "right") - low
        total = int(counts.sum())
        within = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(at, counts), self.at[np.repeat(low, counts) + within]

    def hits(self, words: Words) -> list[tuple[int, int, int]]:
        """Longest shared runs: first and end word of the documents, and the item.

        A seed is extended in both directions while words are equal, and kept if it is as
        long as a window (or as the whole item, if that is shorter). Hashes lead, the words
        themselves decide.
        """
        at, item_at = self.seeds(words)
        if not len(at):
            return []
        order = np.lexsort((at, at - item_at))
        owner = np.searchsorted(words.first, at, "right") - 1
        mine, theirs, done = words.hash, self.words.hash, {}
        found = []
        for k in order.tolist():
            p, q = int(at[k]), int(item_at[k])
            item = int(self.item[q])
            text = int(owner[k])
            line = (text, item, p - q)
            if done.get(line, -1) > p:
                continue
            low_p, high_p = int(words.first[text]), int(words.first[text + 1])
            low_q, high_q = int(self.words.first[item]), int(self.words.first[item + 1])
            back = ahead = 0
            while p - back > low_p and q - back > low_q and mine[p - back - 1] == theirs[q - back - 1]:
                back += 1
            while p + ahead < high_p and q + ahead < high_q and mine[p + ahead] == theirs[q + ahead]:
                ahead += 1
            done[line] = p + max(ahead, 1)
            if back + ahead < min(WINDOW, high_q - low_q):
                continue
            if all(words.word(p + i) == self.words.word(q + i) for i in range(-back, ahead)):
                found.append((p - back, p + ahead, item))
        return found


def _digest(names: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode("utf-8")).hexdigest()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is WINDOW consecutive words of an item, or the whole item if it is shorter; a
    document word inside an occurrence of a window is hit. Winnowing guarantees that every
    shared window is found. ``benchmark`` is measured first: up to ``broadcast_bytes`` of
    text it goes to every task, beyond that fingerprints of both sides are joined by a
    shuffle and candidate pairs are extended pair by pair (``contamination_by_join``).

    Null and empty texts have no words. Items without words match nothing. An item with a
    null id marks words as hit, but is not counted or named. Repeated items count once, by
    their id; repeated documents give repeated results; an empty table gives none, and an
    empty benchmark hits nothing. Other columns are not read.
    """
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item_id"), F.col(item_text).alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    if (size[0] or 0) + 64 * size[1] > broadcast_bytes:
        return contamination_by_join(docs, benchmark, id_col, text_col, item_col, item_text)
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = items.collect()  # bounded by broadcast_bytes
    shared = docs.sparkSession.sparkContext.broadcast(
        ([r["item_id"] for r in rows], [r["text"] for r in rows])
    )
    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType), StructField("n_words", LongType()),
        StructField("n_hit", LongType()), StructField("n_items", LongType()),
        StructField("items_sha256", StringType()), StructField("contaminated", BooleanType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches):
        names, texts = shared.value
        probe = Probe(names, pa.array(texts, pa.string()))
        nothing = _digest(set())
        for batch in slices(batches, text_col):
            words = Words(batch.column(text_col))
            hit = np.zeros(len(words.hash) + 1, np.int64)
            named: dict[int, set[str]] = defaultdict(set)
            for low, high, item in probe.hits(words):
                hit[low:high] = 1
                if names[item] is not None:
                    named[int(np.searchsorted(words.first, low, "right")) - 1].add(names[item])
            before = np.concatenate(([0], np.cumsum(hit)))[words.first]
            hits = np.diff(before)
            count = batch.num_rows
            yield record_batch({
                id_col: batch.column(id_col),
                "n_words": np.diff(words.first),
                "n_hit": hits,
                "n_items": [len(named.get(i, ())) for i in range(count)],
                "items_sha256": [_digest(named[i]) if i in named else nothing for i in range(count)],
                "contaminated": hits > 0,
            }, out)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def contamination_by_join(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                          text_col: str = "text", item_col: str = "item_id",
                          item_text: str = "text") -> DataFrame:
    """``contamination`` for a benchmark of any size: nothing of either side is broadcast.

    Fingerprints of both sides are joined on their hash; a hash held by very many documents
    is split by adaptive execution. The distinct candidate pairs get both texts and are
    extended one pair at a time. Hit ranges, not words, go to the last grouping.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    key = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    # Equal texts have equal results, so they are looked at once.
    distinct = staged(texts.select(key.alias("doc"), "text").dropDuplicates(["doc"]), "texts")
    items = staged(
        benchmark.select(F.col(item_col).cast("string").alias("item_id"),
                         F.col(item_text).alias("text")).distinct()
        .withColumn("item", F.sha2(F.concat_ws("\u0000", F.coalesce("item_id", F.lit("\u0001")),
                                               F.coalesce("text", F.lit(""))), 256)), "items")
    print_schema = StructType([StructField("key", StringType()), StructField("print", LongType()),
                               StructField("width", LongType())])
    out = to_arrow_schema(print_schema)

    def prints(widths):
        def run(batches):
            for batch in slices(batches):
                words = Words(batch.column("text"))
                if widths is None:
                    at, hashes, width = item_fingerprints(words)
                else:
                    at, hashes = fingerprints(words)
                    width = np.zeros(len(at), np.int64)
                    for one in widths:
                        a, h = short_grams(words, one)
                        at, hashes = np.concatenate((at, a)), np.concatenate((hashes, h))
                        width = np.concatenate((width, np.full(len(a), one)))
                owner = np.searchsorted(words.first, at, "right") - 1
                yield record_batch({"key": batch.column("key").take(pa.array(owner)),
                                    "print": hashes.view(np.int64), "width": width}, out)
        return run

    of_items = staged(items.select(F.col("item").alias("key"), "text")
                      .mapInArrow(prints(None), print_schema).distinct(), "item-prints")
    widths = sorted(r[0] for r in of_items.select("width").filter("width > 0").distinct().collect())
    of_docs = distinct.select(F.col("doc").alias("key"), "text").mapInArrow(prints(widths), print_schema)
    pairs = (
        of_docs.distinct().withColumnRenamed("key", "doc")
        .join(of_items.withColumnRenamed("key", "item"), ["print", "width"])
        .select("doc", "item").distinct()
        .join(distinct.withColumnRenamed("text", "doc_text"), "doc")
        .join(items.withColumnRenamed("text", "item_text"), "item")
        .select("doc", "item_id", "doc_text", "item_text")
    )
    range_schema = StructType([StructField("doc", StringType()), StructField("item_id", StringType()),
                               StructField("ranges", ArrayType(ArrayType(IntegerType())))])
    range_out = to_arrow_schema(range_schema)

    def extend(batches):
        for batch in slices(batches, "doc_text"):
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                probe = Probe([None], row.column("item_text"))
                hits = [[a, b] for a, b, _ in probe.hits(Words(row.column("doc_text")))]
                if hits:
                    yield record_batch({"doc": row.column("doc"), "item_id": row.column("item_id"),
                                        "ranges": [hits]}, range_out)

    found = staged(pairs.mapInArrow(extend, range_schema), "ranges")
    named = found.groupBy("doc").agg(F.sort_array(F.collect_set("item_id")).alias("names"))
    hit = (
        found.select("doc", F.explode("ranges").alias("r"))
        .select("doc", F.explode(F.sequence(F.col("r")[0], F.col("r")[1] - 1)).alias("word"))
        .distinct().groupBy("doc").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    count_schema = StructType([StructField("doc", StringType()), StructField("n_words", LongType())])
    count_out = to_arrow_schema(count_schema)

    def count(batches):
        for batch in slices(batches):
            yield record_batch({"doc": batch.column("doc"),
                                "n_words": np.diff(Words(batch.column("text")).first)}, count_out)

    counts = distinct.select("doc", "text").mapInArrow(count, count_schema)
    names = F.coalesce(F.concat_ws(",", "names"), F.lit(""))
    results = counts.join(hit, "doc", "left").join(named, "doc", "left").select(
        "doc", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"))
    return (
        texts.select("_id", key.alias("doc")).join(results, "doc")
        .select(F.col("_id").alias(id_col), "n_words", "n_hit",
                F.greatest("n_items", F.lit(0)).alias("n_items"), "items_sha256",
                (F.col("n_hit") > 0).alias("contaminated"))
    )
