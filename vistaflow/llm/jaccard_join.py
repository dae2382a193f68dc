"""Documents with similar word shingles, by MinHash with Bayesian pruning and exact checks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from vistaflow.llm.arrow_text import Words, grams, record_batch, slices
from vistaflow.llm.components import components
from vistaflow.llm.spread import measured_join, salted_left_join
from vistaflow.session import staged

SHINGLE = 5
THRESHOLD = 0.8
HASHES, STEP = 128, 16  # MinHash values, and how many are compared at a time
BAND = 4  # values of a band: a pair at the threshold misses all bands with p = 5e-8
TOLERANCE = 1e-9  # chance to reach the threshold below which a pair is dropped
BUCKET_BLOCK, CLUSTER_BLOCK = 512, 256
COUNT_ROWS, COUNT_SHINGLES = 1024, 1_000_000  # most rows, and shingles on average, of a block in the count of links
CELLS = 4_000_000

_random = np.random.default_rng(4_242)
FLIP = _random.integers(0, 2**63, HASHES, np.uint64)
FACTOR = _random.integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> list[np.ndarray]:
    """Ascending distinct 64-bit hashes of each text's shingles.

    Words are runs of digits, letters and non-ASCII characters, with A-Z lower-cased. A text
    of fewer than ``width`` words, but not none, is one shingle.
    """
    words = Words(texts)
    every = grams(words.hash, width)
    sets = []
    for low, high in zip(words.first.tolist(), words.first[1:].tolist()):
        if high - low >= width:
            sets.append(np.unique(every[low : high - width + 1]))
        elif high > low:
            sets.append(grams(words.hash[low:high], high - low))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES 32-bit MinHash values of each set; zeros for an empty one."""
    out = np.zeros((len(sets), HASHES), np.uint32)
    some = [i for i, s in enumerate(sets) if len(s)]
    if some:
        joined = np.concatenate([sets[i] for i in some])
        lengths = np.array([len(sets[i]) for i in some])
        starts = np.cumsum(lengths) - lengths
        for k in range(HASHES):
            mixed = (joined ^ FLIP[k]) * FACTOR[k]
            out[some, k] = np.minimum.reduceat(mixed, starts) >> np.uint64(32)
    return out


def needed_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """Fewest equal values after STEP, 2 STEP, ... comparisons with which a pair goes on.

    With a uniform prior the similarity after m matches in n is Beta(m + 1, n - m + 1), so the
    chance to reach the threshold is that of at most m successes in n + 1 draws.
    """
    needed = []
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        needed.append(m)
    return needed


def prune(values: np.ndarray, i: np.ndarray, j: np.ndarray, needed: list[int]) -> tuple:
    """The pairs that no step of the comparison drops."""
    matches = np.zeros(len(i), np.int64)
    for step, least in enumerate(needed):
        part = slice(step * STEP, (step + 1) * STEP)
        matches += (values[i, part] == values[j, part]).sum(axis=1)
        going = matches >= least
        i, j, matches = i[going], j[going], matches[going]
        if not len(i):
            break
    return i, j


class Forest:
    """Which rows are connected; the root of a row is the first row it is connected to."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def add(self, i: np.ndarray, j: np.ndarray):
        root = self.root
        for a, b in zip(i.tolist(), j.tolist()):
            x, y = a, b
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
        while not np.array_equal(root[root], root):
            root = root[root]
        self.root = root

    def links(self) -> list[tuple[int, int]]:
        """Every row that is not a root with its root: stars, which components settle sooner than chains."""
        rows = np.flatnonzero(self.root != np.arange(len(self.root)))
        return list(zip(rows.tolist(), self.root[rows].tolist()))


def group_runs(batches, keys: list[str]):
    """Tables of whole groups from batches that are ordered by ``keys``."""
    carried = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if carried is None else pa.concat_tables([carried, table])
        last = group_numbers(table, keys)
        cut = int(np.searchsorted(last, last[-1])) if len(last) else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        carried = table.slice(cut)
    if carried is not None and carried.num_rows:
        yield carried.combine_chunks()


def group_numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Ascending number of each row's group."""
    change = np.zeros(table.num_rows, bool)
    for key in keys:
        values = table.column(key).to_numpy(zero_copy_only=False)
        change[1:] |= values[1:] != values[:-1]
    return np.cumsum(change)


def signature_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def group_starts(group: np.ndarray) -> np.ndarray:
    """The first row of each group, and the end."""
    return np.flatnonzero(np.diff(group, prepend=-1, append=group[-1] + 1))


def candidate_forest(values: np.ndarray, group: np.ndarray, needed: list[int]) -> Forest:
    """What unpruned pairs of one group connect.

    Rows are compared with the first one of their group, then with the row 1, 2, ... places
    on, as long as that is in the same group; pairs that are connected already are not
    compared.
    """
    forest = Forest(len(group))
    starts = group_starts(group)
    first = np.repeat(starts[:-1], np.diff(starts))
    rest = np.flatnonzero(first != np.arange(len(group)))
    forest.add(*prune(values, first[rest], rest, needed))
    gap = 1
    while gap < len(group):
        i = np.flatnonzero(group[:-gap] == group[gap:])
        if not len(i):
            break
        j = i + gap
        open_ = forest.root[i] != forest.root[j]
        if open_.any():
            forest.add(*prune(values, i[open_], j[open_], needed))
        gap += 1
    return forest


def shared_counts(sets: list[np.ndarray], split: int | None = None) -> np.ndarray:
    """Sizes of all intersections, by products of blocks of the membership matrix.

    With ``split`` only those of the sets before it with the others. Shingles of only one set
    are left out: no intersection holds them.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    distinct, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(counts > 1) - 1
    common = counts[codes] > 1
    owner, codes = owner[common], place[codes[common]]
    size = int((counts > 1).sum())
    order = np.argsort(codes, kind="stable")
    owner, codes = owner[order], codes[order]
    left, right = (slice(None), slice(None)) if split is None else (slice(split), slice(split, None))
    every = range(len(sets))
    total = np.zeros((len(every[left]), len(every[right])), np.float64)
    width = max(64, CELLS // len(sets))
    for low in range(0, size, width):
        a, b = np.searchsorted(codes, [low, low + width])
        block = np.zeros((len(sets), min(width, size - low)), np.float32)
        block[owner[a:b], codes[a:b] - low] = 1
        total += block[left] @ block[right].T
    return total.astype(np.int64)


def similar_pairs(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: Fraction) -> tuple:
    """The pairs of sets at or over the threshold, by exact sizes of their intersections."""
    if not len(i):
        return i, j
    sizes = np.array([len(s) for s in sets])
    if (i == i[0]).all():
        joined = np.concatenate([sets[k] for k in j.tolist()])
        own = sets[i[0]]
        at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
        both = np.add.reduceat((own[at] == joined).astype(np.int64), np.cumsum(sizes[j]) - sizes[j])
    else:
        used = np.unique(np.concatenate((i, j)))
        shared = shared_counts([sets[k] for k in used])
        both = shared[np.searchsorted(used, i), np.searchsorted(used, j)]
    true = both * threshold.denominator >= (sizes[i] + sizes[j] - both) * threshold.numerator
    return i[true], j[true]


def unite(forest: Forest, i: np.ndarray, j: np.ndarray):
    """Add links, one of each row at a time, until all of them join connected rows."""
    while len(i):
        _, first = np.unique(i, return_index=True)
        forest.add(i[first], j[first])
        left = forest.root[i] != forest.root[j]
        i, j = i[left], j[left]


def verified_forest(sets: list[np.ndarray], values: np.ndarray, group: np.ndarray, needed: list[int],
                    threshold: Fraction) -> Forest:
    """What exactly verified pairs of one group connect; rows meet the first of their group first."""
    forest = Forest(len(group))
    starts = group_starts(group).tolist()
    for low, high in zip(starts, starts[1:]):
        rest = np.arange(low + 1, high)
        unite(forest, *similar_pairs(sets, *prune(values, np.full(len(rest), low), rest, needed), threshold)[::-1])
        i, j = np.triu_indices(high - low, 1)
        i, j = i + low, j + low
        apart = forest.root[i] != forest.root[j]
        unite(forest, *similar_pairs(sets, *prune(values, i[apart], j[apart], needed), threshold))
    return forest


def in_chunks(rows: DataFrame, size: int) -> DataFrame:
    """Rows of groups dealt to chunks of about ``size``; a group's pivot goes to all of its chunks.

    ``rows`` has ``node``, ``members`` (rows of the group) and ``pivot``. Adds ``chunks``,
    ``own`` (the row's chunk) and ``chunk``.
    """
    rows = rows.withColumn("chunks", F.ceil(F.col("members") / F.lit(size)).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(17)), F.col("chunks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    return rows.withColumn("chunk", F.explode(F.when(F.col("pivot"), every).otherwise(F.array("own"))))


def connect(rows: Callable[[DataFrame | None], DataFrame], key: str, size: int, payload: list[str],
            forest_of: Callable, judge: Callable, label: str) -> DataFrame:
    """Links (a, b) of nodes that connect all that the links between rows of one group connect.

    ``rows(keys)`` gives the rows of all groups, or of those in ``keys``: ``key``, ``node``,
    ``members``, ``pivot`` (true for one row) and the ``payload`` that pairs are judged by.
    Each row meets its group's pivot and the rows of its chunk (``forest_of(table, group)``).
    What gets connected to the pivot is settled: it has one link. Of groups of several chunks, the
    rows left open meet the other chunks too (``judge(table)`` gives what tells linked pairs), and
    only these. So the
    copies of one text cost one comparison and one link each, however many there are.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    every = rows(None)
    found = StructType([*LINK.fields, StructField("key", every.schema[key].dataType)])
    found_out, link_out = to_arrow_schema(found), to_arrow_schema(LINK)

    def near(batches):
        for table in group_runs(batches, [key, "chunk"]):
            group = group_numbers(table, [key, "chunk"])
            starts = group_starts(group)
            root = forest_of(table, group).root
            first = np.repeat(starts[:-1], np.diff(starts))
            hung = np.flatnonzero(root != np.arange(len(root)))
            several = table.column("chunks").to_numpy() > 1
            open_ = np.flatnonzero(several & (root != root[first]))
            node, keys = table.column("node").combine_chunks(), table.column(key).combine_chunks()
            a = pa.concat_arrays([node.take(pa.array(hung)), node.take(pa.array(open_))])
            b = pa.concat_arrays([node.take(pa.array(root[hung])), pa.nulls(len(open_), node.type)])
            own = pa.concat_arrays([pa.nulls(len(hung), keys.type), keys.take(pa.array(open_))])
            yield record_batch({"a": a, "b": b, "key": own}, found_out)

    dealt = in_chunks(every, size).repartition(key, "chunk")
    dealt = dealt.sortWithinPartitions(key, "chunk", F.desc("pivot"), "node")
    first = staged(dealt.select(key, "chunk", "chunks", "node", *payload).mapInArrow(near, found), label)
    links, opened = first.filter("b IS NOT NULL").select("a", "b"), first.filter("b IS NULL")
    if opened.isEmpty():
        return links
    opened = opened.select(F.col("key").alias(key), F.col("a").alias("node"), F.lit(True).alias("open"))
    hot = staged(opened.groupBy(key).agg(F.count(F.lit(1)).alias("opened")), label)
    again = in_chunks(rows(hot.select(key)), size).filter("chunk = own").join(hot, key)
    again = again.join(opened, [key, "node"], "left").withColumn("open", F.coalesce("open", F.lit(False)))
    again = again.withColumn("strips", F.ceil(F.col("opened") / F.lit(size)).cast("int"))
    strip = F.pmod(F.xxhash64("node", F.lit(23)), F.col("strips")).cast("int")
    columns = [key, "strip", "chunk", "seeks", "open", "node", *payload]
    others = again.withColumn("strip", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)))
    others = others.withColumn("seeks", F.lit(False)).select(columns)
    seekers = again.filter("open").withColumn("strip", strip).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).filter("chunk <> own")
    seekers = seekers.withColumn("seeks", F.lit(True)).select(columns)

    def far(batches):
        for table in group_runs(batches, [key, "strip", "chunk"]):
            starts = group_starts(group_numbers(table, [key, "strip", "chunk"])).tolist()
            for low, high in zip(starts, starts[1:]):
                part = table.slice(low, high - low)
                is_open = part.column("open").to_numpy()
                seeks = part.column("seeks").to_numpy()
                forest = Forest(len(seeks))
                settled = np.flatnonzero(~is_open)
                if len(settled):  # connected by the pivot already
                    forest.root[settled] = settled[0]
                targets, linked = np.flatnonzero(~seeks), judge(part)
                for i in np.flatnonzero(seeks).tolist():
                    apart = targets[forest.root[targets] != forest.root[i]]
                    i_, j_ = linked(np.full(len(apart), i), apart)
                    unite(forest, j_, i_)
                hung = np.flatnonzero(is_open & (forest.root != np.arange(len(seeks))))
                node = part.column("node").combine_chunks()
                yield record_batch({"a": node.take(pa.array(hung)), "b": node.take(pa.array(forest.root[hung]))}, link_out)

    keys = [key, "strip", "chunk"]
    met = others.unionByName(seekers).repartition(*keys).sortWithinPartitions(*keys, "open", "seeks", "node")
    return links.unionByName(staged(met.mapInArrow(far, LINK), label))


def count_links(rows: DataFrame, threshold: Fraction) -> DataFrame:
    """Rows (node, links): of how many documents with other shingles a node reaches the threshold.

    ``rows`` has ``root`` (the class, outside which no link leads), ``blocks``, ``node``,
    ``copies`` and ``shingles``. Nodes of a class are dealt to its blocks; every two blocks, and
    every block with itself, meet in one group, where the sizes of all intersections are taken.
    So a class of any size is counted in pieces of bounded memory; its work is that of its pairs.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(COUNTED)
    keys = ["root", "low", "high"]

    def count(batches):
        for table in group_runs(batches, keys):
            starts = group_starts(group_numbers(table, keys)).tolist()
            sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            copies, own = table.column("copies").to_numpy(), table.column("own").to_numpy()
            low_block, high_block = table.column("low").to_numpy(), table.column("high").to_numpy()
            links = np.zeros(len(sets), np.int64)
            for a, b in zip(starts, starts[1:]):
                within = low_block[a] == high_block[a]
                split = a + int((own[a:b] == low_block[a]).sum())
                if not within and split in (a, b):
                    continue
                both = shared_counts(sets[a:b], None if within else split - a)
                left, right = (slice(a, b), slice(a, b)) if within else (slice(a, split), slice(split, b))
                either = sizes[left, None] + sizes[None, right] - both
                true = both * threshold.denominator >= either * threshold.numerator
                if within:
                    np.fill_diagonal(true, False)
                else:
                    links[right] += copies[left] @ true
                links[left] += true @ copies[right]
            some = np.flatnonzero(links)
            yield record_batch({
                "node": table.column("node").combine_chunks().take(pa.array(some)), "links": links[some]}, out)

    own = F.pmod(F.xxhash64("node", F.lit(29)), F.col("blocks")).cast("int")
    met = rows.withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                     "own", "node", "copies", "shingles")
    met = met.repartition(*keys).sortWithinPartitions(*keys, "own", "node")
    return met.mapInArrow(count, COUNTED).groupBy("node").agg(F.sum("links").alias("links"))


SIGNED = StructType([
    StructField("node", BinaryType()), StructField("size", IntegerType()),
    StructField("signature", BinaryType()),
])
LINK = StructType([StructField("a", BinaryType()), StructField("b", BinaryType())])
COUNTED = StructType([StructField("node", BinaryType()), StructField("links", LongType())])
SETS = StructType([StructField("node", BinaryType()), StructField("shingles", BinaryType())])


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD, width: int = SHINGLE,
                      id_col: str = "doc_id", text_col: str = "text",
                      count: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, class_id, copy_id, class_size; with ``count`` n_links too.

    Two documents are linked if the Jaccard similarity of their word shingles is at least
    ``threshold``. ``class_id`` is the smallest id that links lead to, ``copy_id`` the smallest
    id with the same shingles, ``class_size`` the number of documents of the class, ``n_links``
    the number of other documents, copies among them, that the document itself is linked to.
    64-bit hashes stand for shingles.

    Documents with equal shingle sets are one node. Nodes that share a band of MinHash values
    meet in buckets, where Bayesian pruning leaves candidates. What candidates connect is a
    cluster; its nodes get their shingle sets once, and there unpruned pairs are checked
    exactly until all that links connect is connected (``connect``). A pair whose ends are
    connected already needs no check for the classes. Links are counted afterwards from all pairs
    of nodes of a class, none of them pruned (``count_links``). A pair at the threshold is missed
    with a chance of about 5e-8 by all bands and 1e-8 by pruning, others less.

    Null or empty texts, and texts without words, link to nothing: their class is their own
    id. Rows with a null id have a null class and size 1. Rows that repeat an id count as
    copies. An empty table gives no rows; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    needed = needed_matches(threshold)
    exact = Fraction(str(threshold))
    id_type = docs.schema[id_col].dataType
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed_schema = StructType([StructField("id", id_type), *SIGNED.fields])
    signed_out, sets_out = to_arrow_schema(signed_schema), to_arrow_schema(SETS)

    def sign(batches):
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), width)
            values = minhashes(sets)
            yield record_batch({
                "id": batch.column("id"),
                "node": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                "size": [len(s) for s in sets],
                "signature": [row.tobytes() for row in values],
            }, signed_out)

    signed = staged(frame.mapInArrow(sign, signed_schema), "signatures")
    linkable = signed.filter("id IS NOT NULL AND size > 0")
    nodes = staged(
        linkable.groupBy("node").agg(
            F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"),
            F.first("signature").alias("signature"), F.first("size").alias("size")),
        "nodes")

    bands = F.array(*[
        F.xxhash64(F.lit(b), F.substring("signature", 4 * BAND * b + 1, 4 * BAND))
        for b in range(HASHES // BAND)
    ])
    # 8 bytes stand for a node here; two nodes with one handle only meet in more buckets.
    nodes = nodes.withColumn("handle", F.xxhash64("node"))
    entries = nodes.select("handle", F.explode(bands).alias("bucket"))
    full = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("handle").alias("pivot"))
    entries = staged(entries.join(full.filter("members > 1"), "bucket"), "buckets")

    def unpruned(table):
        values = signature_matrix(table.column("signature"))
        return lambda i, j: prune(values, i, j, needed)

    def bucket_rows(keys):
        own = entries if keys is None else entries.join(keys, "bucket", "left_semi")
        own = own.withColumn("pivot", F.col("handle") == F.col("pivot"))
        return measured_join(nodes.select("handle", "node", "signature"), own, "handle")

    candidates = connect(
        bucket_rows, "bucket", BUCKET_BLOCK, ["signature"],
        lambda table, group: candidate_forest(signature_matrix(table.column("signature")), group, needed),
        unpruned, "candidates")
    clusters = staged(components(candidates), "clusters")

    # The shingle sets of the nodes of clusters, from one document of each.
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("pivot"))
    known = nodes.select("node", "least", "signature")
    wanted = staged(measured_join(known, clusters, "node").join(sizes, "root"), "wanted")

    def shingles(batches):
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), width)
            yield record_batch({
                "node": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                "shingles": [s.tobytes() for s in sets],
            }, sets_out)

    def sets_from(ids, number):
        return measured_join(frame, ids, "id", number).mapInArrow(shingles, SETS).dropDuplicates(["node"])

    sets = sets_from(wanted.select(F.col("least").alias("id")).distinct(), wanted.count())

    def cluster_rows(keys):
        own = wanted if keys is None else wanted.join(keys, "root", "left_semi")
        return own.withColumn("pivot", F.col("node") == F.col("pivot")).join(sets, "node")

    def sets_of(table):
        return [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]

    def similar(table):
        sets, going = sets_of(table), unpruned(table)
        return lambda i, j: similar_pairs(sets, *going(i, j), exact)

    links = connect(
        cluster_rows, "root", CLUSTER_BLOCK, ["signature", "shingles"],
        lambda table, group: verified_forest(
            sets_of(table), signature_matrix(table.column("signature")), group, needed, exact),
        similar, "checked")
    parts = staged(components(links), "parts")
    facts = nodes.select("node", "least", "copies")
    linked = parts.join(facts, "node")
    classes = linked.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    alone = facts.filter("copies > 1").join(parts, "node", "left_anti")
    linked_info = linked.join(classes, "root")
    if count:
        held = parts.join(nodes.select("node", "least", "copies", "size"), "node")
        wide = F.greatest(F.count(F.lit(1)) / COUNT_ROWS, F.sum("size") / COUNT_SHINGLES)
        blocks = held.groupBy("root").agg(F.ceil(wide).cast("int").alias("blocks"))
        held = staged(held.join(blocks, "root").select("root", "blocks", "node", "least", "copies"), "linked")
        ids = held.select(F.col("least").alias("id")).distinct()
        counted = count_links(held.join(sets_from(ids, held.count()), "node"), exact)
        linked_info = linked_info.join(counted, "node", "left")
        others = F.coalesce("links", F.lit(0))
    else:
        others = F.lit(0)
    columns = ["node", "class_id", F.col("least").alias("copy_id"), "class_size"]
    info = linked_info.select(*columns, (F.col("copies") - 1 + others).alias("n_links"))
    info = info.unionByName(alone.select(
        "node", F.col("least").alias("class_id"), F.col("least").alias("copy_id"), F.col("copies").alias("class_size"),
        (F.col("copies") - 1).alias("n_links")))
    rows = salted_left_join(
        signed.select("id", "size", "node"), staged(info, "classes"), ["node"], F.col("id"))
    single = F.col("id").isNull() | (F.col("size") == 0) | F.col("class_id").isNull()
    found = [
        F.col("id").alias(id_col),
        F.when(single, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(single, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(single, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
    ]
    if count:
        found.append(F.when(single, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"))
    return rows.select(*found)
