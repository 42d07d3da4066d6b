"""N-gram Jaccard join with Bayesian pruning of candidates.

Texts are compared by their sets of five-word shingles; a link is a Jaccard similarity of 0.8 or more. The steps:

1. Each text gets its shingle set's fingerprint and 128 MinHash values. Texts with equal sets are one node.
2. 32 bands of four values put nodes into buckets; two nodes at 0.8 miss each other in all bands with a chance
   below 1e-7.
3. Every node of a bucket is compared with the bucket's smallest, and, where that leaves nodes of a bucket in
   different groups, these with each other: in buckets of up to 32 such nodes pair by pair, in larger ones in blocks
   of bounded size. A comparison goes through the MinHash values 16 at a time: with a uniform prior, m equal ones of
   n make the similarity Beta(m + 1, n - m + 1); the pair is dropped once the chance that it is 0.8 or more is
   below the tolerance.
4. Pairs that are left connect nodes to clusters. In each cluster all pairs are verified exactly. Every node is
   compared with the cluster's first: how many shingles differ from it. Two sets differ by the sum of these numbers at
   most, so nodes close enough to the first are sure to be linked with each other; their links are counted from
   sorted numbers alone, without a look at the pairs. All other pairs are verified from the shingles in which the
   nodes differ from the first, in blocks of bounded size by matrix products that give only counts and one link per
   node, not the pairs.
5. Verified links connect nodes to classes.

A large group of near copies thus costs a row per node and bucket; only nodes far from the first meet block by block,
and then with what makes them differ. Nothing is dropped for being frequent: a large bucket is cut into blocks, and
every pair of blocks is looked at.

Words are runs of other characters than ASCII white space. A text of one to four words has one shingle, all of them.
Null texts and texts without words have none and link to nothing. Rows with null doc_id take part like any other;
rows that repeat doc_id and text count as one document. A class is named by its smallest doc_id (null first).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, apart, cells, in_batches, map_arrow, whole_row
from tidemark.llm.components import components

SHINGLE = 5
HASHES, BAND, STAGE = 128, 4, 16
#: A bucket of so many nodes at most is compared pair by pair.
SMALL_BUCKET = 32
#: Nodes in a block of a larger bucket; nodes and shingles in a block of a cluster.
BUCKET_BLOCK, CLUSTER_BLOCK, CLUSTER_SHINGLES = 512, 1024, 1_000_000
_AT_ONCE = 2048


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 32:
            if len(self) >= 100_000:
                self.clear()
            self[word] = value
        return value


_hash_of = _WordHashes().__getitem__


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the shingles of a whole text."""
    words = (text or "").encode("utf-8", "replace").split()
    hashes = np.fromiter(map(_hash_of, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    if not width:
        return hashes
    n = len(words) - width + 1
    rolled = hashes[:n]
    for k in range(1, width):
        rolled = _mixed(rolled) + hashes[k : k + n]
    return np.unique(_mixed(rolled))


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 63, HASHES, np.uint64) << np.uint64(1), rng.integers(0, 1 << 63, HASHES, np.uint64) << np.uint64(1) | np.uint64(1)


def signature(found: np.ndarray) -> bytes:
    """MinHash values, the upper 32 bits of each, of at least one shingle."""
    flips, factors = _permutations()
    least = None
    for at in range(0, len(found), _AT_ONCE):
        part = ((found[at : at + _AT_ONCE, None] ^ flips) * factors).min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return (least >> np.uint64(32)).astype("<u4").tobytes()


@lru_cache(maxsize=4)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For 16, 32, .. compared values: the fewest equal ones with which the pair is kept.

    The chance that a Beta(m + 1, n - m + 1) variable is at least t is that of at most m successes in n + 1 trials
    with chance t.
    """
    found = []
    for n in range(STAGE, HASHES + 1, STAGE):
        m, tail = 0, (1 - threshold) ** (n + 1)
        while tail < tolerance:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found.append(m)
    return tuple(found)


def survivors(left: np.ndarray, right: np.ndarray, limits: tuple[int, ...]) -> np.ndarray:
    """Indices of the rows (MinHash values of two nodes each) that no stage drops."""
    alive, equal = np.arange(len(left)), np.zeros(len(left), np.int32)
    for stage, least in enumerate(limits):
        part = slice(stage * STAGE, (stage + 1) * STAGE)
        equal = equal + (left[alive, part] == right[alive, part]).sum(axis=1)
        keep = equal >= least
        alive, equal = alive[keep], equal[keep]
    return alive


_SIGNED = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("node", pa.binary()), ("size", pa.int32()), ("sig", pa.binary())])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for doc_id, h, text in cells(batch, "doc_id", "h", "text"):
                found = shingles(text)
                if len(found):
                    yield doc_id, h, xxhash.xxh3_128_digest(found), len(found), signature(found)
                else:
                    yield doc_id, h, None, 0, None

    return in_batches(rows(), _SIGNED)


_PAIR = pa.schema([("u", pa.binary()), ("v", pa.binary())])


def _values(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, HASHES)


def _prune(batches: Iterator[pa.RecordBatch], limits: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            kept = pa.array(survivors(_values(part.column("sig_u")), _values(part.column("sig_v")), limits))
            yield pa.RecordBatch.from_arrays([part.column("u").take(kept), part.column("v").take(kept)], schema=_PAIR)


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal keys, which sorting has put side by side."""
    held, current = [], None
    for batch in batches:
        for row in cells(batch, *keys, *names):
            key = row[: len(keys)]
            if key != current and held:
                yield current, held
                held = []
            current = key
            held.append(row[len(keys) :])
    if held:
        yield current, held


def _prune_blocks(batches: Iterator[pa.RecordBatch], limits: tuple[int, ...], threshold: float) -> Iterator[pa.RecordBatch]:
    """Survivors among the nodes of two blocks of a bucket that are in different groups."""

    def rows():
        for (_, i, j), held in _groups(batches, ("bucket", "i", "j"), ("x", "node", "label", "size", "sig")):
            x, nodes, labels, sizes, sigs = zip(*held)
            x, sizes, values = np.array(x), np.array(sizes), np.frombuffer(b"".join(sigs), "<u4").reshape(-1, HASHES)
            group = np.unique(np.array(labels, object), return_inverse=True)[1]
            others = np.flatnonzero(x == j)
            for k in np.flatnonzero(x == i).tolist():
                to = others[others > k] if i == j else others
                to = to[(group[to] != group[k]) & (np.minimum(sizes[to], sizes[k]) >= threshold * np.maximum(sizes[to], sizes[k]))]
                for m in to[survivors(np.broadcast_to(values[k], (len(to), HASHES)), values[to], limits)].tolist():
                    yield nodes[k], nodes[m]

    return in_batches(rows(), _PAIR)


def _intersections(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Shared shingles of each row set with each column set, by products of incidence matrices a few columns wide."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    shared = times[code] > 1
    owner, code = owner[shared], code[shared]
    code = np.cumsum(np.concatenate(([0], np.diff(code) != 0))) if len(code) else code
    out = np.zeros((len(rows), len(columns)), np.float32)
    wide = 2048
    for first in range(0, int(code[-1]) + 1 if len(code) else 0, wide):
        a, b = np.searchsorted(code, [first, first + wide])
        incidence = np.zeros((len(sets), wide), np.float32)
        incidence[owner[a:b], code[a:b] - first] = 1
        out += incidence[rows] @ incidence[columns].T
    return out


_SHINGLED = pa.schema([("cluster", pa.binary()), ("node", pa.binary()), ("copies", pa.int64()), ("shingles", pa.binary())])


def _reshingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for cluster, node, copies, text in cells(batch, "cluster", "node", "copies", "text"):
                found = shingles(text)
                if xxhash.xxh3_128_digest(found) == node:
                    yield cluster, node, copies, found.tobytes()

    return in_batches(rows(), _SHINGLED)


_PLACED = pa.schema([("cluster", pa.binary()), ("node", pa.binary()), ("copies", pa.int64()), ("size", pa.int64()), ("slack", pa.int64()), ("unlike", pa.binary())])


def _compare_with_first(batches: Iterator[pa.RecordBatch], threshold_tenths: int) -> Iterator[pa.RecordBatch]:
    """The shingles that a node has and the cluster's first hasn't, or the other way round, and the node's slack.

    Sets of sizes a and b that differ in d shingles are linked if (10 - t) * (a + b) >= (10 + t) * d, with t the
    threshold in tenths. A node's slack is its share of that, so that two nodes whose slacks add up to 0 or more are linked.
    """
    far, near = 10 + threshold_tenths, 10 - threshold_tenths

    def rows():
        for batch in batches:
            for cluster, node, copies, packed, first in cells(batch, "cluster", "node", "copies", "shingles", "first", step=64):
                found = np.frombuffer(packed, np.uint64)
                unlike = np.setxor1d(found, np.frombuffer(first, np.uint64), assume_unique=True)
                yield cluster, node, copies, len(found), near * len(found) - far * len(unlike), unlike.tobytes()

    return in_batches(rows(), _PLACED)


_VERIFIED = pa.schema([("node", pa.binary()), ("least", pa.binary()), ("links", pa.int64())])


def _verify(batches: Iterator[pa.RecordBatch], threshold_tenths: int) -> Iterator[pa.RecordBatch]:
    """For each node of a pair of blocks: how many documents it links to there, and the smallest node it is connected with.

    Pairs whose slacks add up to 0 or more are counted elsewhere.
    """
    far, near = 10 + threshold_tenths, 10 - threshold_tenths

    def rows():
        for (_, i, j), held in _groups(batches, ("cluster", "i", "j"), ("block", "node", "copies", "size", "slack", "unlike")):
            if len(held) < 2:
                continue
            x, nodes, copies, sizes, slacks, packed = zip(*held)
            sets = [np.frombuffer(s, np.uint64) for s in packed]
            x, copies, sizes, slacks, apart_by = np.array(x), np.array(copies), np.array(sizes), np.array(slacks), np.array([len(s) for s in sets])
            at, to = np.flatnonzero(x == i), np.flatnonzero(x == j)
            differ = apart_by[at][:, None] + apart_by[to][None, :] - 2 * _intersections(sets, at, to)
            linked = (near * (sizes[at][:, None] + sizes[to][None, :]) >= far * differ) & (slacks[at][:, None] + slacks[to][None, :] < 0)
            if i == j:
                np.fill_diagonal(linked, False)
            links = np.zeros(len(nodes), np.int64)
            links[at] += linked @ copies[to]
            if i != j:
                links[to] += copies[at] @ linked
            root = list(range(len(nodes)))

            def find(k: int) -> int:
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            for row, k in enumerate(at.tolist()):
                for m in to[linked[row]].tolist():
                    a, b = find(k), find(m)
                    if a != b:
                        root[max(a, b, key=lambda n: nodes[n])] = min(a, b, key=lambda n: nodes[n])
            for k, node in enumerate(nodes):
                if links[k] or find(k) != k:
                    yield node, nodes[find(k)], int(links[k])

    return in_batches(rows(), _VERIFIED)


def _block_pairs(df: DataFrame, blocks: str) -> DataFrame:
    """Each row once for each pair of blocks (i <= j) that its block x is in."""
    other = F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)).alias("y")
    with_x = df.withColumn("x", F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int"))
    return with_x.select("*", other).withColumns({"i": F.least("x", "y"), "j": F.greatest("x", "y")}).drop("y")


def _pruned(pairs: DataFrame, nodes: DataFrame, limits: tuple[int, ...]) -> DataFrame:
    sig_u = nodes.select(F.col("node").alias("u"), F.col("sig").alias("sig_u"))
    sig_v = nodes.select(F.col("node").alias("v"), F.col("sig").alias("sig_v"))
    return pairs.join(sig_u, "u").join(sig_v, "v").select("u", "v", "sig_u", "sig_v").transform(map_arrow, partial(_prune, limits=limits), "u binary, v binary")


def _labelled(nodes: DataFrame, edges: DataFrame, label: str) -> DataFrame:
    """nodes with the smallest node of their component, themselves where they have no edge."""
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias(label)), "node", "left").withColumn(label, F.coalesce(label, "node"))


def candidate_edges(scratch: Scratch, nodes: DataFrame, threshold: float, limits: tuple[int, ...]) -> DataFrame:
    """Pairs (u, v) that pruning leaves; two nodes that met in a bucket and may be linked are connected through them."""
    keys = F.array(*(F.xxhash64(F.lit(b), F.substring("sig", 4 * BAND * b + 1, 4 * BAND)) for b in range(HASHES // BAND)))
    bands = nodes.select("node", "size", F.explode(keys).alias("bucket"))
    buckets = bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("head")).where("n > 1")
    members = scratch.keep(bands.join(apart(buckets), "bucket"))
    stars = members.where("node != head").select(F.col("node").alias("u"), F.col("head").alias("v")).distinct()
    first = scratch.keep(_pruned(stars, nodes, limits))
    grouped = components(scratch, first)

    mixed_rows = _labelled(members.where("n > 2"), grouped, "label")
    mixed = mixed_rows.groupBy("bucket").agg(F.count("*").alias("m"), F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("bucket", "m")
    unlike = scratch.keep(mixed_rows.join(apart(mixed), "bucket").select("bucket", "m", "node", "label", "size"))
    small = unlike.where(F.col("m") <= SMALL_BUCKET)
    left, right = (small.select("bucket", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "label", "size"))) for x in "uv")
    near = (F.col("node_u") < F.col("node_v")) & (F.col("label_u") != F.col("label_v")) & (F.least("size_u", "size_v") >= threshold * F.greatest("size_u", "size_v"))
    pairs = left.join(right, "bucket").where(near).select(F.col("node_u").alias("u"), F.col("node_v").alias("v")).distinct()
    large = unlike.where(F.col("m") > SMALL_BUCKET).withColumn("blocks", F.ceil(F.col("m") / BUCKET_BLOCK).cast("int")).join(nodes.select("node", "sig"), "node")
    blocks = _block_pairs(large, "blocks").select("bucket", "i", "j", "x", "node", "label", "size", "sig").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    found = blocks.transform(map_arrow, partial(_prune_blocks, limits=limits, threshold=threshold), "u binary, v binary")
    out = scratch.keep(first.select("u", "v").union(_pruned(pairs, nodes, limits)).union(found))
    scratch.drop(members, unlike, first, grouped)
    return out


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, and the text; the first two tell documents apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")


def _nodes(signed: DataFrame) -> DataFrame:
    """A row for each shingle set: its documents, the first of them, its size and MinHash values."""
    signed = signed.where("node is not null")
    owners = signed.select("node", "doc_id", "h").distinct().groupBy("node").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "h")).alias("doc"))
    return owners.join(signed.groupBy("node").agg(F.first("size").alias("size"), F.first("sig").alias("sig")), "node")


def _by_slack(values: DataFrame) -> DataFrame:
    """values (cluster, slack, n, m documents, w shingles) with `sure`, the documents whose slack makes up for the row's, `top`, the
    cluster's largest slack, and where nodes of the row go: from block `g` on, dealt to `parts` blocks.

    A cluster meets in one task here with a row for each slack, which are as many as its texts have sizes, not nodes.
    """
    asked = values.select("cluster", (-F.col("slack")).alias("at"), F.lit(0).cast("bigint").alias("m"), F.lit(1).alias("asks"))
    told = values.select("cluster", F.col("slack").alias("at"), "m", F.lit(0).alias("asks"))
    down = Window.partitionBy("cluster").orderBy(F.desc("at"), "asks").rowsBetween(Window.unboundedPreceding, 0)
    sure = told.union(asked).withColumn("sure", F.sum("m").over(down)).where("asks = 1").select("cluster", (-F.col("at")).alias("slack"), "sure")
    above = Window.partitionBy("cluster").orderBy(F.desc("slack")).rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("n").over(above), F.lit(0)) / CLUSTER_BLOCK + F.coalesce(F.sum("w").over(above), F.lit(0)) / CLUSTER_SHINGLES
    parts = F.ceil(F.greatest(F.col("n") / CLUSTER_BLOCK, F.col("w") / CLUSTER_SHINGLES, F.lit(1.0)))
    dealt = values.select("cluster", "slack", F.max("slack").over(Window.partitionBy("cluster")).alias("top"), F.floor(filled).alias("g"), parts.alias("parts"))
    return dealt.join(sure, ["cluster", "slack"])


def _verified(scratch: Scratch, docs: DataFrame, nodes: DataFrame, clusters: DataFrame, threshold_tenths: int) -> DataFrame:
    """Links and a connection for each node that has any, from the shingle sets of all nodes in clusters."""
    clustered = clusters.union(clusters.select(F.col("v").alias("u"), "v")).distinct().select(F.col("u").alias("node"), F.col("v").alias("cluster"))
    places = clustered.join(nodes.select("node", "copies", "doc"), "node").select("cluster", "node", "copies", F.col("doc.doc_id").alias("d"), F.col("doc.h").alias("dh"))
    # The texts meet their places by sorting at every size, so the plan doesn't depend on an estimate.
    texts = docs.join(places.hint("merge"), docs["doc_id"].eqNullSafe(places["d"]) & (docs["h"] == places["dh"])).select("cluster", "node", "copies", "text")
    sets = scratch.keep(texts.transform(map_arrow, _reshingle, "cluster binary, node binary, copies bigint, shingles binary").dropDuplicates(["node"]))
    firsts = sets.where("node = cluster").select("cluster", F.col("shingles").alias("first"))
    compared = sets.join(firsts.hint("merge"), "cluster").transform(
        map_arrow, partial(_compare_with_first, threshold_tenths=threshold_tenths), "cluster binary, node binary, copies bigint, size bigint, slack bigint, unlike binary"
    )
    compared = scratch.keep(compared)
    values = scratch.keep(compared.groupBy("cluster", "slack").agg(F.count("*").alias("n"), F.sum("copies").alias("m"), F.sum(F.octet_length("unlike") / 8).alias("w")))
    block = F.shiftleft(F.col("g").cast("bigint"), 24) + F.pmod(F.xxhash64("node"), F.col("parts"))
    placed = scratch.keep(compared.join(apart(_by_slack(values)), ["cluster", "slack"]).withColumn("block", block).drop("g", "parts"))

    # Sure links all lead to the node with the largest slack, so that one connects them.
    hubs = placed.where("slack = top").groupBy("cluster").agg(F.min("node").alias("hub"))
    others = F.col("sure") - F.when(F.col("slack") >= 0, F.col("copies")).otherwise(0)
    sure = placed.select("cluster", "node", others.alias("links")).where("links > 0").join(apart(hubs), "cluster").select("node", F.col("hub").alias("least"), "links")

    lows = placed.groupBy("cluster", "block").agg(F.min("slack").alias("low"))
    left, right = (lows.select("cluster", F.col("block").alias(x), F.col("low").alias(f"low_{x}")) for x in "ij")
    open_pairs = left.join(right, "cluster").where("i <= j and low_i + low_j < 0")
    sides = open_pairs.select("cluster", F.col("i").alias("block"), "i", "j", F.col("low_j").alias("low")).union(open_pairs.where("i < j").select("cluster", F.col("j").alias("block"), "i", "j", F.col("low_i").alias("low")))
    paired = placed.join(apart(sides), ["cluster", "block"]).where("slack + low < 0").select("cluster", "i", "j", "block", "node", "copies", "size", "slack", "unlike")
    paired = paired.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    found = scratch.keep(sure.union(paired.transform(map_arrow, partial(_verify, threshold_tenths=threshold_tenths), "node binary, least binary, links bigint")))
    scratch.drop(sets, compared, values, placed)
    return found


def _linked(spark: SparkSession, docs: DataFrame, threshold_tenths: int, tolerance: float) -> DataFrame:
    """doc_id, h, node, class (its smallest node), class_id and n_links for each document."""
    scratch = Scratch(spark)
    limits = least_matches(threshold_tenths / 10, tolerance)
    docs = _documents(docs)
    signed = scratch.keep(docs.transform(map_arrow, _sign, "doc_id bigint, h bigint, node binary, size int, sig binary"))
    nodes = scratch.keep(_nodes(signed))
    edges = candidate_edges(scratch, nodes, threshold_tenths / 10, limits)
    clusters = components(scratch, edges)
    verified = _verified(scratch, docs, nodes, clusters, threshold_tenths)
    classes = components(scratch, verified.select(F.col("node").alias("u"), F.col("least").alias("v")))

    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    whole = _labelled(nodes.select("node", "copies", "doc"), classes, "class").join(links, "node", "left")
    names = whole.groupBy("class").agg(F.min("doc").alias("first"))
    result = scratch.keep(whole.join(apart(names), "class").select("node", "class", F.col("first.doc_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = scratch.keep(signed.select("doc_id", "h", "node").distinct().join(result, "node", "left"))
    scratch.drop(signed, nodes, edges, clusters, verified, classes, result)
    alone = F.col("node").isNull()
    return out.select("doc_id", "h", "node", "class", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def link(spark: SparkSession, docs: DataFrame, threshold_tenths: int = 8, tolerance: float = 1e-6) -> DataFrame:
    """doc_id, class_id and n_links for each document: its class, and how many other documents it is linked to."""
    return _linked(spark, docs, threshold_tenths, tolerance).select("doc_id", "class_id", "n_links")


def keep_one(spark: SparkSession, docs: DataFrame, threshold_tenths: int = 8, tolerance: float = 1e-6) -> DataFrame:
    """docs with one document of each class, that with the smallest doc_id (null first), and one row of each document.

    Documents without words are in no class and stay.
    """
    linked = _linked(spark, docs, threshold_tenths, tolerance)
    alone = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("h").cast("string")).cast("binary")
    kept = linked.groupBy(F.coalesce("class", alone).alias("class")).agg(F.min(F.struct("doc_id", "h")).alias("doc"))
    kept = kept.select(F.coalesce("doc.doc_id", F.lit(-(1 << 63))).alias("d"), F.col("doc.h").alias("h"))
    keyed = docs.select(whole_row(docs), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64("text").alias("h"))
    return keyed.join(kept, ["d", "h"], "left_semi").dropDuplicates(["d", "h"]).select("row.*")


def oracle_sql(threshold_tenths: int = 8) -> str:
    """DuckDB SQL for the registered query, by comparing all pairs that share a shingle; for tables with unique doc_ids."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id::bigint AS doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + {SHINGLE - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 10 * c >= {threshold_tenths} * (nx.n + ny.n - c)),
r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x, min(y) AS y FROM r GROUP BY 1), l AS (SELECT x, count(*) AS n FROM e GROUP BY 1)
SELECT d.doc_id, coalesce(least(d.doc_id, c.y), d.doc_id) AS class_id, coalesce(l.n, 0)::bigint AS n_links FROM d LEFT JOIN c ON c.x = d.doc_id LEFT JOIN l ON l.x = d.doc_id
"""
