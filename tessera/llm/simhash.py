"""SimHash near-duplicate detection with a Gray-order hierarchical index.

A document's fingerprint is taken over its word shingles: bit b is set if it is set in more than
half of the shingles' hashes. Two fingerprints link if they differ in at most ``max_bits`` bits;
documents are one class if links connect them.

Finding links. Equal fingerprints are one node. With m bit blocks, two fingerprints that differ in
at most d bits agree on at least m - d whole blocks, so each is dealt out once for every choice of
m - d blocks, keyed by their bits: linked pairs share a key, whatever the data (``_plan`` takes
more blocks as the number of fingerprints grows, so that keys stay small; the links found are the
same). In a task, the fingerprints of each key are sorted by Gray rank and packed into a tree: a
node holds the bits that all its members share and its parent's members do not. A search carries
the differences accumulated from the root and drops whole groups once these exceed d. What leaves
a task is not all pairs but a spanning forest of each key, and a search skips groups that are
connected to it already; a star contraction joins the forests into classes.

Results in special cases: null and empty texts have fingerprint zero and link like any other; a
text with fewer words than a shingle is one shingle; repeated rows are each in the result; a null
doc_id never names a class unless all ids of the class are null; very long texts are hashed piece by
piece; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import discard, in_slices, join_hot, materialize, small_batches

BITS = 64
MAX_BITS = 4
SHINGLE = 4
SEED = 42
#: Members of a tree node, at each level.
FAN_OUT = 16
#: Fingerprints searched at once, and a key's fingerprints that one task takes at most; larger keys are dealt out as pairs of parts.
BLOCK, PART = 8192, 262_144
#: Tree nodes that one search holds at once.
FRONTIER = 2_000_000
#: Edges that a task of the components turns into a forest of its own.
LOCAL = 262_144


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> Iterator[np.ndarray]:
    """The hashes of a whole text's shingles, repeats included, some at a time; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n, digest = max(1, len(words) - shingle + 1), xxhash.xxh64_intdigest
    step = 1 << 16  # bounded memory on very long texts
    for at in range(0, n if words else 0, step):
        part = words[at : min(at + step, n) + shingle - 1]
        if n == 1:
            yield np.array([digest(b" ".join(words), seed)], np.uint64)
        else:
            yield np.array([digest(b" ".join(s), seed) for s in zip(*(part[k : len(part) - shingle + 1 + k] for k in range(shingle)))], np.uint64)


def fingerprint_of(hashes: Iterable[np.ndarray]) -> int:
    """The fingerprint over all hashes: the bits set in more than half of them."""
    counts, n = np.zeros(BITS, np.int64), 0
    for part in hashes:
        raw = part.astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
        n += len(part)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a whole text."""
    return fingerprint_of(shingle_hashes(text, shingle, seed))


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint of every row as a signed long, and a hash of its text."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"])

    small_batches(documents.sparkSession)
    text = F.col(text_col).cast("string")
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(compute, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash bigint, fp bigint")


def _gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the Gray sequence: neighbours in it differ in few bits."""
    out = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def _expand(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range: its number, and every position in it."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(starts)), sizes)
    return owner, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


class GrayIndex:
    """The tree over fingerprints that come sorted by (key, Gray rank); nodes never span two keys."""

    def __init__(self, keys: np.ndarray, fps: np.ndarray):
        self.fps = fps
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        self.levels: list[dict] = []
        both, either, bounds = fps, fps, start
        while True:
            # bounds: where each key starts among the members of this level
            sizes = np.diff(np.r_[bounds, len(both)])
            groups = -(-sizes // FAN_OUT)
            owner, at = _expand(np.zeros_like(groups), groups)
            first = bounds[owner] + at * FAN_OUT
            last = np.r_[first[1:], len(both)]
            both, either = np.bitwise_and.reduceat(both, first), np.bitwise_or.reduceat(either, first)
            self.levels.append({"first": first, "last": last, "mask": ~(both ^ either), "bits": both, "key": owner})
            bounds = np.cumsum(groups) - groups
            if (groups == 1).all():
                break
        self.key_of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(fps)]))
        for below, above in zip(self.levels, self.levels[1:]):  # bits factored into upper nodes are not held again below
            parent, _ = _expand(above["first"], above["last"])
            below["mask"] &= ~above["mask"][parent]

    def links(self, queries: np.ndarray, max_bits: int, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later member) within ``max_bits``; groups that wholly carry the query's label are skipped."""
        query, node, far = queries, self.key_of[queries], np.zeros(len(queries), np.uint8)
        for level in reversed(self.levels):
            far = far + np.bitwise_count((self.fps[query] ^ level["bits"][node]) & level["mask"][node])
            keep = (far <= max_bits) & (level["reach"][node] > query) & (level["label"][node] != labels[query])
            query, node, far = query[keep], node[keep], far[keep]
            first, last = level["first"][node], level["last"][node]
            if len(queries) > 1 and (last - first).sum() > FRONTIER:  # bounded memory: half the queries at a time
                halves = [self.links(q, max_bits, labels) for q in np.array_split(queries, 2)]
                return np.concatenate([h[0] for h in halves]), np.concatenate([h[1] for h in halves])
            owner, node = _expand(first, last)
            query, far = query[owner], far[owner]
        keep = (node > query) & (labels[node] != labels[query])
        query, node = query[keep], node[keep]
        keep = np.bitwise_count(self.fps[query] ^ self.fps[node]) <= max_bits
        return query[keep], node[keep]

    def forest(self, max_bits: int) -> np.ndarray:
        """For each fingerprint the first one that links connect it to."""
        labels = np.arange(len(self.fps))
        reach = labels
        for level in self.levels:
            level["reach"] = reach = reach[level["last"] - 1]  # the last member below
        step = 64
        at = 0
        while at < len(labels):
            low, high = labels, labels
            for level in self.levels:  # a node's label, where all its members have the same
                low, high = np.minimum.reduceat(low, level["first"]), np.maximum.reduceat(high, level["first"])
                level["label"] = np.where(low == high, low, -1)
            a, b = self.links(np.arange(at, min(at + step, len(labels))), max_bits, labels)
            labels = _join(labels, a, b)
            at += step
            step = min(2 * step, BLOCK)
        return labels


def _join(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b: the smallest label of each connected set."""
    while len(a):
        x, y = labels[a], labels[b]
        keep = x != y
        if not keep.any():
            break
        a, b, x, y = a[keep], b[keep], x[keep], y[keep]
        root = labels.copy()
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
        labels = root[labels]
    return labels


def _plan(n: int, max_bits: int) -> tuple[int, int]:
    """(blocks, agreeing blocks): the fewest copies of each fingerprint that leave about 512 or fewer to a random key."""
    for blocks in range(max_bits + 1, BITS + 1):
        if n <= 512 << (BITS * (blocks - max_bits) // blocks):
            return blocks, blocks - max_bits
    return BITS, BITS - max_bits


def _forest_edges(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links that connect within each key what its links connect; nodes has distinct ``fp``."""
    n = nodes.count()
    blocks, agree = _plan(n, max_bits)
    bounds = [BITS * k // blocks for k in range(blocks + 1)]
    masks = []
    for choice in combinations(range(blocks), agree):
        mask = sum(((1 << (bounds[k + 1] - bounds[k])) - 1) << bounds[k] for k in choice)
        masks.append(mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask)
    keyed = nodes.select("fp", F.posexplode(F.array(*(F.lit(m).cast("bigint") for m in masks))).alias("choice", "mask"))
    keyed = keyed.select("fp", "choice", F.expr("fp & mask").alias("key"))
    large = keyed.groupBy("choice", "key").count().filter(F.col("count") > PART).withColumn("parts", F.ceil(F.col("count") / (PART // 2)).cast("int")).drop("count")
    dealt = keyed.join(large, ["choice", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # a part meets every other part of its key: pair (i, j) with i <= j
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("fp", "choice", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def links() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            key = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("choice", "key", "i", "j")])
            fps = np.ascontiguousarray(table.column("fp").to_numpy()).view(np.uint64)
            group = np.cumsum(np.r_[0, (key[:, 1:] != key[:, :-1]).any(axis=0)])
            order = np.lexsort((_gray_rank(fps), group))
            fps = fps[order]
            label = GrayIndex(group[order], fps).forest(max_bits)
            at = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(fps[at].view(np.int64)), pa.array(fps[label[at]].view(np.int64))], ["a", "b"])

        def last_key(batch: pa.RecordBatch) -> int:
            """Where the batch's last key starts."""
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("choice", "key", "i", "j")])
            other = np.flatnonzero((key != key[:, -1:]).any(axis=0))
            return int(other[-1]) + 1 if len(other) else 0

        for batch in batches:
            if not batch.num_rows:
                continue
            cut = last_key(batch)
            if cut and size + cut >= PART // 4:  # whole keys only, and many at once
                held.append(batch.slice(0, cut))
                yield from links()
                held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += batch.num_rows
        if held:
            yield from links()

    parts = dealt.repartition("choice", "key", "i", "j").sortWithinPartitions("choice", "key", "i", "j")
    return parts.mapInArrow(search, "a bigint, b bigint").distinct()


def _forest(edges: DataFrame) -> tuple[DataFrame, int]:
    """Edges (a, b) that connect what the given ones connect, and how many parts they were dealt to: each part, ``LOCAL`` edges or so, becomes stars around its smallest nodes."""
    parts = max(1, -(-edges.count() // LOCAL))

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("a", "b"))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = _join(np.arange(len(nodes)), at[: len(a)], at[len(a) :])
        down = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[down]), pa.array(nodes[label[down]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if held and sum(x.num_rows for x in held) + batch.num_rows > LOCAL:  # bounded memory, however large a task's input
                yield stars(held)
                held = []
            held.append(batch)
        if held:
            yield stars(held)

    found = materialize(edges.coalesce(parts).mapInArrow(run, "a bigint, b bigint"), "edges")
    discard(edges)
    return found, parts


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): alternating star contraction over edges (a, b); nodes without edges are absent.

    In the first round tasks turn their own edges into forests, ``LOCAL`` of them or so at a time; where one
    such part held all edges, that is the result. Else each further round is two aggregations and joins,
    written to the shared folder, and forests again. There are none once every node is either a root or has
    one edge, to a root. Rounds are logarithmic in the number of nodes; if ``max_rounds`` did not suffice
    this raises.
    """
    edges, parts = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b"), "edges"), 0
    if max_rounds:
        edges, parts = _forest(edges)
    for k in range(min(1, max_rounds), max_rounds + 1):
        settled = parts == 1
        if not settled:
            ends = edges.select(F.col("a").alias("node"), "b").unionByName(edges.select(F.col("b").alias("node"), F.lit(None).cast("bigint").alias("b")))
            # a node with an edge down that has another one, or an edge up
            ends = ends.groupBy("node").agg(F.min("b").alias("least"), F.max("b").alias("most"), F.count_if(F.col("b").isNull()).alias("above"))
            settled = ends.filter("least <> most OR least IS NOT NULL AND above > 0").isEmpty()
        if settled:
            edges = edges if parts == 1 else edges.distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        if k == max_rounds:
            break
        # what joins read is written before, so that Spark can split the rows of a hub over many tasks
        # large star: every neighbour above a node goes to the smallest one around it
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
        large = materialize(both.filter("b > a").join(around, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct(), "large")
        # small star: a node and its smaller neighbours go to the smallest of them
        below = materialize(large.groupBy("a").agg(F.min("b").alias("least")), "least")
        pairs = large.join(below, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        after = materialize(pairs.unionByName(below.select("a", F.col("least").alias("b"))).filter("a <> b").distinct(), "edges")
        for used in (around, large, below):
            discard(used)
        discard(edges)
        edges, parts = _forest(after)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(documents: DataFrame, max_bits: int = MAX_BITS, doc_id: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id): every row, with a fingerprint that stands for its class and the smallest doc_id of the class."""
    docs = materialize(fingerprints(documents, doc_id, text_col, shingle, seed), "fingerprints")
    nodes = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")), "nodes")
    linked = materialize(nodes.join(classes(nodes.select("fp"), max_bits), "fp"), "linked")
    smallest = materialize(linked.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")), "smallest")
    named = materialize(join_hot(linked, smallest, "root", F.col("n"), nodes.count()).select("fp", "root", "component_id", "rows"), "classes")
    return join_hot(docs, named, "fp", F.col("rows"), docs.count()).select("doc_id", "text_hash", "fp", "root", "component_id")


def classes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root): a fingerprint that stands for its class, for each of the distinct ``fp``."""
    roots = connected_components(_forest_edges(fps, max_bits))
    return fps.join(roots, fps.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def hex_digits(fp: str = "fp") -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class, that with the smallest doc_id (null last), with the input's columns.

    Of several rows with that doc_id in the class, the text with the smallest hash stays; of rows
    equal in both, any one.
    """
    found = near_duplicates(documents, doc_id=doc_id, text_col=text_col, **options)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = found.groupBy("root").agg(F.min(rank).alias("kept")).select(F.col("kept.doc_id").alias("_id"), F.col("kept.text_hash").alias("_hash"))
    rows = documents.select(F.struct("*").alias("doc"), F.col(doc_id).alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_hash"))
    rows = rows.alias("d").join(kept.alias("k"), F.col("d._id").eqNullSafe(F.col("k._id")) & (F.col("d._hash") == F.col("k._hash"))).select("d.*")
    first = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_hash"))
    return rows.withColumn("_n", first).filter("_n = 1").select([F.col("doc").getField(c).alias(c) for c in documents.columns])
