"""Near copies: SimHash classes first, then whatever else has an exact Jaccard similarity of word shingles.

A text is the set of its lower-cased word shingles; two texts link if their sets' Jaccard similarity
is ``SIMILAR`` at least, and documents are one class if links connect them.

SimHash alone cannot give that: at a similarity of 0.8 fingerprints differ by about 5 to 12 bits, and
an index over so many bits would hold each fingerprint some thousand times. So the fingerprints of the
same shingles, linked by the Gray-order index of ``simhash``, find copies and close copies; each is
confirmed on whole sets with the first one of its class. What these leave is found by prefixes.

Prefixes. Equal sets are one node. Shingles have one order for all texts, rare ones first as
far as a sample tells; two sets that link share a shingle among the first fifth or so of the larger
and the first ninth of the smaller (prefix filtering), whatever the order, so nodes meet by these
shingles and by nothing else; pairs whose first common shingle comes too late for the similarity are
passed over. Where the pairs that meet at a shingle are many, its nodes are compared with one of them
only and what links is joined, so that a large group of copies is not compared pair by pair; then all
pairs that are in no class together are. Of shingles with the same nodes the first serves for all, and
a pair meets at the first shingle that it shares, as far as ``EARLIER`` shingles before tell: what is left
out comes up at the other. Pairs that meet must also differ in few of ``PARITY`` bits, which is asked within the join. Every pair is confirmed on its whole sets; before these are made, the counts of both sets' shingles in ``BUCKETS`` buckets tell pairs that cannot share enough, and
then those in up to ``FINE`` buckets do.

Shingles are 48-bit hashes. Results in special cases: texts without words (null too) are equal; a
text with fewer words than a shingle is one shingle; repeated rows leave one; very long texts are
hashed piece by piece, and their sets are one value of a row; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import discard, in_slices, join_hot, materialize, may_match, share, small_batches
from tessera.llm.simhash import classes as simhash_classes
from tessera.llm.simhash import connected_components, fingerprint_of, shingle_hashes

SHINGLE = 5
#: The similarity that links, as a fraction.
SIMILAR = (4, 5)
#: Documents that tell rare shingles from common ones, and common ones listed at most; both bear on the time only.
SAMPLE, LISTED = 8000, 200_000
#: Pairs that may meet at a shingle for each of its nodes, before these are compared with one of them only; rounds of that at most, and the share of a round's pairs that must link for another.
MEETINGS, STARS, YIELD = 8, 8, 0.1
#: Shingles before a post that tell whether a pair has met already; more of them only save pairs that come up twice.
EARLIER = 16
#: Bits that tell whether a set has an odd number of shingles in each of as many buckets.
PARITY = 512
#: Buckets in which a set's shingles are counted, in a byte each: those that every pair is judged by, and most of those for pairs that these leave.
BUCKETS, FINE = 128, 1024


def grams(hashes: list[np.ndarray]) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *hashes]) >> np.uint64(16)).astype(np.int64)


def pack(found: np.ndarray) -> bytes:
    return found.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view("<i8").reshape(-1)


def similar(a: bytes, b: bytes) -> bool:
    """Whether two packed sets link."""
    x, y = unpack(a), unpack(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return SIMILAR[1] * both >= SIMILAR[0] * (len(x) + len(y) - both)


def counts(found: np.ndarray, buckets: int = BUCKETS) -> bytes | None:
    """How many of a set's shingles fall into each bucket; nothing if a byte does not hold that."""
    each = np.bincount(found & (buckets - 1), minlength=buckets)
    return each.astype(np.uint8).tobytes() if len(found) == 0 or each.max() < 256 else None


def parity(found: np.ndarray) -> np.ndarray:
    """Whether the number of a set's shingles in each bucket is odd, as longs: two sets differ in as many shingles at least as these differ in bits."""
    return np.packbits(np.bincount(found & (PARITY - 1), minlength=PARITY) & 1).view(np.int64)


def may_link(x: list[bytes | None], y: list[bytes | None]) -> np.ndarray:
    """Whether sets with these counts can link: what they share is at most the smaller count in each bucket."""
    out = np.array([a is None or b is None for a, b in zip(x, y)], bool)
    at = np.flatnonzero(~out)
    if len(at):
        a, b = (np.frombuffer(b"".join(s[i] for i in at), np.uint8).reshape(-1, BUCKETS).astype(np.int32) for s in (x, y))
        out[at] = (SIMILAR[0] + SIMILAR[1]) * np.minimum(a, b).sum(axis=1) >= SIMILAR[0] * (a.sum(axis=1) + b.sum(axis=1))
    return out


def fine_counts(found: np.ndarray) -> bytes | None:
    """The counts in about as many buckets as the set has shingles, a power of two of ``FINE`` at most."""
    return counts(found, min(FINE, 1 << len(found).bit_length()))


def may_link_finely(x: bytes | None, y: bytes | None) -> bool:
    """Whether sets with these fine counts can link; the buckets of the larger number are put together."""
    if x is None or y is None:
        return True
    size = min(len(x), len(y))
    a, b = (np.frombuffer(s, np.uint8).reshape(-1, size).sum(axis=0, dtype=np.int32) for s in (x, y))
    return bool((SIMILAR[0] + SIMILAR[1]) * np.minimum(a, b).sum() >= SIMILAR[0] * (a.sum() + b.sum()))


def _common(texts: DataFrame) -> np.ndarray:
    """Common shingles of a sample, those of most texts last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *(grams(list(shingle_hashes(t.as_py(), SHINGLE))) for t in batch.column(0))]))], ["gram"])

    every = max(1, texts.count() // SAMPLE)
    sample = texts.filter(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(every)) == 0).select("text")
    counted = sample.mapInArrow(run, "gram bigint").groupBy("gram").count().filter("count > 1")
    listed = counted.orderBy(F.desc("count"), "gram").limit(LISTED).select("gram").toArrow()  # rows would take some hundred bytes each
    return listed.column("gram").to_numpy()[::-1].astype(np.int64)


def _sets(documents: DataFrame, doc_id: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, node, fp, n, first, counted, fine, odd): of every row's set its hash, fingerprint, size, first shingles, and counts in buckets and their parities."""
    text = F.col(text_col).cast("string")
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    small_batches(documents.sparkSession)
    common = _common(rows)
    by_gram = np.argsort(common)
    shared = share(documents.sparkSession, (common[by_gram], by_gram))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = shared()
        for batch in in_slices(batches):
            nodes, fps, sizes, first, counted, fine, odd = [], [], [], [], [], [], []
            for t in batch.column(2):
                hashes = list(shingle_hashes(t.as_py(), SHINGLE))
                fps.append(fingerprint_of(hashes))
                found = grams(hashes)
                n = len(found)
                rank = np.full(n, -1)
                if n and len(known):
                    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    rank = np.where(known[at] == found, place[at], -1)
                # a set that links shares at least this part of this one
                keep = n - -(-n * SIMILAR[0] // SIMILAR[1]) + 1 if n else 0
                nodes.append(xxhash.xxh64_intdigest(pack(found)) - (1 << 63))
                sizes.append(n)
                counted.append(counts(found))
                fine.append(fine_counts(found))
                odd.append(parity(found))
                first.append(found[np.argsort(rank, kind="stable")[:keep]])
            new = [pa.array(nodes, pa.int64()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(first, pa.list_(pa.int64())), pa.array(counted, pa.binary()), pa.array(fine, pa.binary()), pa.array(odd, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], ["doc_id", "text_hash", "node", "fp", "n", "first", "counted", "fine", "odd"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash bigint, node bigint, fp bigint, n int, first array<bigint>, counted binary, fine binary, odd array<bigint>"
    return materialize(rows.mapInArrow(compute, schema), "sets")


class Sets:
    """The table of ``_sets``, and the packed sets of the nodes asked for, made anew from their texts: sets are as large as the texts, and few are ever compared."""

    def __init__(self, documents: DataFrame, doc_id: str, text_col: str):
        text = F.col(text_col).cast("string")
        self.texts = documents.select(F.xxhash64(text).alias("text_hash"), text.alias("text"))
        self.rows = _sets(documents, doc_id, text_col)
        self.nodes = materialize(self.rows.groupBy("node").agg(F.min("text_hash").alias("text_hash"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("counted").alias("counted"), F.first("odd").alias("odd"), F.count(F.lit(1)).alias("rows")), "nodes")

    def prefixes(self) -> DataFrame:
        """(node, n, first) of each node with shingles; only what several rows may share is shuffled."""
        rows = may_match(self.rows.filter("n > 0").select("node", "n", "first"), self.nodes.filter("rows > 1"), "node")
        return rows.filter("NOT maybe").drop("maybe").unionByName(rows.filter("maybe").groupBy("node").agg(F.first("n").alias("n"), F.first("first").alias("first")))

    def fine(self, asked: DataFrame) -> DataFrame:
        """(node, fine) of the nodes asked for."""
        near = may_match(self.rows.select("node", "fine"), asked, "node").filter("maybe").drop("maybe")
        return materialize(near.groupBy("node").agg(F.first("fine").alias("fine")), "fine")

    def packed(self, asked: DataFrame) -> DataFrame:
        """(node, packed) of the nodes asked for."""
        wanted = materialize(asked.join(self.nodes, "node").select("node", "text_hash"), "asked")
        near = may_match(self.texts, wanted, "text_hash").filter("maybe").drop("maybe")
        found = near.join(wanted, "text_hash").groupBy("node").agg(F.first("text").alias("text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in in_slices(batches):
                sets = [pack(grams(list(shingle_hashes(t.as_py(), SHINGLE)))) for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "packed"])

        out = materialize(found.mapInArrow(run, "node bigint, packed binary"), "candidates")
        discard(wanted)
        return out


def _confirm(pairs: DataFrame, sets: Sets) -> DataFrame:
    """The pairs (a, b, ...) whose whole sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            keep = [similar(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["a", "b"]).filter(pa.array(may_link(batch.column("x").to_pylist(), batch.column("y").to_pylist())))

    def finely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [may_link_finely(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def both(pairs: DataFrame, of_node: DataFrame) -> DataFrame:
        """The pairs with what ``of_node`` says of each side, as x and y."""
        return pairs.join(of_node.toDF("a", "x"), "a").join(of_node.toDF("b", "y"), "b").select("a", "b", "x", "y")

    def asked(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()

    coarse = materialize(both(pairs, sets.nodes.select("node", "counted")).mapInArrow(possible, "a bigint, b bigint"), "possible")
    fine = sets.fine(asked(coarse))
    pairs = materialize(both(coarse, fine).mapInArrow(finely, "a bigint, b bigint"), "possible")
    held = sets.packed(asked(pairs))
    found = materialize(both(pairs, held).mapInArrow(run, "a bigint, b bigint"), "links")
    for used in (coarse, fine, held, pairs):
        discard(used)
    return found


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Add each node's root, itself if it has no links; only rows of nodes with links are shuffled, and a few more."""
    rows = may_match(rows, roots, "node")
    linked = rows.filter("maybe").drop("maybe").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return linked.unionByName(rows.filter("NOT maybe").drop("maybe").withColumn("root", F.col("node")))


def _undecided(now: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The posts (node, n, at, gram, root) of shingles whose nodes are not all in one class, as no others can bring two classes together; and these shingles, with the pairs that meet there.

    Of shingles that the same nodes have, only the first stays: shingles have one order, so it comes first
    in each of these nodes, and what two nodes share first is the first of its kind. Some posts of other
    shingles come along (``may_match``); they meet nothing new. The pairs of equal root are estimated from
    a sum of signs that depend on the root: its square is right on average.
    """
    sign = F.pmod(F.xxhash64("root"), F.lit(2)) * 2 - 1
    who = [F.min("node").alias("least"), F.max("node").alias("most"), F.bit_xor(F.xxhash64("node")).alias("who"), F.min_by("at", "node").alias("at")]
    grams = now.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("posts"), F.sum(sign).alias("s"), *who).filter("low <> high")
    grams = grams.groupBy("posts", "least", "most", "who").agg(F.min_by("gram", "at").alias("gram"), F.first("s").alias("s"))
    grams = materialize(grams.select("gram", "posts", ((F.col("posts") * F.col("posts") - F.col("s") * F.col("s")) / 2).alias("pairs")), "grams")
    return materialize(may_match(now, grams, "gram").filter("maybe").drop("maybe"), "posts"), grams


def _meetings(now: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of posts of one shingle whose sets are in no class together and may link, repeats left out as far as the shingles before tell.

    With the parities (node, odd), pairs that these tell apart are no rows of the join either.
    """
    before = F.collect_list("gram").over(Window.partitionBy("node").orderBy("at").rowsBetween(-EARLIER, -1))
    now = now.withColumn("before", before)
    if nodes is not None:
        now = now.join(may_match(nodes.select("node", "odd"), now, "node").filter("maybe").drop("maybe"), "node")
    now = materialize(now, "posts")
    # the smaller of two sets that link has its first common shingle in its first ninth
    x, y = now.filter((SIMILAR[0] + SIMILAR[1]) * F.col("at") <= (SIMILAR[1] - SIMILAR[0]) * F.col("n")).alias("x"), now.alias("y")
    larger = (F.col("y.n") > F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.node") > F.col("x.node")))
    col = lambda side: {c: F.col(f"{side}.{c}") for c in ("n", "at")}
    new = ~F.arrays_overlap("x.before", "y.before")  # at a shingle before, all that is asked here holds as well
    meet = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.root") != F.col("y.root")) & larger & _fits(col("x"), col("y"))
    if nodes is not None:
        apart = sum((F.bit_count(F.col("x.odd")[k].bitwiseXOR(F.col("y.odd")[k])) for k in range(PARITY // 64)), F.lit(0))
        meet &= (SIMILAR[0] + SIMILAR[1]) * apart <= (SIMILAR[1] - SIMILAR[0]) * (F.col("x.n") + F.col("y.n"))
    met = x.join(y, meet & new)
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _fits(x, y) -> Column:
    """Whether two sets can link if this is the first shingle that they share: what they share is not before it in either."""
    most = F.least(x["n"] - x["at"], y["n"] - y["at"])
    return (SIMILAR[0] + SIMILAR[1]) * most >= SIMILAR[0] * (x["n"] + y["n"])


def close_copies(sets: Sets) -> DataFrame:
    """Links (a, b) between nodes of one SimHash class, each with the class's first node, as far as whole sets confirm them."""
    nodes = sets.nodes.select("node", "fp")
    known = nodes.join(simhash_classes(nodes.select("fp").distinct()), "fp")
    first = known.groupBy("root").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = join_hot(known, materialize(first, "first"), "root", F.col("n"), nodes.count()).filter("node <> b")
    return _confirm(materialize(pairs.select(F.col("node").alias("a"), "b"), "pairs"), sets)


def classes(sets: Sets) -> DataFrame:
    """(node, root): a node that stands for its class, for every node with links."""
    roots = connected_components(close_copies(sets))
    now, grams = _undecided(_rooted(sets.prefixes(), roots).select("node", "n", "root", F.posexplode("first").alias("at", "gram")))
    def joined(roots: DataFrame, found: DataFrame) -> DataFrame:
        """Edges that connect what the classes so far and these links connect."""
        return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found)

    for star in range(STARS):
        crowded = grams.filter(F.col("pairs") > MEETINGS * F.col("posts")).select("gram")
        if crowded.isEmpty():
            break
        met = may_match(now, crowded, "gram").filter("maybe").drop("maybe")
        center = met.groupBy("gram").agg(F.min(F.struct(F.xxhash64("node", F.lit(star)).alias("by"), "node", "n", "at", "root")).alias("c"))
        pairs = met.join(center, "gram").filter((F.col("root") != F.col("c.root")) & _fits(met, F.col("c")))
        pairs = materialize(pairs.select(F.col("node").alias("a"), F.col("c.node").alias("b")).distinct(), "pairs")
        found = _confirm(pairs, sets)
        roots = connected_components(joined(roots, found))
        before = now, grams
        rooted = materialize(_rooted(now.drop("root"), roots), "rooted")
        now, grams = _undecided(rooted)
        for used in (*before, rooted):
            discard(used)
        if found.count() < YIELD * pairs.count():
            break
    found = _confirm(materialize(_meetings(now, sets.nodes).distinct(), "pairs"), sets)
    return connected_components(joined(roots, found))


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, that with the smallest doc_id (null last), with the input's columns.

    Of several rows with that doc_id in the class, the text with the smallest hash stays; of rows
    equal in both, any one.
    """
    sets = Sets(documents, doc_id, text_col)
    roots = classes(sets)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    own = sets.rows.groupBy("node").agg(F.min(rank).alias("kept"))
    kept = own.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("kept").alias("kept"))
    kept = kept.select(F.xxhash64(F.xxhash64("kept.doc_id"), "kept.text_hash").alias("_key"))
    # rows whose key stands for one row, and that is kept, pass without a shuffle
    keys = sets.rows.groupBy(F.xxhash64(F.xxhash64("doc_id"), "text_hash").alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    judged = materialize(keys.join(kept.withColumn("stays", F.lit(True)), "_key", "left"), "judged")
    rows = documents.select(F.struct("*").alias("doc"), F.xxhash64(F.xxhash64(F.col(doc_id)), F.xxhash64(F.col(text_col).cast("string"))).alias("_key"))
    rows = may_match(rows, judged.filter("n > 1 OR stays IS NULL"), "_key")
    first = F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(1)))
    unsure = rows.filter("maybe").join(judged.filter("stays").select("_key"), "_key", "left_semi").withColumn("_n", first).filter("_n = 1")
    found = rows.filter("NOT maybe").select("doc").unionByName(unsure.select("doc"))
    return found.select([F.col("doc").getField(c).alias(c) for c in documents.columns])
