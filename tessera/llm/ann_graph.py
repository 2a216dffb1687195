"""Approximate nearest neighbours by inner product, over robust-pruned directed graphs.

Vectors of lengths of one order are hashed into shards of about ``SHARD_ROWS``. In a shard, vectors are scaled and given
one more component, so that all have the same length and nearness by distance is nearness by inner
product. Points are inserted in batches: a greedy beam search on the graph so far proposes
neighbours, and pruning with a relaxed distance (``ALPHA``) keeps diverse edges, also where edges
back to a point exceed its ``DEGREE``. A query searches every shard with a beam; what the beam ends
with is scored on the original vectors in double precision, and the shards' best are merged.

Equal vectors are one point, with the smallest ``k + 1`` ids (no answer needs more, as ties go to
the smaller id). The index is a table: build it once, search it many times.

Results in special cases: vectors null, empty, zero or with null or non-finite components take no
part, nor do null ids; vectors meet only those of their own length; rows that repeat an id with
another vector are one candidate, at its best score; vectors that differ by little are told apart in
double precision; repeated rows count once; fewer candidates
than ``k`` are all returned; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import materialize

SHARD_ROWS = 8192
DEGREE, BEAM, BUILD_BEAM = 48, 192, 96
ALPHA = 1.2
#: Points inserted and queries searched at once, and candidates expanded at once.
BATCH, WIDTH = 256, 3

_INDEX = "dim int, shard int, node bigint, vec array<double>, members array<bigint>, neighbours array<int>"
_FOUND = "query_id bigint, vec_id bigint, score double"


def points(embeddings: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec, members): the distinct vectors that take part, each with its smallest k + 1 ids."""
    rows = valid(embeddings, vec_id, vector).distinct()
    first = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    return rows.withColumn("n", first).filter(F.col("n") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))


def valid(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vec) of the rows that take part, as longs and doubles."""
    rows = embeddings.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))


class Graph:
    """A shard's points and their edges, padded with -1."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None):
        self.vectors = vectors
        scaled = vectors / np.abs(vectors).max()
        square = (scaled * scaled).sum(axis=1)
        self.square = float(square.max())
        self.x = np.c_[scaled, np.sqrt(np.maximum(self.square - square, 0))]
        self.entry = int((self.x @ self.x.mean(axis=0)).argmax())
        self.edges = edges

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and nearness (inner products) of the beam's points for each query, nearest first; -1 where there are fewer."""
        rows = np.arange(len(queries))[:, None]
        ids = np.full((len(queries), beam), -1)
        near = np.full((len(queries), beam), -np.inf)
        open_ = np.zeros((len(queries), beam), bool)
        seen = np.zeros((len(queries), len(self.x)), bool)
        ids[:, 0], near[:, 0], open_[:, 0], seen[:, self.entry] = self.entry, queries @ self.x[self.entry], True, True
        while open_.any():
            at = np.argsort(~open_, axis=1, kind="stable")[:, :WIDTH]  # the nearest not expanded yet
            chosen = np.where(open_[rows, at], ids[rows, at], -1)
            open_[rows, at] = False
            more = np.where(chosen[:, :, None] >= 0, self.edges[chosen], -1).reshape(len(queries), -1)
            more.sort(axis=1)
            fresh = more >= 0
            fresh[:, 1:] &= more[:, 1:] != more[:, :-1]
            fresh &= ~seen[rows, more]
            seen[np.nonzero(fresh)[0], more[fresh]] = True
            width = max(1, int(fresh.sum(axis=1).max()))
            at = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
            more, fresh = more[rows, at], fresh[rows, at]
            value = np.where(fresh, np.einsum("qd,qkd->qk", queries, self.x[more]), -np.inf)
            ids, near, open_ = np.c_[ids, np.where(fresh, more, -1)], np.c_[near, value], np.c_[open_, fresh]
            at = np.argsort(-near, axis=1, kind="stable")[:, :beam]
            ids, near, open_ = ids[rows, at], near[rows, at], open_[rows, at]
        return ids, near

    def prune(self, of: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """At most DEGREE diverse neighbours of each point, from its candidates (-1: none)."""
        rows = np.arange(len(of))[:, None]
        candidates = np.sort(np.where(candidates == of[:, None], -1, candidates), axis=1)
        live = candidates >= 0
        live[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
        near = np.where(live, np.einsum("pd,pkd->pk", self.x[of], self.x[candidates]), -np.inf)
        at = np.argsort(-near, axis=1, kind="stable")
        candidates, live = candidates[rows, at], live[rows, at]
        x = self.x[candidates]
        far = np.maximum(self.square - np.where(live, near[rows, at], 0), 0)  # half of squared distances
        apart = np.maximum(self.square - x @ x.transpose(0, 2, 1), 0)
        out = np.full((len(of), DEGREE), -1)
        for k in range(DEGREE):
            if not live.any():
                break
            first = live.argmax(axis=1)
            has = live[rows[:, 0], first]
            out[:, k] = np.where(has, candidates[rows[:, 0], first], -1)
            live &= ~(has[:, None] & (ALPHA**2 * apart[rows[:, 0], first] <= far))
            live[rows[:, 0], first] = False
        return out

    def insert(self, new: np.ndarray) -> None:
        """Search, prune, and add edges both ways."""
        self.connect(new, self.search(self.x[new], BUILD_BEAM)[0])

    def connect(self, new: np.ndarray, found: np.ndarray) -> None:
        """Give the new points edges to what pruning leaves of the candidates found, and these edges back."""
        self.edges[new] = self.prune(new, found)
        target = self.edges[new].ravel()
        source = np.repeat(new, DEGREE)[target >= 0]
        target = target[target >= 0]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        there = (self.edges[target] == source[:, None]).any(axis=1)
        target, source = target[~there], source[~there]
        points, start, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(start, count)
        back = np.full((len(points), int(count.max(initial=0))), -1)
        back[np.repeat(np.arange(len(points)), count), place] = source
        degree = (self.edges[points] >= 0).sum(axis=1)
        over = degree + count > DEGREE
        for at in np.array_split(np.flatnonzero(over), 1 + over.sum() // BATCH):
            if len(at):
                self.edges[points[at]] = self.prune(points[at], np.c_[self.edges[points[at]], back[at]])
        row = np.repeat(~over, count)
        self.edges[target[row], (np.repeat(degree, count) + place)[row]] = source[row]

    def build(self, seed: int = 11) -> Graph:
        n = len(self.x)
        self.edges = np.full((n, DEGREE), -1)
        order = np.random.default_rng(seed).permutation(n)
        order = np.r_[self.entry, order[order != self.entry]]
        done = min(n, 2 * DEGREE)
        if n > 1:  # the first points see each other all
            self.connect(order[:done], np.tile(order[:done], (done, 1)))
        while done < n:
            size = min(BATCH, done, n - done)
            self.insert(order[done : done + size])
            done += size
        return self


def build_index(embeddings: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The index table (dim, shard, node, vec, members, neighbours), written to the shared folder."""
    found = materialize(points(embeddings, k, vec_id, vector), "points")
    shards = max(1, -(-found.count() // shard_rows))
    # lengths within a shard are of one order, else the longest vectors would hide the differences of the others
    most = F.array_max(F.transform("vec", F.abs))
    length = F.log2(most) + F.log2(F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / most) * (x / most))) / 2
    band = F.floor((length + 1) / 2) + 2000  # unit vectors lie in the middle of a band
    dealt = found.select(F.size("vec").alias("dim"), (F.pmod(F.xxhash64("vec"), F.lit(shards)) + shards * band).cast("int").alias("shard"), "vec", "members")

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([("first", "ascending")])  # one order, so one graph
        vectors = group.column("vec").combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
        edges = Graph(vectors).build().edges
        kept = edges >= 0
        offsets = np.r_[0, np.cumsum(kept.sum(axis=1))]
        neighbours = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(edges[kept].astype(np.int32)))
        return pa.table([group.column("dim"), group.column("shard"), pa.array(np.arange(group.num_rows)), group.column("vec"), group.column("members"), neighbours], names=[c.split()[0] for c in _INDEX.split(", ")])

    # hashing bounds a group to about shard_rows points
    index = dealt.withColumn("first", F.col("members")[0]).groupBy("dim", "shard").applyInArrow(build, _INDEX)
    return materialize(index, "ann-index")


def search(index: DataFrame, queries: DataFrame, k: int = 20, beam: int = BEAM, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row, without the row's own id."""
    asked = valid(queries, vec_id, vector).distinct()
    shards = index.select("dim", "shard").distinct()
    none = [F.lit(None).cast("array<bigint>").alias("members"), F.lit(None).cast("array<int>").alias("neighbours")]
    # every shard of the query's length is asked
    sent = asked.withColumn("dim", F.size("vec")).join(shards, "dim").select("dim", "shard", F.lit(1).alias("kind"), F.col("vec_id").alias("id"), "vec", *none)
    nodes = index.select("dim", "shard", F.lit(0).alias("kind"), F.col("node").alias("id"), "vec", "members", "neighbours")
    met = nodes.unionByName(sent).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, graph, members = None, [], None, []
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("dim", "shard", "kind")])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if here != (key[0, a], key[1, a]):
                    here, held, graph = (key[0, a], key[1, a]), [], None
                if key[2, a] == 0:
                    held.append(part)
                    continue
                if graph is None:  # all nodes of the shard came before its queries
                    table = pa.Table.from_batches(held)
                    vectors = table.column("vec").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
                    edges = np.full((table.num_rows, DEGREE), -1)
                    lists = table.column("neighbours").combine_chunks()
                    count = lists.value_lengths().to_numpy()
                    edges[np.repeat(np.arange(len(count)), count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)] = lists.flatten().to_numpy()
                    graph, members, held = Graph(vectors, edges), table.column("members").to_pylist(), []
                for at in range(0, part.num_rows, BATCH):
                    yield answers(graph, members, part.slice(at, BATCH), k, beam)

    found = met.mapInArrow(run, _FOUND).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def answers(graph: Graph, members: list[list[int]], asked: pa.RecordBatch, k: int, beam: int) -> pa.RecordBatch:
    """The k best of one shard for each query row, scored on the original vectors."""
    own = asked.column("id").to_pylist()
    queries = asked.column("vec").flatten().to_numpy().reshape(len(own), -1)
    scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
    ids, _ = graph.search(np.c_[scaled, np.zeros(len(own))], max(beam, k + 1))
    scores = (graph.vectors[ids] * queries[:, None, :]).sum(axis=2)
    rows: list[tuple[int, int, float]] = []
    for q, nodes, values in zip(own, ids.tolist(), scores.tolist()):
        best = sorted((-v, m) for n, v in zip(nodes, values) if n >= 0 for m in members[n] if m != q)[:k]
        rows += [(q, m, -v) for v, m in best]
    columns = list(zip(*rows)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])
