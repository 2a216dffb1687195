"""Graph search against brute force: exact on small shards, recall on larger ones, special cases."""

import numpy as np
import pytest

from tessera.llm import ann_graph as ann


def brute(rows, queries, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault((i, tuple(v)))
    out = {}
    for q, u in ok:
        if q in queries:
            best = {}
            for i, v in ok:
                if i != q and len(v) == len(u):
                    best[i] = max(best.get(i, -np.inf), float((np.array(u) * np.array(v)).sum()))
            have = out.setdefault(q, {})
            for i, s in best.items():
                have[i] = max(have.get(i, -np.inf), s)
    return {q: sorted(((-s, i) for i, s in best.items()))[:k] for q, best in out.items()}


def rows_of(seed, n, d, spread=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, d))
    x = centers[rng.integers(0, 6, n)] + 0.4 * rng.normal(size=(n, d))
    return x * rng.uniform(1, spread, (n, 1))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, score string, node int")


def test_exact_where_the_beam_holds_all(spark):
    x = np.round(rows_of(1, 70, 4), 1).tolist()
    rows = list(enumerate(x)) + [(100 + i, x[3]) for i in range(30)]  # many ties
    rows += [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 0.0]), (204, [float("nan"), 0.0, 0.0, 0.0]), (205, [float("inf"), 0.0, 0.0, 0.0]), (None, x[0])]
    rows += [(40, [1.0, 2.0]), (60, [3.0, -1.0]), (61, [0.5, 0.5]), (5, x[5]), (5, x[5]), (6, x[60]), (300, [1e200, 1e200, 0.0, -1e200]), (301, [1e-200, 0.0, 0.0, 0.0])]
    queries = {i for i, _ in rows if i is not None and i % 20 == 0}
    table = frame(spark, rows)
    found = ann.search(ann.build_index(table, 20, shard_rows=40), table.filter("vec_id % 20 = 0"), 20).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert len(got[r.query_id]) == r.rank
    assert got == brute(rows, queries, 20)


@pytest.mark.parametrize("spread", [1.0, 3.0])
def test_recall(spark, spread):
    x = rows_of(2, 3000, 24, spread)
    table = frame(spark, list(enumerate(x.tolist())))
    found = ann.search(ann.build_index(table, 20, shard_rows=1000), table.filter("vec_id % 20 = 0"), 20).collect()
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    true = {q: set(np.argsort(-s[q])[:20].tolist()) for q in range(0, 3000, 20)}
    assert np.mean([r.vec_id in true[r.query_id] for r in found]) >= 0.95 and len(found) == 150 * 20
    assert all(abs(r.score - s[r.query_id, r.vec_id]) < 1e-9 for r in found)


@pytest.mark.parametrize("jitter", [1e-2, 1e-4, 1e-6])
@pytest.mark.parametrize("size", [2, 60, 500])
def test_groups_of_jittered_copies(jitter, size):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1000, 32))
    x = np.r_[x, x[0] + jitter * rng.normal(size=(size, 32))].astype(np.float32).astype(float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    g = ann.Graph(x).build()
    asked = np.r_[0:20, 1000 : 1000 + min(size, 40)]
    ids, _ = g.search(np.c_[x[asked] / np.abs(x[asked]).max(axis=1, keepdims=True), np.zeros(len(asked))], ann.BEAM)
    true = np.argsort(-(x[asked] @ x.T), axis=1, kind="stable")[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(ids.tolist(), true.tolist())]) >= 0.95


def test_edges_are_diverse_and_bounded():
    g = ann.Graph(rows_of(3, 500, 8)).build()
    assert g.edges.shape == (500, ann.DEGREE)
    x = g.x.astype(float)
    for p in range(0, 500, 25):
        mine = [n for n in g.edges[p] if n >= 0]
        assert p not in mine and len(set(mine)) == len(mine)
    few = g.prune(np.array([0]), np.arange(500)[None, :])[0]
    few = [n for n in few if n >= 0]
    far = lambda a, b: ((x[a] - x[b]) ** 2).sum()
    assert all(ann.ALPHA**2 * far(a, b) > far(0, b) * 0.999 for k, b in enumerate(few) for a in few[:k])


def test_empty_and_single(spark):
    table = frame(spark, [(20, [1.0, 0.0])])
    assert ann.search(ann.build_index(table), table).count() == 0
    none = table.filter("vec_id < 0")
    assert ann.search(ann.build_index(none), none).count() == 0
