"""SimHash against brute force: fingerprints, all pairs within the distance, classes."""

import random

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash


def brute_fingerprint(text):
    words = [w.encode() for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def texts():
    rng = random.Random(3)
    words = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 3, 4, 5, 60, 90, 200, 300)]
    near = []
    for b in base[5:]:
        for _ in range(6):
            w = b.split()
            w[rng.randrange(len(w))] = rng.choice(words)
            near.append("\n".join(w))
    return [None, "", "  \t\v\f\r", *base, *base[:3], *near, "x" * 70_000 + " y" * 70_000, "a b c d"]


def test_fingerprint_equals_brute_force():
    for t in texts():
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def clusters(n, seed):
    rng = np.random.default_rng(seed)
    out = set()
    while len(out) < n:
        center = int(rng.integers(0, 2**63)) * 2 + 1
        for _ in range(int(rng.integers(1, 12))):
            x = center
            for b in rng.integers(0, 64, int(rng.integers(0, 7))):
                x ^= 1 << int(b)
            out.add(x)
            if rng.random() < 0.5:
                center = x
    return np.array(sorted(out), np.uint64)[:n]


@pytest.mark.parametrize("keys", [1, 7])
def test_tree_gives_the_classes_of_each_key(keys):
    fps = clusters(600, 5)
    group = (fps % np.uint64(keys)).astype(np.int64)
    order = np.lexsort((simhash._gray_rank(fps), group))
    fps, group = fps[order], group[order]
    label = simhash.GrayIndex(group, fps).forest(4)
    for g in range(keys):
        at = np.flatnonzero(group == g)
        mine = brute_classes([int(x) for x in fps[at]])
        assert {(a, b) for a in range(len(at)) for b in range(a) if mine[a] == mine[b]} == {(a, b) for a in range(len(at)) for b in range(a) if label[at[a]] == label[at[b]]}


def test_gray_rank_inverts_the_gray_code():
    x = np.arange(1000, dtype=np.uint64)
    assert (simhash._gray_rank(x ^ (x >> np.uint64(1))) == x).all()


@pytest.mark.parametrize("n", [100, 10**7, 10**9, 10**12])
def test_any_plan_keeps_a_common_key(n):
    blocks, agree = simhash._plan(n, 4)
    assert blocks - agree == 4


@pytest.mark.parametrize("part", [simhash.PART, 40])
def test_links_over_keys_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)  # small: keys are dealt out as pairs of parts
    fps = clusters(500, 9)
    fps = np.concatenate([fps, (fps[0] ^ (np.uint64(1) << np.arange(3, dtype=np.uint64)))])
    fps = np.unique(fps)
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    roots = {r.node: r.root for r in simhash.connected_components(simhash._forest_edges(nodes, 4)).collect()}
    mine = brute_classes([int(x) for x in fps])
    got = [roots.get(int(x), int(x)) for x in fps.view(np.int64)]
    assert {(a, b) for a in range(len(fps)) for b in range(a) if mine[a] == mine[b]} == {(a, b) for a in range(len(fps)) for b in range(a) if got[a] == got[b]}


def test_documents_and_survivors(spark):
    rows = [(i if i != 4 else None, t, "en", f"fp{i}") for i, t in enumerate(texts())]
    rows += [rows[7], rows[7], (3, "another text with the same id", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, root string, fp string")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    fps = [brute_fingerprint(r[1]) for r in rows]
    classes = brute_classes(fps)
    least = {c: min((r[0] for r, x in zip(rows, classes) if x == c and r[0] is not None), default=None) for c in classes}
    key = lambda x: str(x)
    assert sorted([(r.doc_id, r.fp % 2**64, r.component_id) for r in found], key=key) == sorted([(r[0], f, least[c]) for r, f, c in zip(rows, fps, classes)], key=key)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(classes))
    by_class = {}
    for r, c in zip(rows, classes):
        by_class.setdefault(c, []).append(r[0])
    assert sorted(map(key, (d for d, _ in got))) == sorted(key(least[c]) for c in by_class)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def test_stars_need_no_round_and_chains_do(spark):
    stars = spark.createDataFrame([(5, 1), (1, 6), (5, 1), (9, 8), (7, 7)], "a bigint, b bigint")
    assert {tuple(r) for r in simhash.connected_components(stars, max_rounds=0).collect()} == {(1, 1), (5, 1), (6, 1), (8, 8), (9, 8)}
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)], "a bigint, b bigint")
    assert {tuple(r) for r in simhash.connected_components(chain).collect()} == {(k, 0) for k in range(41)}
    with pytest.raises(RuntimeError):
        simhash.connected_components(chain, max_rounds=0)


def components(edges):
    root = {}
    for a, b in edges:
        x, y = root.setdefault(a, a), root.setdefault(b, b)
        root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    return root


@pytest.mark.parametrize("local", [1, 7, 40, simhash.LOCAL])
def test_components_of_parts_of_any_size(spark, monkeypatch, local):
    monkeypatch.setattr(simhash, "LOCAL", local)
    rng = random.Random(local)
    edges = [(k, k + 1) for k in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(50)] + [(300, 300 + k) for k in range(1, 20)] + [(7, 7)]
    rng.shuffle(edges)
    found = simhash.connected_components(spark.createDataFrame(edges + edges[:9], "a bigint, b bigint").repartition(6)).collect()
    want = components([e for e in edges if e[0] != e[1]])
    assert len(found) == len(want) and {r.node: r.root for r in found} == want


def test_components_of_few_edges_take_no_rounds(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)], "a bigint, b bigint")
    spark.sparkContext.setJobGroup("components", "")
    try:
        assert {r.root for r in simhash.connected_components(edges).collect()} == {0}
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("components")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 8
