"""Near copies against brute force over whole sets of shingles."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import near_copies


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_kept(rows):
    """Ids of the first row of each class."""
    sets, seen = [shingles(t) for _, t in rows], {}
    for i in range(len(rows)):
        group = {i} | {j for j in range(i) if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
        root = min(seen.get(j, j) for j in group)
        old = {seen.get(j, j) for j in group}
        seen = {j: root if r in old else r for j, r in seen.items()} | {i: root}
    return {rows[i][0] for i in set(seen.values())}


def texts():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    out = [None, "", " \t", "one two", "One  TWO", "a b c d e f"]
    for n in (30, 80, 150, 300):
        base = [rng.choice(words) for _ in range(n)]
        for edits in (0, 0, 1, 1, 2, 2, 3, 4, 5, 6, 8, 10):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(n)] = rng.choice(words)
            out.append(" ".join(w))
    return out + [passage + " " + " ".join(rng.choice(words) for _ in range(n)) for n in (5, 6, 20, 60)]


@pytest.mark.parametrize("meetings", [near_copies.MEETINGS, 0])
def test_stage_equals_brute_force(spark, monkeypatch, meetings):
    monkeypatch.setattr(near_copies, "MEETINGS", meetings)  # none: rounds of stars come first
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id bigint, text string, root string")
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(brute_kept(rows))


def posts(spark, shingles_of):
    """The posts of nodes of 90 shingles each, whose first ones are given."""
    rows = [(node, 90, node, at, gram) for node, grams in shingles_of.items() for at, gram in enumerate(grams)]
    return spark.createDataFrame(rows, "node bigint, n int, root bigint, at int, gram bigint")


def test_shingles_of_the_same_nodes_count_once(spark):
    now = posts(spark, {1: [10, 11, 12, 13], 2: [5, 11, 12, 13], 3: [6, 13], 4: [7, 8]})
    kept, grams = near_copies._undecided(now)
    assert {(r.gram, r.posts) for r in grams.collect()} == {(11, 2), (13, 3)}
    assert {(r.node, r.gram) for r in kept.collect()} >= {(1, 11), (2, 11), (1, 13), (2, 13), (3, 13)}


def test_a_pair_meets_once(spark):
    now = posts(spark, {1: [10, 11, 12, 13], 2: [10, 11, 12, 13], 3: [11, 12], 4: [12, 13], 5: [99]})
    met = near_copies._meetings(now).collect()
    assert sorted(tuple(sorted(r)) for r in met) == [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]


def test_parities_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(3)
    for n in (0, 1, 30, 146, 900):
        base = np.unique(rng.integers(0, 1 << 48, n))
        for gone in (0, n // 20, n // 9, n // 3):
            other = np.unique(np.concatenate([base[gone:], rng.integers(0, 1 << 48, gone)]))
            bits = int(np.bitwise_count((near_copies.parity(base) ^ near_copies.parity(other)).view(np.uint64)).sum())
            assert bits <= len(np.setxor1d(base, other)) and (bits - len(base) - len(other)) % 2 == 0


def test_a_large_group_of_near_copies_that_do_not_link_makes_no_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 40, 146)
    sets = {k: np.unique(np.concatenate([base[rng.permutation(146)[:116]], rng.integers(1 << 41, 1 << 48, 30)])) for k in range(80)}
    sets[80] = np.unique(np.concatenate([sets[0][:-4], rng.integers(1 << 41, 1 << 48, 4)]))  # a true link
    now = spark.createDataFrame([(k, len(s), k, 0, 7) for k, s in sets.items()], "node bigint, n int, root bigint, at int, gram bigint")
    nodes = spark.createDataFrame([(k, near_copies.parity(s).tolist()) for k, s in sets.items()], "node bigint, odd array<bigint>")
    links = {(a, b) for a in sets for b in sets if a < b and near_copies.similar(near_copies.pack(sets[a]), near_copies.pack(sets[b]))}
    met = {tuple(sorted(r)) for r in near_copies._meetings(now, nodes).collect()}
    assert (0, 80) in links <= met and near_copies._meetings(now).count() == 81 * 80 // 2
    assert len(met) < 81  # fewer than one for each node; the square was met before
