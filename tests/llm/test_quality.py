"""Multiple-instance quality classifier: gradients, held-out accuracy, special cases."""

import math
import random
import zlib

import numpy as np
import pytest
import xxhash

from tessera.llm import langid, quality
from tessera.llm.queries import QUERIES


def test_passages_hold_the_whole_text():
    for text in (None, "", "a", "x" * 5000, "é ñ\n" * 3000, " ".join(["word"] * 4000)):
        parts = quality.passages(text)
        assert b"".join(parts) == (text or "").encode() and max(map(len, parts)) <= quality.PASSAGE


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    x, starts, y = rng.normal(size=(9, 5)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])
    net = quality.Network(x.mean(axis=0), x.std(axis=0))

    def loss():
        s = net.forward(x, starts)[0]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    s, kept = net.forward(x, starts)
    for name, g in net.gradients(s, y, kept, starts).items():
        for at in list(np.ndindex(g.shape))[:6]:
            old, eps = net.p[name][at], 1e-6
            net.p[name][at] = old + eps
            up = loss()
            net.p[name][at] = old - eps
            down = loss()
            net.p[name][at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 1e-6


def corpus(n=400):
    rng, rows, labels = random.Random(4), [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("aeioustnr") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(5, 400))]
        text = " ".join(words).capitalize() + "." if good else " ".join(w + rng.choice(["%%%", "$$$", "###"]) for w in words)
        rows.append((i, text, "s", 0.5))
        labels.append((i, int(good), None))
    return rows, labels


def test_held_out_accuracy_and_special_cases(spark):
    rows, labels = corpus()
    special = [(1000, None, None, 0.0), (1001, "", None, 0.0), (None, "Plain words here.", None, 0.0), (1002, "good words. " * 50_000, None, 0.0), rows[3]]
    docs = spark.createDataFrame(rows + special, "doc_id bigint, text string, doc string, score double")
    marks = spark.createDataFrame([*labels, (3, None, 1), (None, 1, 0), (99999, 0, 0), (7, labels[7][1], 0)], "doc_id bigint, quality int, text int")
    learn = ~langid.in_part("doc_id", 4, 2)
    model = quality.fit(docs, marks, learn)
    found = quality.score(docs, model).collect()
    assert len(found) == len(rows) + len(special) and all(0 <= r.score <= 1 for r in found)
    truth = {i: q for i, q, _ in labels}
    held = {r.doc_id for r in docs.filter(langid.in_part("doc_id", 4, 2)).collect()}
    mine = [(r.score >= 0.7) == truth[r.doc.doc_id] for r in found if r.doc.doc_id in held and r.doc.doc_id in truth]
    assert len(mine) > 50 and np.mean(mine) > 0.97
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= 0.7 for r in found)


def test_held_out_labels_teach_nothing(spark):
    rows, labels = corpus(120)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, x string, y double")
    marks = spark.createDataFrame([(i, q) for i, q, _ in labels], "doc_id bigint, quality int")
    from pyspark.sql import functions as F

    other = marks.withColumn("quality", F.when(langid.in_part("doc_id", 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    learn = ~langid.in_part("doc_id", 4, 2)
    a, b = quality.fit(docs, marks, learn), quality.fit(docs, other, learn)
    assert all(np.array_equal(a.p[k], b.p[k]) for k in a.p)


def plain_score(text, net):
    """The score of a text by loops over its passages."""
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    p = {k: v.astype(float) for k, v in net.p.items()}
    hidden, weights = [], []
    for part in quality.passages(text):
        x = np.clip((quality.encode([part])[0] - net.mean) / net.scale, -8, 8).astype(float)
        x[quality._COUNTED :] *= len(part) / (len(part) + quality.EVIDENCE)
        h = [math.tanh(sum(x[i] * p["We"][i, j] for i in range(len(x))) + p["be"][j]) for j in range(quality.HIDDEN)]
        gate = [math.tanh(sum(h[i] * p["V"][i, j] for i in range(len(h)))) * sigmoid(sum(h[i] * p["U"][i, j] for i in range(len(h)))) for j in range(quality.ATTENTION)]
        hidden.append(h)
        weights.append(math.exp(sum(g * w for g, w in zip(gate, p["w"]))))
    z = [sum(w * h[j] for w, h in zip(weights, hidden)) / sum(weights) for j in range(quality.HIDDEN)]
    return sigmoid(sum(a * b for a, b in zip(z, p["c"])) + p["b"][0])


def signed(raw):
    h = xxhash.xxh64_intdigest(raw, 42)
    return h - 2**64 if h >= 2**63 else h


def test_query_equals_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op10_quality"](spark, sf).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    marks = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        if r.doc_id in texts and r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            marks.setdefault(r.doc_id, []).append(r.quality)
    bags = {(signed(texts[i].encode()), float(np.mean(v) >= 0.5)): texts[i] for i, v in marks.items() if texts[i] is not None}
    order = sorted(bags)
    net = quality.train([quality.encode(quality.passages(bags[k])) for k in order], np.array([k[1] for k in order]))
    assert set(got) == set(texts)
    for i, text in texts.items():
        assert abs(got[i].score - plain_score(text, net)) < 1e-4
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and got[i].predicted == int(got[i].score >= 0.7)


def test_labels_of_absent_documents_take_no_place(spark):
    rows, labels = corpus(40)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, x string, y double")
    absent = spark.range(1000, 101_000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    marks = spark.createDataFrame([(i, q) for i, q, _ in labels], "doc_id bigint, quality int")
    model, same = (quality.fit(docs, x, langid.in_part("doc_id", 1, 0)) for x in (marks.unionByName(absent), marks))
    assert isinstance(model, quality.Network) and all(np.array_equal(model.p[k], same.p[k]) for k in model.p)


def test_training_takes_every_passage_and_settles():
    rng = np.random.default_rng(5)
    bags, labels = [], []
    for k in range(60):  # one telling passage among many
        bag = rng.normal(size=(300, 6)).astype(np.float32)
        bag[rng.integers(300), 0] += 40 * (k % 2)
        bags.append(bag)
        labels.append(float(k % 2))
    net = quality.train(bags, np.array(labels))
    starts = np.cumsum([0, *map(len, bags[:-1])])
    assert ((net.forward(np.concatenate(bags), starts)[0] >= 0.5) == np.array(labels)).mean() > 0.95


@pytest.mark.parametrize(("labels", "share"), [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0)])
def test_labels_of_one_kind(spark, labels, share):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    from pyspark.sql import functions as F

    model = quality.fit(docs, marks, F.lit(True))
    assert [r.score for r in quality.score(docs, model).collect()] == [share] * 2
    assert quality.score(docs.limit(0), model).count() == 0
