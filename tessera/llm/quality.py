"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages of about ``PASSAGE`` bytes, cut at white space; all its text is in
one of them. A passage is encoded by what its bytes and words look like (classes of characters,
lengths and repetition of words, compressibility), by its hashed sequences of ``GRAM`` bytes (parts of
words, in ``BUCKETS``) and a learned layer. Gated attention learns from document labels how much each
passage weighs; the weighted passage representation is scored.

Training takes a bounded sample, the ``MAX_BAGS`` labelled documents of the table whose ids hash
smallest, with all their passages, and goes on until the loss has settled: until ``PATIENCE`` steps
have bettered it by less than ``SETTLED`` of itself. Scoring takes every passage of every text.

Results in special cases: null and empty texts are one passage of nothing and get a score too;
several labels of a document count by their mean (1 if at least half); null labels are left out;
labels of absent documents teach nothing and take no place in the sample; repeated rows are each
scored; very long texts are more passages, taken some at a time; with no labels at all, or of one
kind only, every score is that kind's share (0.5 without labels); an empty table gives no rows;
further columns are kept in ``doc``, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import in_slices, share, small_batches, text_of

PASSAGE = 1024
MAX_BAGS = 4000
#: Bytes of a hashed sequence, and the buckets these fall into.
GRAM, BUCKETS = 4, 256
#: Bytes of a passage at which its hashed sequences count for half of what they say.
EVIDENCE = 1024
#: Widths of the encoder and of the attention, and the rate of training.
HIDDEN, ATTENTION, RATE = 24, 12, 0.02
#: Training ends when the best loss falls by less than a share in so many steps.
PATIENCE, SETTLED = 40, 0.02
THRESHOLD = 0.7

_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b"\t\v\f",
    b".", b",;:", b"!", b"?", b"'\"`", b"()[]{}<>", b"|", b"#", b"$%&*", b"+-=_/\\~^@", bytes(range(128, 192)), bytes(range(192, 256)),
)
_CLASS_OF = np.full(256, len(_CLASSES))
for _k, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c)] = _k
_COUNTED = len(_CLASSES) + 1 + 8
N_FEATURES = _COUNTED + BUCKETS
_PRIMES = (2654435761, 2246822519, 3266489917, 668265263)


def passages(text: str | None) -> list[bytes]:
    """The whole text in passages of at most PASSAGE bytes, cut at white space where there is any."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out, at = [], 0
    while at < len(raw):
        end = at + PASSAGE
        if end < len(raw):
            cut = max(raw.rfind(b" ", at, end), raw.rfind(b"\n", at, end))
            end = cut + 1 if cut > at else end
        out.append(raw[at:end])
        at = end
    return out or [b""]


def encode(parts: list[bytes]) -> np.ndarray:
    """One row of N_FEATURES numbers for each passage."""
    out = np.zeros((len(parts), N_FEATURES), np.float32)
    k = len(_CLASSES) + 1
    for row, part in zip(out, parts):
        if not part:
            continue
        raw = np.frombuffer(part, np.uint8)
        row[:k] = np.bincount(_CLASS_OF[raw], minlength=k) / len(part)
        words = part.split()
        n = max(1, len(words))
        lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
        row[k:_COUNTED] = (
            np.log1p(len(part)) / 7,
            lengths.mean() / 10,
            lengths.std() / 5,
            (lengths <= 3).mean(),
            len(set(words)) / n,
            len(zlib.compress(part, 1)) / (len(part) + 20),
            sum(map(bytes.isalnum, words)) / n,
            sum(map(bytes.isupper, words)) / n,
        )
        if len(raw) >= GRAM:
            row[_COUNTED:] = np.sqrt(np.bincount(_grams(raw), minlength=BUCKETS) / (len(raw) - GRAM + 1))
    return out


def _grams(raw: np.ndarray) -> np.ndarray:
    """The bucket of each sequence of GRAM bytes."""
    wide, n = raw.astype(np.uint32), len(raw) - GRAM + 1
    mixed = np.zeros(n, np.uint32)
    for k, prime in enumerate(_PRIMES):
        mixed += wide[k : k + n] * np.uint32(prime)
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(_PRIMES[1])) >> np.uint32(24)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


class Network:
    """Encoder layer, gated attention and output, over passages grouped in bags."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        kind = np.asarray(mean).dtype
        self.p = {
            "We": rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), HIDDEN)), "be": np.zeros(HIDDEN),
            "V": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, ATTENTION)), "U": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, ATTENTION)),
            "w": rng.normal(0, 1 / np.sqrt(ATTENTION), ATTENTION), "c": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b": np.zeros(1),
        }
        self.p = {name: value.astype(kind) for name, value in self.p.items()}

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """The features in their usual range; those of hashed sequences count by how many of these a passage has."""
        out = np.clip((x - self.mean) / self.scale, -8, 8)
        if x.shape[1] == N_FEATURES:
            size = np.expm1(7 * x[:, len(_CLASSES) + 1])
            out[:, _COUNTED:] *= (size / (size + EVIDENCE))[:, None]
        return out

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        """Scores of the bags, and what the gradients need."""
        return self.forward_scaled(self.scaled(x), starts)

    def forward_scaled(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        p, sizes = self.p, np.diff(np.r_[starts, len(x)])
        h = np.tanh(x @ p["We"] + p["be"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        a = (t * s) @ p["w"]
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return _sigmoid(z @ p["c"] + p["b"]), {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "sizes": sizes}

    def gradients(self, score: np.ndarray, y: np.ndarray, k: dict, starts: np.ndarray) -> dict[str, np.ndarray]:
        p, h, t, s, a = self.p, k["h"], k["t"], k["s"], k["a"]
        d = (score - y) / len(y)
        dz = np.repeat(d[:, None] * p["c"], k["sizes"], axis=0)
        da = (dz * h).sum(axis=1)
        da = a * (da - np.repeat(np.add.reduceat(a * da, starts), k["sizes"]))
        dt, ds = da[:, None] * p["w"] * s * (1 - t * t), da[:, None] * p["w"] * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {"We": k["x"].T @ dh, "be": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ da, "c": k["z"].T @ d, "b": np.array([d.sum()])}


class Constant:
    """For labels of one kind only."""

    def __init__(self, share: float):
        self.share = share

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        return np.full(len(starts), self.share), {}


def loss_of(score: np.ndarray, y: np.ndarray) -> float:
    score = np.clip(score.astype(float), 1e-7, 1 - 1e-7)
    return float(-(y * np.log(score) + (1 - y) * np.log(1 - score)).mean())


def train(bags: list[np.ndarray], labels: np.ndarray) -> Network | Constant:
    """Fit by Adam on all bags at once, with a little weight decay, until the loss has settled; the best weights are kept."""
    if len(set(labels.tolist())) < 2:
        return Constant(float(labels.mean()) if len(labels) else 0.5)
    x = np.concatenate(bags).astype(np.float32)
    labels = labels.astype(np.float32)
    starts = np.cumsum([0, *map(len, bags[:-1])])
    net = Network(x.mean(axis=0, dtype=float).astype(np.float32), (x.std(axis=0, dtype=float) + 1e-3).astype(np.float32))
    x = net.scaled(x)
    m, v = ({k: np.zeros_like(p) for k, p in net.p.items()} for _ in range(2))
    step, since, best, kept_best = 0, 0, np.inf, net.p
    while since < PATIENCE:
        step += 1
        score, kept = net.forward_scaled(x, starts)
        found = loss_of(score, labels) + 0.5e-3 * sum(float((p * p).sum()) for p in net.p.values())
        since += 1
        if found < best * (1 - SETTLED):
            since = 0
        if found < best:
            best, kept_best = found, net.p
        grown = {}
        for k, g in net.gradients(score, labels, kept, starts).items():
            g = g + 1e-3 * net.p[k]
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            grown[k] = (net.p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        net.p = grown
    net.p = kept_best
    return net


def fit(documents: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_bags: int = MAX_BAGS) -> Network | Constant:
    """Learn from the labelled documents whose label rows satisfy ``learn`` (a condition on ``doc_id`` of labels)."""
    small_batches(documents.sparkSession)
    known = labels.filter(learn & F.col(label_col).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.avg(label_col).alias("_label"))
    known = known.join(documents.select(F.col(doc_id).alias("_id")), "_id", "left_semi")
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(max_bags)  # so the broadcast has max_bags rows at most

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1 << 20):
            rows = [encode(passages(text.as_py())).tobytes() for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("label"), pa.array(rows, pa.binary())], ["h", "label", "bag"])

    text = F.col(text_col).cast("string")
    rows = documents.select(F.col(doc_id).alias("_id"), text.alias("text"), F.xxhash64(text).alias("h")).join(F.broadcast(sample), "_id")
    rows = rows.groupBy("h", (F.col("_label") >= 0.5).cast("double").alias("label")).agg(F.first("text").alias("text"))  # copies of a text count once
    found = rows.mapInArrow(bags, "h bigint, label double, bag binary").orderBy("h", "label").collect()
    return train([np.frombuffer(r.bag, np.float32).reshape(-1, N_FEATURES) for r in found], np.array([r.label for r in found]))


def score_of(text: str | None, model: Network | Constant) -> float:
    """The score of one text, from all its passages."""
    return float(model.forward(encode(passages(text)), np.zeros(1, int))[0][0])


def score(documents: DataFrame, model: Network | Constant, text_col: str = "text") -> DataFrame:
    """Per row: the input row as ``doc`` and its score, from every passage of its text."""
    shared = share(documents.sparkSession, model)
    rows, texts = text_of(documents, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared()
        for batch in in_slices(batches):
            scores = [score_of(t.as_py(), network) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(scores, pa.float64())], ["doc", "score"])

    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, score double")


def keep_good(documents: DataFrame, model: Network | Constant, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``, with the input's columns."""
    found = score(documents, model, text_col).filter(F.col("score") >= threshold)
    return found.select([F.col("doc").getField(c).alias(c) for c in documents.columns])
