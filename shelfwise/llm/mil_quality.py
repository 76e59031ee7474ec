"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded
as a vector that doesn't depend on the vocabulary: frequencies of pairs of
character classes, word lengths, and how much its words repeat. A small
network with gated attention (a tanh branch times a sigmoid branch, softmax
over the passages) weighs the passages, and the weighted passage
representation is scored. Only documents carry labels; the attention learns
which passages matter.

The network is fitted with numpy on the driver, on a bounded sample:
``TRAIN_ROWS`` labelled documents, with every passage of each. Encoding, for the
sample and for all documents, runs in Arrow batches on the executors.

Defined cases: a null, empty or blank text is one passage without words. With
no usable label every score is 0.5; with one class only, its share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_held_out, training_sample

PASSAGE = 64
TRAIN_ROWS = 4000
HIDDEN = 24
ATTENTION = 12
EPOCHS = 60
BATCH = 128
RATE = 0.01
DECAY = 1e-4
THRESHOLD = 0.3
SEED = 11
_CLASSES = 8
ROWS_AT_ONCE = 1000


def _class_table() -> np.ndarray:
    """Class of each code point below 0x250; the last entry stands for the rest."""
    table = np.full(0x251, 6, np.uint8)
    for c in range(0x250):
        ch = chr(c)
        table[c] = (0 if ch.islower() else 1 if ch.isupper() else 2 if ch.isdigit() else 3 if ch == " "
                    else 4 if ch in ".,;:'\"()-" else 5 if 32 < c < 127 else 7 if c < 32 else 6)
    return table


FEATURES = _CLASSES * _CLASSES + 8


def encode(text: str | None, table: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` numbers for each passage of ``text``."""
    words = (text or "").split()
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    n = len(words)
    passages = -(-n // PASSAGE)
    lengths = np.fromiter(map(len, words), np.int64, n)
    codes = np.frombuffer(" ".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = table[np.minimum(codes, len(table) - 1)].astype(np.int64)
    starts = np.zeros(n, np.int64)
    np.cumsum(lengths[:-1] + 1, out=starts[1:])
    first = starts[::PASSAGE]
    owner = np.zeros(len(codes), np.int64)
    owner[first[1:]] = 1
    owner = np.cumsum(owner)
    pairs = np.bincount((owner[:-1] * _CLASSES + kinds[:-1]) * _CLASSES + kinds[1:],
                        minlength=passages * _CLASSES ** 2)[: passages * _CLASSES ** 2]
    pairs = pairs.reshape(passages, -1).astype(np.float32)
    chars = np.maximum(pairs.sum(1, keepdims=True), 1)
    hashed = np.zeros(passages * PASSAGE, np.int64)
    hashed[:n] = np.fromiter(map(hash, words), np.int64, n)
    hashed[n:] = np.arange(passages * PASSAGE - n) - 2**62  # padding repeats nothing
    grid = hashed.reshape(passages, PASSAGE)
    size = np.full(passages, PASSAGE, np.float32)
    size[-1] = n - (passages - 1) * PASSAGE
    ordered = np.sort(grid, axis=1)
    same = ordered[:, 1:] == ordered[:, :-1]
    run = np.zeros(passages, np.float32)
    longest = np.zeros(passages, np.float32)
    for column in same.T:
        run = np.where(column, run + 1, 0)
        longest = np.maximum(longest, run)
    adjacent = (grid[:, 1:] == grid[:, :-1]).sum(1)
    at = np.arange(0, n, PASSAGE)
    mean = np.add.reduceat(lengths, at) / size
    spread = np.sqrt(np.maximum(np.add.reduceat(lengths ** 2, at) / size - mean ** 2, 0))
    out = np.concatenate([pairs / chars, np.stack([
        same.sum(1) / size, longest / size, adjacent / size, mean / 10, spread / 10,
        np.maximum.reduceat(lengths, at) / 20, np.log1p(size) / 4, np.full(passages, np.log1p(n) / 8)], axis=1)], axis=1)
    return out.astype(np.float32)


class GatedAttention:
    """The network: passage encoder, gated attention, score of the weighted passage representation."""

    SHAPES = (("W", (FEATURES, HIDDEN)), ("b", (HIDDEN,)), ("V", (HIDDEN, ATTENTION)), ("U", (HIDDEN, ATTENTION)),
              ("w", (ATTENTION,)), ("c", (HIDDEN,)), ("o", (1,)))

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "wc" else np.zeros(s)
                  for k, s in self.SHAPES}
        self.mean, self.scale, self.constant = np.zeros(FEATURES), np.ones(FEATURES), None

    def _forward(self, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> dict:
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["o"], -30, 30)))
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": y}

    def _gradients(self, f: dict, starts: np.ndarray, sizes: np.ndarray, target: np.ndarray) -> dict:
        p, n = self.p, len(target)
        dy = (f["y"] - target) / n
        dz = np.repeat(dy[:, None] * p["c"], sizes, axis=0)
        da = (dz * f["h"]).sum(1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), sizes))
        dt = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dy, "o": dy.sum(keepdims=True)}

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def fit(self, bags: list[np.ndarray], target: np.ndarray) -> "GatedAttention":
        if not len(bags) or target.min() == target.max():
            self.constant = float(target.mean()) if len(bags) else 0.5
            return self
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), every.std(0) + 1e-3
        bags = [self._scaled(b) for b in bags]
        rng = np.random.default_rng(SEED)
        m = {k: np.zeros(s) for k, s in self.SHAPES}
        v = {k: np.zeros(s) for k, s in self.SHAPES}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                some = order[i: i + BATCH]
                sizes = np.array([len(bags[j]) for j in some])
                starts = np.r_[0, np.cumsum(sizes)[:-1]]
                f = self._forward(np.concatenate([bags[j] for j in some]), starts, sizes)
                step += 1
                for k, grad in self._gradients(f, starts, sizes, target[some]).items():
                    grad = grad + DECAY * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad ** 2
                    self.p[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None or not bags:
            return np.full(len(bags), self.constant if self.constant is not None else 0.5)
        sizes = np.array([len(b) for b in bags])
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        return self._forward(self._scaled(np.concatenate(bags)), starts, sizes)["y"]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> GatedAttention:
    """Fit the network on the bounded sample; only encoded passages reach the driver."""
    table = _class_table()

    def run(batches):
        for batch in batches:
            encoded = [encode(t.as_py(), table).ravel() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0).cast(pa.string()), pa.array(encoded, pa.list_(pa.float32())),
                                   batch.column(2)], names=["id", "x", "label"])

    found = (training_sample(docs, labels, label, rows).mapInArrow(run, "id string, x array<float>, label double")
             .toArrow())
    order = sorted(range(found.num_rows), key=lambda i: (found["id"][i].as_py(), found["x"][i].as_py()[:FEATURES]))
    bags = [np.array(found["x"][i].values.to_numpy(zero_copy_only=False), np.float64).reshape(-1, FEATURES)
            for i in order]
    target = np.array([found["label"][i].as_py() for i in order])
    return GatedAttention().fit(bags, target)


def _scores(model: GatedAttention, texts: pa.Array) -> pa.Array:
    table, scores, bags, held = _class_table(), [], [], 0
    for text in texts:
        bags.append(encode(text.as_py(), table))
        held += len(bags[-1])
        if held > 20_000:  # passages in memory at once
            scores.append(model.score(bags))
            bags, held = [], 0
    scores.append(model.score(bags))
    return pa.array(np.concatenate(scores), pa.float64())


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = train(named, labels.withColumnRenamed(id_col, "doc_id") if id_col != "doc_id" else labels, label)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.record_batch([batch.column(0), _scores(model, batch.column(1))], names=["id", "score"])

    return (named.mapInArrow(run, f"id {kind}, score double")
            .select("id", F.coalesce(is_held_out(F.col("id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
              text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay.

    Every row is kept or dropped by its own text, in the pass that scores it, so
    rows that share an id may differ and nothing is shuffled.
    """
    model = train(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                  labels.withColumnRenamed(id_col, "doc_id") if id_col != "doc_id" else labels, label)
    named = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select([F.col(f"`{c}`").alias(n) for c, n in named.items()])
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            good = np.asarray(_scores(model, batch.column(at))) >= threshold
            yield batch.filter(pa.array(good))

    return inner.mapInArrow(run, inner.schema).select([F.col(n).alias(c) for c, n in named.items()])


def filter_by(docs: DataFrame, keep, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is among ``keep(docs)`` (a column ``id``); all columns stay."""
    named = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select([F.col(f"`{c}`").alias(n) for c, n in named.items()])
    ids = keep(docs).distinct()
    return inner.join(ids, inner[named[id_col]].eqNullSafe(ids["id"]), "left_semi").select(
        [F.col(n).alias(c) for c, n in named.items()])
