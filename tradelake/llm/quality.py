"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded, a learned gate weighs the
encodings, and the weighted sum is scored, so one bad passage among good ones counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import held_out, runs, with_answers

PASSAGE = 512
HASHED = 256
LAGS = tuple(range(2, 17))
FEATURES = 256 + HASHED + len(LAGS) + 2
HIDDEN = 16
GATES = 8
EPOCHS = 30
BATCH = 64
RATE = 0.01
DECAY = 1e-4
THRESHOLD = 0.7
#: Labelled documents of each class that the model learns from, and their longest text.
LEARNED = 2000
LEARNED_BYTES = 1 << 16


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and where each text's passages start.

    A passage is ``PASSAGE`` bytes of UTF-8; an empty text has one empty passage.
    Features: shares of byte values and of hashed byte trigrams, how often a byte
    equals the one some steps before it, and the sizes of passage and document.
    """
    data = [text.encode() for text in texts]
    sizes = np.array([len(d) for d in data])
    joined = np.frombuffer(b"".join([*data, b"\n" * (LAGS[-1] + 2)]), dtype=np.uint8)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    firsts = np.cumsum(counts) - counts
    total = int(counts.sum())
    order = np.arange(total) - np.repeat(firsts, counts)
    begins = np.repeat(np.cumsum(sizes) - sizes, counts) + order * PASSAGE
    lengths = np.minimum(PASSAGE, np.repeat(sizes, counts) - order * PASSAGE)
    n = int(sizes.sum())
    owner = np.repeat(np.arange(total), lengths)
    # How many bytes of its own text follow each byte: nothing looks into the next text.
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n) - 1
    out = np.zeros((total, FEATURES), dtype=np.float32)
    per = np.maximum(lengths, 1)[:, None].astype(np.float32)
    text = joined[:n]
    out[:, :256] = np.bincount(owner * 256 + text, minlength=total * 256).reshape(total, 256)
    wide = joined.astype(np.uint32)
    grams = wide[:n] * np.uint32(0x9E3779B1) ^ wide[1 : n + 1] * np.uint32(0x85EBCA77)
    grams = (grams ^ wide[2 : n + 2] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F) >> np.uint32(24)
    own = left >= 2
    out[:, 256 : 256 + HASHED] = np.bincount(
        owner[own] * HASHED + grams[own], minlength=total * HASHED
    ).reshape(total, HASHED)
    some = np.flatnonzero(lengths > 0)
    if n:
        for i, lag in enumerate(LAGS):
            same = ((joined[:n] == joined[lag : n + lag]) & (left >= lag)).astype(np.int32)
            out[some, 512 + i] = np.add.reduceat(same, begins[some])
    out[:, : 512 + len(LAGS)] = np.sqrt(out[:, : 512 + len(LAGS)] / per)
    out[:, -2] = np.log1p(lengths) / np.log1p(PASSAGE)
    out[:, -1] = np.repeat(np.log1p(sizes), counts) / 12
    return out, firsts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass(frozen=True)
class Model:
    """``weights`` by name; without any, every text scores ``share``."""

    weights: dict[str, np.ndarray]
    share: float

    def attended(self, x: np.ndarray, firsts: np.ndarray) -> dict[str, np.ndarray]:
        """Encodings, attention weights and document vectors."""
        w = self.weights
        owner = np.repeat(np.arange(len(firsts)), np.diff(firsts, append=len(x)))
        hidden = np.tanh((x - w["mean"]) * w["scale"] @ w["encode"] + w["encode_bias"])
        tanh, gate = np.tanh(hidden @ w["tanh"]), _sigmoid(hidden @ w["gate"])
        raw = (tanh * gate) @ w["attend"]
        raised = np.exp(raw - np.maximum.reduceat(raw, firsts)[owner])
        weight = raised / np.add.reduceat(raised, firsts)[owner]
        pooled = np.add.reduceat(weight[:, None] * hidden, firsts, axis=0)
        return {"owner": owner, "hidden": hidden, "tanh": tanh, "gate": gate, "weight": weight, "pooled": pooled}

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.share)
        pooled = self.attended(*encode(texts))["pooled"]
        return _sigmoid(pooled @ self.weights["score"] + self.weights["score_bias"])


def _gradients(model: Model, x: np.ndarray, firsts: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
    w, a = model.weights, model.attended(x, firsts)
    owner, hidden, weight = a["owner"], a["hidden"], a["weight"]
    error = (_sigmoid(a["pooled"] @ w["score"] + w["score_bias"]) - wanted) / len(wanted)
    from_pooled = (error[:, None] * w["score"])[owner]
    pull = weight * (hidden * from_pooled).sum(axis=1)
    from_raw = pull - weight * np.add.reduceat(pull, firsts)[owner]
    from_tanh = from_raw[:, None] * w["attend"] * a["gate"] * (1 - a["tanh"] ** 2)
    from_gate = from_raw[:, None] * w["attend"] * a["tanh"] * a["gate"] * (1 - a["gate"])
    from_hidden = weight[:, None] * from_pooled + from_tanh @ w["tanh"].T + from_gate @ w["gate"].T
    from_hidden = from_hidden * (1 - hidden**2)
    return {
        "score": a["pooled"].T @ error,
        "score_bias": error.sum(),
        "attend": (a["tanh"] * a["gate"]).T @ from_raw,
        "tanh": hidden.T @ from_tanh,
        "gate": hidden.T @ from_gate,
        "encode": ((x - w["mean"]) * w["scale"]).T @ from_hidden,
        "encode_bias": from_hidden.sum(axis=0),
    }


def train(rows: list[tuple[str, int]], seed: int = 7) -> Model:
    """A model of (text, label) rows, by Adam on batches of documents."""
    labels = np.array([label for _, label in rows], dtype=np.float32)
    share = float((labels.sum() + 1) / (len(labels) + 2))
    if not len(labels) or labels.min() == labels.max():
        return Model({}, share)
    random = np.random.default_rng(seed)
    parts = [encode(run) for run in runs([text for text, _ in rows])]
    x = np.concatenate([part for part, _ in parts])
    begins = np.cumsum([0] + [len(part) for part, _ in parts])
    firsts = np.concatenate([own + begin for (_, own), begin in zip(parts, begins, strict=False)])
    ends = np.append(firsts[1:], len(x))
    small = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
    weights = {
        "mean": x.mean(axis=0),
        "scale": 1 / (x.std(axis=0) + 0.02),
        "encode": small(FEATURES, HIDDEN),
        "encode_bias": np.zeros(HIDDEN, dtype=np.float32),
        "tanh": small(HIDDEN, GATES),
        "gate": small(HIDDEN, GATES),
        "attend": small(GATES),
        "score": small(HIDDEN),
        "score_bias": np.float32(0),
    }
    model = Model(weights, share)
    moved: dict[str, tuple] = {}
    step = 0
    for epoch in range(EPOCHS):
        for batch in np.array_split(random.permutation(len(rows)), -(-len(rows) // BATCH)):
            part = np.concatenate([x[firsts[i] : ends[i]] for i in batch])
            sizes = ends[batch] - firsts[batch]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for name, slope in _gradients(model, part, np.cumsum(sizes) - sizes, labels[batch]).items():
                slope = slope + DECAY * weights[name]
                m, v = moved.get(name, (0.0, 0.0))
                m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
                moved[name] = (m, v)
                change = m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                weights[name] = weights[name] - np.float32(rate) * np.float32(change)
    return model


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = LEARNED) -> DataFrame:
    """At most ``per_class`` documents of each label (``text``, ``quality``).

    Only rows outside the held-out fold, chosen by a hash of the id. Ids with both
    labels are left out, as are texts above ``LEARNED_BYTES`` bytes.
    """
    able = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .filter("quality = most")
        .drop("most")
        .withColumn("draw", F.xxhash64("doc_id"))
    )
    chosen = [able.filter(F.col("quality") == q).orderBy("draw", "doc_id").limit(per_class) for q in (0, 1)]
    # At most two times per_class ids, so this side is always small enough to send around.
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return own.filter(F.octet_length("text") <= LEARNED_BYTES).join(ids, "doc_id")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = LEARNED) -> Model:
    found = labelled(docs, labels, per_class).orderBy("draw", "doc_id", "text").limit(4 * per_class)
    return train([(row["text"], row["quality"]) for row in found.collect()])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (the document, all its columns), ``quality_score`` and ``predicted``.

    The whole text decides and nothing else; a null text counts as empty and is
    scored too. Equal texts score alike; an empty table gives no rows.
    """
    found = with_answers(
        docs, lambda texts: [pa.array(model.scores(texts), pa.float64())], "quality_score double"
    )
    return found.withColumn("predicted", (F.col("quality_score") >= THRESHOLD).cast("int"))


def good_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns."""
    return score(docs, model).filter("predicted = 1").select("row.*")
