"""Toxicity by logistic regression on hashed n-grams and skip-grams, learned by FTRL-proximal.

Every coordinate has a learning rate of its own, and the L1 term keeps all weights at zero
whose summed gradients stay small, so a model is a short list of indices and weights.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import held_out, with_answers
from tradelake.llm.hashing import mixed, word_hashes

BITS = 20
#: Steps between the two words of a feature: 1 is a pair of neighbours, more skip words.
REACHES = (1, 2, 3)
THRESHOLD = 0.3
#: Labelled documents of each class that the model learns from, and their longest text.
LEARNED = 4000
LEARNED_BYTES = 1 << 15
EPOCHS = 8
#: FTRL-proximal: size and offset of the rates, L1 and L2 weights.
ALPHA = 1.0
BETA = 1.0
#: A feature of a single text gathers at most ``EPOCHS``, so it never weighs anything.
LAMBDA_1 = 12.0
LAMBDA_2 = 0.1
_NO_LETTERS = re.compile(r"[\W\d_]+")
_FIRST = np.uint64(0xA0761D6478BD642F)
_SECOND = np.uint64(0xE7037ED1A0B428DB)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashed features of all texts, each feature once for each place.

    Words are runs of letters in lower case. Features are words, pairs of neighbours and
    pairs with one or two words between them; none spans two texts.
    """
    hashes, starts = word_hashes([_NO_LETTERS.sub(" ", text.lower()) for text in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    hashes = hashes[starts[0] : starts[-1]]
    owners, found = [owner], [hashes]
    for reach in REACHES:
        n = max(len(hashes) - reach, 0)
        same = owner[:n] == owner[reach:]
        pair = mixed(hashes[:n] * _FIRST + hashes[reach:] * _SECOND + np.uint64(reach))
        owners.append(owner[:n][same])
        found.append(pair[same])
    ids = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int32)
    return np.concatenate(owners), ids


@dataclass(frozen=True)
class Model:
    """``weights`` of the features ``indices`` (ascending); all others weigh nothing."""

    indices: np.ndarray
    weights: np.ndarray
    bias: float
    _dense: list[np.ndarray] = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {"indices": self.indices, "weights": self.weights, "bias": self.bias, "_dense": []}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)

    def dense(self) -> np.ndarray:
        if not self._dense:
            table = np.zeros(1 << BITS)
            table[self.indices] = self.weights
            self._dense.append(table)
        return self._dense[0]

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of each text; a feature counts once, however often it stands."""
        owner, ids = features(texts)
        weigh = self.dense()[ids] != 0
        distinct = np.unique(owner[weigh] << BITS | ids[weigh])
        sums = np.bincount(distinct >> BITS, self.dense()[distinct & (1 << BITS) - 1], len(texts))
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -50, 50)))


def _log_odds(ones: float, zeros: float) -> float:
    return float(np.log((ones + 1) / (zeros + 1)))


class Ftrl:
    """Per-coordinate sums of FTRL-proximal: gradients less what they moved, and squares."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - LAMBDA_1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + LAMBDA_2)

    def step(self, at: np.ndarray, weights: np.ndarray, slope: float) -> None:
        """One example whose features at ``at`` are 1: all have the same gradient."""
        n = self.n[at]
        rate = (np.sqrt(n + slope * slope) - np.sqrt(n)) / ALPHA
        self.z[at] += slope - rate * weights
        self.n[at] = n + slope * slope


def train(rows: list[tuple[str, int]], totals: tuple[int, int] | None = None, seed: int = 7) -> Model:
    """A model of (text, label) rows; ``totals`` counts all labels 0 and 1 behind them.

    The rows hold other shares of the labels than the whole, so the bias is moved by the
    difference in log odds. Without both labels every text scores their share.
    """
    labels = [label for _, label in rows]
    own = (labels.count(0), labels.count(1))
    totals = totals or own
    prior = _log_odds(totals[1], totals[0])
    nothing = np.zeros(0, dtype=np.int32)
    if not min(own):
        return Model(nothing, nothing.astype(float), prior)
    examples = [np.unique(features([text])[1]) for text, _ in rows]
    learner = Ftrl(1 << BITS)
    bias, squares = 0.0, 0.0
    random = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            at = examples[i]
            weights = learner.weights(at)
            score = 1 / (1 + np.exp(-np.clip(weights.sum() + bias, -50, 50)))
            slope = float(score - labels[i])
            learner.step(at, weights, slope)
            squares += slope * slope
            bias -= ALPHA * slope / (BETA + np.sqrt(squares))
    weights = learner.weights(slice(None))
    indices = np.flatnonzero(weights).astype(np.int32)
    return Model(indices, weights[indices], bias + prior - _log_odds(own[1], own[0]))


def able(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``toxic`` of the labels that may be learned.

    Ids outside the held-out fold, labelled 0 or 1 and not both; null ids do not count.
    """
    return (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .filter("toxic = most")
        .select("doc_id", "toxic")
    )


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = LEARNED) -> DataFrame:
    """The documents of at most ``per_class`` ids of each label (``doc_id``, ``text``, ``toxic``).

    A hash of the id picks them. Null texts count as empty; texts above
    ``LEARNED_BYTES`` bytes are left out.
    """
    drawn = able(labels).withColumn("draw", F.xxhash64("doc_id", F.lit(12)))
    chosen = [drawn.filter(F.col("toxic") == k).orderBy("draw", "doc_id").limit(per_class) for k in (0, 1)]
    # At most two times per_class ids, so this side is always small enough to send around.
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return own.filter(F.octet_length("text") <= LEARNED_BYTES).join(ids, "doc_id")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = LEARNED) -> Model:
    """The model of a bounded sample of labelled documents; see ``labelled``."""
    totals = dict(able(labels).groupBy("toxic").count().collect())
    found = labelled(docs, labels, per_class).orderBy("draw", "doc_id", "text").limit(2 * per_class)
    rows = [(row["text"], row["toxic"]) for row in found.select("text", "toxic").toLocalIterator()]
    return train(rows, (totals.get(0, 0), totals.get(1, 0)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (the document, all its columns), ``toxic_score`` and ``predicted``.

    The whole text decides and nothing else; a null text counts as empty and is scored
    too. Equal texts score alike; an empty table gives no rows.
    """
    found = with_answers(
        docs, lambda texts: [pa.array(model.scores(texts), pa.float64())], "toxic_score double"
    )
    return found.withColumn("predicted", (F.col("toxic_score") >= THRESHOLD).cast("int"))


def clean_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not found toxic, with their own columns."""
    return score(docs, model).filter("predicted = 0").select("row.*")
