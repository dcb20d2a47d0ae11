"""Language identification by averaged hashed subword embeddings."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm.common import held_out, with_answers, written

UNKNOWN = "und"
BUCKET_BITS = 16
DIMENSION = 16
SUBWORDS = (2, 3, 4)
#: Passages that the model learns from, for each language, and their length.
PASSAGES = 1500
PASSAGE_CHARS = 1000
EPOCHS = 4
#: The share of rightly recognised validation passages that may score below the limit.
REFUSED = 0.001
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, 0 for anything else, and where each text starts.

    Two zeros end every text, so that no subword spans two of them.
    """
    lowered = [text.lower() for text in texts]
    joined = "\0\0".join(["", *lowered, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    starts = np.cumsum([2] + [len(text) + 2 for text in lowered])
    return np.where(_letters()[points], points, 0).astype(np.uint32), starts


def _subwords(points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and buckets of subwords of ``n`` signs; a word's edges count as signs."""
    m = len(points) - n + 1
    valid = points[1 : m + 1] != 0 if n > 2 else (points[:m] != 0) | (points[1 : m + 1] != 0)
    for k in range(2, n - 1):
        valid &= points[k : m + k] != 0
    at = np.flatnonzero(valid)
    hashed = np.full(len(at), 0x811C9DC5 * n & 0xFFFFFFFF, dtype=np.uint32)
    for k in range(n):
        hashed = (hashed ^ points[at + k]) * np.uint32(_MIX[k])
        hashed ^= hashed >> np.uint32(15)
    return at, (hashed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: What each bucket adds to the languages' scores: its embedding through the output layer.
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    limit: float

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each text's languages, and its number of subwords."""
        points, starts = _points(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts), dtype=np.int64)
        for n in SUBWORDS:
            at, buckets = _subwords(points, n)
            # A subword that begins with the sign before a word belongs to that word's text.
            cuts = np.searchsorted(at, starts - 1)
            found = np.diff(cuts)
            counts += found
            some = found > 0
            if some.any():
                values = self.table[buckets[cuts[0] : cuts[-1]]]
                sums[some] += np.add.reduceat(values, (cuts[:-1] - cuts[0])[some], axis=0)
        logits = sums / np.maximum(counts, 1)[:, None] + self.bias
        return _softmax(logits / self.temperature), counts


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _example(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and their shares."""
    points, _ = _points([text])
    buckets = np.concatenate([_subwords(points, n)[1] for n in SUBWORDS])
    found, count = np.unique(buckets, return_counts=True)
    return found, (count / max(len(buckets), 1)).astype(np.float32)


def train(passages: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """A model of (text, language) rows, by stochastic gradient descent.

    Every second passage is shortened, so that short texts are learned too. A tenth
    of the rows is kept apart: on it a temperature makes the scores probabilities, and
    ``limit`` is set so that ``REFUSED`` of its right answers score below it.
    """
    languages = sorted({language for _, language in passages})
    if not languages:
        return None
    random = np.random.default_rng(seed)
    number = {language: i for i, language in enumerate(languages)}
    examples = []
    for i, (text, language) in enumerate(passages):
        if i % 2:
            words = text.split()
            size = int(np.exp(random.uniform(np.log(3), np.log(max(len(words), 4)))))
            begin = int(random.integers(0, max(len(words) - size, 0) + 1))
            text = " ".join(words[begin : begin + size])
        buckets, shares = _example(text)
        if len(buckets):
            examples.append((text, buckets, shares, number[language]))
    random.shuffle(examples)
    held = examples[: len(examples) // 10]
    learned = examples[len(held) :]
    embeddings = random.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSION)).astype(np.float32) / DIMENSION
    output = np.zeros((DIMENSION, len(languages)), dtype=np.float32)
    output += random.normal(0, 0.1, output.shape)
    bias = np.zeros(len(languages), dtype=np.float32)
    steps, step = EPOCHS * len(learned), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(learned)):
            _, buckets, shares, wanted = learned[i]
            rate = np.float32(1 - step / steps)
            rows = embeddings[buckets]
            hidden = shares @ rows
            error = _softmax((hidden @ output + bias)[None, :])[0].astype(np.float32)
            error[wanted] -= 1
            back = output @ error
            output -= rate * 0.5 * np.outer(hidden, error)
            bias -= rate * 0.05 * error
            embeddings[buckets] = rows - rate * 80 * np.outer(shares, back)
            step += 1
    model = Model(languages, embeddings @ output, bias, 1.0, 0.0)
    if not held:
        return model
    logits = np.log(model.scores([text for text, *_ in held])[0] + 1e-300)
    wanted = np.array([language for *_, language in held])
    rows = np.arange(len(held))

    def loss(t: float) -> float:
        return -np.log(_softmax(logits / t)[rows, wanted] + 1e-12).mean()

    temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    shares = _softmax(logits / temperature)
    right = np.sort(shares.max(axis=1)[shares.argmax(axis=1) == wanted])
    limit = float(right[int(REFUSED * len(right))]) if len(right) else 0.0
    # A text without any evidence scores 1 / languages: never ask for less than that.
    limit = min(0.5, max(limit, 1 / len(languages)))
    return Model(languages, model.table, bias, temperature, limit)


def passages(docs: DataFrame, per_language: int = PASSAGES) -> DataFrame:
    """About ``per_language`` passages of each language (``text``, ``lang``), and never more
    than twice as many, however often a row is repeated.

    Only rows outside the held-out fold that have a text and a language. A hash of
    the row picks documents, and the place of the one passage that each of them gives.
    """
    able = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    shares = written(
        able.groupBy("lang").agg((F.lit(float(per_language)) / F.count("*")).alias("share")), "languages"
    )
    draw = F.crc32(F.concat(F.md5(F.substring("text", 1, 200).cast("binary")), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    place = F.pmod(F.xxhash64("draw"), F.greatest(F.length("text") - PASSAGE_CHARS + 1, F.lit(1))) + 1
    drawn = (
        able.select("text", "lang", draw.alias("draw"))
        .join(shares, "lang")
        .filter(F.col("draw") / float(1 << 32) < F.col("share"))
        .select("lang", "draw", F.substring(F.col("text"), place, F.lit(PASSAGE_CHARS)).alias("text"))
    )
    # Equal rows draw alike. Spark keeps no more rows than these per task before it shuffles.
    order = Window.partitionBy("lang").orderBy("draw", "text")
    numbered = drawn.withColumn("nth", F.row_number().over(order))
    return numbered.filter(F.col("nth") <= 2 * per_language).drop("nth")


def fit(docs: DataFrame, per_language: int = PASSAGES) -> Model | None:
    """The model of a bounded sample of ``docs``; None where there is nothing to learn."""
    rows = passages(docs, per_language).orderBy("lang", "draw", "text").collect()
    return train([(row["text"], row["lang"]) for row in rows])


def _answer(model: Model | None):
    def answer(texts: list[str]) -> list[pa.Array]:
        if model is None:
            names, score, limit = [UNKNOWN] * len(texts), np.zeros(len(texts)), 0.0
        else:
            shares, counts = model.scores(texts)
            best = [model.languages[i] for i in shares.argmax(axis=1)]
            names = [n if c else UNKNOWN for n, c in zip(best, counts, strict=True)]
            score, limit = np.where(counts > 0, shares.max(axis=1), 0.0), model.limit
        rejected = [n == UNKNOWN or s < limit for n, s in zip(names, score, strict=True)]
        return [pa.array(names, pa.string()), pa.array(score), pa.array(rejected, pa.bool_())]

    return answer


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """The language of every whole text.

    Columns: ``row`` (the document, all its columns), ``lang_pred``, ``lang_score``
    (the calibrated probability) and ``lang_rejected``. A null text, or one without a
    letter, is ``und`` with score 0 and rejected; so is everything without a model.
    Only the text decides; equal texts get equal answers.
    """
    return with_answers(
        docs, _answer(model), "lang_pred string, lang_score double, lang_rejected boolean"
    )


def recognised(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents whose language is not rejected, with their own columns."""
    return identify(docs, model).filter("NOT lang_rejected").select("row.*")
