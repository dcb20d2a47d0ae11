"""Language, quality and language-model scores."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from cases import TEXTS, documents, labels, words
from pyspark.sql import functions as F

from tradelake.llm import language, lm, quality
from tradelake.llm.common import held_out


def by_row(df, *names):
    return sorted(((r.row.doc_id, r.row.text, *[r[n] for n in names]) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet")


@pytest.fixture(scope="module")
def given_labels(spark):
    return spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


def test_language_of_held_out_documents(given):
    model = language.fit(given, per_language=400)
    found = language.identify(given.filter(held_out(given["doc_id"])), model)
    rows = found.selectExpr("row.lang", "lang_pred", "lang_score", "lang_rejected").collect()
    assert len(rows) > 2000
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert np.mean([r.lang_rejected for r in rows]) < 0.005
    # Scores are calibrated: their mean is near the share of right answers.
    assert abs(np.mean([r.lang_score for r in rows]) - np.mean([r.lang == r.lang_pred for r in rows])) < 0.03


def test_language_learns_nothing_from_held_out_rows(given):
    swapped = given.selectExpr(
        "doc_id", "text", "CASE WHEN crc32(cast(string(doc_id) AS binary)) % 4 = 2 THEN 'xx' ELSE lang END AS lang"
    )
    assert language.fit(swapped, 50).languages == ["de", "en", "es", "fr"]


def test_repeated_rows_do_not_add_passages(spark):
    same = spark.range(3_000).selectExpr("7L AS doc_id", "'one and the same text' AS text", "'en' AS lang")
    for seven in range(7, 60):
        own = same.withColumn("doc_id", F.lit(seven).cast("long")).filter(~held_out(F.col("doc_id")))
        n = language.passages(own, 50).count()
        assert n in (0, 100)
        if n:
            break
    assert n == 100


def test_language_of_odd_documents(spark, given):
    docs = documents(spark)
    model = language.fit(given, per_language=100)
    found = language.identify(docs, model)
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        has_letter = any(c.isalpha() for c in row.row.text or "")
        assert (row.lang_pred == "und") == (not has_letter)
        assert 0 <= row.lang_score <= 1
        assert row.row.size == "s"
    kept = language.recognised(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.lang_rejected for r in rows)
    assert by_row(found, "lang_pred", "lang_score") == by_row(language.identify(docs.repartition(3), model), "lang_pred", "lang_score")


def test_language_without_anything_to_learn(spark):
    nothing = documents(spark, [(1, "text", None, "a"), (2, None, "en", "a")])
    assert language.fit(nothing) is None
    rows = language.identify(nothing, None).collect()
    assert {(r.lang_pred, r.lang_score) for r in rows} == {("und", 0.0)}
    assert language.fit(documents(spark, [])) is None
    assert language.identify(documents(spark, []), None).collect() == []


def test_subwords_stay_in_their_text():
    model = language.train([("ab cd", "x"), ("ef gh", "y")] * 20)
    texts = ["ab cd", "", "a", "ef gh", "zz 1", "É"]
    together = model.scores(texts)[0]
    alone = np.concatenate([model.scores([t])[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-6)


def test_quality_of_held_out_documents(given, given_labels):
    model = quality.fit(given, given_labels)
    found = quality.score(given.filter(held_out(given["doc_id"])), model)
    rows = found.selectExpr("row.doc_id", "quality_score", "predicted").join(given_labels, "doc_id").collect()
    assert len(rows) > 500
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(0 <= r.quality_score <= 1 and r.predicted == int(r.quality_score >= 0.7) for r in rows)


def test_quality_learns_nothing_from_held_out_rows(given, given_labels):
    chosen = quality.labelled(given, given_labels)
    assert chosen.filter(held_out(chosen["doc_id"])).count() == 0
    assert max(row["count"] for row in chosen.groupBy("quality").count().collect()) <= quality.LEARNED


def test_quality_of_odd_documents(spark):
    docs = documents(spark)
    model = quality.fit(docs, labels(spark))
    assert model.weights
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(TEXTS)
    assert all(0 <= r.quality_score <= 1 for r in rows)
    kept = quality.good_documents(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in rows)


def test_quality_without_labels(spark):
    docs = documents(spark)
    one_sided = quality.fit(docs, labels(spark, [(0, 1), (2, 1)]))
    assert {r.quality_score for r in quality.score(docs, one_sided).collect()} == {one_sided.share}
    assert quality.fit(documents(spark, []), labels(spark, [])).share == 0.5
    assert quality.score(documents(spark, []), one_sided).collect() == []


def test_passages_are_encoded_one_by_one():
    texts = ["", "a", "x" * 511, "y" * 513, "é" * 600, "word " * 400]
    together, firsts = quality.encode(texts)
    assert list(np.diff([*firsts, len(together)])) == [1, 1, 1, 2, 3, 4]
    assert np.isfinite(together).all()
    shares = together[:, :256] ** 2
    assert np.allclose(shares.sum(axis=1)[1:], 1)


def test_a_text_scores_alike_beside_any_other():
    texts = ["", "abc", "aaaa", "xyz " * 300, "a", "é" * 700, "abc"]
    together, firsts = quality.encode(texts)
    for i, text in enumerate(texts):
        alone, _ = quality.encode([text])
        assert (together[firsts[i] : firsts[i] + len(alone)] == alone).all()


def test_quality_scores_equal_plain_loops():
    """The whole forward pass, one byte, one passage and one weight at a time."""
    texts = ["good words here " * 70, "$$$ %%% bad " * 90, "", "é ñ 中", "ab"]
    model = quality.train([(t, i % 2) for i, t in enumerate(texts)] * 3)
    w = {name: np.asarray(value, dtype=np.float64) for name, value in model.weights.items()}

    def passage(data, begin):
        part = data[begin : begin + quality.PASSAGE]
        x = [0.0] * quality.FEATURES
        for i in range(begin, begin + len(part)):
            x[data[i]] += 1
            if i + 2 < len(data):
                h = (data[i] * 0x9E3779B1 & 0xFFFFFFFF) ^ (data[i + 1] * 0x85EBCA77 & 0xFFFFFFFF)
                h ^= data[i + 2] * 0xC2B2AE3D & 0xFFFFFFFF
                x[256 + ((h * 0x27D4EB2F & 0xFFFFFFFF) >> 24)] += 1
            for k, lag in enumerate(quality.LAGS):
                x[512 + k] += i + lag < len(data) and data[i] == data[i + lag]
        x = [math.sqrt(v / max(len(part), 1)) for v in x]
        x[-2] = math.log1p(len(part)) / math.log1p(quality.PASSAGE)
        x[-1] = math.log1p(len(data)) / 12
        return x

    for text, score in zip(texts, model.scores(texts), strict=True):
        data = text.encode()
        hidden, raw = [], []
        for begin in range(0, max(len(data), 1), quality.PASSAGE):
            x = (np.array(passage(data, begin)) - w["mean"]) * w["scale"]
            h = [math.tanh(sum(x * w["encode"][:, j]) + w["encode_bias"][j]) for j in range(quality.HIDDEN)]
            gated = [
                math.tanh(sum(h[j] * w["tanh"][j, g] for j in range(quality.HIDDEN)))
                / (1 + math.exp(-sum(h[j] * w["gate"][j, g] for j in range(quality.HIDDEN))))
                for g in range(quality.GATES)
            ]
            hidden.append(h)
            raw.append(sum(gated[g] * w["attend"][g] for g in range(quality.GATES)))
        weight = [math.exp(r) / sum(math.exp(q) for q in raw) for r in raw]
        pooled = [sum(a * h[j] for a, h in zip(weight, hidden, strict=True)) for j in range(quality.HIDDEN)]
        plain = sum(pooled[j] * w["score"][j] for j in range(quality.HIDDEN)) + float(w["score_bias"])
        assert score == pytest.approx(1 / (1 + math.exp(-plain)), abs=1e-4)


def test_language_scores_equal_plain_loops():
    """Subwords one by one, their mean, the output layer and the softmax."""
    model = language.train([("ab cd été", "x"), ("ef gh straße", "y"), ("ij kl ñu", "z")] * 20)
    for text in ["ab ef", "", "12", "Été ß", "a", "x'y  kl9mn", "中文 ab"]:
        points = [0, 0, *[ord(c) if c.isalpha() else 0 for c in text.lower()], 0, 0]
        sums, count = np.zeros(3), 0
        for n in language.SUBWORDS:
            # A word's edges count as signs; nothing else that is no letter does.
            for i in range(len(points) - n + 1):
                gram = points[i : i + n]
                if not (any(gram) if n == 2 else all(gram[1:-1])) or i == 0 and n == 2:
                    continue
                h = 0x811C9DC5 * n & 0xFFFFFFFF
                for point, mix in zip(gram, language._MIX, strict=False):
                    h = (h ^ point) * mix & 0xFFFFFFFF
                    h ^= h >> 15
                sums += model.table[h >> (32 - language.BUCKET_BITS)]
                count += 1
        found, counts = model.scores([text])
        logits = (sums / max(count, 1) + model.bias) / model.temperature
        assert counts[0] == count
        assert found[0] == pytest.approx(np.exp(logits) / np.exp(logits).sum(), abs=1e-6)


def test_gradients_of_the_quality_model():
    rng = np.random.default_rng(0)
    model = quality.train([("good words here", 1), ("$$$ %%%", 0)] * 4)
    x, firsts = quality.encode(["good words here " * 60, "$$$ %%% bad " * 90, "fine"])
    wanted = np.array([1.0, 0.0, 1.0])

    def loss():
        pooled = model.attended(x, firsts)["pooled"]
        p = 1 / (1 + np.exp(-(pooled @ model.weights["score"] + model.weights["score_bias"])))
        return -(wanted * np.log(p) + (1 - wanted) * np.log(1 - p)).mean()

    for name in model.weights:
        model.weights[name] = np.asarray(model.weights[name], dtype=np.float64) + (rng.normal(0, 0.3, np.shape(model.weights[name])) if name not in ("mean", "scale", "encode") else 0)
    slopes = quality._gradients(model, x.astype(np.float64), firsts, wanted)
    for name in ("encode_bias", "tanh", "gate", "attend", "score"):
        weight, at = model.weights[name], tuple(rng.integers(0, n) for n in model.weights[name].shape)
        before = weight[at]
        weight[at] = before + 1e-5
        up = loss()
        weight[at] = before - 1e-5
        down = loss()
        weight[at] = before
        assert slopes[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def plain_losses(rows, good):
    """Both models' mean losses by counting words and pairs in plain dictionaries; every
    event is judged by the counts of all others."""
    models = []
    for own in ([t for _, t in rows], [t for d, t in rows if d in good]):
        single, pair = Counter(), Counter()
        for text in own:
            if words(text):
                line = [None, *words(text), None]
                single.update(line[1:])
                pair.update(zip(line, line[1:]))
        models.append((single, pair))
    size = len(models[0][0])
    out = []
    for doc_id, text in rows:
        line = [None, *words(text), None] if words(text) else [None]
        found = []
        for (single, pair), off in zip(models, (1, int(doc_id in good))):
            total = sum(single.values()) - off
            loss = 0.0
            for last, event in zip(line, line[1:]):
                before = max(single[last] - off, 0)
                weight = lm.PAIR_WEIGHT if before > 0 else 0.0
                share = max(pair[last, event] - off, 0) / max(before, 1)
                alone = (max(single[event] - off, 0) + lm.ADDED) / (total + lm.ADDED * (size + 1))
                loss -= math.log(weight * share + (1 - weight) * alone)
            found.append(loss / max(len(line) - 1, 1))
        out.append(found)
    return out


def same_losses(found, rows, good):
    found = {r.row.doc_id: r for r in found.collect()}
    assert len(found) == len(rows)
    for (doc_id, text), (background, target) in zip(rows, plain_losses(rows, good), strict=True):
        row = found[doc_id]
        assert row.n_words == len(words(text))
        assert row.background_loss == pytest.approx(background)
        assert row.target_loss == pytest.approx(target)
        assert row.difference == pytest.approx(row.target_loss - row.background_loss)


def test_cross_entropy_difference(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    good = {r.doc_id for r in marks.collect() if r.quality == 1}
    same_losses(lm.score(spark.createDataFrame(rows, "doc_id bigint, text string"), marks), rows, good)


def test_probabilities_add_up_to_one():
    """After every word and in both models, over all words, the end and one unknown word,
    with the counts of everything but one event."""
    rng = random.Random(4)
    texts = [rng.choices("abcdefghijk", k=rng.randrange(1, 30)) for _ in range(40)]
    for own in (texts, texts[:7]):
        single, pair = Counter(), Counter()
        for text in own:
            line = [None, *text, None]
            single.update(line[1:])
            pair.update(zip(line, line[1:]))
        vocabulary = [None, *"abcdefghijk"]
        for taken in ([], *([p] for p in pair)):
            ones, twos = single - Counter(p[1] for p in taken), pair - Counter(taken)
            for last in {p[0] for p in taken} or vocabulary:
                before = single[last] - len(taken)
                events = [*vocabulary, "never seen"]
                likely = lm.probability(
                    np.array([twos[last, e] for e in events]), np.array([before] * len(events)),
                    np.array([ones[e] for e in events]), sum(ones.values()), len(vocabulary),
                )
                assert likely.min() > 0
                assert likely.sum() == pytest.approx(1)


def test_packed_numbers_come_back():
    for arrays in ([[0, 1, 255]], [[], []], [[1 << 63, 0], [0, 0], [256, 3]]):
        arrays = [np.array(values, np.uint64) for values in arrays]
        back = lm.unpacked(lm.packed(*arrays))
        assert [b.tolist() for b in back] == [a.tolist() for a in arrays]


def test_no_word_or_pair_is_left_out(spark, monkeypatch):
    """Over 65,536 words and 2**20 pairs seen twice, over many chunks and buckets."""
    rng = random.Random(9)
    rare = [f"w{i}" for i in range(70_000)]
    once = [" ".join(rare[k : k + 1000]) for k in range(0, 70_000, 1000)]
    frequent = rng.choices([f"v{i}" for i in range(3000)], k=1_100_000)
    many = [" ".join(frequent[k : k + 10_000]) for k in range(0, len(frequent), 10_000)]
    rows = list(enumerate([*many, *many, *once, *once]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    good = set(range(0, len(rows), 3))
    monkeypatch.setattr(lm, "CHUNK", 1 << 16)
    same_losses(lm.score(docs, labels(spark, [(i, 1) for i in good])), rows, good)


def test_texts_are_dealt_once(spark, sf_dir):
    """The exchange of the texts that ask is the one of the texts that are judged."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = lm.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored.collect()
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]


def test_equal_rows_are_dealt_to_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 1 << 10)
    same = spark.range(0, 4000, 1, 8).selectExpr("7L AS doc_id", "'one and the same text' AS text")
    marks = labels(spark, [(7, 1)]).selectExpr("doc_id", "true AS good")
    sizes = same.groupBy("doc_id").agg(F.count("*").alias("n_rows"))
    chunks, _ = lm._chunked(same, marks, sizes, 4000, 83)
    assert chunks.groupBy("chunk").count().agg(F.max("count")).first()[0] <= 1000
    assert chunks.filter("is_target").count() == 4000
    rows = lm.score(same, labels(spark, [(7, 1)])).collect()
    assert len(rows) == 4000
    assert len({(r.target_loss, r.background_loss) for r in rows}) == 1
    assert rows[0].difference == pytest.approx(0)


def test_losses_of_odd_documents(spark):
    rows = lm.score(documents(spark), labels(spark)).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        assert row.n_words == len(words(row.row.text))
        if not row.n_words:
            assert (row.target_loss, row.background_loss, row.difference) == (0, 0, 0)
        assert math.isfinite(row.difference)


def test_language_model_of_empty_tables(spark):
    assert lm.score(documents(spark, []), labels(spark, [])).collect() == []
    assert all(math.isfinite(r.difference) for r in lm.score(documents(spark), labels(spark, [])).collect())
