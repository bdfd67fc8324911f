import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressmill.llm.quality import (
    FILTERS, PAD, STEP, WIDTH, Model, answers, chunks, fit, fit_quality, pair_tables, probabilities, quality_classifier,
    score_quality)

WORDS = "the of and river stone light paper garden window market bread music".split()


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(5, 200))
        good = int(i % 4 > 0)
        if not good:
            words = [w + rng.choice(["%%%", "&&&"]) for w in words] if i % 8 else [words[0]] * len(words)
        rows.append((i, " ".join(words), good))
    return rows


def random_model(seed=0):
    rng = np.random.default_rng(seed)
    filters = rng.normal(0, 1, (WIDTH, 257, FILTERS)).astype(np.float32)
    filters[:, PAD] = 0
    return Model(filters, rng.normal(0, 1, FILTERS).astype(np.float32), rng.normal(0, 1, 2 * FILTERS).astype(np.float32), 0.3)


def plain(text, model):
    """The network by its definition, position by position."""
    data = list((text or "").encode()) + [PAD] * (WIDTH - 1)
    n, best = len(data) - WIDTH + 1, []
    for lo in range(0, n, STEP):
        own = [sum(model.filters[k, data[p + k]].astype(float) for k in range(WIDTH)) for p in range(lo, min(lo + STEP, n))]
        best.append(np.maximum(np.max(own, axis=0) + model.bias, 0))
    features = np.r_[np.mean(best, axis=0), np.max(best, axis=0)] if best else np.zeros(2 * FILTERS)
    return 1 / (1 + np.exp(-np.clip(features @ model.out + model.place, -30, 30)))


def test_network_by_its_definition():
    model, rng = random_model(), random.Random(0)
    texts = [None, "", "a", "é" * 3, "x" * (STEP - 1), "y" * STEP, "z" * (STEP + 1), "".join(chr(rng.randrange(32, 700)) for _ in range(900))]
    got = probabilities(pa.array(texts), model, pair_tables(model.filters))
    assert np.allclose(got, [plain(t, model) for t in texts], atol=1e-4)


def test_long_text_in_slices_is_one_text(monkeypatch):
    from pressmill.llm import quality

    model, rng = random_model(1), random.Random(1)
    text = "".join(chr(rng.randrange(32, 126)) for _ in range(20_000))
    whole = probabilities(pa.array(["q", text, "r"]), model, pair_tables(model.filters))
    monkeypatch.setattr(quality, "_SLICE", 4 * STEP)
    assert np.allclose(probabilities(pa.array(["q", text, "r"]), model, pair_tables(model.filters)), whole, atol=1e-6)


def test_chunks_overlap_and_cover():
    rows, first = chunks(np.arange(600, dtype=np.int64).astype(np.uint8), np.array([0, 0, 600]))
    assert first.tolist() == [0, 0, 3] and rows.shape == (3, STEP + WIDTH - 1)
    assert (rows[1, : WIDTH - 1] == rows[0, STEP:]).all() and (rows[2, 600 - 2 * STEP :] == PAD).all()
    assert np.isneginf(answers(rows, pair_tables(random_model().filters))[2, 600 - 2 * STEP :]).all()


def test_gradient_lowers_the_loss():
    rows = corpus(120)
    texts, y = [r[1] for r in rows], np.array([r[2] for r in rows])
    def loss(model):
        p = probabilities(pa.array(texts), model, pair_tables(model.filters))
        return -np.mean(np.log(np.where(y == 1, p, 1 - p)))
    assert loss(fit(texts, y.tolist(), 0.75, epochs=12)) < 0.3 * loss(fit(texts, y.tolist(), 0.75, epochs=0))


def test_one_class_gives_its_share():
    model = fit(["a", "b"], [1, 1], 0.9)
    assert np.allclose(probabilities(pa.array(["a", "", None]), model, pair_tables(model.filters)), 0.9)


def test_unseen_texts_and_edges(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, "x"), (1, rows[1][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (1, None), (5, 5)], "doc_id long, quality int")
    model = fit_quality(docs, labels)
    again = fit_quality(docs.repartition(7), labels)
    assert all(np.array_equal(a, b) for a, b in zip(model, again))
    new = corpus(80, seed=9)
    extra = [(None, None, 0), (7, "", 0), (7, "", 0), (8, " ".join(WORDS) * 20_000, 1)]
    frame = spark.createDataFrame(
        [(a, b, 5.0, "s", c) for a, b, c in new + extra], "doc_id long, text string, score double, `new score` string, c0 int")
    got = score_quality(frame, model)
    assert got.columns == ["doc_id", "text", "new score", "c0", "score"]
    rows = got.collect()
    assert len(rows) == 84 and all(0 <= r.score <= 1 for r in rows)
    right = [(r.score >= 0.5) == bool(r.c0) for r in rows if r.text]
    assert np.mean(right) > 0.95
    assert score_quality(frame.limit(0), model).collect() == []


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    model = fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert score_quality(docs, model).first().score == pytest.approx(0.5)


def test_query(spark, sf_dir):
    rows = quality_classifier(spark, sf_dir)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert rows.where("predicted <> cast(score >= 0.3 as int) or score is null").isEmpty()
    assert dict(rows.dtypes)["predicted"] == "int"
    assert rows.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 5 == 0)).isEmpty()
