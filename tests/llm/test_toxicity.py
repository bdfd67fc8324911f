import random

import numpy as np
import pyarrow as pa

from pressmill.llm.toxicity import decisions, fit_toxicity, letters, score_toxicity, toxicity, triples, words_of, norms, SPAN, DECAY

CLEAN = "the of and river stone light paper garden window market bread music".split()


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = rng.choices(CLEAN, k=rng.randint(5, 60))
        bad = i % 4 == 0
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["dumbhead", "nastyfool", "Rotter"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_images_are_gapped_triples():
    words, brute = words_of([b"abcde", b"x"]), {}
    for weight, word, code in triples(words):
        for w, c in zip(word.tolist(), code.tolist()):
            brute[w, c] = brute.get((w, c), 0) + weight
    letters_ = [62, 0, 1, 2, 3, 4, 63]
    want = {}
    for i in range(7):
        for j in range(i + 1, 7):
            for k in range(j + 1, min(i + SPAN, 7)):
                c = (letters_[i] << 12) + (letters_[j] << 6) + letters_[k]
                want[0, c] = want.get((0, c), 0) + DECAY ** (k - i + 1)
    assert {k: v for k, v in brute.items() if k[0] == 0} == want
    assert np.isclose(norms(words)[0] ** 2, sum(v * v for v in want.values()))


def test_letters_join_spaced_and_marked_words():
    (_, _, words), = letters(pa.array(["Hi i d i o t, x.y*z go", None, "", "1 2"]))
    got = [bytes(words.data[s:e]) for s, e in zip(words.starts, words.ends)]
    assert got == [b"hi", b"idiot", b"xyz", b"go"] and words.counts.tolist() == [4, 0, 0, 0]


def test_bent_insults_are_found_and_clean_texts_are_not(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels, per_class=200)
    texts = ["the dumb-head of", "n a s t y f o o l", "a rotxter here", "dummbhead", "bread and music", "", None, "... 12",
             "window " * 30_000, "window " * 30_000 + "rotter"]
    asked = spark.createDataFrame(list(enumerate(texts)) + [(None, "rotter"), (3, "bread")], "doc_id long, text string")
    asked = asked.selectExpr("*", "1 as scored_text2", "2 as id")
    got = [(r.doc_id, r.text, r.score) for r in score_toxicity(asked, model).collect()]
    assert len(got) == 12
    for doc, text, score in got:
        assert 0 <= score <= 1
        assert (score >= 0.5) == (doc in (0, 1, 2, 9) or text in ("rotter", "dummbhead")), (doc, score)


def test_one_class_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        model = fit_toxicity(docs, known)
        assert score_toxicity(docs, model).first().score < 0.5
        assert score_toxicity(docs.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    import duckdb

    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in toxicity(spark, sf).collect()}
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall())
    held = [(labels[d], r.predicted) for d, r in got.items() if r.held_out and d in labels]
    hits = sum(t and p for t, p in held)
    assert hits / sum(t for t, _ in held) > 0.75
    assert hits / sum(p for _, p in held) > 0.75
    assert len(got) == 10_000
