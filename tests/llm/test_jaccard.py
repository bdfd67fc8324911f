import random
import re

import numpy as np
import pytest

from pressmill.llm.jaccard import jaccard_components, ngram_jaccard, prefix_signatures


def brute(rows, n, num, den):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(lower))
        sets.append((doc, {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}))
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and den * len(x & y) >= num * len(x | y):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(s), least.get(find(i))) for i, (doc, s) in enumerate(sets) if doc is not None)


def near_copies(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            text = rng.choice(out).split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                text[rng.randrange(len(text))] = rng.choice(words)
        else:
            text = rng.choices(words[: rng.choice([5, 50, 400])], k=rng.choice([1, 2, 3, 8, 60, 200]))
        out.append(" ".join(text))
    return list(enumerate(out))


@pytest.mark.parametrize("n, num, den, frequent", [(3, 90, 100, 2), (5, 80, 100, 4), (1, 60, 100, 3)])
def test_against_brute_force(spark, n, num, den, frequent):
    rows = near_copies(n)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_components(docs, n=n, num=num, den=den, frequent=frequent, flag_bits=16)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, n, num, den)


def test_signatures_meet_for_every_pair_that_links():
    rng = np.random.default_rng(3)
    universe = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    often = rng.random(len(universe)) < 0.6
    for _ in range(300):
        n = int(rng.integers(2, 250))
        x = np.sort(rng.choice(universe, n, replace=False))
        drop = int(rng.integers(0, n // 10 + 1))
        y = np.unique(np.r_[rng.permutation(x)[drop:], rng.choice(universe, int(rng.integers(0, n // 20 + 1)), replace=False)])
        both = len(np.intersect1d(x, y))
        if 100 * both < 85 * (len(x) + len(y) - both) or np.array_equal(x, y):
            continue
        signs = [prefix_signatures(s, np.ones(len(s), bool), often[np.searchsorted(universe, s)], 85, 100) for s in (x, y)]
        assert len(np.intersect1d(*signs))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "a b"), (7, "a b"), (8, "x " * 50_000), (9, "x " * 9),
            (9, "x " * 9), (None, "a b"), (None, "alone here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as doc", "2 as n", "3 as cls")
    got = jaccard_components(docs, n=3, num=90, den=100)
    assert got.count() == len(rows)
    assert sorted(tuple(r) for r in got.where("doc_id is not null").collect()) == brute(rows, 3, 90, 100)
    assert sorted(r.component_id or -1 for r in got.where("doc_id is null").collect()) == [-1, 6]
    assert jaccard_components(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        jaccard_components(docs, num=50, den=100)


def test_rows_without_id_or_with_one_id_keep_their_links(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(900)]
    a, b, c = (rng.choices(words, k=200) for _ in range(3))

    def near(text, k):
        return " ".join([*text[:k], "other", *text[k + 1 :]])

    rows = [(1, " ".join(a)), (None, near(a, 50)), (None, near(b, 60)), (None, " ".join(b)), (7, near(b, 120)),
            (9, " ".join(c)), (9, near(a, 150)), (9, "unlike all others"), (4, near(c, 10)), (None, " ".join(c)), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id or 0, r.component_id or 0) for r in jaccard_components(docs, n=3, num=90, den=100).collect()))
    assert got == sorted([(1, 1), (0, 1), (0, 7), (0, 7), (7, 7), (9, 4), (9, 1), (9, 9), (4, 4), (0, 4), (0, 0)])


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in ngram_jaccard(spark, sf_dir).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(rows, 3, 90, 100)
