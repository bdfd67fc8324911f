import hashlib
import random
import re

import pytest

from pressmill.llm.lines import dedup_lines, line_dedup
from pressmill.llm.substrings import SuffixAutomaton, dedup_substrings, substring_dedup


def brute_words(rows, window=20):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        w = re.findall(r"[^\x20\x09-\x0d]+", text or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in seen:
                gone[k : k + window] = [True] * window
            seen.add(key)
        out[doc] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def brute_lines(rows, window=2):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        lines = (text or "").split("\n")
        solid = [k for k, line in enumerate(lines) if line.strip(" \t\n\v\f\r")]
        gone = set()
        for i in range(len(solid) - window + 1):
            key = tuple(lines[k].strip(" \t\n\v\f\r") for k in solid[i : i + window])
            if key in seen:
                gone |= set(solid[i : i + window])
            seen.add(key)
        out[doc] = (len(solid), len(gone), None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def corpus(seed, unit):
    rng = random.Random(seed)
    pieces = [unit.join(f"w{rng.randrange(60)}" for _ in range(rng.randint(5, 60))) for _ in range(12)]
    rows = [(i, unit.join(rng.choices(pieces, k=rng.randint(1, 5)))) for i in range(60)]
    return rows + [(100, "x " * 300), (101, "x " * 50), (102, "a b c " * 40), (103, None), (104, ""), (105, "é" * 90_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_words_against_brute_force(spark, seed):
    rows = corpus(seed, " ")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 as doc", "2 as spans")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in dedup_substrings(docs).collect()}
    assert got == brute_words(rows)


@pytest.mark.parametrize("window", [2, 3])
def test_lines_against_brute_force(spark, window):
    rows = corpus(window, "\n")
    rows += [(200, " w1 \n\n\tw2\r\nw3"), (201, "w1\nw2\n\nw3\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 as doc", "2 as start")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in dedup_lines(docs, window=window, carry=("doc",)).collect()}
    assert got == brute_lines(rows, window)


def test_edges(spark):
    text = " ".join(f"t{k}" for k in range(30))
    rows = [(None, text), (1, text), (1, text), (2, text + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in dedup_substrings(docs).collect())
    assert got == [(0, 0), (1, 30), (1, 30), (2, 30)]
    assert dedup_substrings(docs.limit(0)).count() == 0 and dedup_lines(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        dedup_lines(docs, carry=("kept",))


def test_automaton_knows_first_starts():
    rng = random.Random(4)
    for _ in range(200):
        text = [rng.randrange(3) for _ in range(rng.randint(1, 40))]
        asked = [rng.randrange(3) for _ in range(rng.randint(1, 30))]
        window = rng.randint(1, 6)
        want = [next((s for s in range(len(text) - window + 1) if text[s : s + window] == asked[k : k + window]), -1)
                for k in range(len(asked) - window + 1)]
        assert SuffixAutomaton(text).first_starts(asked, window) == want


def test_queries(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(spark, sf_dir).collect()}
    assert got == {d: (n, k, digest(t)) for d, (n, k, t) in brute_words(rows).items()}
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in line_dedup(spark, sf_dir).collect()}
    assert got == {d: (n, k, digest(t)) for d, (n, k, t) in brute_lines(rows).items()}
