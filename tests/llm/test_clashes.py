"""Columns that are named like something inside an operator or like a result."""

import pytest

from pressmill.llm.decontamination import find_items
from pressmill.llm.lines import dedup_lines
from pressmill.llm.toxicity import fit, score_toxicity

NAMES = ["doc", "run_id", "run_text", "run_spans", "bench_text", "bench_hits", "scored_text", "score", "start", "id", "a b", "carried_0"]


@pytest.fixture()
def docs(spark):
    rows = [(i, "one line here\nand a second line\nthird of them" if i else None, *[f"{n}{i}" for n in NAMES]) for i in range(3)]
    return spark.createDataFrame(rows, ["doc_id", "text", *NAMES])


def carried(rows, names):
    return all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def test_line_dedup(docs):
    got = dedup_lines(docs, carry=tuple(NAMES))
    assert got.columns == ["doc_id", *NAMES, "kept", "n_lines", "n_removed"]
    rows = got.collect()
    assert carried(rows, NAMES) and {r.doc_id: (r.n_lines, r.n_removed) for r in rows} == {0: (0, 0), 1: (3, 0), 2: (3, 3)}


def test_toxicity(docs):
    got = score_toxicity(docs, fit([], []))
    others = [n for n in NAMES if n != "score"]
    assert got.columns == ["doc_id", "text", *others, "score"]
    assert carried(got.collect(), others)


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(5, "one line here and a second line")], "item_id long, text string")
    got = find_items(docs, bench, carry=tuple(NAMES))
    assert got.columns == ["doc_id", *NAMES, "hits"]
    rows = got.collect()
    assert carried(rows, NAMES) and {r.doc_id: len(r.hits) for r in rows} == {0: 0, 1: 1, 2: 1}
    with pytest.raises(ValueError):
        find_items(docs.withColumnRenamed("id", "hits"), bench, carry=("hits",))
