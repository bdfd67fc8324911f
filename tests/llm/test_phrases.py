import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pressmill.llm import phrases as module
from pressmill.llm.phrases import PHRASES_SQL, phrase_counts, phrase_mining, phrases
from tests.oracle import compare, connect

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, longest):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return counts, totals


def brute(rows, least, longest, top, cover):
    out = []
    counts, totals = counted(rows, longest)
    for lang, f in counts.items():
        found = []
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        for p in candidates:
            a = f[p]
            score, cut = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            held = any(len(q) > len(p) and 100 * f[q] >= cover * a and
                       any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in candidates)
            if not held:
                found.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def corpus(seed=0, n=120):
    rng = random.Random(seed)
    words = ["The", "of", "New", "York", "city", "ć", "Ć", "İ", "a" * 300, "und", "😀", "x-y"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words[: rng.randint(2, 12)]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\x0b", "\x0c", "\xa0"])
                       for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice([i, None, 1]), rng.choice([text, text, text, None, ""]) if i % 9 else "new york city " * 40,
                     rng.choice(["en", "en", None, "und", "de"])))
    return rows


@pytest.mark.parametrize("least, longest, top, cover", [(10, 3, 2000, 50), (2, 3, 7, 100), (3, 4, 2000, 30), (4, 2, 2000, 50)])
def test_against_counters(spark, least, longest, top, cover):
    rows = corpus()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    frame = frame.select("*", *(F.lit("x").alias(c) for c in ("w1", "n", "phrase", "words")))
    got = sorted(tuple(r) for r in phrases(frame, least, longest, top, cover).collect())
    want = brute(rows, least, longest, top, cover)
    assert got == want and want


def test_small_parts_and_few_buckets_change_nothing(spark, monkeypatch):
    rows = corpus(1, 60)
    want, totals = counted(rows, 3)
    want = {(lang, p): n for lang, f in want.items() for p, n in f.items() if n >= 3}
    want.update({(lang, ()): n for lang, n in totals.items() if n >= 3})
    # Workers import the module afresh, so the driver's figures are sent along in the functions.
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {(r.lang, tuple(r.words)): r.f for r in phrase_counts(frame, 3).collect()}
    assert got == want


def test_parts_hold_whole_rows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(module, "PART_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["a b", "c" * 30, "", "d e f g", "h"], "lang": ["x"] * 5})
    parts = [t.names.take(pa.array(t.word)).to_pylist() for t, _ in module._parts(iter([batch, batch]))]
    assert [w for p in parts for w in p] == ["a", "b", "c" * 30, "d", "e", "f", "g", "h"] * 2 and len(parts) > 3


def test_open_buckets_never_hide_a_frequent_pair(spark):
    rows = [(i, "p q" if i < 5 else f"u{i} v{i}", "en") for i in range(400)]
    texts = spark.createDataFrame(rows, SCHEMA).select("text", "lang").repartition(7)
    for longest in (2, 3):
        bits, table = module.open_buckets(texts, 5, longest)
        assert bits == module.BLOCK_BITS and 0 < sum(bin(b).count("1") for b in table.tolist()) < 5


def test_no_rows_and_no_words(spark):
    assert phrases(spark.createDataFrame([], SCHEMA)).collect() == []
    assert phrases(spark.createDataFrame([(1, None, "en"), (2, "", None), (3, " .,", "de")], SCHEMA)).collect() == []


def test_query_agrees_with_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), sf_dir, phrase_mining, PHRASES_SQL) is None
