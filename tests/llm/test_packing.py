import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from pressmill.llm.packing import VOCABULARY, WordIds, best_fit_packing, fit, make_plan, pack, patterns, tokenizer
from pressmill.llm.words import slices


def filled(histogram, size, classes=512):
    """Sequence -> pieces (offset, length) by the plan; every rank of every length once."""
    table, out = make_plan(histogram, size, classes).table(), {}
    for length, count in histogram.items():
        own = [r for r in table.tolist() if r[0] == length]
        for rank in range(count):
            _, first, times, sequence, offset = [r for r in own if r[1] <= rank][-1]
            k = rank - first
            out.setdefault(sequence + k % times, []).append((offset + k // times * length, length))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_gapless_and_tight(seed):
    rng, size = random.Random(seed), 64
    histogram = {}
    for _ in range(rng.choice([1, 30, 3000])):
        length = min(size, 1 + int(rng.expovariate(1 / rng.choice([5, 20]))))
        histogram[length] = histogram.get(length, 0) + 1
    bins = filled(histogram, size)
    assert sum(map(len, bins.values())) == sum(histogram.values())
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    tokens = sum(k * v for k, v in histogram.items())
    assert len(bins) <= 1.03 * tokens / size + 1 or len(bins) <= sum(v for k, v in histogram.items() if 2 * k > size) * 1.03 + 1


def test_fit_finds_an_exact_mixture():
    shapes = patterns(16)
    want = np.zeros(len(shapes))
    want[[3, 10, 17]] = [5, 2, 7]
    counts = np.zeros(17)
    for shape, times in zip(shapes, want):
        for c in shape[shape > 0]:
            counts[c] += times
    x = fit(counts, shapes, 1e-9)
    got = np.zeros(17)
    for shape, times in zip(shapes, x):
        for c in shape[shape > 0]:
            got[c] += times
    assert (x >= 0).all() and np.allclose(got, counts, atol=1e-2)


def test_no_rows_no_plan():
    assert make_plan({}).table().shape == (0, 5)


def ids_of(coder, texts):
    (_, _, words), = slices(pa.array(texts, pa.string()), 1 << 30)
    ids, begins = coder.encode(words, 7)
    assert len(begins) == len(texts) + 1 and begins[-1] == len(ids)
    own = [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])]
    assert all(i[-1] == 7 for i in own)
    return [i[:-1] for i in own]


TEXTS = ["", "A b", "don't  STOP now x", "é ́a", "ΣΑΣ Σ", "x" * 300, "1234 🙂🙂 a_b", "İI\x00 \x1cz", "İ. İ İ? ẞ! K. ſ,",
         "<|ENDOFTEXT|> <|EndOfText|>. <|endoftext|> a<|endoftext|>. <|startoftext|>, <| |> <|endoftext|", None,
         "it's. IT'S! 'S. a'. a.b. a.. .", "e\u0301. E\u0301 A\u030a. a\u00a0b.\u2003C", "word " * 3000]


def test_words_have_the_ids_of_the_text():
    coder = tokenizer(VOCABULARY)
    want = [coder.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    for most in (1 << 20, 3):  # a full table starts anew
        table = WordIds(VOCABULARY, most)
        for _ in range(2):
            assert ids_of(table, TEXTS) == want
            assert [ids_of(table, [t])[0] for t in TEXTS] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aAiİIıſK.,!?'<|>sSendoftxt \n\u0301\u0307éÉß1🙂_"), max_size=40), min_size=1, max_size=6))
def test_any_words(texts):
    coder = tokenizer(VOCABULARY)
    assert ids_of(WordIds(VOCABULARY), texts) == [coder.encode(t, add_special_tokens=False).ids for t in texts]


def check(rows, texts, size=2048):
    coder, by, bins = tokenizer(VOCABULARY), {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by) == set(texts)
    for doc, own in by.items():
        ids = np.array(coder.encode(texts[doc] or "", add_special_tokens=False).ids + [0], np.uint32)
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // size)))
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert r.start == r.piece * size and len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b c"), (4, "word " * 5000), (5, "same text"), (6, "same text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as rank", "2 as length", "3 as id")
    out = pack(docs).collect()
    check(out, dict(rows))
    assert np.frombuffer(out[0].token_ids, np.uint32)[-1] is not None
    assert pack(docs.union(docs)).count() == 2 * len(out)
    assert pack(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = best_fit_packing(spark, sf_dir).collect()
    check(rows, texts)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.05 * total / 2048 + 1
