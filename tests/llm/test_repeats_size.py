"""Work of the substring operator: in proportion to the words, whatever the parts and however periodic the text."""

import random
import time

import pyarrow as pa
import pytest

from pressmill.llm.substrings import ANCHOR, SuffixAutomaton, _entries, _resolve
from pressmill.llm.words import split

WINDOW = 20


def blobs(rows, bits):
    batch = pa.RecordBatch.from_pydict({"doc": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows]})
    return list(_entries(WINDOW, bits, ANCHOR, split)(iter([batch])))


def test_a_stretch_costs_the_same_for_many_parts():
    rng = random.Random(7)
    rows = [(d, " ".join(f"w{rng.randrange(5000)}" for _ in range(500))) for d in range(400)]

    def seconds(bits):
        took = []
        for _ in range(3):
            began = time.process_time()
            blobs(rows, bits)
            took.append(time.process_time() - began)
        return min(took)

    assert seconds(13) < 6 * seconds(4)


def test_a_periodic_text_is_streamed_in_steps_of_its_words():
    class Counted(list):
        reads = 0

        def __getitem__(self, k):
            Counted.reads += 1
            return list.__getitem__(self, k)

    n = 2000
    automaton = SuffixAutomaton([1] * n)
    automaton.link = Counted(automaton.link)
    assert automaton.first_starts([1] * n, WINDOW) == [0] * (n - WINDOW + 1)
    assert Counted.reads < 4 * n


@pytest.mark.parametrize("bits", [1, 4, 9])
def test_candidates_do_not_depend_on_parts(bits):
    rng = random.Random(3)
    pieces = [[f"w{rng.randrange(40)}" for _ in range(rng.randint(10, 50))] for _ in range(10)]
    texts = [sum(rng.choices(pieces, k=rng.randint(1, 6)), []) for _ in range(60)] + [["x"] * 90, ["a", "b"] * 30, ["y"] * 19]
    rows = list(zip([-(1 << 63), *range(len(texts) - 1)], texts))  # a null id is the smallest long
    want, seen = set(), set()
    for doc, words in rows:
        for k in range(len(words) - WINDOW + 1):
            key = tuple(words[k : k + WINDOW])
            if key in seen:
                want.add((doc, k))
            seen.add(key)
    parts = {}
    for lo in range(3):
        for batch in blobs([(d, " ".join(w)) for d, w in rows[lo::3]], bits):
            batch.validate(full=True)
            fields = batch.schema
            for row in batch.to_pylist():
                parts.setdefault(row["part"], []).append(row)
    assert set(parts) <= set(range(1 << bits))
    got = set()
    for own in parts.values():
        runs = _resolve(pa.Table.from_pylist(own, schema=fields)).to_pydict()
        for doc, start, size, ref, ref_start in zip(*runs.values()):
            assert (ref, ref_start) < (doc, start)
            got |= {(doc, start + i) for i in range(size)}
    assert got == want


def test_blobs_of_many_batches_keep_their_bounds():
    text = " ".join(f"t{k}" for k in range(40))
    out = blobs([(d, text) for d in (3, 1, 2)], 3)
    assert sum(batch.num_rows for batch in out) == len({r["part"] for b in out for r in b.to_pylist()})
    total = sum(len(r["tails"]) // 4 for b in out for r in b.to_pylist())
    assert total == 40 - WINDOW + 1  # each window once, however many texts have it
    assert sum(len(r["runs"]) // 40 for b in out for r in b.to_pylist()) == 2
