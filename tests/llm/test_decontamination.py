import math
import random

from pressmill.llm.decontamination import benchmark_decontamination, find_items


def shingles(words):
    n = min(5, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()


def brute(docs, items, least=0.8):
    """All windows as long as an item, at every place; weights as documented."""
    items = [(i, (t or "").lower().split()) for i, t in items]
    items = [(i, w) for i, w in items if w]
    count = {}
    for _, w in items:
        for s in shingles(w):
            count[s] = count.get(s, 0) + 1
    weight = lambda ss: sum(math.log1p(len(items) / count.get(s, 1)) for s in ss)
    out = {}
    for doc, text in docs:
        words, hits = (text or "").lower().split(), set()
        for i, w in items:
            n, own = min(5, len(w)), shingles(w)
            for start in range(n - len(w), len(words) - n + 1):
                part = words[max(start, 0) : start + len(w)]
                near = {tuple(part[k : k + n]) for k in range(len(part) - n + 1)}
                if near & own and weight(near & own) / max(weight(near), weight(own)) >= least - 1e-12:
                    hits.add(i)
        out[doc] = sorted(hits)
    return out


def test_against_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 12, 30, 45])))) for i in range(30)]
    items += [(30, "just One"), (31, None), (32, " "), (33, items[5][1])]
    docs = []
    for d in range(60):
        text = rng.choices(words, k=rng.randint(0, 80))
        if d % 2:
            part = rng.choice(items[:30])[1].split()
            for _ in range(rng.choice([0, 1, 2])):
                kind, at = rng.randrange(3), rng.randrange(len(part))
                part[at : at + (kind != 0)] = [] if kind == 1 else [rng.choice(words)]
            at = rng.randint(0, len(text))
            text[at:at] = part
        docs.append((d, " ".join(text)))
    docs += [(100, None), (101, ""), (102, "so JUST one"), (103, items[7][1]), (104, "z " * 60_000 + items[8][1].upper())]
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as item_id", "1 as similarity")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 as doc_id")
    got = {r.doc_id: sorted(h.item_id for h in r.hits) for r in find_items(table, bench, carry=("item_id",)).collect()}
    want = brute(docs[:-1], items)
    assert {d: h for d, h in got.items() if d != 104} == want
    assert got[104] == [8]


def test_edges(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b c d e f"), (2, "")], "item_id long, text string")
    got = sorted((r.doc_id or 0, len(r.hits)) for r in find_items(docs, items).collect())
    assert got == [(0, 1), (1, 0), (1, 1)]
    assert all(not r.hits for r in find_items(docs, items.limit(0)).collect())
    assert find_items(docs.limit(0), items).count() == 0


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in benchmark_decontamination(spark, sf_dir).collect()}
    assert set(got) == {d for d, _ in docs}
    flat = lambda t: " ".join((t or "").lower().split())
    for doc, text in docs:
        assert {i for i, t in items if f" {flat(t)} " in f" {flat(text)} "} <= set(got[doc].item_ids)
