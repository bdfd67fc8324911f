import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pressmill.llm.merkle import FAN, MERKLE_SQL, folded, manifest, merkle_manifest, siblings
from tests.oracle import compare, connect

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def path_up(nodes, place):
    """Siblings level by level, and the root, by plain lists."""
    proof = []
    while len(nodes) > 1:
        lo = place // FAN * FAN
        run = nodes[lo : lo + FAN]
        proof.append((run[: place - lo], run[place - lo + 1 :]))
        nodes = [H(*nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)]
        place //= FAN
    return proof, nodes[0] if nodes else None


def brute(rows, change):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), leaf(change(row))))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    for own in trees.values():
        own.sort()
    subroots = [path_up([x[2] for x in trees[n]], 0)[1] for n in names]
    out = []
    for k, name in enumerate(names):
        nodes = [x[2] for x in trees[name]]
        upper, root = path_up(subroots, k)
        for place, (known, key, own, claim) in enumerate(trees[name]):
            proof = path_up(nodes, place)[0] + upper
            node = claim
            for left, right in proof:
                node = H(*left, node, *right)
            out.append((key if known else None, own, subroots[k], root,
                        H(*(s for left, right in proof for s in (*left, *right))), node, node == root))
    return out


def upper(row):
    return row if row[4] is None else (*row[:4], row[4].upper())


def rows_of(sizes, seed=3):
    rng, rows = random.Random(seed), []
    for lang, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Ab ć", "AB", "x" * 5000, "lower"])
            rows.append((rng.choice([None, rng.randrange(4 * n), -5]), rng.choice([None, "s"]), lang, rng.choice([None, 7]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("depth", [1, 2, 3])
@pytest.mark.parametrize("sizes", [
    {None: 1, "": 9, "de": 8, "en": 700, "Z": 65, "é": 1},
    {f"l{i:02d}": 1 + i % 3 for i in range(20)},
    {"en": 1},
    {None: 64},
])
def test_against_lists(spark, depth, sizes):
    rows = rows_of(sizes)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("tree", F.lit("x")).repartition(5)
    got = manifest(docs, tampered={"text": F.upper("text")}, depth=depth)
    want = brute(rows, upper)
    have = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got.collect()]
    order = lambda r: (str(r[0]), *r[1:])
    assert sorted(have, key=order) == sorted(want, key=order)


def test_untampered_rows_verify_and_proofs_fold(spark):
    rows = rows_of({"a": 30, None: 3})
    got = manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 33 and all(r.verified and r.folded_root == r.root for r in got)
    assert all(folded(r.leaf, r.proof) == r.root and H(siblings(r.proof)) == r.proof_sha256 for r in got)
    assert folded(H("other"), got[0].proof) != got[0].root


def test_large_ids_beside_a_null(spark):
    rows = [(2**60 + 1, "s", "en", 1, "A"), (None, "s", "en", 1, "B"), (-(2**61) - 3, None, "en", None, None)]
    got = {r.doc_id: r.leaf for r in manifest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {row[0]: leaf(row) for row in rows}


def test_no_rows(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_agrees_with_sql_and_tampers_every_third(spark, sf_dir):
    assert compare(spark, connect(sf_dir), sf_dir, merkle_manifest, MERKLE_SQL) is None
    for r in merkle_manifest(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").collect():
        text = r.text or ""
        same = zlib.crc32(str(r.doc_id).encode()) % 3 or not any("A" <= c <= "Z" for c in text)
        assert r.verified == bool(same)
