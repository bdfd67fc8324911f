import random
import re

import pytest

from pressmill.llm.secrets import BASE, MORE, find_secrets, scanner, secret_scan

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(k, s, e) for s, _, k, e in sorted(out)]


PIECES = ["token", "ToKen", "secret", "api_key", "apikey", "password", "passwd", "=", ":", " ", "'", '"', "==",
          "AKIA", "AKIAAKIA", "0123456789abcdef", "abc", "ABCDEFGH0123", "é", " ", "-----BEGIN ", "x",
          "abcdefghijkl", "\n", "_", "."]


def test_base_spans_are_those_of_the_patterns():
    compiled = scanner(BASE)
    rng = random.Random(5)
    for _ in range(6000):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 14)))
        data = text.encode()
        got = [(BASE[k].kind, len(data[:s].decode()), len(data[:e].decode())) for s, e, k in compiled.spans(data)]
        assert got == brute(text), text


def test_more_kinds_never_change_the_base():
    rng = random.Random(6)
    base, every = scanner(BASE), scanner(BASE + MORE)
    for _ in range(2000):
        data = "".join(rng.choices(PIECES + ["ghp_", "xoxb-", "AIza", "eyJa.eyJb."], k=12)).encode()
        assert [s for s in every.spans(data) if s[2] < len(BASE)] == base.spans(data)


@pytest.mark.parametrize("text, kind", [
    ("-----BEGIN RSA PRIVATE KEY-----", "pem"), ("x ghp_" + "a1B2" * 9, "github"), ("xoxb-12345-abcdef", "slack"),
    ("AIza" + "x" * 35, "google"), ("eyJhbGci.eyJzdWIi." + "k" * 20, "jwt")])
def test_more_kinds(text, kind):
    data = text.encode()
    assert kind in [(BASE + MORE)[k].kind for _, _, k in scanner(BASE + MORE).spans(data)]


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "token=abcdefghijkl"), (3, "é token=abcdefghijkl"), (3, "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as spans")
    got = {(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in find_secrets(docs).collect()}
    assert got == {(1, ()), (2, ()), (None, (("assign", 0, 18),)), (3, (("assign", 2, 20),)), (3, ())}
    assert find_secrets(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    import hashlib

    rows = secret_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = brute(texts[row.doc_id] or "")
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(w[0] == k for w in want) for k in ("assign", "access", "hex")]
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
