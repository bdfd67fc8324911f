"""Secrets in texts, found by one combined automaton in one pass over the bytes.

A rule is a head, a body sign and the least number of body signs. Matches of a rule are taken
leftmost and without overlap, as long as they go; a match whose body is too short is dropped,
but what it covers is used up. The automaton of all rules tells where matches end; only there
a small automaton of the rule, reversed, goes back to the leftmost start.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .automaton import Dfa, compile_rules, ends, longest, parse


class Rule(NamedTuple):
    kind: str
    head: str
    body: str = ""
    least: int = 0
    any_case: bool = False  # letters of the head


# The base kinds and their patterns.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
         "[A-Za-z0-9+/_.=-]", 12, True),
    Rule("access", "AKIA", "[A-Z0-9]", 14),
    Rule("hex", "", "[0-9a-f]", 16),
)
# Kinds this package adds: public formats of keys and access tokens.
MORE = (
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", "(ghp|gho|ghu|ghs|ghr)_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 10),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]", 16),
)


class Scanner:
    """All rules compiled: one automaton to scan with, and three small ones for each rule."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        trees, self.whole, self.back, self.head = [], [], [], []
        for rule in rules:
            parts = [parse(rule.head, rule.any_case)] if rule.head else []
            if rule.body:
                # Without a head a short run could not hide anything, so it need not be reported.
                parts.append(("rep", parse(rule.body), 1 if rule.head else rule.least, None))
            tree = ("seq", parts)
            trees.append(tree)
            self.whole.append(compile_rules([tree], everywhere=False))
            self.back.append(compile_rules([tree], everywhere=False, backward=True))
            self.head.append(compile_rules([parts[0]], everywhere=False) if rule.head and rule.body else None)
        self.scan: Dfa = compile_rules(trees)

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """``(start, end, rule)`` in bytes, by start, then rule."""
        events = ends(self.scan, data)
        if not events:
            return []
        out = []
        by_rule: dict[int, list[int]] = {}
        for at, state in events:
            for rule in self.scan.rules[state >> 8]:
                by_rule.setdefault(rule, []).append(at)
        for number, stops in by_rule.items():
            rule, used = self.rules[number], 0
            for here, following in zip(stops, [*stops[1:], -1]):
                if here <= used or following == here + 1:
                    continue
                start = longest(self.back[number], data, here, -1, used)
                if start < 0:
                    continue
                used = longest(self.whole[number], data, start)
                body = start
                if self.head[number] is not None:
                    body = longest(self.head[number], data, start, 1, used - 1)
                if used - body >= rule.least:
                    out.append((start, used, number))
        return sorted(out)


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """Compiled once a process; rules are few and the automaton is small."""
    return Scanner(rules)


def _scan(rules: tuple[Rule, ...]):
    kinds = [r.kind for r in rules]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = scanner(rules)
        for batch in batches:
            found = []
            for text in batch.column(1):
                data = b"" if not text.is_valid else text.as_buffer().to_pybytes()
                own = compiled.spans(data)
                if own and not data.isascii():
                    # Code points before a byte: bytes less those that continue a sequence.
                    inner = np.frombuffer(data, np.uint8) & 0xC0 == 0x80
                    point = np.arange(len(data) + 1) - np.r_[0, np.cumsum(inner)]
                    own = [(int(point[a]), int(point[b]), k) for a, b, k in own]
                found.append([{"kind": kinds[k], "start": a, "end": b} for a, b, k in own])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, span)], ["id", "spans"])

    return run


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``id_col, spans``: for every row the secrets of its text (kind, start, end in code points).

    Spans are ordered by start, then by the order of the rules; spans of different kinds may
    overlap. A null or empty text has none. Null and repeated ids keep their rows. Other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(_scan(rules), "id long, spans array<struct<kind: string, start: long, end: long>>")
    return found.withColumnRenamed("id", id_col)


def secret_scan(spark, sf_dir: str) -> DataFrame:
    """Contract of op5: counts and digest of the base kinds, and all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = [r.kind for r in BASE]
    written = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return find_secrets(docs).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
