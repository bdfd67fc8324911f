"""Quality of whole texts by a convolutional network over their bytes, in numpy.

A text is cut into chunks of ``STEP`` filter positions; each chunk also holds the ``WIDTH - 1``
bytes behind its last position, so chunks overlap and every position of every byte string lies
in exactly one of them. Learned filters slide over the bytes of a chunk (a weight for each
byte at each of ``WIDTH`` places), the greatest answer of each filter in the chunk is kept, and
a text is the mean and the maximum of its chunks. One layer turns these into a probability.

The network is fitted by gradient descent on at most ``PER_CLASS`` labelled rows of each class
and ``FIT_BYTES`` bytes of text, in one task: gradients reach only the byte string that answered most.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .limits import small_enough, written
from .words import flat

WIDTH = 8  # bytes under a filter; even, as two are looked up at a time
STEP = 256
FILTERS = 24
PER_CLASS = 1500
FIT_BYTES = 6_000_000
EPOCHS = 12
PAD = 256  # stands behind the end of a text
_PART = 48  # chunks at a time: their answers fit a core's cache
_SLICE = 1 << 20


class Model(NamedTuple):
    filters: np.ndarray  # WIDTH x 257 x FILTERS
    bias: np.ndarray
    out: np.ndarray  # for means, then for maxima
    place: float


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of STEP + WIDTH - 1 bytes, PAD behind the end, and the first row of each text."""
    sizes = np.diff(offsets)
    many = -(-sizes // STEP)
    first = np.r_[0, np.cumsum(many)]
    begin = offsets[:-1].repeat(many) + STEP * (np.arange(first[-1]) - first[:-1].repeat(many))
    at = begin[:, None] + np.arange(STEP + WIDTH - 1)
    rows = np.full(at.shape, PAD, np.uint16)
    inside = at < offsets[1:].repeat(many)[:, None]
    rows[inside] = data[at[inside]]
    return rows, first


def pair_tables(filters: np.ndarray) -> np.ndarray:
    """Answers to two bytes in a row: a lookup for each pair of places."""
    pairs = filters[0::2, :, None, :] + filters[1::2, None, :, :]
    return np.ascontiguousarray(pairs.reshape(WIDTH // 2, 257 * 257, -1), np.float32)


def answers(rows: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Sums under every filter at every position of some chunks."""
    pairs = rows[:, :-1].astype(np.int32) * 257 + rows[:, 1:]
    total = tables[0].take(pairs[:, :STEP], axis=0)
    for k in range(1, len(tables)):
        total += tables[k].take(pairs[:, 2 * k : 2 * k + STEP], axis=0)
    total[rows[:, :STEP] == PAD] = -np.inf
    return total


def pooled(rows: np.ndarray, tables: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The greatest answer of each filter in each chunk, zero if negative."""
    best = [answers(rows[lo : lo + _PART], tables).max(axis=1) for lo in range(0, len(rows), _PART)]
    best = np.concatenate(best) if best else np.zeros((0, len(bias)), np.float32)
    return np.maximum(best + bias, 0)


def combined(best: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean and maximum over the chunks of each text; zeros for a text without bytes."""
    n = np.diff(first)
    out = np.zeros((len(n), 2 * best.shape[1]), np.float32)
    full = np.flatnonzero(n)
    if len(full):
        out[full] = np.hstack([
            np.add.reduceat(best, first[:-1][full], dtype=np.float64) / n[full][:, None],
            np.maximum.reduceat(best, first[:-1][full])])
    return out


def probabilities(texts: pa.Array, model: Model, tables: np.ndarray) -> np.ndarray:
    """One for each text, taken in slices of about a megabyte."""
    data, offsets = flat(texts)
    scores, lo = np.zeros(len(texts)), 0
    while lo < len(texts):
        hi = int(np.searchsorted(offsets, offsets[lo] + _SLICE, side="right")) - 1
        hi = min(max(hi, lo + 1), len(texts))
        own = offsets[lo : hi + 1]
        bags, begin = [], 0  # a long text is cut between chunks
        if hi == lo + 1 and own[1] - own[0] > _SLICE:
            for begin in range(0, own[1] - own[0], _SLICE):
                end = min(begin + _SLICE + WIDTH - 1, own[1] - own[0])
                rows, _ = chunks(data[own[0] + begin : own[0] + end], np.array([0, end - begin]))
                bags.append(pooled(rows[: _SLICE // STEP], tables, model.bias))
            best, first = np.concatenate(bags), np.array([0, sum(map(len, bags))])
        else:
            rows, first = chunks(data[own[0] : own[-1]], own - own[0])
            best = pooled(rows, tables, model.bias)
        logits = combined(best, first) @ model.out + model.place
        scores[lo:hi] = 1 / (1 + np.exp(-np.clip(logits, -30, 30).astype(np.float64)))
        lo = hi
    return scores


class _Adam:
    """Steps for one array, scaled by running moments of its gradients."""

    def __init__(self, value: np.ndarray, rate: float) -> None:
        self.value, self.rate, self.n = value, rate, 0
        self.mean, self.square = np.zeros_like(value), np.zeros_like(value)

    def step(self, slope: np.ndarray) -> None:
        self.n += 1
        self.mean += 0.1 * (slope - self.mean)
        self.square += 0.01 * (slope * slope - self.square)
        unbiased = np.sqrt(self.square / (1 - 0.99**self.n)) + 1e-6
        self.value -= self.rate * (self.mean / (1 - 0.9**self.n)) / unbiased


def fit(texts: list[str], good: list[int], share: float, epochs: int = EPOCHS, seed: int = 0) -> Model:
    """The network for labelled texts; ``share`` of label 1 among all labelled rows sets the odds.

    Without both classes it has nothing to learn and gives everything that share.
    """
    rng, y = np.random.default_rng(seed), np.asarray(good, np.float32)
    place = float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3))))
    weights = rng.normal(0, 0.3, (WIDTH, 257, FILTERS)).astype(np.float32)
    weights[:, PAD] = 0
    bias, out = np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS, np.float32)
    if not len(y) or y.min() == y.max():
        return Model(weights, bias, out, place)
    per_row = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    data, offsets = flat(pa.array(texts, pa.string()))
    rows, first = chunks(data, offsets)
    place = np.array([place], np.float32)
    parts = [_Adam(weights, 0.01), _Adam(bias, 0.01), _Adam(out, 0.02), _Adam(place, 0.02)]
    for epoch in range(epochs):
        for part in parts:  # smaller steps towards the end
            part.rate *= 1.0 if epoch < epochs // 2 else 0.7
        order = rng.permutation(len(y))
        for lo in range(0, len(order), 32):
            batch = order[lo : lo + 32]
            own = np.concatenate([np.arange(first[i], first[i + 1]) for i in batch])
            begin = np.r_[0, np.cumsum(first[batch + 1] - first[batch])]
            tables, best, where = pair_tables(weights), [], []
            for k in range(0, len(own), _PART):
                answer = answers(rows[own[k : k + _PART]], tables)
                where.append(answer.argmax(axis=1))
                best.append(np.take_along_axis(answer, where[-1][:, None], 1)[:, 0])
            if not best:
                continue
            best, where = np.maximum(np.concatenate(best) + bias, 0), np.concatenate(where)
            features = combined(best, begin)
            p = 1 / (1 + np.exp(-np.clip(features @ out + place[0], -30, 30)))
            error = (per_row[batch] * (p - y[batch]) / len(batch)).astype(np.float32)
            text = np.repeat(np.arange(len(batch)), np.diff(begin))
            slope = (error / np.maximum(np.diff(begin), 1))[text][:, None] * out[:FILTERS]
            peak = best == features[text, FILTERS:]
            ties = np.add.reduceat(peak, begin[:-1][np.diff(begin) > 0], axis=0) if len(own) else peak
            ties = np.repeat(np.maximum(ties, 1), np.diff(begin)[np.diff(begin) > 0], axis=0)
            slope += np.where(peak, error[text][:, None] * out[FILTERS:] / ties, 0)
            slope[best <= 0] = 0
            chunk, filter_ = np.nonzero(slope)
            value, at = slope[chunk, filter_], where[chunk, filter_]
            change = np.stack([
                np.bincount(rows[own[chunk], at + k].astype(np.int64) * FILTERS + filter_, value, 257 * FILTERS)
                for k in range(WIDTH)]).reshape(weights.shape).astype(np.float32)
            change[:, PAD] = 0
            parts[0].step(change)
            parts[1].step(slope.sum(axis=0))
            parts[2].step(features.T @ error + 1e-4 * out)
            parts[3].step(error.sum(keepdims=True))
    return Model(weights, bias, out, float(place[0]))


def _packed(model: Model) -> list[bytes]:
    return [np.asarray(x, np.float32).tobytes() for x in model]


def _unpacked(parts: list[bytes]) -> Model:
    filters, bias, out, place = (np.frombuffer(p, np.float32) for p in parts)
    return Model(filters.reshape(WIDTH, 257, FILTERS), bias, out, float(place[0]))


def _fitting(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["draw"], r["text"], r["label"]) for b in batches for r in b.to_pylist())
        model = fit([r[1] for r in rows], [r[2] for r in rows], share)
        yield pa.RecordBatch.from_arrays([pa.array([_packed(model)], pa.list_(pa.binary()))], ["parts"])

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", per_class: int = PER_CLASS, most_bytes: int = FIT_BYTES) -> Model:
    """The network for labelled documents.

    About ``per_class`` ids of each class are drawn by a hash, on the labels alone; only their texts are
    looked up. If these have more than ``most_bytes`` bytes, as many are drawn again as fit (a text above
    a sixteenth of that is not drawn, which bounds the sample). Rows without id or label are left out;
    the smallest of several labels of one id counts, and the smallest of several texts. Tables
    without labelled rows give a network that answers one half. Only ``id_col``, ``text_col`` and
    ``label_col`` are read.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").groupBy("id").agg(F.min("label").alias("label"))
    known = written(known, "quality-labels")
    found = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = found.get(1, 0) / sum(found.values()) if found else 0.5

    def drawn(seed: int, rates: dict[int, float]) -> Column:
        draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30))
        limits = [(F.col("label") == label) & (draw < int(rate * (1 << 30))) for label, rate in rates.items()]
        return reduce(lambda a, b: a | b, limits, F.lit(False))

    ids = known.where(drawn(11, {label: min(1.0, per_class / n) for label, n in found.items()}))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.where(F.octet_length("text") <= most_bytes // 16).join(small_enough(written(ids, "quality-ids")), "id")
    sample = written(texts.groupBy("id", "label").agg(F.min("text").alias("text")), "quality-sample")
    sizes = sample.groupBy("label").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    sample = sample.where(drawn(12, {r["label"]: min(1.0, most_bytes / 2 / max(r["n"], 1)) for r in sizes}))
    rows = sample.select(F.xxhash64("id").alias("draw"), "text", "label")
    model = rows.coalesce(1).mapInArrow(_fitting(share), "parts array<binary>").first()
    return _unpacked([bytes(p) for p in model["parts"]]) if model else fit([], [], share)


def _scored(model):
    tables = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "pairs" not in tables:
            tables["model"] = _unpacked(model.value)
            tables["pairs"] = pair_tables(tables["model"].filters)
        for batch in batches:
            scores = probabilities(batch.column(0), tables["model"], tables["pairs"])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores, pa.float64())], [*batch.schema.names[1:], "new_score"])

    return run


def score_quality(docs: DataFrame, model: Model, text_col: str = "text", output: str = "score",
                  columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all by default) and ``output``, 0 to 1, of every whole text.

    A null or empty text has no chunk and gets what the output layer gives to zeros. Rows stay
    as they are, also with null or repeated ids; a column already named ``output`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_packed(model))
    kept = [c for c in (docs.columns if columns is None else columns) if c != output]
    inner = [f"c{i}" for i in range(len(kept))]
    rows = docs.select(F.col(text_col), *(F.col(f"`{c}`").alias(i) for c, i in zip(kept, inner)))
    kinds = [f"{i} {rows.schema[i].dataType.simpleString()}" for i in inner]
    scored = rows.mapInArrow(_scored(sent), ", ".join([*kinds, "new_score double"]))
    return scored.select(*(F.col(i).alias(c) for c, i in zip(kept, inner)), F.col("new_score").alias(output))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Contract of op11: labels of the other four folds only; every document is scored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = score_quality(docs, fit_quality(docs, labels), columns=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
