"""Toxicity of documents: a subsequence string-kernel SVM on Nyström landmarks.

The kernel compares two words by the letter triples they share as subsequences: a triple that
spans ``s`` letters counts ``DECAY ** s``, spans go up to ``SPAN``. Letters put between those
of an insult lower the similarity a little and do not break it. Signs and digits inside a word
are dropped, and single letters that stand apart are read as one word.

A document is judged by its ``WORST`` worst words, repeated ones included: one word that looks
like an insult by chance weighs less than several. Labels belong to documents, so training
looks for witnesses: in every toxic document its worst words so far are positive examples, the worst words of clean documents are negative
ones, and fit and choice alternate. Positive words also come with a letter put in. The machine is linear in Nyström features over landmark
words, so its decision is a sum of kernels with landmarks, which folds into one weight per
triple: scoring is a table look-up with a table of fixed size.

Only the fit is done on a sample of labelled rows (at most ``per_class`` of each class, whole
texts); every document is scored over its whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .limits import inner_names, small_enough, written
from .words import SLICE, Words, slices, split

SPAN = 7
DECAY = 0.75
PER_CLASS = 2000
LANDMARKS = 200
ROUNDS = 5
WORST = 3
RIDGE = 1e-4

_PART = 20_000  # words scored at a time while fitting
_BITS = 6
_TABLE = 1 << 3 * _BITS
# Letters a-z have codes of their own; bytes of other letters share the rest.
_CODE = np.array([(b - 97 if 97 <= b <= 122 else 26 + b % 36) if b >= 97 and b != 127 else 0 for b in range(256)], np.int32)
_BEGIN, _END = 62, 63  # the borders of a word count as letters
_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
_BLANK = np.array([b in (9, 10, 11, 12, 13, 32) for b in range(256)])
_OFFSETS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


class Model(NamedTuple):
    """Weights of triples, and slopes and place of the logistic scale of a text's worst decisions."""

    weights: np.ndarray
    slopes: np.ndarray
    bias: float


def letters(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int, Words]]:
    """Like ``slices``, with texts in lower case and words reduced to their letters."""
    for lo, hi, words in slices(pc.utf8_lower(texts.fill_null("")), most):
        keep = _LETTER[words.data] | _BLANK[words.data]
        place = np.r_[0, np.cumsum(keep)]
        words = split(words.data[keep], place[words.offsets])
        inner = np.r_[0, np.cumsum(words.data & 0xC0 == 0x80)] if len(words.data) else np.zeros(1, int)
        single = words.ends - words.starts - (inner[words.ends] - inner[words.starts]) == 1
        joint = np.flatnonzero(single[1:] & single[:-1] & (np.diff(words.rows) == 0))
        if len(joint):
            keep = np.ones(len(words.data) + 1, np.int64)
            change = np.zeros(len(words.data) + 1, np.int64)
            np.add.at(change, words.ends[joint], 1)
            np.add.at(change, words.starts[joint + 1], -1)
            keep = (np.cumsum(change) == 0)[:-1]
            place = np.r_[0, np.cumsum(keep)]
            words = split(words.data[keep], place[words.offsets])
        yield lo, hi, words


def triples(words: Words) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """``(weight, word numbers, triple codes)`` of all words, one offset pair at a time."""
    size = words.ends - words.starts + 2
    word = np.repeat(np.arange(len(size)), size)
    last = np.cumsum(size) - 1
    at = np.arange(len(word)) - np.repeat(last + 1 - size, size)
    code = np.full(len(word), _BEGIN, np.int32)
    inner = np.flatnonzero((at > 0) & (at < size[word] - 1))
    code[inner] = _CODE[words.data[at[inner] - 1 + words.starts[word[inner]]]]
    code[last] = _END
    left = size[word] - at
    for j, k in _OFFSETS:
        head = np.flatnonzero(left > k)
        yield DECAY ** (k + 1), word[head], (code[head] << 2 * _BITS) + (code[head + j] << _BITS) + code[head + k]


def norms(words: Words) -> np.ndarray:
    """The length of a word's image, as if all its triples differed."""
    size = (words.ends - words.starts + 2)[:, None]
    k = np.array([k for _, k in _OFFSETS])[None, :]
    return np.sqrt(np.maximum((np.maximum(size - k, 0) * DECAY ** (2 * k + 2)).sum(axis=1), 1e-9))


def decisions(words: Words, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words.starts))
    for weight, word, code in triples(words):
        out += np.bincount(word, weight * weights[code], len(out))
    return out / norms(words)


def worst(decided: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The ``WORST`` largest decisions of every text, largest first; a missing word counts -1.

    Text ``t`` has the decisions ``first[t]`` to ``first[t + 1]``.
    """
    count = np.diff(first)
    order = np.lexsort((-decided, np.repeat(np.arange(len(count)), count)))
    out = np.full((len(count), WORST), -1.0)
    for k in range(WORST):
        long = np.flatnonzero(count > k)
        out[long, k] = decided[order[first[long] + k]]
    return out


def words_of(strings: list[bytes]) -> Words:
    data = np.frombuffer(b" ".join(strings), np.uint8)
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    starts = ends - np.array([len(s) for s in strings])
    return Words(data, starts, ends, np.array([0, len(starts)]), np.array([0, len(data)]))


def images(strings: list[bytes]) -> np.ndarray:
    """Rows of the feature space for a few words, dense over the triples that occur."""
    words, rows, cols, values = words_of(strings), [], [], []
    for weight, word, code in triples(words):
        rows.append(word), cols.append(code), values.append(np.full(len(word), weight))
    rows, cols, values = map(np.concatenate, (rows, cols, values))
    found, cols = np.unique(cols, return_inverse=True)
    out = np.zeros((len(strings), len(found)))
    np.add.at(out, (rows, cols), values)
    return found, out / norms(words)[:, None]


def svm(x: np.ndarray, y: np.ndarray, times: np.ndarray, cost: float = 1000.0) -> np.ndarray:
    """A linear machine with squared hinge loss by Newton steps; both classes weigh the same.

    ``times`` says how many documents stand behind an example.
    """
    x = np.c_[x, np.ones(len(x))]
    weight = cost * np.where(y > 0, times / times[y > 0].sum(), times / times[y < 0].sum())
    w = np.zeros(x.shape[1])
    for _ in range(50):
        active = y * (x @ w) < 1
        own = x[active] * weight[active][:, None]
        new = np.linalg.solve(own.T @ x[active] + np.eye(len(w)), own.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def _with_letter(word: bytes, rng: np.random.Generator) -> bytes:
    """The word with a letter put in somewhere, as writers do to get past filters."""
    at = int(rng.integers(1, max(len(word), 2)))
    return word[:at] + bytes([97 + int(rng.integers(26))]) + word[at:]


def fit(texts: list[str], toxic: list[int], share: float | None = None) -> Model:
    """The model of labelled texts; without both classes it knows nothing and scores the share.

    ``share`` is the share of toxic rows among all labelled ones, by default that of the texts.
    """
    y = np.array(toxic)
    if not len(y) or y.min() == y.max():  # no two classes
        share = share if share is not None else float(y.mean()) if len(y) else 0.0
        share = min(max(share, 1e-3), 0.499)
        return Model(np.zeros(_TABLE, np.float32), np.eye(1, WORST)[0], float(np.log(share / (1 - share))))
    number: dict[bytes, int] = {}
    inside: list[np.ndarray] = []  # numbers of the distinct words of each text
    often: list[np.ndarray] = []  # how often each occurs there, up to WORST times
    for _, _, words in letters(pa.array(texts, pa.string())):
        own = words.data.tobytes()
        for a, b in zip(words.first[:-1], words.first[1:]):
            strings = Counter(own[s:e] for s, e in zip(words.starts[a:b].tolist(), words.ends[a:b].tolist()))
            inside.append(np.array([number.setdefault(w, len(number)) for w in sorted(strings)], np.int32))
            often.append(np.array([min(strings[w], WORST) for w in sorted(strings)], np.int8))
    vocabulary = list(number)
    in_clean, in_toxic = (np.bincount(np.concatenate([w for w, t in zip(inside, y) if t == label]), minlength=len(vocabulary))
                          for label in (0, 1))
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    p, q = (in_toxic + 0.1) / (n1 + 1), (in_clean + 0.1) / (n0 + 1)
    rank = np.where(in_toxic > 1, (p - q) / np.sqrt(p * (1 - p) / n1 + q * (1 - q) / n0), 0.0)
    likely = np.argsort(-rank, kind="stable")[: LANDMARKS * 3 // 4]
    common = np.argsort(-in_clean, kind="stable")
    landmarks = sorted({vocabulary[i] for i in [*likely, *common[: LANDMARKS // 4]]})
    codes, basis = images(landmarks)
    value, vector = np.linalg.eigh(basis @ basis.T)
    good = value > 1e-6 * value.max()
    whiten = vector[:, good] / np.sqrt(value[good])
    at = np.full(_TABLE, -1)
    at[codes] = np.arange(len(codes))

    def features(strings: list[bytes]) -> np.ndarray:
        found, image = images(strings)
        shared = at[found] >= 0
        return image[:, shared] @ basis[:, at[found[shared]]].T @ whiten

    def scores(weights: np.ndarray) -> np.ndarray:
        return np.concatenate([decisions(words_of(vocabulary[k : k + _PART]), weights) for k in range(0, len(vocabulary), _PART)])

    rng = np.random.default_rng(0)
    # Clean words, common and random; the worst of clean documents join them round by round.
    clean = np.flatnonzero(in_clean)
    negative = Counter(rng.choice(clean, min(2000, len(clean)), replace=False).tolist())
    negative.update({int(i): int(in_clean[i]) for i in common[:1000] if in_clean[i]})
    score, least, weights, w = rank, 3.0, np.zeros(_TABLE, np.float32), np.zeros(1)
    for _ in range(ROUNDS):
        leading = [bag[np.argsort(-score[bag], kind="stable")[:3]] if len(bag) else bag for bag in inside]
        positive = Counter(int(i) for own, t in zip(leading, y) if t == 1 for k, i in enumerate(own)
                           if k == 0 or score[i] > least)
        negative.update(int(i) for own, t in zip(leading, y) if t == 0 for i in own)
        if not positive or not negative:
            break
        bent = [_with_letter(vocabulary[i], rng) for i in positive]
        chosen = [vocabulary[i] for i in positive] + bent + [vocabulary[i] for i in negative]
        times = np.array([*positive.values(), *positive.values(), *negative.values()], float)
        x = np.concatenate([features(chosen[k : k + 50]) for k in range(0, len(chosen), 50)])
        w = svm(x, np.repeat([1.0, -1.0], [2 * len(positive), len(negative)]), times)
        weights = np.zeros(_TABLE, np.float32)
        weights[codes] = basis.T @ (whiten @ w[:-1])
        score, least = scores(weights) + w[-1], 0.0
    most = np.concatenate([worst(np.repeat(score[bag] - w[-1], times), np.array([0, times.sum(dtype=int)]))
                           for bag, times in zip(inside, often)])
    # Half-way between the share of toxic rows and classes of equal weight.
    slopes, place = _logistic(most, y, ((float(y.mean()) if share is None else share) + 0.5) / 2)
    return Model(weights, slopes, place)


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[np.ndarray, float]:
    """Slopes and bias with classes weighted by their share; targets are pulled in a little."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, share / n1, (1 - share) / n0)
    rows = np.c_[x, np.ones(len(x))]
    a, ridge = np.zeros(rows.shape[1]), np.diag(np.r_[np.full(x.shape[1], RIDGE), 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-rows @ a))
        slope = rows.T @ (weight * (p - target)) + ridge @ a
        step = np.linalg.solve((rows.T * (weight * p * (1 - p))) @ rows + ridge, slope)
        a -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    if a[:-1].min() < 0 and x.shape[1] > 1:  # a worse word must not make a text better: fit without it
        slopes, keep = np.zeros(x.shape[1]), np.flatnonzero(a[:-1] > a[:-1].min())
        slopes[keep], bias = _logistic(x[:, keep], y, share)
        return slopes, bias
    return np.maximum(a[:-1], 1e-3), float(a[-1])


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, slopes, bias = model.value
        for batch in batches:
            others = [i for i, f in enumerate(batch.schema) if f.name != "scored_text"]
            scores = []
            for _, _, words in letters(batch.column("scored_text"), SLICE // 4):
                most = worst(decisions(words, weights), words.first)
                scores.append(1 / (1 + np.exp(-np.clip(most @ slopes + bias, -50, 50))))
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in others] + [pa.array(scores, pa.float64())],
                [batch.schema[i].name for i in others] + ["score"])

    return run


def _fitting(share: float | None):
    """The labelled rows -> the parts of the model, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["id"], r["text"], r["label"]) for b in batches for r in b.to_pylist())
        model = fit([r[1] for r in rows], [r[2] for r in rows], share)
        parts = [model.weights.astype(np.float32).tobytes(), model.slopes.astype(float).tobytes(), np.float64(model.bias).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([parts], pa.list_(pa.binary()))], ["parts"])

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Fits on at most ``per_class`` labelled rows of each class, chosen by a hash of the id, in one task.

    Rows without label or id are left out; of several labels of one id the largest counts.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    known = written(known, "labels")
    share = known.agg(F.avg("label")).first()[0]
    order = F.xxhash64("id", F.lit(7))
    sample = known.where("label = 1").orderBy(order, "id").limit(per_class).union(
        known.where("label = 0").orderBy(order, "id").limit(per_class))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = written(texts.join(small_enough(written(sample, "toxic-ids")), "id"), "toxic-sample")
    parts = rows.coalesce(1).mapInArrow(_fitting(share), "parts array<binary>").first()
    if parts is None:
        return fit([], [], share)
    weights, slopes, bias = (bytes(p) for p in parts["parts"])
    return Model(np.frombuffer(weights, np.float32), np.frombuffer(slopes), float(np.frombuffer(bias)[0]))


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all by default) and ``score``, 0 to 1, of every whole text.

    A null, empty or letterless text has the score of one without any insult. Rows stay as
    they are, also with null or repeated ids. A column already named ``score`` is replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(model)
    into, inner, back = inner_names([c for c in (docs.columns if columns is None else columns) if c != "score"])
    rows = docs.select(*into, F.col(text_col).alias("scored_text"))
    kinds = "".join(f"{n} {rows.schema[n].dataType.simpleString()}, " for n in inner)
    return rows.mapInArrow(_scored(model), f"{kinds}score double").select(*back, "score")


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract of op4: labels of the other four folds only; every document is scored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = score_toxicity(docs, fit_toxicity(docs, labels), columns=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
