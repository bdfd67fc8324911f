"""Packing of documents into sequences of a fixed number of tokens.

1. Every document becomes ids, closed by an end id; only longer ones are cut.
2. The histogram of piece lengths (at most ``size`` numbers, whatever the corpus) comes to the
   driver. Lengths are dealt into classes, all patterns of one to three pieces that fill a
   sequence are enumerated, and non-negative least squares fits repeat counts of patterns to
   the histogram. Counts are rounded down, and what is left is packed best-fit.
3. The plan says, for every length, which ranks of pieces of that length go where. Pieces get
   their ranks in parallel: a count inside their task, plus the counts of the tasks before.

No text and no list of pieces passes through the driver or one task, and a length that many
pieces share is not gathered anywhere.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .limits import written
from .words import Words, slices, word_hashes

SIZE = 2048
CLASSES = 256
VOCABULARY = "word_bpe_49k.json"
END = 0
HELD_WORDS = 1_000_000
_SIGN = np.isin(np.arange(256), list(b".,;:!?"))

_PIECE = "id long, piece int, start long, length long, ids_crc32 long, token_ids binary, shard int, rank long"


# --- ids -----------------------------------------------------------------------------


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use all cores
    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


def stems(words: Words) -> tuple[Words, np.ndarray]:
    """Words with a sign behind an ASCII letter at the end as two, and which may be lower-cased.

    The tokenizer drops case, and such a sign stands for itself there. Only words in ASCII are
    lower-cased here, and a word in which a reserved string may stand is left as it is.
    """
    data, starts, ends = words.data, words.starts, words.ends
    if not len(starts):
        return words, np.zeros(0, bool)

    def holds(marked: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(marked, dtype=np.int32)]
        return total[ends] > total[starts]

    reserved = holds((data == ord("<")) & (np.r_[data[1:], 0] == ord("|")))
    letter = ((data | 0x20) >= ord("a")) & ((data | 0x20) <= ord("z"))
    signed = _SIGN[data[ends - 1]] & letter[ends - 2] & (ends - starts > 1) & ~reserved
    times = 1 + signed
    second = np.cumsum(times)[signed] - 1
    new_starts, new_ends = starts.repeat(times), ends.repeat(times)
    new_starts[second] = ends[signed] - 1
    new_ends[second - 1] -= 1
    first = np.r_[0, np.cumsum(times)][words.first]
    plain = (~reserved & ~holds(data >= 0x80)).repeat(times)
    return Words(data, new_starts, new_ends, first, words.offsets), plain


class WordIds:
    """Words, by their hashes, and their ids, looked up once a process.

    The tokenizer drops white space and never joins across it, so a text has the ids of its
    words, one after the other. Only words not met before are given to it, many at a time. A full table starts anew.
    """

    def __init__(self, vocabulary: str, most: int = HELD_WORDS):
        self.coder, self.most = tokenizer(vocabulary), most
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.many, self.ids = np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Adds words with new, sorted hashes."""
        lists = [e.ids for e in self.coder.encode_batch(words, add_special_tokens=False)]
        many = np.fromiter(map(len, lists), np.int32, len(lists))
        first = (len(self.ids) + np.r_[0, np.cumsum(many)[:-1]]).astype(np.int32)
        at = np.searchsorted(self.hashes, hashes)
        ids = np.fromiter(chain.from_iterable(lists), np.uint32, many.sum())
        self.ids = np.concatenate([self.ids, ids])
        self.hashes, self.first, self.many = (
            np.insert(old, at, new) for old, new in ((self.hashes, hashes), (self.first, first), (self.many, many)))

    def encode(self, words: Words, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end``, and where each text begins."""
        words, plain = stems(words)
        hashes = np.where(plain, word_hashes(words, lower=True), word_hashes(words))
        distinct, example, word = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > self.most or len(self.ids) > 16 * self.most:
            self._clear()
        at = np.searchsorted(self.hashes, distinct)
        new = np.flatnonzero(np.append(self.hashes, 0)[at] != distinct) if len(self.hashes) else np.arange(len(distinct))
        if len(new):
            data, own = words.data.tobytes(), example[new]
            strings = [data[s:e].lower() if p else data[s:e]
                       for s, e, p in zip(words.starts[own].tolist(), words.ends[own].tolist(), plain[own].tolist())]
            self._learn(distinct[new], [s.decode() for s in strings])
            at = np.searchsorted(self.hashes, distinct)
        many = self.many[at][word]
        before = np.r_[0, np.cumsum(many)]
        texts = len(words.first) - 1
        begins = before[words.first] + np.arange(texts + 1)
        out = np.full(before[-1] + texts, end, np.uint32)
        place = np.arange(before[-1])
        source = np.repeat(self.first[at][word] - before[:-1], many)
        source += place
        place += np.repeat(words.rows, many)
        out[place] = self.ids[source]
        return out, begins


@lru_cache(maxsize=2)
def word_ids(vocabulary: str) -> WordIds:
    """One table a process, kept from task to task."""
    return WordIds(vocabulary)


def _pieces(size: int, vocabulary: str, end: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard, seen = word_ids(vocabulary), TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo, hi, words in slices(batch.column(1)):
                ids, begins = coder.encode(words, end)
                ids, at, rows = ids.astype("<u4").tobytes(), (4 * begins).tolist(), []
                for name, a, b in zip(names[lo:hi], at[:-1], at[1:]):
                    for piece, start in enumerate(range(a, b, 4 * size)):
                        own = ids[start : min(start + 4 * size, b)]
                        length = len(own) // 4
                        rows.append((name, piece, (start - a) // 4, length, zlib.crc32(own),
                                     own if keep_ids else None, shard, seen[length]))
                        seen[length] += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    ["id", "piece", "start", "length", "ids_crc32", "token_ids", "shard", "rank"])

    return run


# --- the plan ------------------------------------------------------------------------


def patterns(classes: int) -> np.ndarray:
    """All ``a >= b >= c`` with ``a + b + c = classes``; zeros stand for no piece."""
    a, b = np.meshgrid(np.arange(classes + 1), np.arange(classes + 1), indexing="ij")
    c = classes - a - b
    fits = (a >= b) & (b >= c) & (c >= 0)
    return np.stack([a[fits], b[fits], c[fits]], axis=1)


def fit(counts: np.ndarray, shapes: np.ndarray, least: float = 0.5) -> np.ndarray:
    """Repeat counts ``x >= 0`` of the patterns with ``A x`` nearest to ``counts``.

    Active-set non-negative least squares. Column ``j`` of ``A`` counts the classes of pattern
    ``j``; it has at most three entries, so products with it are sums of three.
    """
    n = len(counts)

    def columns(chosen) -> np.ndarray:
        out = np.zeros((n, len(chosen)))
        for part in shapes[chosen].T:
            np.add.at(out, (part, np.arange(len(chosen))), part > 0)
        return out

    x, target = np.zeros(len(shapes)), counts.astype(float)
    free: list[int] = []
    rest = target.copy()
    for _ in range(3 * n):
        pull = np.where(np.arange(n) > 0, rest, 0.0)[shapes].sum(axis=1)
        pull[free] = -np.inf
        best = int(np.argmax(pull))
        # A pattern that would explain less than half a sequence cannot get a whole repeat.
        if pull[best] <= max(least, 1e-5 * target.max()):
            break
        free.append(best)
        while free:
            own = columns(free)
            solved = np.linalg.solve(own.T @ own + 1e-8 * np.eye(len(free)), own.T @ target)
            if (solved > 1e-9).all():
                x[free] = solved
                break
            now = x[free]
            bad = solved <= 1e-9
            step = np.min(now[bad] / np.maximum(now[bad] - solved[bad], 1e-12))
            x[free] = now + step * (solved - now)
            drop = {f for f, v in zip(free, x[free]) if v <= 1e-9}
            if not drop:
                drop = {free[int(np.argmin(x[free]))]}
            x[list(drop)] = 0.0
            free = [f for f in free if f not in drop]
        rest = target - columns(free) @ x[free] if free else target.copy()
    return x


class Plan:
    """Where the pieces of each length go, by their rank: arrays sorted by (length, rank)."""

    def __init__(self, size: int):
        self.size, self.next, self.used, self.rows = size, 0, {}, []

    def add(self, parts: list[tuple[int, int]], times: int) -> None:
        """``times`` sequences that each hold ``copies`` pieces of every (length, copies)."""
        offset = 0
        for length, copies in parts:
            first = self.used.get(length, 0)
            self.rows.append((length, first, times, self.next, offset))
            self.used[length] = first + times * copies
            offset += length * copies
        self.next += times

    def table(self) -> np.ndarray:
        return np.array(sorted(self.rows), np.int64).reshape(-1, 5)


def make_plan(histogram: dict[int, int], size: int = SIZE, classes: int = CLASSES) -> Plan:
    """Fitted patterns first, in lengths that fill a sequence exactly; the rest best-fit."""
    left = np.zeros(size + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    plan, width = Plan(size), -(-size // min(classes, size))
    by_class = np.zeros(size + 2, np.int64)
    np.add.at(by_class, -(-np.arange(size + 1) // width), left)
    # Lengths are up to a class too short, on average half of it: one class more makes up for it.
    total = -(-size // width) + (width > 1)
    shapes = patterns(total)
    repeats = fit(by_class[: total + 1], shapes)
    for j in np.argsort(-repeats, kind="stable"):
        times = int(repeats[j] + 1e-6)
        if times < 1:
            break
        lengths = [[v for v in range(c * width, (c - 1) * width, -1) if v <= size] for c in shapes[j].tolist() if c]
        for head in product(*lengths[:-1]):
            last = size - sum(head)
            if last not in lengths[-1]:
                continue
            picked = [*head, last]
            now = min(times, *(int(left[v]) // picked.count(v) for v in picked))
            if now:
                plan.add([(v, 1) for v in picked], now)
                for v in picked:
                    left[v] -= now
                times -= now
            if not times:
                break
    _best_fit(left, plan)
    return plan


def _best_fit(left: np.ndarray, plan: Plan) -> None:
    """Longest first into the fullest sequence with room, many equal sequences at a time."""
    size = plan.size
    room: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            space = min((s for s in room if s >= length and room[s]), default=None)
            if space is None:
                each = size // length
                times, rest = divmod(count, each)
                for copies, n in ((each, times), (rest, 1)):
                    if copies and n:
                        room.setdefault(size - copies * length, []).append((((length, copies),), n))
                break
            parts, times = room[space].pop()
            now = min(times, count)
            if times > now:
                room[space].append((parts, times - now))
            room.setdefault(space - length, []).append((parts + ((length, 1),), now))
            count -= now
    for groups in room.values():
        for parts, times in groups:
            plan.add(list(parts), times)


# --- the job -------------------------------------------------------------------------


def _placed(plan):
    """``length, rank`` -> the place of a piece; its ids are not sent to the workers."""

    @F.arrow_udf("sequence_id long, offset long")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        length, first, times, sequence, offset = plan.value.T
        keys = (length << 44) + first
        for lengths, ranks in batches:
            own, rank = lengths.to_numpy(), ranks.to_numpy()
            row = np.searchsorted(keys, (own << 44) + rank, side="right") - 1
            inside = rank - first[row]
            yield pa.StructArray.from_arrays(
                [pa.array(sequence[row] + inside % times[row]), pa.array(offset[row] + inside // times[row] * own)],
                ["sequence_id", "offset"])

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = SIZE,
         vocabulary: str = VOCABULARY, end: int = END, keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32, token_ids, sequence_id, offset``.

    ``token_ids`` are the ids as little-endian unsigned 32-bit numbers (null unless
    ``keep_ids``). A null or empty text is the end id alone. A null id keeps its rows, and so
    does every repeated row. No rows give no sequences. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pieces = written(rows.mapInArrow(_pieces(size, vocabulary, end, keep_ids), _PIECE), "pieces")
    counts = written(pieces.groupBy("shard", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(make_plan(histogram, size).table())
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["shard", "length"]).select(
        "id", "piece", "start", "length", "ids_crc32", "token_ids", (F.col("rank") + F.col("before")).alias("rank"))
    placed = ranked.withColumn("place", _placed(plan)("length", "rank"))
    return placed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "token_ids",
                         "place.sequence_id", "place.offset")


def best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Contract of op7: all documents, sequences of 2048 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, keep_ids=False).drop("token_ids")
