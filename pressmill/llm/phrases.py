"""Collocations: word sequences that occur more often together than their parts would tell.

Top-order marginalisation: only the longest windows are counted. Beside every word stand the
words that lead it by one, two, … places, in columns ``w1``, ``w2``, …, padded with null behind the
end of a piece. Spark's ROLLUP over these columns sums the counts of ever shorter prefixes, so one
table of windows gives the counts of all shorter phrases, each occurrence being the prefix of one window.

Most windows of natural text occur once, and only phrases from ``least`` occurrences on matter. So a
first pass counts all sequences of two words and more in buckets of a hash. A bucket with fewer than
``least`` occurrences holds no sequence that matters, and a window is padded from the word on with
which it or its last pair would fall into such a bucket. What is padded away still counts for the shorter
prefix; counts of phrases that occur ``least`` times or more are exact, since they and all pairs inside
them lie in open buckets. The number of buckets follows the size of the text up to ``MOST_BITS``;
where buckets fill up beyond that, fewer windows are padded early, and nothing else changes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .limits import written
from .words import Words, flat, mix, word_hashes

LEAST = 10
LONGEST = 3
TOP = 2000
COVER = 50  # percent of a phrase's occurrences that a longer one must hold to replace it
PART_BYTES = 3 << 20  # text that a task looks at together
BATCH_ROWS = 20_000  # windows that go back at a time
BLOCK_BITS = 16  # buckets of one block of the table
HELD_BUCKETS = 2_000_000  # that a task holds before it passes them on
MOST_BITS = 30  # 128 MB of one bit each is the most that is sent to every worker
_FULL = 255

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


class Tokens(NamedTuple):
    """Words of several texts in order, as numbers in ``names``."""

    names: pa.Array
    word: np.ndarray
    piece: np.ndarray
    row: np.ndarray


def tokens(texts: pa.Array) -> Tokens:
    """Words between blanks, A-Z lower-cased; sentence marks and line ends start a new piece."""
    data, offsets = flat(texts)
    data = _LOWER[data]
    kind = _KIND[data]
    solid = kind == 0
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | border[1:-1]
    starts = np.flatnonzero(begins)
    narrow = np.int32 if len(data) < 1 << 31 else np.int64
    piece = np.cumsum((kind == 2) | border[:-1], dtype=narrow)[starts]
    places = np.cumsum(solid, dtype=narrow)
    ends = np.r_[places[starts] - 1, places[-1:] if len(data) else np.zeros(1, np.int64)]
    strings = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[solid]))
    coded = strings.dictionary_encode()
    row = np.searchsorted(offsets, starts, side="right") - 1
    return Tokens(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), piece, row)


def _hashes(names: pa.Array) -> np.ndarray:
    data, offsets = flat(names)
    return word_hashes(Words(data, offsets[:-1], offsets[1:], offsets, offsets))


def sequences(t: Tokens, langs: pa.DictionaryArray, longest: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 2, 3, … words from each word on: are they in one piece, and a hash of them and their language."""
    word = _hashes(t.names)[t.word] if len(t.names) else np.zeros(0, np.uint64)
    own = mix(_hashes(langs.dictionary))[langs.indices.to_numpy(zero_copy_only=False)][t.row] + word
    out = []
    for k in range(1, longest):
        whole = np.zeros(len(word), bool)
        whole[: max(len(word) - k, 0)] = t.piece[k:] == t.piece[: max(len(word) - k, 0)]
        own = mix(own * np.uint64(0xD6E8FEB86659FD93) + np.roll(word, -k))
        out.append((whole, own))
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Tokens, pa.DictionaryArray]]:
    """Texts of about PART_BYTES at a time; a row stays whole."""
    held, size = [], 0

    def out():
        table = pa.Table.from_batches(held).combine_chunks()
        texts, langs = (table.column(i).chunk(0) for i in range(2))
        return tokens(texts), langs.dictionary_encode()

    for batch in batches:
        lo = 0
        offsets = flat(batch.column(0))[1]
        while lo < len(batch):
            hi = int(np.searchsorted(offsets, offsets[lo] + PART_BYTES - size, side="right")) - 1
            hi = min(max(hi, lo + 1), len(batch))
            held.append(batch.slice(lo, hi - lo))
            size += int(offsets[hi] - offsets[lo])
            lo = hi
            if size >= PART_BYTES or lo < len(batch):
                yield out()
                held, size = [], 0
    if held:
        yield out()


def _counting(bits: int, longest: int):
    def out(bucket: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        block = (bucket >> np.uint64(BLOCK_BITS)).astype(np.int32)
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else np.zeros(1, int)
        places, n = (bucket & np.uint64((1 << BLOCK_BITS) - 1)).astype("<u2"), np.minimum(n, _FULL).astype(np.uint8)
        parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        return pa.RecordBatch.from_arrays(
            [pa.array(block[cuts[:-1]], pa.int32()), pa.array([places[a:b].tobytes() for a, b in parts], pa.binary()),
             pa.array([n[a:b].tobytes() for a, b in parts], pa.binary())], ["block", "places", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for t, langs in _parts(batches):
            found = [pair[whole] >> np.uint64(64 - bits) for whole, pair in sequences(t, langs, longest)]
            bucket, at = np.unique(np.concatenate([held, *found]), return_inverse=True)
            held, n = bucket, np.bincount(at, np.r_[n, np.ones(len(at) - len(n), np.int64)], len(bucket)).astype(np.int64)
            if len(held) > HELD_BUCKETS:
                yield out(held, n)
                held, n = held[:0], n[:0]
        yield out(held, n)

    return run


def _opening(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, places, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                own = sums.setdefault(block, np.zeros(1 << BLOCK_BITS, np.uint16))
                at, n = np.frombuffer(places.as_buffer(), "<u2"), np.frombuffer(counts.as_buffer(), np.uint8).astype(int)
                own[at] = np.where(n == _FULL, 65535, np.minimum(own[at] + n, 65535))
        for block, own in sums.items():
            opened = np.packbits((own >= least) | (own == 65535))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([opened.tobytes()], pa.binary())], ["block", "opened"])

    return run


def open_buckets(texts: DataFrame, least: int, longest: int = LONGEST) -> tuple[int, np.ndarray]:
    """One bit for each bucket: may it hold a sequence of words that occurs ``least`` times?"""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max((size // 4).bit_length(), BLOCK_BITS), MOST_BITS)
    blocks = 1 << (bits - BLOCK_BITS)
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = texts.mapInArrow(_counting(bits, longest), "block int, places binary, counts binary")
    opened = counted.repartition(max(width, blocks // 128), "block").mapInArrow(_opening(least), "block int, opened binary")
    table = np.zeros((blocks, (1 << BLOCK_BITS) // 8), np.uint8)
    for row in written(opened, "open-buckets").toLocalIterator():
        table[row["block"]] = np.frombuffer(row["opened"], np.uint8)
    return bits, table.reshape(-1)


def _windows(sent, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, table = sent.value
        for t, langs in _parts(batches):
            opened = []  # for 2, 3, … words from each word on
            for whole, hashed in sequences(t, langs, longest):
                bucket = hashed >> np.uint64(64 - bits)
                bit = table[bucket >> np.uint64(3)] >> (np.uint64(7) - (bucket & np.uint64(7))) & 1
                opened.append(whole & bit.astype(bool))
            n, width = len(t.word), len(t.names) + 1
            columns, ahead = [], np.ones(n, bool)
            group = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[t.row]
            for k in range(longest):  # the word k places ahead, -1 for padding
                if k:
                    pair = np.r_[opened[0][k - 1 :], np.zeros(min(k - 1, n), bool)][:n]
                    ahead = ahead & pair & opened[k - 1]
                lead = np.where(ahead, np.r_[t.word[k:], np.zeros(min(k, n), np.int64)][:n], -1)
                columns.append(lead)
                _, group = np.unique(group * width + lead + 1, return_inverse=True)
            _, first, count = np.unique(group, return_index=True, return_counts=True)
            words = [t.names.take(pa.array(c[first], pa.int64(), mask=c[first] < 0)).cast(pa.string()) for c in columns]
            lang = langs.take(pa.array(t.row[first])).cast(pa.string())
            out = pa.RecordBatch.from_arrays(
                [lang, *words, pa.array(count, pa.int64())], ["lang", *(f"w{k + 1}" for k in range(longest)), "n"])
            for lo in range(0, len(out), BATCH_ROWS):
                yield out.slice(lo, BATCH_ROWS)

    return run


def phrase_counts(texts: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``(lang, words, f)`` of all phrases of up to ``longest`` words that occur ``least`` times.

    ``texts`` has ``text`` and ``lang``. The row of a language without words in it (an empty array)
    has the number of all its words, if that is ``least`` or more. Stored.
    """
    texts = texts.select(F.coalesce(F.col("text"), F.lit("")).alias("text"),
                         F.coalesce(F.col("lang"), F.lit("und")).alias("lang"))
    sent = texts.sparkSession.sparkContext.broadcast(open_buckets(texts, least, longest))
    names = [f"w{k + 1}" for k in range(longest)]
    kinds = ", ".join(f"{c} string" for c in ("lang", *names))
    windows = texts.mapInArrow(_windows(sent, longest), f"{kinds}, n long")
    summed = windows.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    # Level k has summed over all columns behind the k-th; where the k-th is null, padding was counted, which
    # says nothing. This condition is on the grouping alone, so Spark drops such rows before it counts.
    levels = [(F.col("g") == (1 << (longest - k)) - 1) & (F.col(f"w{k}").isNotNull() if k else F.lit(True))
              for k in range(longest + 1)]
    summed = summed.where(reduce(lambda a, b: a | b, levels))
    # Columns that were summed over are null, and so is padding; neither is part of a phrase.
    words = F.array_compact(F.array(*names))
    counts = written(summed.where(F.col("f") >= least).select("lang", words.alias("words"), "f"), "phrase-counts")
    sent.destroy()
    return counts


def _exact(column: str) -> str:
    return f"cast({column} as decimal(15, 0))"


def phrases(texts: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """The best ``top`` phrases of two to ``longest`` words of each language.

    Returns ``(lang, rank, phrase, a, l, r, n, score)``. A phrase is cut where it scores least
    (then as early as possible) into parts that occur ``l`` and ``r`` times; its score is the whole part of
    ``1000000 * a * a / (l * r)``, exact for counts below 10^15. Phrases inside a longer one that has
    ``cover`` percent of their occurrences are left out. A null language is ``und``; null and empty
    texts have no words; rows that repeat count as often as they occur; other columns are not read.
    """
    counts = phrase_counts(texts, least, longest)
    size = F.size("words")
    joined = F.array_join("words", " ").alias("phrase")
    known = counts.where(size > 0).select("lang", joined, "f")
    candidates = counts.where(size > 1).select("lang", joined, "words", F.col("f").alias("a"))

    def part(first: Column, many: Column) -> Column:
        return F.array_join(F.slice("words", first, many), " ")

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
                       part(F.col("k") + 1, size - F.col("k")).alias("right"))
    left = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * {_exact('a')} * {_exact('a')}) div ({_exact('l')} * {_exact('r')})")
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    worst = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("lang", "phrase", "cut.*")

    inner = F.explode(F.sequence(F.lit(2), size - 1)).alias("many")
    inside = candidates.where(size > 2).select("lang", "words", F.col("a").alias("f"), inner)
    inside = inside.select("lang", "f", "words", "many", F.explode(F.sequence(F.lit(1), size - F.col("many") + 1)).alias("at"))
    holders = inside.select("lang", part(F.col("at"), F.col("many")).alias("phrase"), "f").groupBy("lang", "phrase").agg(
        F.max("f").alias("held"))
    free = worst.join(holders, ["lang", "phrase"], "left").where(
        F.col("held").isNull() | (F.lit(100) * F.col("held") < F.lit(cover) * F.col("a")))

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = free.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    totals = counts.where(size == 0).select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def phrase_mining(spark, sf_dir: str) -> DataFrame:
    """Contract of op12."""
    return phrases(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


PHRASES_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
sequences AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
sizes AS (SELECT unnest([1, 2, 3]) AS k),
occurrences AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM sequences, sizes WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM occurrences GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE k >= 2 AND f >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, x.k AS cut, array_to_string(c.w[1:x.k], ' ') AS lhs, array_to_string(c.w[x.k + 1:], ' ') AS rhs
    FROM candidates c JOIN sizes x ON x.k < c.k),
scored AS (
    SELECT c.lang, c.phrase, a, l.f AS l, r.f AS r, cut,
           ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = lhs JOIN f r ON r.lang = c.lang AND r.phrase = rhs),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
held AS (
    SELECT lang, phrase, max(f) AS held FROM (
        SELECT lang, f, array_to_string(w[1:2], ' ') AS phrase FROM candidates WHERE k = 3
        UNION ALL SELECT lang, f, array_to_string(w[2:3], ' ') FROM candidates WHERE k = 3)
    GROUP BY ALL),
ranked AS (
    SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
    FROM worst w LEFT JOIN held h ON h.lang = w.lang AND h.phrase = w.phrase
    WHERE held IS NULL OR 100 * held < 50 * a)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000
"""
