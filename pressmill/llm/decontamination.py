"""Documents that hold items of a benchmark: SimHash of item-sized windows.

A window has as many words as an item. Windows are laid wherever a document shares a word
shingle with the item, so that the shared shingles lie where the item has them, and at all
places between such layouts. A similar window shares most of its shingles, so none is missed.

Every window gets a SimHash of 64 bits of its weighted shingles. Item fingerprints are indexed
by eight blocks of eight bits; each block lists the items within two bits of each value. Two
fingerprints within 23 bits have a block within two bits, so all items within that radius are
found. Their similarity is then computed exactly: the weight of shared shingles over the larger
weight of window and item. At similarity 0.8 fingerprints differ by 13 bits on average, and a
distance of 24 is more than three standard deviations off.

Weights come from the benchmark: ``log(1 + items / items with the shingle)``; shingles of no
item weigh the most. The index of at most ``SHARD`` items is broadcast; a larger benchmark is
taken in shards, one pass over the texts each, in the same tasks and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .limits import inner_names
from .words import grams, slices, word_hashes

SHARD = 4096
SHINGLE = 5
SIMILARITY = 0.8
NEAR = 2  # bits in a block; the guaranteed radius is 8 * (NEAR + 1) - 1
RADIUS = 8 * (NEAR + 1) - 1
_PREFILTER = 20

_COUNTS = np.array([bin(v).count("1") for v in range(256)], np.uint8)


class Index(NamedTuple):
    ids: list
    sizes: np.ndarray  # words of each item
    known: np.ndarray  # shingles of all items, sorted
    weight: np.ndarray  # of each known shingle
    posts: tuple[np.ndarray, np.ndarray, np.ndarray]  # per known shingle: first entry; items and offsets
    prints: np.ndarray
    near: np.ndarray  # block, value, item -> within NEAR bits
    shingles: list[np.ndarray]
    mass: np.ndarray
    prefilter: np.ndarray
    short: tuple[int, ...]  # sizes of items with fewer words than a shingle
    heaviest: float


def weights_of(shingles: np.ndarray, index) -> np.ndarray:
    at = np.minimum(np.searchsorted(index.known, shingles), len(index.known) - 1)
    return np.where(index.known[at] == shingles, index.weight[at], index.heaviest)


def simhash(shingles: np.ndarray, weights: np.ndarray) -> np.uint64:
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = weights @ (2.0 * bits - 1.0)
    return np.packbits(votes > 0, bitorder="little").view(np.uint64)[0]


def build_index(items: list[tuple], n: int = SHINGLE) -> Index | None:
    """The index of (id, text) pairs; null and blank texts are no items. None if none is left."""
    ids, sizes, own, offsets = [], [], [], []
    texts = pa.array([t for _, t in items], pa.string())
    for lo, hi, words in slices(texts):
        hashes = word_hashes(words, lower=True)
        for k in range(lo, hi):
            part = hashes[words.first[k - lo] : words.first[k - lo + 1]]
            if len(part):
                ids.append(items[k][0])
                sizes.append(len(part))
                own.append(grams(part, min(n, len(part))))
    if not ids:
        return None
    known, count = np.unique(np.concatenate([np.unique(s) for s in own]), return_counts=True)
    weight = np.log1p(len(ids) / count)
    heaviest = float(np.log1p(len(ids)))
    item = np.repeat(np.arange(len(own)), [len(s) for s in own])
    offsets = np.concatenate([np.arange(len(s)) for s in own])
    at = np.searchsorted(known, np.concatenate(own))
    order = np.argsort(at, kind="stable")
    first = np.searchsorted(at[order], np.arange(len(known) + 1))
    sets = [np.unique(s) for s in own]
    mass = np.array([weight[np.searchsorted(known, s)].sum() for s in sets])
    prints = np.array([simhash(s, weight[np.searchsorted(known, s)]) for s in sets], np.uint64)
    blocks = prints.view(np.uint8).reshape(-1, 8)
    near = _COUNTS[blocks.T[:, None, :] ^ np.arange(256, dtype=np.uint8)[None, :, None]] <= NEAR
    prefilter = np.zeros(1 << _PREFILTER, bool)
    prefilter[known >> np.uint64(64 - _PREFILTER)] = True
    return Index(ids, np.array(sizes), known, weight, (first, item[order], offsets[order]), prints, near, sets, mass,
                 prefilter, tuple(sorted({s for s in sizes if s < n})), heaviest)


def _layouts(index: Index, places: np.ndarray, n: int, words: int) -> set[tuple[int, int]]:
    """(start, size) of the windows to look at, from places of known shingles of ``n`` words."""
    first, item, offset = index.posts
    starts: dict[int, list[int]] = {}
    for place, shingle in places.tolist():
        for k in range(first[shingle], first[shingle + 1]):
            if min(index.sizes[item[k]], SHINGLE) == n:
                starts.setdefault(int(item[k]), []).append(place - int(offset[k]))
    out = set()
    for number, own in starts.items():
        size, own = int(index.sizes[number]), sorted(set(own))
        for a, b in zip(own, [*own[1:], own[-1] + 1]):
            out.update((s, size) for s in range(a, b if b - a <= size else a + 1))
    return out


def matches(index: Index, hashes: np.ndarray, places: dict[int, np.ndarray], similarity: float) -> dict[int, float]:
    """Items (by number) of the benchmark in one document, with their best similarity."""
    found: dict[int, float] = {}
    for n, own in places.items():
        every = grams(hashes, n)
        for start, size in _layouts(index, own, n, len(hashes)):
            shingles = np.unique(every[max(start, 0) : max(start + size - n + 1, 0)])
            if not len(shingles):
                continue
            weights = weights_of(shingles, index)
            print_ = simhash(shingles, weights)
            close = index.near[np.arange(8), np.array([print_]).view(np.uint8)].any(axis=0)
            for k in np.flatnonzero(close):
                far = _COUNTS[np.array([print_ ^ index.prints[k]]).view(np.uint8)].sum()
                if far > RADIUS:
                    continue
                shared = weights[np.isin(shingles, index.shingles[k], assume_unique=True)].sum()
                alike = shared / max(weights.sum(), index.mass[k])
                if alike >= similarity - 1e-12:
                    found[int(k)] = max(found.get(int(k), 0.0), float(alike))
    return found


def _hits(index, similarity: float):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            hits = batch.column("bench_hits").to_pylist()
            for lo, hi, words in slices(batch.column("bench_text")):
                hashes = word_hashes(words, lower=True)
                places: dict[int, dict[int, list]] = {}
                for n in (*own.short, SHINGLE):
                    every = grams(hashes, n)
                    maybe = np.flatnonzero(own.prefilter[every >> np.uint64(64 - _PREFILTER)])
                    at = np.minimum(np.searchsorted(own.known, every[maybe]), len(own.known) - 1)
                    maybe, at = maybe[own.known[at] == every[maybe]], at[own.known[at] == every[maybe]]
                    row = np.searchsorted(words.first, maybe, side="right") - 1
                    inside = maybe + n <= words.first[row + 1]
                    maybe, at, row = maybe[inside], at[inside], row[inside]
                    for r in np.unique(row).tolist():
                        mine = row == r
                        places.setdefault(r, {})[n] = np.stack([maybe[mine] - words.first[r], at[mine]], axis=1)
                for r, by_size in places.items():
                    text = hashes[words.first[r] : words.first[r + 1]]
                    for k, alike in matches(own, text, by_size, similarity).items():
                        hits[lo + r].append({"item_id": own.ids[k], "similarity": alike})
            columns = [pa.array(hits, kind) if f.name == "bench_hits" else batch.column(i) for i, f in enumerate(batch.schema)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               item_col: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY,
               carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns of ``carry`` and ``hits`` (item_id, similarity) of every document.

    Letters A-Z count as small ones. An item with fewer than five words must occur whole.
    Null or blank items match nothing, null or blank documents have no hits; null and repeated
    ids keep their rows, and equal items are all reported. Hits are ordered by item id. A carried
    column may have any name but ``hits``, which is an error.
    """
    if "hits" in carry:
        raise ValueError("a carried column has the name of a result")
    into, _, back = inner_names([id_col, *[c for c in carry if c != id_col]])
    out = docs.select(*into, F.col(text_col).alias("bench_text"), F.expr(
        "cast(array() as array<struct<item_id: long, similarity: double>>)").alias("bench_hits"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text"))
    shards = -(-items.count() // SHARD)
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == shard).collect()
        index = build_index([(r["item"], r["text"]) for r in part])
        if index is not None:
            out = out.mapInArrow(_hits(docs.sparkSession.sparkContext.broadcast(index), similarity), kinds)
    return out.select(*back, F.array_sort("bench_hits").alias("hits"))


def benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """op6: every document, the benchmark items it holds, and the best similarity (null: none)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"), F.col("hits.item_id").alias("item_ids"),
        F.array_max("hits.similarity").alias("similarity"))
