"""Removal of word sequences that occur earlier in the corpus, with suffix automata.

The texts that repeat are the reference. It would take one pass over all documents for each
shard if the automata of all documents were sent to every task, so the reference is narrowed
to passages that do repeat, and an automaton goes only where a document meets its passage:

1. *Candidates.* Every window of ``window`` words is fingerprinted and routed by the smallest
   hash of a short gram inside it, so neighbouring windows travel together. Copies inside a
   stretch of texts are settled there; what is left, one entry a window and stretch, meets
   the other stretches in one shuffle. This gives runs of windows with a place that comes earlier.
2. *Reference shards.* The earlier places, merged by document and block of words, are the
   shards. A shard is at most ``BLOCK`` words long, so is its automaton.
3. *Matching statistics.* Every run is streamed through the automaton of its shard. A window
   is removed if the automaton knows its words from an earlier start.

No step gathers a passage with all its copies: a passage in a third of all documents is one
shard, joined to many short runs, which Spark's skew join can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


from .jaccard import parts_for
from .limits import small_enough, written
from .words import grams, slices, split, word_hashes

WINDOW = 20
ANCHOR = 6
BLOCK = 4096
FLUSH = 1 << 20

_RUN = "doc long, start long, len long, ref_doc long, ref_start long"
_NO_ID = -(1 << 63)


def key_of(id_col: str) -> Column:
    """Ids as long; a null id counts as the smallest."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))


def _runs(doc, pos, ref_doc, ref_pos) -> list[np.ndarray]:
    """Windows, sorted by place, as runs in which both places go on together."""
    if not len(doc):
        return [np.zeros(0, np.int64)] * 5
    go_on = (np.diff(doc) == 0) & (np.diff(pos) == 1) & (np.diff(ref_doc) == 0) & (np.diff(ref_pos) == 1)
    heads = np.flatnonzero(np.r_[True, ~go_on])
    size = np.diff(np.r_[heads, len(doc)])
    return [doc[heads], pos[heads], size, ref_doc[heads], ref_pos[heads]]


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, …`` (``size[i]`` values) for all i."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - first, size)


def _sliding_least(values: np.ndarray, n: int) -> np.ndarray:
    out, have = values, 1
    while have < n:
        step = min(have, n - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of ``values[bounds[i]:bounds[i + 1]]`` for all i."""
    offsets = bounds * (values.nbytes // max(len(values), 1))
    if offsets[-1] >= 1 << 31:
        raise ValueError("more than 2 GB for one binary column of a batch")
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _entries(window: int, bits: int, anchor_size: int, by):
    """(doc, text) -> blobs by part, and runs already settled inside a stretch of texts.

    ``by`` cuts texts into words or other units.
    """
    fields = pa.schema([("part", pa.int32()), ("anchor", pa.binary()), ("doc", pa.binary()),
                        ("pos", pa.binary()), ("size", pa.binary()), ("tails", pa.binary()), ("runs", pa.binary())])

    def flush(held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        held.sort(key=lambda x: x[0])
        sizes = np.array([len(x[1]) for x in held])
        ids = np.array([x[0] for x in held], np.int64)
        hashes = np.concatenate([x[1] for x in held])
        first = np.r_[0, np.cumsum(sizes)]
        at = _spread(first[:-1], np.maximum(sizes - window + 1, 0))
        if not len(at):
            return pa.RecordBatch.from_pylist([], fields)
        row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - window + 1, 0))
        doc, pos = ids[row], at - first[row]
        whole = grams(hashes, window)[at]
        least = _sliding_least(grams(hashes, anchor_size), window - anchor_size + 1)[at]
        order = np.argsort(whole, kind="stable")
        known = whole[order]
        heads = np.flatnonzero(np.r_[True, known[1:] != known[:-1]])
        source = np.empty(len(at), np.int64)
        source[order] = np.repeat(order[heads], np.diff(np.r_[heads, len(at)]))
        # In one text, point to the place just before: repetitions of a period make one run.
        again = np.flatnonzero((known[1:] == known[:-1]) & (row[order[1:]] == row[order[:-1]]))
        source[order[again + 1]] = order[again]
        later = np.flatnonzero(source != np.arange(len(at)))
        # Rows of one id may stand in several texts; equal places are no earlier start.
        later = later[(doc[later] != doc[source[later]]) | (pos[later] != pos[source[later]])]
        settled = np.stack(_runs(doc[later], pos[later], doc[source[later]], pos[source[later]]), axis=1)
        new = np.flatnonzero(source == np.arange(len(at)))
        anchors = least[new]
        go_on = (np.diff(new) == 1) & (np.diff(row[new]) == 0) & (anchors[1:] == anchors[:-1])
        heads = np.flatnonzero(np.r_[True, ~go_on])
        size = np.diff(np.r_[heads, len(new)])
        part = (anchors[heads] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        heads, size, part = heads[order], size[order], part[order]
        tails = (whole[new] >> np.uint64(32)).astype(np.uint32)[_spread(heads, size)]
        owner = settled[:, 0] & ((1 << bits) - 1)
        order = np.argsort(owner, kind="stable")
        settled, owner = settled[order], owner[order]
        # Everything is in the order of parts now, so what a part gets is a stretch of each array.
        bounds = np.searchsorted(part, np.arange((1 << bits) + 1))
        kept = np.searchsorted(owner, np.arange((1 << bits) + 1))
        parts = np.flatnonzero((np.diff(bounds) > 0) | (np.diff(kept) > 0))
        bounds, kept = np.r_[bounds[parts], len(part)], np.r_[kept[parts], len(owner)]
        ends = np.r_[0, np.cumsum(size)]
        place = new[heads]
        steps = np.diff(doc[place], prepend=0)
        first_of = bounds[:-1][np.diff(bounds) > 0]
        steps[first_of] = doc[place[first_of]]
        return pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), _binary(anchors[heads].astype(np.uint32), bounds), _binary(steps, bounds),
             _binary(pos[place].astype(np.int32), bounds), _binary(size.astype(np.int32), bounds),
             _binary(tails, ends[bounds]), _binary(settled, kept)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, words in slices(batch.column(1), by=by):
                hashes = word_hashes(words)
                for k in range(lo, hi):
                    a, b = words.first[k - lo], words.first[k - lo + 1]
                    if b - a >= window:
                        held.append((ids[k].as_py(), hashes[a:b]))
                        size += b - a
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _resolve(batch: pa.Table) -> pa.Table:
    """All blobs of a part -> runs of windows whose words start earlier."""
    def joined(name, kind):
        return [np.frombuffer(x, kind) for x in batch[name].to_pylist()]

    runs = np.concatenate(joined("runs", np.int64)).reshape(-1, 5).T
    anchor, size = np.concatenate(joined("anchor", np.uint32)), np.concatenate(joined("size", np.int32))
    doc = np.concatenate([np.cumsum(d) for d in joined("doc", np.int64)])
    pos = np.concatenate(joined("pos", np.int32)).astype(np.int64)
    key = (np.repeat(anchor, size).astype(np.uint64) << np.uint64(32)) | np.concatenate(joined("tails", np.uint32))
    order = np.argsort(key)
    known = key[order]
    same = known[1:] == known[:-1]
    several = order[np.r_[same, False] | np.r_[False, same]] if len(key) else order
    owner = np.repeat(np.arange(len(size)), size)[several]
    inside = several - (np.cumsum(size) - size)[owner]
    doc, pos, key = doc[owner], pos[owner] + inside, key[several]
    order = np.lexsort((pos, doc, key))
    doc, pos, key = doc[order], pos[order], key[order]
    if len(key):
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[heads, len(key)])
        ref_doc, ref_pos = np.repeat(doc[heads], size), np.repeat(pos[heads], size)
        later = np.flatnonzero((doc != ref_doc) | (pos != ref_pos))
        later = later[np.lexsort((pos[later], doc[later]))]
        more = np.stack(_runs(doc[later], pos[later], ref_doc[later], ref_pos[later]))
        runs = np.concatenate([runs, more], axis=1)
    return pa.table(list(runs), names=["doc", "start", "len", "ref_doc", "ref_start"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by place; those that go on from each other become one."""
    names, last = ["doc", "start", "len", "ref_doc", "ref_start"], None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if last is not None:
            rows = np.concatenate([last, rows], axis=1)
        doc, start, size, ref_doc, ref_start = rows
        # Runs settled in a stretch may overlap those found between stretches: windows keep their own.
        go_on = ((doc[1:] == doc[:-1]) & (ref_doc[1:] == ref_doc[:-1]) & (start[1:] == start[:-1] + size[:-1])
                 & (ref_start[1:] == ref_start[:-1] + size[:-1]))
        heads = np.flatnonzero(np.r_[True, ~go_on])
        out = np.stack([doc[heads], start[heads], np.add.reduceat(size, heads), ref_doc[heads], ref_start[heads]])
        last = out[:, -1:]
        if out.shape[1] > 1:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out[:, :-1]], names)
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in last], names)


def candidate_runs(docs: DataFrame, window: int, anchor_size: int = ANCHOR, by=split) -> DataFrame:
    """Runs of windows of (``doc``, ``text``) with an earlier place of the same fingerprint."""
    bits = parts_for(docs, "text", FLUSH).bit_length() - 1
    blobs = docs.mapInArrow(_entries(window, bits, anchor_size, by), "part int, anchor binary, doc binary, pos binary, "
                                                    "size binary, tails binary, runs binary")
    runs = written(blobs.groupBy("part").applyInArrow(_resolve, _RUN), "runs")
    merged = runs.repartition("doc").sortWithinPartitions("doc", "start").mapInArrow(_merged, _RUN)
    return written(merged, "merged-runs")


class SuffixAutomaton:
    """All subsequences of consecutive words of one text, with the first end of each."""

    def __init__(self, words: list[int]):
        # State ``k`` is the text's first ``k`` words; copies of states come behind.
        n = len(words)
        moves, link = [{} for _ in range(n + 1)], [-1] + [0] * n
        length, first_end = list(range(n + 1)), list(range(-1, n))
        for end, word in enumerate(words):
            new = end + 1
            moves[end][word] = new
            at = link[end]
            while at >= 0:
                own = moves[at]
                if word in own:
                    break
                own[word] = new
                at = link[at]
            else:
                continue
            to = own[word]
            if length[to] == length[at] + 1:
                link[new] = to
                continue
            twin = len(moves)
            moves.append(moves[to].copy())
            link.append(link[to])
            length.append(length[at] + 1)
            first_end.append(first_end[to])
            while at >= 0 and moves[at].get(word) == to:
                moves[at][word] = twin
                at = link[at]
            link[to] = link[new] = twin
        self.next, self.link, self.length, self.first_end = moves, link, length, first_end

    def first_starts(self, words: list[int], window: int) -> list[int]:
        """For every window of ``words``: where its words first start in the text, or -1."""
        moves, link, length, first_end = self.next, self.link, self.length, self.first_end
        out, at, matched = [], 0, 0
        for end, word in enumerate(words):
            to = moves[at].get(word)
            while to is None and at:
                at = link[at]
                matched = length[at]
                to = moves[at].get(word)
            if to is not None:
                at = to
                matched += 1
            if matched >= window:
                # Words before the window are forgotten, or periodic texts would climb all states at every word.
                matched = window
                while length[link[at]] >= window:
                    at = link[at]
                out.append(first_end[at] - window + 1)
            elif end >= window - 1:
                out.append(-1)
        return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted) -> the word hashes of every wanted stretch of the text."""
    names = ["ref", "ref_doc", "block", "doc", "start", "words"]
    for batch in batches:
        wanted = batch.column(1).to_pylist()
        for lo, hi, words in slices(batch.column(0)):
            hashes = word_hashes(words)
            rows = [(w["ref"], w["ref_doc"], w["block"], w["doc"], w["start"],
                     hashes[words.first[k - lo] + w["start"] : words.first[k - lo] + w["end"]].tobytes())
                    for k in range(lo, hi) for w in wanted[k]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)


def _streamed(window: int):
    """Runs with the words of their shard, by shard -> runs of windows that do start earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, automaton = None, None
        for batch in batches:
            shards, words = batch.column("shard"), batch.column("words")
            out = []
            for k, row in enumerate(batch.drop_columns(["shard", "words"]).to_pylist()):
                shard = (row["ref_doc"], row["block"])
                if shard != last:
                    last = shard
                    automaton = SuffixAutomaton(np.frombuffer(shards[k].as_buffer(), np.uint64).tolist())
                stretch = np.frombuffer(words[k].as_buffer(), np.uint64).tolist()
                first = np.array(automaton.first_starts(stretch, window))
                place = row["start"] + np.arange(len(first))
                earlier = (first >= 0) & ((row["ref_doc"] < row["doc"]) | (first + row["base"] < place))
                edges = np.flatnonzero(np.diff(np.r_[False, earlier, False].astype(np.int8)))
                out += [(row["doc"], row["start"] + int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc", "start", "len"])

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   window: int = WINDOW) -> DataFrame:
    """``doc, start, end``: stretches of words (end exclusive) to remove; they may overlap.

    A stretch is covered by windows whose word sequence also starts earlier: in a smaller id,
    or in the same document before. A null id counts as the smallest; rows that share an id
    are places of one document, and equal places do not precede each other. Null, blank and
    short texts have no windows.
    """
    if window < 2 * ANCHOR:
        raise ValueError(f"a window has at least {2 * ANCHOR} words")
    docs = docs.select(key_of(id_col).alias("doc"), F.col(text_col).alias("text"))
    runs = candidate_runs(docs, window)
    block = F.explode(F.sequence(F.expr(f"ref_start div {BLOCK}"), F.expr(f"(ref_start + len - 1) div {BLOCK}")))
    runs = runs.select("*", block.alias("block"))
    low = F.greatest("ref_start", F.col("block") * BLOCK)
    high = F.least(F.col("ref_start") + F.col("len"), (F.col("block") + 1) * BLOCK)
    runs = runs.select("ref_doc", "block", "doc", (F.col("start") + low - F.col("ref_start")).alias("start"),
                       low.alias("low"), high.alias("high"))
    shards = runs.groupBy("ref_doc", "block").agg(F.min("low").alias("start"), F.max("high").alias("high"))
    wanted = runs.select(
        F.lit(False).alias("ref"), "ref_doc", "block", "doc", "start",
        (F.col("start") + F.col("high") - F.col("low") + window - 1).alias("end"),
    ).union(shards.select(F.lit(True), "ref_doc", "block", "ref_doc", "start", F.col("high") + window - 1))
    wanted = written(
        wanted.groupBy("doc").agg(F.collect_list(F.struct("ref", "ref_doc", "block", "doc", "start", "end")).alias("wanted")),
        "wanted",
    )
    parts = written(
        docs.join(small_enough(wanted, F.size("wanted")), "doc").select("text", "wanted").mapInArrow(
            _cut, "ref boolean, ref_doc long, block long, doc long, start long, words binary"),
        "stretches",
    )
    shards = parts.where("ref").groupBy("ref_doc", "block").agg(
        F.min("start").alias("base"), F.max("words").alias("shard"))
    met = parts.where("not ref").select("ref_doc", "block", "doc", "start", "words").join(shards, ["ref_doc", "block"])
    found = met.sortWithinPartitions("ref_doc", "block").mapInArrow(_streamed(window), "doc long, start long, len long")
    return written(found.select("doc", "start", (F.col("start") + F.col("len") + window - 1).alias("end")), "spans")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_words", "n_removed", "kept"]
    for batch in batches:
        texts, spans = batch.column("text"), batch.column("spans").to_pylist()
        count, removed, kept = [], [], []
        for k, own in enumerate(spans):
            words = (texts[k].as_py() or "").encode().split()
            count.append(len(words))
            if own:
                stay = np.ones(len(words), bool)
                for span in own:
                    stay[span["start"] : span["end"]] = False
                words = [words[i] for i in np.flatnonzero(stay)]
            removed.append(count[-1] - len(words))
            kept.append(b" ".join(words).decode())
        columns = [pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
        others = [i for i, f in enumerate(batch.schema) if f.name not in ("text", "spans")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in others] + columns, [batch.schema[i].name for i in others] + names)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                     window: int = WINDOW) -> DataFrame:
    """``id_col, n_words, n_removed, kept``: every row with its text less the repeated stretches.

    Kept words are joined by one space. A null text is an empty one. Other columns are not read.
    """
    spans = repeated_spans(docs, id_col, text_col, window=window)
    spans = written(spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "document-spans")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), key_of(id_col).alias("doc"), F.col(text_col).alias("text"))
    rows = rows.join(small_enough(spans, F.size("spans")), "doc", "left").select("id", "text", "spans")
    kept = rows.mapInArrow(_kept, "id long, n_words long, n_removed long, kept string")
    return kept.withColumnRenamed("id", id_col)


def substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract of op2: windows of 20 words, words unchanged, digest of the kept text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
