"""Near-duplicate documents: an exact set-similarity self-join on token-combination prefixes.

A document is the set of its distinct word shingles ("tokens"). Two documents link when the
Jaccard similarity of their sets reaches ``num / den``. A set of size ``n`` can miss at most
``slack = n - ceil(n * num / den)`` of its tokens in a partner. Tokens are ordered rare first,
frequent last, by hash within a class, and a *prefix* is taken so long that no ``slack``
losses can remove all of its signatures:

* a token of the rare class is a signature by itself (rare: in fewer documents than
  ``frequent``; with the default 2, such a token has no partner and only fills the prefix, so
  a text that is mostly its own emits nothing at all);
* tokens of the frequent class are dealt into groups, and every pair of prefix tokens of one
  group is a signature. A group of ``c`` tokens survives ``c - 2`` losses, so it counts
  ``c - 1`` towards the prefix, which is extended accordingly.

The prefix that ends first in the order is contained in the other up to its end, so two
linked documents share a signature. The number of groups follows the size of the larger
document; each document emits the signatures for every number a partner may use (at most two).

Steps: (1) count every token over all documents; (2) emit signatures; tokens of one document
only count for the prefix but are not emitted; (3) ``STARS`` times, compare all members of a signature with one
of them, the one with the most links so far, and contract links to components; (4) compare
whatever pairs of a signature are in different components still, each at the first signature it shares. Before sets are compared, sizes and 512 parity bits a class
rule out pairs that differ in too many tokens. Pairs inside one component cannot change the result, so a
group of near copies costs its members, not their pairs.

Tokens and sets are identified by 64-bit hashes. Documents with equal sets are one class.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


from .graph import components
from .limits import small_batches, small_enough, written
from .words import mix, shingles, slices, word_hashes

FLAG_BITS = 27
FREQUENT = 2
PARITIES = 8
STARS = 1
FLUSH = 1 << 20
PER_PART = 1 << 22


_PARITY = [f"p{k}" for k in range(PARITIES)]


def parts_for(docs: DataFrame, text: str, per_part: int = PER_PART) -> int:
    """A power of two, in proportion to the bytes of all texts; a word takes some six."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return 1 << max(4, (int(size) // 6 // per_part).bit_length())


def _token_blobs(n: int, lower: bool, bits: int):
    """Texts -> (part, lows, counts): tokens of many texts, sorted, without their top ``bits``."""

    def flush(sets: list[np.ndarray]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
        bounds = np.searchsorted(tokens >> np.uint64(64 - bits), np.arange((1 << bits) + 1))
        lows = (tokens << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)
        counts = np.minimum(counts, 1 << 15).astype(np.uint16)
        rows = [(p, lows[a:b].tobytes(), counts[a:b].tobytes())
                for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.binary())], ["part", "lows", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held = [], 0
        for batch in batches:
            for _, _, words in slices(batch.column(0)):
                for tokens in shingles(word_hashes(words, lower), words.first, n):
                    sets.append(tokens)
                    held += len(tokens)
                if held >= FLUSH:
                    yield flush(sets)
                    sets, held = [], 0
        if held:
            yield flush(sets)

    return run


def _flags(bits: int, flag_bits: int, frequent: int):
    """All blobs of a part -> its stretch of the two bit maps: tokens seen twice, often."""
    width = 1 << (flag_bits - bits)

    def run(batch: pa.Table) -> pa.Table:
        lows = np.concatenate([np.frombuffer(b, np.uint32) for b in batch["lows"].to_pylist()])
        counts = np.concatenate([np.frombuffer(b, np.uint16) for b in batch["counts"].to_pylist()])
        order = np.argsort(lows, kind="stable")
        lows, counts = lows[order], counts[order]
        heads = np.flatnonzero(np.r_[True, lows[1:] != lows[:-1]])
        total = np.add.reduceat(counts.astype(np.int64), heads)
        at = lows[heads] >> np.uint32(32 + bits - flag_bits)
        out = []
        for least in sorted({2, frequent}):
            bitmap = np.zeros(width, bool)
            bitmap[at[total >= least]] = True
            out.append(np.packbits(bitmap, bitorder="little").tobytes())
        return pa.table({"part": pa.array([batch["part"][0].as_py()], pa.int32()),
                         "repeated": pa.array([out[0]], pa.binary()),
                         "frequent": pa.array([out[-1]], pa.binary())})

    return run


def token_flags(docs: DataFrame, text: str, n: int, lower: bool, frequent: int, flag_bits: int):
    """Bit maps of ``2**flag_bits`` bits over token hashes, from counts of all documents: tokens
    of more than one document, and frequent ones (left out if that is the same).

    Their size is fixed, whatever the corpus. Tokens that share a bit share a class, which is
    a matter of speed alone: a set bit never hides a link. Counting moves four bytes a token.
    """
    bits = min(parts_for(docs, text).bit_length() - 1, flag_bits - 3)
    blobs = docs.select(text).mapInArrow(_token_blobs(n, lower, bits), "part int, lows binary, counts binary")
    parts = blobs.groupBy("part").applyInArrow(
        _flags(bits, flag_bits, frequent), "part int, repeated binary, frequent binary")
    each = (1 << (flag_bits - bits)) // 8
    maps = {c: bytearray((1 << flag_bits) // 8) for c in (["repeated"] if frequent == 2 else ["repeated", "frequent"])}
    # A row for each part, of a fixed size together; one job, however many partitions there are.
    with small_batches(docs.sparkSession):
        found = parts.select("part", *maps).collect()
    for row in found:
        for name, whole in maps.items():
            whole[row["part"] * each : (row["part"] + 1) * each] = row[name]
    return tuple(maps.values())


def _groups(slack: int) -> int:
    """About one group for each token that may be missing: small groups have few pairs."""
    return 1 << max(0, slack.bit_length() - 1)


def prefix_signatures(tokens, repeated, frequent, num: int, den: int) -> np.ndarray:
    """Signatures of one set. ``repeated`` and ``frequent`` say so of each token."""
    n = len(tokens)
    slack = n - -(-n * num // den)
    rare = tokens[~frequent]
    if len(rare) > slack:
        head = ~frequent
        keep = np.flatnonzero(head)[: slack + 1]
        return mix(tokens[keep][repeated[keep]])
    often = tokens[frequent]
    out = [mix(rare[repeated[~frequent]])]
    largest = n * den // num
    counts = {_groups(m - -(-m * num // den)) for m in (n, largest)}
    counts |= {1 << k for k in range(min(counts).bit_length(), max(counts).bit_length() - 1)}
    for groups in counts:
        group = (often >> np.uint64(7)) % np.uint64(groups)
        # A token adds one to the prefix unless it is the first of its group.
        _, first = np.unique(group, return_index=True)
        worth = np.ones(len(often), np.int64)
        worth[first] = 0
        have = len(rare) + np.cumsum(worth)
        end = int(np.searchsorted(have, slack + 1)) + 1
        taken, group = often[:end], group[:end]
        order = np.argsort(group, kind="stable")
        taken, group = taken[order], group[order]
        for back in range(1, len(taken)):
            same = group[back:] == group[:-back]
            if not same.any():
                break
            a, b = taken[:-back][same], taken[back:][same]
            out.append(mix(mix(a) * np.uint64(3) + mix(b) + np.uint64(groups)))
    return np.unique(np.concatenate(out))


def _name(tokens: np.ndarray) -> int:
    """The class of a set: a hash of all its tokens."""
    return int(mix(np.array([mix(tokens).sum() + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def _signed(n: int, lower: bool, num: int, den: int, maps, flag_bits: int):
    """(key, anon, text) -> (key, anon, n, cls, parities, sigs); signatures come once a class and task."""
    shift, seven, one = np.uint64(64 - flag_bits), np.uint64(7), np.uint8(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = [np.frombuffer(m, np.uint8) for m in maps.value]
        seen: set[int] = set()
        for batch in batches:
            for lo, hi, words in slices(batch.column(2)):
                size, cls, sigs, parity = [], [], [], []
                for tokens in shingles(word_hashes(words, lower), words.first, n):
                    size.append(len(tokens))
                    name = _name(tokens)
                    cls.append(name if len(tokens) else None)
                    odd = np.bincount((tokens >> np.uint64(3)) % np.uint64(64 * PARITIES), minlength=64 * PARITIES) & 1
                    parity.append(np.packbits(odd.astype(bool), bitorder="little").view(np.int64))
                    if not len(tokens) or name in seen:
                        sigs.append(None)
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(name)
                    at = tokens >> shift
                    byte, bit = at >> np.uint64(3), (at & seven).astype(np.uint8)
                    marked = [(f[byte] >> bit & one).astype(bool) for f in flags]
                    own = prefix_signatures(tokens, marked[0], marked[-1], num, den)
                    sigs.append(own.view(np.int64) if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(size, pa.int64()), pa.array(cls, pa.int64()),
                     *[pa.array(p, pa.int64()) for p in zip(*parity)], pa.array(sigs, pa.list_(pa.int64()))],
                    ["key", "anon", "n", "cls", *_PARITY, "sigs"])

    return run


def _verified(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, right = [], None, None
            for x, y in zip(batch.column(2), batch.column(3)):
                left = np.frombuffer(x.as_buffer(), np.uint64)
                if last is None or last != y:
                    last, right = y, np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(den * both >= num * (len(left) + len(right) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(n: int, lower: bool):
    """(cls, text) -> the sets of texts that are of the class, once a class and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for lo, hi, words in slices(batch.column(1)):
                out = []
                for cls, tokens in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), shingles(word_hashes(words, lower), words.first, n)):
                    # Rows of one id may hold different texts.
                    if cls not in seen and _name(tokens) == cls:
                        out.append((cls, tokens.tobytes()))
                        if len(seen) < 1_000_000:
                            seen.add(cls)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _ in out], pa.int64()), pa.array([t for _, t in out], pa.binary())], ["cls", "tokens"])

    return run


def _may_link(n: str, m: str, p: list[str], q: list[str], num: int, den: int) -> Column:
    """A bound that no link exceeds, from sizes and parities.

    Every token that only one of two sets has changes one of their parity bits, and a link
    allows ``(den - num) / (den + num)`` of both sizes together to differ.
    """
    differ = reduce(add, [F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(p, q)])
    return (F.greatest(n, m) * num <= F.least(n, m) * den) & (
        differ * (den + num) <= (F.col(n) + F.col(m)) * (den - num))


def _links(pairs: DataFrame, docs: DataFrame, owners: DataFrame, n: int, lower: bool, num: int, den: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets are similar enough, by the texts of their owners.

    Only documents in pairs are read into sets; the larger side stays where it is if the list
    of those documents is small enough to broadcast.
    """
    pairs = written(pairs, "pairs")
    asked = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    asked = written(owners.join(asked, "cls").select("cls", "owner.anon", "owner.key"), "asked")
    texts = docs.join(small_enough(asked), ["anon", "key"]).select("cls", "text")
    sets = written(texts.mapInArrow(_sets(n, lower), "cls long, tokens binary").dropDuplicates(["cls"]), "sets")
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x")), "a").join(
        sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y")), "b"
    )
    return written(both.select("a", "b", "x", "y").mapInArrow(_verified(num, den), "a long, b long"), "links", 128)


def _mixed(entries: DataFrame) -> DataFrame:
    """The entries of signatures with more than one component; of signatures of the same classes, one.

    Near copies share most of their signatures, so many signatures have the very same classes.
    """
    entries = written(entries, "entries")
    several = entries.groupBy("sig").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("c"),
        F.bit_xor(F.xxhash64("cls")).alias("f"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("g")).where("x < y")
    several = several.groupBy("c", "f", "g").agg(F.min("sig").alias("sig"))
    return written(entries.join(several.select("sig"), "sig", "left_semi"), "mixed")


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    n: int = 5,
    num: int = 80,
    den: int = 100,
    lower: bool = True,
    frequent: int = FREQUENT,
    flag_bits: int = FLAG_BITS,
) -> DataFrame:
    """One row per document: ``id_col, n_shingles, component_id``.

    ``component_id`` is the smallest id that links reach, the document itself included. A null
    or blank text has no shingles and no links; fewer than ``n`` words are one shingle; equal
    sets always link. Rows with a null id keep their row and form no component of their own:
    they get the smallest id that is not null among their links, else null. Repeated rows stay
    repeated. Other columns are not looked at. The similarity must exceed one half.
    """
    if not 2 * num > den >= num > 0:
        raise ValueError("the similarity must be above one half and at most one")
    own = F.col(id_col).cast("long")
    # A row without an id is found again by its text.
    docs = docs.select(F.coalesce(own, F.xxhash64(text_col)).alias("key"), own.isNull().alias("anon"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    maps = spark.sparkContext.broadcast(token_flags(docs, "text", n, lower, frequent, flag_bits))
    signed = written(
        docs.mapInArrow(_signed(n, lower, num, den, maps, flag_bits),
                        f"key long, anon boolean, n long, cls long, {', '.join(f'{p} long' for p in _PARITY)}, sigs array<long>"),
        "signed",
    )
    maps.destroy()
    entries = written(
        signed.where("sigs is not null").select(F.explode("sigs").alias("sig"), "cls").distinct(),
        "signatures",
    )
    other = {p: f"q{p}" for p in _PARITY}
    bound = _may_link("n", "m", [*other], [*other.values()], num, den)
    known = signed.where("sigs is not null").groupBy("cls").agg(
        F.first("n").alias("n"), *[F.first(p).alias(p) for p in _PARITY])
    known = written(known, "known")
    its = known.select(F.col("cls").alias("lead"), F.col("n").alias("m"), *[F.col(p).alias(q) for p, q in other.items()])
    owners = written(
        signed.where("cls is not null").groupBy("cls").agg(
            F.min(F.struct("anon", "key")).alias("owner"), F.min(F.when(~F.col("anon"), F.col("key"))).alias("least")), "owners")
    # Entries of signatures whose classes are not all in one component yet.
    open_ = _mixed(entries.select("sig", "cls", F.col("cls").alias("component"), F.lit(0).cast("long").alias("degree")))
    links, found = None, None
    for _ in range(STARS):
        leads = open_.groupBy("sig").agg(F.max(F.struct("degree", "cls", "component")).alias("lead"))
        met = open_.join(leads, "sig").where("component <> lead.component").select("cls", F.col("lead.cls").alias("lead"))
        pairs = met.distinct().join(known, "cls").join(its, "lead").where(bound).select(
            F.col("cls").alias("a"), F.col("lead").alias("b"))
        new = _links(pairs, docs, owners, n, lower, num, den)
        links = new if links is None else links.union(new)
        found = components(links)
        degrees = links.select(F.col("a").alias("cls")).union(links.select("b")).groupBy("cls").agg(F.count("*").alias("degree"))
        open_ = _mixed(
            open_.select("sig", "cls").join(found.withColumnRenamed("id", "cls"), "cls", "left").join(degrees, "cls", "left")
            .select("sig", "cls", F.coalesce("component", "cls").alias("component"), F.coalesce("degree", F.lit(0)).alias("degree")))
    # A pair is compared where it meets first, not at every signature that it shares.
    lists = open_.groupBy("cls").agg(F.collect_list("sig").alias("all"))
    left = open_.join(known, "cls").join(lists, "cls").select("sig", "cls", "component", "n", *_PARITY, "all")
    left = written(left, "open")
    right = left.select(F.col("sig").alias("same"), F.col("cls").alias("b"), F.col("n").alias("m"), F.col("component").alias("other"),
                        F.col("all").alias("every"), *[F.col(p).alias(q) for p, q in other.items()])
    meets_first = F.array_min(F.array_intersect("all", "every")) == F.col("sig")
    rest = left.withColumnRenamed("cls", "a").join(
        right, (F.col("sig") == F.col("same")) & (F.col("a") < F.col("b")) & (F.col("component") != F.col("other"))
        & bound & meets_first).select("a", "b")
    more = _links(rest, docs, owners, n, lower, num, den)
    found = components(links.union(more))
    owners = written(
        owners.join(found.withColumnRenamed("id", "cls"), "cls", "left").select(
            "cls", "least", F.coalesce("component", "cls").alias("component")),
        "classes",
    )
    smallest = owners.groupBy("component").agg(F.min("least").alias("smallest"))
    classes = owners.join(smallest, "component").select("cls", "smallest")
    named = F.when(~F.col("anon"), F.col("key"))
    return signed.select("key", "anon", "n", "cls").join(classes, "cls", "left").select(
        named.alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce(F.col("smallest"), named).alias("component_id"),
    )


def ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Contract of op1: three-word shingles, similarity 0.9, letters A-Z in lower case."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(docs, n=3, num=90, den=100)
