"""Exact, seeded and repeatable sampling, splitting and shuffling.

A row's place is the rank of ``md5(seed:purpose:key)`` within its class, so it depends
on the data and the seed only, not on partitions, task order or retries.

Taking the first rows of that order needs no sort of the data. A histogram over hash
prefixes (at most 4,096 counts per class, combined in the tasks) says in which prefix
the last wanted row lies. While that prefix holds more than ``RANKED`` rows, it is divided by the
next digits, in a pass that reads it alone; what is left is short enough to be ranked by hand.
After these small jobs the sample is a filter on literals: the rows themselves are never
shuffled or sorted, however many or uneven the classes are. The jobs read ``df`` each, so give
it a stored table if it is costly to compute.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.fixed import AI, HUMAN, SEED, TRAIN_SHARE, VAL_SHARE
from .filters import require_both_classes

PREFIX_DIGITS = 3
DIGITS = 32
# Rows that are ranked in one place: by the driver to cut a class, in one window task to shuffle.
RANKED = 4096
RANKED_IN_TASK = 1 << 20


def draw(seed: int, purpose: str, key: str) -> Column:
    """The hash that orders rows for one purpose."""
    return F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), F.col(key).cast("string")))


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


@dataclass(frozen=True)
class Order:
    """The seeded order of the rows of each class."""

    seed: int
    purpose: str
    key: str

    @property
    def hash(self) -> Column:
        return draw(self.seed, self.purpose, self.key)

    @property
    def prefix(self) -> Column:
        return F.substring(self.hash, 1, PREFIX_DIGITS)

    def histogram(self, df: DataFrame) -> dict[int, list[tuple[str, int]]]:
        """Rows per hash prefix for each class (a job; the result is of fixed size)."""
        counts = df.groupBy("label", self.prefix.alias("prefix")).count()
        found: dict[int, list[tuple[str, int]]] = {}
        rows = counts.collect()
        if any(row["label"] is None for row in rows):
            raise ValueError("rows without a label cannot be dealt into classes; drop them first")
        for label, prefix, n in sorted(rows):
            found.setdefault(label, []).append((prefix, n))
        return found

    def rows_at(
        self,
        df: DataFrame,
        histogram: Mapping[int, Sequence[tuple[str, int]]],
        ranks: Mapping[int, Sequence[int]],
    ) -> dict[tuple[int, int], tuple[str, object]]:
        """Hash and key of the row at each 1-based rank of each class (a few small jobs)."""
        places: dict[tuple[int, int], tuple[str, int, int]] = {}  # prefix, rank in it, rows in it

        def place(label: int, rank: int, nth: int, bins: Sequence[tuple[str, int]]) -> None:
            for prefix, n in bins:
                if nth <= n:
                    places[label, rank] = (prefix, nth, n)
                    return
                nth -= n

        for label, wanted in ranks.items():
            for rank in wanted:
                if rank:
                    place(label, rank, rank, histogram[label])
        keyed = df.select("label", F.col(self.key).alias("key"), self.hash.alias("hash"))

        def inside(prefixes: Iterable[tuple[int, str]]) -> DataFrame:
            return keyed.where(
                _any((F.col("label") == label) & F.col("hash").startswith(p) for label, p in prefixes)
            )

        while True:
            wide = {(l, p) for (l, _), (p, _, n) in places.items() if n > RANKED and len(p) < DIGITS}
            if not wide:
                break
            known = len(next(iter(wide))[1])
            finer = F.substring("hash", 1, known + PREFIX_DIGITS).alias("prefix")
            bins: dict[tuple[int, str], list[tuple[str, int]]] = {}
            for row in sorted(inside(wide).groupBy("label", finer).count().collect()):
                bins.setdefault((row.label, row.prefix[:known]), []).append((row.prefix, row["count"]))
            for (label, rank), (prefix, nth, _) in list(places.items()):
                if (label, prefix) in wide:
                    place(label, rank, nth, bins[label, prefix])
        if not places:
            return {}
        rows: dict[int, list[tuple[str, object, int]]] = {}
        near = inside({(label, prefix) for (label, _), (prefix, _, _) in places.items()})
        for row in near.groupBy("label", "hash", "key").count().collect():
            rows.setdefault(row.label, []).append((row.hash, row.key, row["count"]))
        found = {}
        for (label, rank), (prefix, nth, _) in places.items():
            own = sorted(r for r in rows[label] if r[0].startswith(prefix))
            ends = list(accumulate(n for *_, n in own))
            found[label, rank] = own[next(i for i, end in enumerate(ends) if nth <= end)][:2]
        return found

    def up_to(self, row: tuple[str, object] | None) -> Column:
        """Is this row at or before the given one?"""
        if row is None:
            return F.lit(False)
        last, key = row
        return (self.hash < last) | ((self.hash == last) & (F.col(self.key) <= F.lit(key)))


def balanced(df: DataFrame, seed: int = SEED, key: str = "article_id") -> Column:
    """Which rows make a sample with as many rows of each class as the smaller one has.

    The condition holds literals only and may be put to any table with ``label`` and ``key``.
    Rows of any other label are left out. Raises if a class has no rows.
    """
    order = Order(seed, "b", key)
    histogram = order.histogram(df.where(F.col("label").isin(HUMAN, AI)))
    sizes = {label: sum(n for _, n in bins) for label, bins in histogram.items()}
    require_both_classes(sizes.get(HUMAN, 0), sizes.get(AI, 0))
    smallest = min(sizes.values())
    larger = {label: [smallest] for label, n in sizes.items() if n > smallest}
    last = order.rows_at(df, histogram, larger)
    return _any(
        (F.col("label") == label)
        & (order.up_to(last[label, smallest]) if label in larger else F.lit(True))
        for label in sizes
    )


def balance(df: DataFrame, seed: int = SEED, key: str = "article_id") -> DataFrame:
    """As many rows of each class as the smaller one has, without replacement."""
    return df.where(balanced(df, seed, key))


def _largest_remainder(available: Mapping[int, int], take: int) -> dict[int, int]:
    """Share ``take`` over the classes in proportion to what is available.

    Every class gets the whole part of its share; what is left over goes to the
    largest remainders, ties to the lower label.
    """
    total = sum(available.values())
    shares = {label: divmod(take * n, total) for label, n in available.items()} if total else {}
    taken = {label: whole for label, (whole, _) in shares.items()}
    by_remainder = sorted(shares, key=lambda label: (-shares[label][1], label))
    for label in by_remainder[: take - sum(taken.values())]:
        taken[label] += 1
    return taken


def split_sizes(
    counts: Mapping[int, int], train_share: float = TRAIN_SHARE, val_share: float = VAL_SHARE
) -> dict[int, tuple[int, int, int]]:
    """Rows per class for train, val and test.

    What is not train is rounded up, then test is rounded up within it. Train is
    shared out over the classes first, then val over what is left.
    """
    total = sum(counts.values())
    test_share = 1.0 - train_share - val_share
    held = ceil((1.0 - train_share) * total)
    test = ceil(test_share / (val_share + test_share) * held)
    train = _largest_remainder(counts, total - held)
    left = {label: n - train[label] for label, n in counts.items()}
    val = _largest_remainder(left, held - test)
    return {label: (train[label], val[label], left[label] - val[label]) for label in counts}


def split_of(
    df: DataFrame,
    seed: int = SEED,
    key: str = "article_id",
    train_share: float = TRAIN_SHARE,
    val_share: float = VAL_SHARE,
) -> Column:
    """train, val or test, in the same proportion in every class of ``df``; literals only."""
    order = Order(seed, "s", key)
    histogram = order.histogram(df)
    sizes = split_sizes(
        {label: sum(n for _, n in bins) for label, bins in histogram.items()},
        train_share,
        val_share,
    )
    ranks = {label: [train, train + val] for label, (train, val, _) in sizes.items()}
    last = order.rows_at(df, histogram, ranks)

    def reached(index: int) -> Column:
        return _any(
            (F.col("label") == label) & order.up_to(last.get((label, ranks[label][index])))
            for label in ranks
        )

    return F.when(reached(0), "train").when(reached(1), "val").otherwise("test")


def stratified_split(
    df: DataFrame,
    seed: int = SEED,
    key: str = "article_id",
    train_share: float = TRAIN_SHARE,
    val_share: float = VAL_SHARE,
) -> DataFrame:
    """Adds ``split``: train, val or test, in the same proportion in every class."""
    return df.withColumn("split", split_of(df, seed, key, train_share, val_share))


def shuffle_rank(df: DataFrame, seed: int = SEED, key: str = "article_id") -> DataFrame:
    """Adds ``position``, the row's place in a seeded permutation of all rows.

    Windows run per hash prefix, as long as it takes for one to hold few enough rows for a task. The
    rows before a prefix are the rows before its first digits (at most 4,096 counts, ready in the
    plan) and the counts of longer prefixes that begin with them, one window for each.
    """
    order = Order(seed, "o", key)
    drawn = df.withColumn("_hash", order.hash).withColumn("_short", order.prefix)
    counts = sorted(tuple(r) for r in drawn.groupBy("_short").count().collect())
    digits, largest = PREFIX_DIGITS, max((n for _, n in counts), default=0)
    while largest > RANKED_IN_TASK and digits < 2 * PREFIX_DIGITS:
        digits, largest = digits + 1, largest // 16
    ends = accumulate((n for _, n in counts), initial=0)
    first = df.sparkSession.createDataFrame(
        [(p, start) for (p, _), start in zip(counts, ends)], "_short string, _start long"
    )
    drawn = drawn.join(F.broadcast(first), "_short").withColumn("_prefix", F.substring("_hash", 1, digits))
    inside = Window.partitionBy("_prefix").orderBy("_hash", key)
    place = F.col("_start") + F.row_number().over(inside)
    if digits > PREFIX_DIGITS:
        earlier = Window.partitionBy("_short").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
        before = (
            drawn.groupBy("_short", "_prefix")
            .agg(F.count("*").alias("_n"))
            .select("_prefix", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        )
        # Rows and counts meet by the prefix that the window needs them by.
        drawn, place = drawn.join(before, "_prefix"), place + F.col("_before")
    return drawn.withColumn("position", place).select(*df.columns, "position")


def shuffled(df: DataFrame, seed: int = SEED, key: str = "article_id") -> DataFrame:
    """Rows in seeded order, for an export: a range sort over all cores."""
    return df.orderBy(draw(seed, "o", key), key)
