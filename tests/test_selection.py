"""Filters, de-duplication, sampling and counts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from pressmill.operators import counters, filters, sampling
from pressmill.operators.dedup import keep_first
from pressmill.operators.sampling import (
    Order, balance, shuffle_rank, shuffled, split_sizes, stratified_split,
)
from pressmill.plans.prepare import prepare


@pytest.fixture(scope="module")
def skewed(spark):
    """Five thousand rows, nine tenths of them of one class."""
    df = spark.range(5000).select(
        F.col("id").alias("article_id"), (F.col("id") % 10 == 0).cast("int").alias("label")
    )
    return df.cache()


def place(seed, purpose, key):
    return hashlib.md5(f"{seed}:{purpose}:{key}".encode()).hexdigest()


def test_balance_takes_the_first_rows_by_hash(spark, skewed):
    odd = skewed.unionByName(
        spark.createDataFrame([(9001, 7), (9002, None)], "article_id long, label int")
    )
    got = {(r.article_id, r.label) for r in balance(odd, 42).collect()}
    human = sorted((i for i in range(5000) if i % 10), key=lambda i: place(42, "b", i))[:500]
    assert got == {(i, 0) for i in human} | {(i, 1) for i in range(0, 5000, 10)}


def test_balance_ignores_partitioning(skewed):
    one = balance(skewed.coalesce(1), 7).select("article_id").collect()
    many = balance(skewed.repartition(8), 7).select("article_id").collect()
    assert sorted(one) == sorted(many)


def test_balance_does_not_shuffle_rows(skewed, capsys):
    balance(skewed, 42).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 0), (2, 0)], "article_id long, label int")
    with pytest.raises(ValueError):
        balance(df)


def test_split_sizes():
    assert split_sizes({0: 56, 1: 56}) == {0: (45, 5, 6), 1: (44, 6, 6)}
    assert split_sizes({0: 11, 1: 11}) == {0: (9, 1, 1), 1: (8, 1, 2)}
    assert split_sizes({0: 533, 1: 533}) == {0: (426, 54, 53), 1: (426, 53, 54)}
    for n in range(1, 400):
        sizes = split_sizes({0: n, 1: 3 * n, 5: 1})
        held = -(-(4 * n + 1) // 5)
        assert sum(s[0] for s in sizes.values()) == 4 * n + 1 - held
        assert sum(s[2] for s in sizes.values()) == -(-held // 2)
        assert all(min(s) >= 0 for s in sizes.values())
        assert [sum(sizes[label]) for label in (0, 1, 5)] == [n, 3 * n, 1]


def test_split_follows_the_hash_order(skewed):
    got = {r.article_id: r.split for r in stratified_split(skewed, 3).collect()}
    assert len(got) == 5000
    sizes = split_sizes({0: 4500, 1: 500})
    for label, ids in ((0, [i for i in range(5000) if i % 10]), (1, list(range(0, 5000, 10)))):
        ids.sort(key=lambda i: place(3, "s", i))
        train, val, test = sizes[label]
        assert [got[i] for i in ids] == ["train"] * train + ["val"] * val + ["test"] * test


def test_shuffle(skewed):
    got = {r.article_id: r.position for r in shuffle_rank(skewed, 42).collect()}
    ids = sorted(range(5000), key=lambda i: place(42, "o", i))
    assert got == {i: n for n, i in enumerate(ids, 1)}
    assert [r.article_id for r in shuffled(skewed, 42).limit(20).collect()] == ids[:20]


@pytest.mark.parametrize("ranked", [1, 7, 400])
def test_deeper_prefixes_change_nothing(spark, skewed, monkeypatch, ranked):
    """Prefixes are divided until few rows are left; the rows stay the same."""
    want = (
        sorted(balance(skewed, 42).collect()),
        sorted(stratified_split(skewed, 3).collect()),
        sorted(shuffle_rank(skewed, 42).collect()),
    )
    monkeypatch.setattr(sampling, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(sampling, "RANKED", ranked)
    monkeypatch.setattr(sampling, "RANKED_IN_TASK", ranked)
    got = (
        sorted(balance(skewed, 42).collect()),
        sorted(stratified_split(skewed, 3).collect()),
        sorted(shuffle_rank(skewed, 42).collect()),
    )
    assert got == want


def test_repeated_keys_do_not_pile_up(spark, monkeypatch):
    """All copies of a key have one hash; they are counted, not gathered."""
    monkeypatch.setattr(sampling, "RANKED", 2)
    rows = [(7, 0)] * 50 + [(i, 0) for i in range(50)] + [(i, 1) for i in range(100, 140)]
    df = spark.createDataFrame(rows, "article_id long, label int")
    got = balance(df, 1)
    keys = sorted([7] * 50 + list(range(50)), key=lambda i: place(1, "b", i))
    assert {r.article_id for r in got.where("label = 0").collect()} == set(keys[:40])
    assert got.where("label = 1").count() == 40


def test_rank_bins_cover_the_class(skewed):
    histogram = Order(42, "b", "article_id").histogram(skewed)
    assert {k: sum(n for _, n in bins) for k, bins in histogram.items()} == {0: 4500, 1: 500}


def test_keep_first(spark):
    rows = [(5, "a"), (3, "a"), (4, "b"), (9, "a"), (1, None), (2, None)]
    df = spark.createDataFrame(rows, "n long, text string")
    kept = sorted(keep_first(df, "n").collect(), key=lambda r: r.n)
    assert [tuple(r) for r in kept] == [(1, None), (3, "a"), (4, "b")]


def body_exchanges(df, columns=("text",)):
    """Exchanges of the plan whose rows hold a body."""
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        found += "Exchange" in node.nodeName() and any(c in names for c in columns)
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_bodies_stay_where_they_are(spark):
    """One cleaning, no body in an exchange, also where Spark would not broadcast."""
    rows = [(i, f"{'riječ ' * 40} broj {i // 2}", i % 3 % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "article_id long, text string, label int").repartition(3)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        for result in (keep_first(df, "article_id"), prepare(df)):
            assert body_exchanges(result) == 0
            plan = result._jdf.queryExecution().executedPlan().toString()
            assert "regexp_replace" not in plan and plan.count("FileScan") <= 2
    finally:
        spark.conf.set(key, before)


def test_hot_text(spark):
    """A third of all rows are copies of one text."""
    df = spark.range(30_000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, "isto").otherwise(F.col("id").cast("string")).alias("text"),
    )
    kept = keep_first(df, "n")
    assert kept.count() == 20_001
    assert kept.where("text = 'isto'").first().n == 0


def test_filters(spark):
    df = spark.createDataFrame(
        [(199, None, "a"), (200, 2022, "Karikature i stripovi"), (50_000, 2023, "a"), (50_001, 1, "b")],
        "text_len int, year int, category string",
    )
    lengths = [r.text_len for r in filters.within_length(df).collect()]
    assert lengths == [200, 50_000]
    assert filters.within_years(df, last=2022).count() == 2
    assert filters.within_years(df, first=2022, last=2022).count() == 1
    assert filters.without_categories(df).count() == 3
    assert filters.without_categories(df, set()).count() == 4
    assert filters.without_categories(df, {"a"}).count() == 2
    with pytest.raises(ValueError):
        filters.require_columns(df, "text")


def test_statistics(spark, skewed):
    chosen = stratified_split(balance(skewed))
    row = counters.split_statistics(chosen).first().asDict(recursive=True)
    assert (row["total"], row["train"], row["val"], row["test"]) == (1000, 800, 100, 100)
    assert row["class_distribution"]["val"] == {"0": 50, "1": 50}
    lines = {(r.split, r.label): r.n for r in counters.split_counts(chosen).collect()}
    assert lines[None, None] == 1000 and lines["train", None] == 800 and lines["test", 1] == 50


def test_prepare(spark):
    base = "riječ " * 40
    rows = [(i, f"{base} broj {i // 2 if i < 20 else i} (FENA)", int(i % 4 == 0)) for i in range(100)]
    rows += [(200, "kratko", 0), (201, None, 1), (202, base, None)]
    df = spark.createDataFrame(rows, "article_id long, text string, label int")
    result = prepare(df)
    got = result.collect()
    assert result.columns == ["article_id", "text", "label", "text_len", "split"]
    assert len({r.text for r in got}) == len(got)
    assert not any(r.article_id < 20 and r.article_id % 2 for r in got)
    assert all(r.text_len == len(r.text) and "FENA" not in r.text for r in got)
    labels = [r.label for r in got]
    assert labels.count(0) == labels.count(1) == 25
