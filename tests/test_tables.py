"""CSV readers, mixed folders, writers and the jobs on files."""

import csv
import json
import os
import glob

import pytest
from pyspark.sql import functions as F

from pressmill.catalog import views
from pressmill.operators.scoring import score_table
from pressmill.plans.prepare import prepare_dataset
from pressmill.plans.validate import score_batch, score_categories, score_years, store_batch
from pressmill.sources import sinks, tables
from pressmill.streaming.incremental import score_new_dumps
from tests.test_dumps import put

SCORER = views.stand_in_expression()


def put_csv(folder, name, header, *rows):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([header, *rows])
    return path


def test_csv_cells(spark, folder):
    cells = ['a "b" c', "l1\nl2\n\nl3", "\\", "  x ", "čćž", "a,b", "\\\"", "'q'"]
    put_csv(folder, "a.csv", ["text", "label", "year"], *([c, "1", "2005.0"] for c in cells))
    got = tables.read_csv(spark, folder).orderBy("pos").collect()
    assert [r.text for r in got] == cells
    assert {(r.label, r.year) for r in got} == {(1, 2005)}


def test_csv_null_words(spark, folder):
    put_csv(folder, "a.csv", ["text", "label"], ["NA", "0"], ["null", ""], ["", "1"], ["N/a", "x"])
    got = [tuple(r) for r in tables.read_csv(spark, folder).select("text", "label").collect()]
    assert got == [(None, 0), (None, None), (None, 1), ("N/a", None)]


def test_short_csv_rows_are_filled_and_long_ones_raise(spark, folder):
    put_csv(folder, "a.csv", ["text", "label", "source"], ["abc", "1"], ["d", "0", "x"], ["e"], ["f", "0.7", "y"])
    got = tables.read_csv(spark, f"{folder}/a.csv").select("text", "label", "source").collect()
    assert sorted(map(tuple, got)) == [("abc", 1, None), ("d", 0, "x"), ("e", None, None), ("f", None, "y")]
    put_csv(folder, "b.csv", ["text", "label", "source"], ["abc", "1", "x", "more"])
    with pytest.raises(Exception, match="more cells than columns"):
        tables.read_csv(spark, f"{folder}/b.csv").count()


def test_csv_files_are_joined_by_name(spark, folder):
    put_csv(folder, "a.csv", ["text", "label"], ["x", "0"])
    put_csv(folder, "b.csv", ["label", "text", "extra col"], ["1", "y", "z"])
    put_csv(folder, "sub/c.csv", ["text", "label"], ["deep", "1"])
    put_csv(folder, "d [1].csv", ["text", "label"], ["brackets", "1"])
    rows = tables.read_csv(spark, folder).select("text", "label", "extra col").collect()
    assert sorted(map(tuple, rows)) == [("brackets", 1, None), ("x", 0, None), ("y", 1, "z")]
    assert tables.read_csv(spark, folder, recursive=True).count() == 4


def test_headers_come_from_the_first_line_only(spark, folder):
    rows = [[f"text {i}", "1"] for i in range(20_000)]
    put_csv(folder, "big.csv", ["text", "label"], *rows)
    put_csv(folder, "same.csv", ["text", "label"], ["x", "0"])
    put_csv(folder, "c,d.csv", ["a, b", 'say "x"', "", "label"], ["x", "0", "", "1"])
    put(folder, "empty.csv", b"")
    headers = {os.path.basename(r.path): r.header for r in tables.csv_headers(spark, folder).collect()}
    assert headers == {"big.csv": ["text", "label"], "same.csv": ["text", "label"],
                       "c,d.csv": ["a, b", 'say "x"', "_c2", "label"]}


def test_csv_rows_meet_their_header_without_broadcast_too(spark, folder, monkeypatch):
    small = tables.broadcast_if_small
    monkeypatch.setattr(tables, "broadcast_if_small", lambda table: small(table, 0))
    for i in range(12):
        put_csv(folder, f"{i}.csv", ["text", "label"][:: 1 if i % 2 else -1], [f"t{i}", "7"][:: 1 if i % 2 else -1])
    got = tables.read_csv(spark, folder)
    assert sorted((r.text, r.label) for r in got.collect()) == sorted((f"t{i}", 7) for i in range(12))


def test_csv_files_are_sized_by_bytes(spark, folder, monkeypatch):
    monkeypatch.setattr(sinks.rows_per_file, "__defaults__", (20_000,))
    rows = [(i, "kratko" if i < 500 else "dugo, " * 200) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, text string").repartitionByRange(2, "id")
    sinks.write_corpus(df, f"{folder}/out", "csv")
    sizes = [os.path.getsize(f) for f in glob.glob(f"{folder}/out/*.csv")]
    assert len(sizes) > 5 and max(sizes) < 25_000
    assert tables.read_csv(spark, f"{folder}/out").count() == 600


@pytest.mark.parametrize("widths, rows", [
    ([9] * 5000, 1024), ([9] * 100 + [15_000] + [9] * 3000, 128), ([5_000] * 50, 3), ([50_000] * 3, 1), ([9], 1 << 20)])
def test_rows_of_a_csv_file(spark, widths, rows):
    df = spark.createDataFrame([("x" * w,) for w in widths], "text string").coalesce(1)
    assert sinks.rows_per_file(df, 20_000) == rows


def test_year_from_file_name(spark, folder):
    put_csv(folder, "2023_articles.csv", ["text"], ["a"], ["b"])
    put_csv(folder, "2024_articles.csv", ["text", "year"], ["c", "2020"], ["d", ""])
    put_csv(folder, "other.csv", ["text"], ["e"])
    got = tables.read_csv(spark, f"{folder}/*.csv", year_from_name=True)
    assert {r.text: r.year for r in got.collect()} == {
        "a": 2023, "b": 2023, "c": 2020, "d": None, "e": None}


def mixed_folder(folder):
    put_csv(folder, "z.csv", ["text", "label", "source"], ["isti tekst", "0", "csv"])
    put(folder, "x/avaz_ai.txt", "<***>\nNOVINA: Avaz\n\nisti tekst\n<***>\nDATUM: 2020\n\ndrugi")
    put(folder, "y/human.txt", "bez zaglavlja")
    put(folder, "avaz.txt", "<***>\n\npreskočeno")
    return folder


def test_mixed_folder(spark, folder):
    got = tables.read_mixed(spark, mixed_folder(folder)).orderBy("kind", "path", "pos").collect()
    assert [(r.text, r.label, r.source, r.year) for r in got] == [
        ("isti tekst", 0, "csv", None), ("isti tekst", 1, "avaz", None),
        ("drugi", 1, "unknown", 2020), ("bez zaglavlja", 0, "unknown", None)]
    rejected = [os.path.basename(r.path) for r in tables.unlabelled_dumps(spark, folder).collect()]
    assert rejected == ["avaz.txt"]
    forced = tables.read_mixed(spark, folder, txt_label=0).where("kind = 1").collect()
    assert len(forced) == 4 and {r.label for r in forced} == {0}


def test_mixed_folder_without_input(spark, folder):
    with pytest.raises(FileNotFoundError):
        tables.read_mixed(spark, folder)
    put(folder, "avaz.txt", "nothing is known of this file")
    with pytest.raises(FileNotFoundError):
        tables.read_mixed(spark, folder)
    put_csv(folder, "a.csv", ["text"], ["no label"])
    with pytest.raises(ValueError):
        tables.read_mixed(spark, folder)


def article(i, label):
    word = "ljudski" if label == 0 else "strojni,"
    return f"{word} tekst broj {i} " + "riječ " * (40 + i % 7)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_prepare_dataset(spark, folder, fmt):
    source, target = f"{folder}/in", f"{folder}/out"
    put_csv(source, "h.csv", ["text", "label", "year"], *([article(i, 0), 0, 2005] for i in range(40)))
    dump = "".join(f"<***>\nNOVINA: A\nDATUM: 2024\n\n{article(i, 1)}\n" for i in range(30))
    put(source, "d_ai.txt", dump + "<***>\n\nkratko\n<***>\n\n" + article(3, 0))
    stats = prepare_dataset(spark, source, target, fmt=fmt)
    assert stats["stages"] == {"loaded": 72, "length": 71, "unique": 70, "balanced": 60}
    assert (stats["train"], stats["val"], stats["test"]) == (48, 6, 6)
    assert stats["class_distribution"]["train"] == {"0": 24, "1": 24}
    with open(glob.glob(f"{target}/statistics/*.json")[0], encoding="utf-8") as f:
        stored = json.load(f)
    assert stored["total"] == 60 and stored["class_distribution"]["test"] == {"0": 3, "1": 3}
    splits = tables.read_splits(spark, f"{target}/splits", fmt).collect()
    assert len(splits) == 60 and len({r.text for r in splits}) == 60
    # The copy loaded first kept its class: the CSV row, not the dump's.
    assert all(r.label == (0 if r.text.startswith("ljudski") else 1) for r in splits)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "512")
    try:
        again = prepare_dataset(spark, source, f"{folder}/again", fmt=fmt)
    finally:
        spark.conf.set(key, before)
    other = tables.read_splits(spark, f"{folder}/again/splits", fmt).collect()
    assert again == stats and sorted(other) == sorted(splits)


def test_missing_splits(spark, folder):
    put_csv(folder, "train.csv", ["text", "label"], ["a", "1"], ["", "0"], ["b", ""])
    with pytest.raises(FileNotFoundError, match="val"):
        tables.read_splits(spark, folder, "csv")
    put_csv(folder, "val.csv", ["text", "label"], ["c", "0.0"])
    put_csv(folder, "test.csv", ["label", "text"], ["1", "d"])
    got = {tuple(r) for r in tables.read_splits(spark, folder, "csv").collect()}
    assert got == {("a", 1, "train"), ("c", 0, "val"), ("d", 1, "test")}


def test_score_years_writes_all_reports(spark, folder):
    put_csv(folder, "2023_a.csv", ["text", "source"], ["a,b", "s"], ["abc", "s"], ["", "t"])
    put_csv(folder, "2024_a.csv", ["text", "source", "label"], ["x,", "s", "0"])
    stored = score_years(spark, folder, SCORER, f"{folder}/out")
    assert {(r.text, r.pred_label, r.label) for r in stored.collect()} == {
        ("a,b", 1, None), ("abc", 0, None), (None, 0, None), ("x,", 1, 0)}
    report = spark.read.csv(f"{folder}/out/summary_by_year", header=True, inferSchema=True)
    assert [tuple(r)[:4] for r in report.collect()] == [(2023, 3, 66.7, 33.3), (2024, 1, 0.0, 100.0)]
    by_source = spark.read.csv(f"{folder}/out/summary_by_year_source", header=True)
    assert by_source.count() == 3
    # Without categories that report is the one by year.
    assert spark.read.csv(f"{folder}/out/summary_by_year_category", header=True).count() == 2


def test_score_categories_and_batches(spark, folder):
    path = put(folder, "Društvo/a.txt", "<***>\nDATUM: 2024\n\na,b\n<***>\n\nabc")
    put(folder, "Karikature i stripovi/a.txt", "<***>\n\nx")
    got = score_categories(spark, folder, SCORER).orderBy("text").collect()
    assert [(r.text, r.category, r.year, r.pred_label) for r in got] == [
        ("a,b", "Društvo", 2024, 1), ("abc", "Društvo", None, 0)]
    assert "label" not in got[0].asDict()
    assert score_batch(spark, path, SCORER).count() == 2
    table = put_csv(folder, "b.csv", ["tijelo"], ["a,b"])
    assert score_batch(spark, table, SCORER, text="tijelo").first().pred_label == 1


def test_batches_replace_themselves(spark, folder):
    put_csv(folder, "a.csv", ["text", "id"], ["a,b", "1"], ["abc", "2"], ["", "3"])
    put(folder, "b.txt", "<***>\nDATUM: 2024\n\nx,y\n<***>\n\nxyz")
    put_csv(folder, "none.csv", ["text", "id"])
    out = f"{folder}/out"
    first = store_batch(spark, f"{folder}/a.csv", SCORER, out, "a")
    assert (first["n_articles"], first["n_ai"], first["ai_pct"]) == (3, 1, 33.3)
    assert store_batch(spark, f"{folder}/b.txt", SCORER, out, "b")["n_articles"] == 2
    put_csv(folder, "a.csv", ["text", "id"], ["abc", "9"])
    assert store_batch(spark, f"{folder}/a.csv", SCORER, out, "a")["n_ai"] == 0
    stored = spark.read.option("mergeSchema", "true").parquet(f"{out}/predictions")
    assert sorted((r.batch, r.text, r.pred_label) for r in stored.collect()) == [("a", "abc", 0), ("b", "x,y", 1), ("b", "xyz", 0)]
    totals = {r.batch: r.n_articles for r in spark.read.parquet(f"{out}/totals").collect()}
    assert totals == {"a": 1, "b": 2}
    assert store_batch(spark, f"{folder}/none.csv", SCORER, out, "none") == {
        "n_articles": 0, "n_ai": 0, "ai_pct": None, "mean_conf_pct": None}
    put_csv(folder, "c.csv", ["text", "batch"], ["a", "b"])
    with pytest.raises(ValueError, match="batch"):
        store_batch(spark, f"{folder}/c.csv", SCORER, out, "c")


def test_file_counts(spark, folder):
    put_csv(folder, "t/z.csv", ["text", "label"], ["x\ny", "0"], ["", ""])
    put_csv(folder, "t/only.csv", ["text", "label"])
    put(folder, "x_ai.txt", "<***>\nNOVINA: Avaz\n\nisti\n<***>\nDATUM: 2020\n\ndrugi <***> x\n<***> y\n<***>")
    put(folder, "y_human.txt", "\n")
    put(folder, "prazno_human.txt", b"")
    put(folder, "avaz.txt", "nepoznato")
    got = {os.path.basename(r.path): (r.kind, r.n_blocks, r.n_articles, r.n_rows) for r in tables.file_counts(spark, folder).collect()}
    assert got == {"z.csv": ("csv", None, None, 2), "only.csv": ("csv", None, None, 0),
                   "x_ai.txt": ("dump", 4, 2, None), "y_human.txt": ("dump", 1, 0, None)}
    assert tables.file_counts(spark, folder, txt_label=0).where("kind = 'dump'").count() == 3


def test_corpus_by_category(spark, folder):
    df = spark.createDataFrame([("a", "x y"), ("b", "z")], "text string, category string")
    sinks.write_corpus(df, f"{folder}/out", partition_by=["category"])
    back = spark.read.parquet(f"{folder}/out").where(F.col("category") == "x y")
    assert [tuple(r) for r in back.collect()] == [("a", "x y")]


def test_new_dumps_are_scored_once(spark, folder):
    def run():
        query = score_new_dumps(spark, f"{folder}/in", SCORER, f"{folder}/out", f"{folder}/cp")
        query.awaitTermination()
        return sorted(r.text for r in spark.read.parquet(f"{folder}/out").collect())

    put(folder, "in/a.txt", "<***>\nNOVINA: A\n\na,b\n<***>\n\nabc")
    assert run() == ["a,b", "abc"]
    put(folder, "in/b.txt", "<***>\n\nnovo")
    assert run() == ["a,b", "abc", "novo"]
    batch = score_table(spark.createDataFrame([("a,b",)], "text string"), SCORER).first()
    stored = spark.read.parquet(f"{folder}/out").where("text = 'a,b'").first()
    assert (stored.pred_label, stored.confidence) == (batch.pred_label, batch.confidence)
