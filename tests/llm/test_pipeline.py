"""Every stage of the pipeline on small tables: nulls, repeats, empty tables, order of columns."""

import random

import pytest

import corpus_pipeline as pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"word{k}" for k in range(400)]


def prose(rng, n=80):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with labels and a benchmark, and documents of which each stage must take some."""
    rng, folder = random.Random(8), str(tmp_path_factory.mktemp("sf"))
    item = prose(rng, 20)
    rows = [(i, prose(rng)) for i in range(120)]
    rows += [(200 + i, " ".join([*prose(rng).split(), "nastyfool", "nastyfool", "nastyfool"])) for i in range(40)]
    near = rows[3][1].split()
    near[40] = "other"
    rows += [(300, rows[3][1]), (301, " ".join(near)), (302, prose(rng, 10) + " " + item + " " + prose(rng, 10))]
    lines = "\n".join(prose(rng, 9) for _ in range(4))
    rows += [(310, lines + "\n" + prose(rng, 30)), (311, prose(rng, 30) + "\n" + lines), (312, lines)]
    rows += [(None, None), (None, prose(rng)), (320, ""), (320, None), (321, " \n"), (5, rows[5][1]), (5, rows[5][1])]
    frame = spark.createDataFrame([(i, t, None if (i or 0) % 7 == 0 else "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    frame.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(200 <= i < 240)) for i in [*range(120), *range(200, 240)]]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def stage(name):
    return dict(pipeline.STAGES)[name]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_columns_and_empty_tables(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name, run in pipeline.STAGES[:-1]:
        mixed = docs.select("n_chars", "source", "text", "doc_id", "lang")
        assert run(spark, mixed, tables).columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    for name, run in pipeline.STAGES:
        assert run(spark, docs.limit(0), tables).count() == 0, name


def test_toxicity(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = rows(stage("toxicity")(spark, docs, tables))
    assert kept == rows(docs.where("doc_id is null or doc_id not between 200 and 239"))


def test_line_dedup(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    got = {r.doc_id: r for r in stage("line_dedup")(spark, docs, tables).where("doc_id >= 310").collect()}
    first = docs.where("doc_id = 311").first()
    assert 312 not in got and got[310].text == docs.where("doc_id = 310").first().text
    assert got[311].text == first.text.split("\n")[0] and got[311].n_chars == len(got[311].text)
    kept = stage("line_dedup")(spark, docs, tables)
    assert kept.where("doc_id in (320, 321)").count() == 3 and kept.where("doc_id is null").count() == 2


def test_near_duplicates(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = stage("near_duplicates")(spark, docs, tables)
    gone = rows(docs.exceptAll(kept).select("doc_id"))
    assert gone == [(300,), (301,)]  # rows that repeat an id that stays all stay


def test_decontamination(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = stage("decontamination")(spark, docs, tables)
    assert rows(docs.exceptAll(kept).select("doc_id")) == [(302,)]


def test_packing_and_the_whole(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    pieces = stage("packing")(spark, docs, tables)
    assert pieces.where("start = 0").count() == docs.count()
    done = pipeline.run(spark, tables)
    ids = {r.doc_id for r in done.select("doc_id").distinct().collect()}
    assert not ids & {*range(200, 240), 300, 301, 302, 312} and {310, 311, 320, 321, None, *range(120)} <= ids
