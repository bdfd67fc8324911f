"""Queries for readers and writers.

Each writes files made from the given tables to the scratch folder, reads them back
with the package's readers, and must find what the SQL says the tables hold.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.blanks import strip
from ..operators import counters, summary
from ..operators.articles import corpus_rows
from ..plans import validate
from ..plans.prepare import prepare, prepare_dataset as prepare_files
from ..session import scratch_path, written
from ..sources import dumps, sinks, tables
from . import views as v
from .cleaning import STEMS, sql_choice, sql_label
from .registry import fixture, query
from .reports import FAMILY_SQL
from .selection import PREPARED, balanced_view, split_view

# What one task writes of a dump or of a table in order.
PART_BYTES = 128 * 1024 * 1024


def _in_order(rows: DataFrame, width: Column) -> tuple[DataFrame, int]:
    """``rows`` by ``article_id`` in parts of about ``PART_BYTES`` of ``width``, and the number of parts."""
    n_bytes = rows.agg(F.sum(width)).first()[0] or 0
    parts = max(1, -(-n_bytes // PART_BYTES))
    # Rows are chosen before they move, for one part too: coalesce would bring the whole scan into its task.
    ranges = rows.repartitionByRange(parts, "article_id")
    return ranges.sortWithinPartitions("article_id"), parts


def _write_dump(rows: DataFrame, folder: str, name: str) -> None:
    """One dump whose file names start with ``name``, articles in order.

    A large one goes on in further files. These start with an article without a mark in front, so all files
    together hold as many blocks as one file would.
    """
    ranges, parts = _in_order(rows, F.octet_length("article"))
    if parts > 1:
        # A null article is an empty line, which no reader gives out.
        ranges = ranges.where("article is not null").withColumn("row", F.monotonically_increasing_id())
        goes_on = (F.col("row") > 0) & (F.col("row").bitwiseAND(F.lit((1 << 33) - 1)) == 0)
        bare = F.regexp_replace("article", r"\A<\*{3}>\n", "")
        ranges = ranges.withColumn("article", F.when(goes_on, bare).otherwise(F.col("article")))
    ranges.select("article").write.option("mapreduce.output.basename", name).mode("append").text(folder)


@fixture
def bucket_dumps(spark, sf_dir, path):
    """One dump of 250 articles per bucket, in order; every second one with CRLF."""
    rows = v.dump_articles(spark, sf_dir).withColumn("bucket", F.expr("article_id div 250"))
    crlf = F.replace("article", F.lit("\n"), F.lit("\r\n"))
    (
        rows.repartition("bucket")
        .sortWithinPartitions("bucket", "article_id")
        .select("bucket", F.when(F.col("bucket") % 2 == 1, crlf).otherwise(F.col("article")))
        .write.partitionBy("bucket")
        .text(path)
    )


def _bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", F.regexp_extract("path", "bucket=([0-9]+)", 1).cast("long"))


@query(v.with_(v.DOCUMENTS, v.DUMPS, select="""
  SELECT bucket, CAST(length(value) AS INTEGER) AS n_chars, md5(value) AS value_md5 FROM (
    SELECT bucket, string_agg(article, chr(10) ORDER BY article_id) || chr(10) AS value
    FROM dumps GROUP BY bucket)"""))
def dump_scan(spark, sf_dir):
    scan = _bucket(dumps.scan_dumps(spark, bucket_dumps(spark, sf_dir)))
    return scan.select("bucket", F.length("value").alias("n_chars"), F.md5("value").alias("value_md5"))


_BLOCKS = v.with_(v.DOCUMENTS, v.DUMPS, select=f"""
  SELECT bucket, CAST(row_number() OVER (PARTITION BY bucket ORDER BY article_id) AS INTEGER) AS pos,
    md5({v.sql_strip("substr(article, 6)")}) AS block_md5
  FROM dumps
  UNION ALL SELECT DISTINCT bucket, 0, md5('') FROM dumps""")


def _blocks(spark, sf_dir) -> DataFrame:
    blocks = _bucket(dumps.read_blocks(spark, bucket_dumps(spark, sf_dir), positions=True))
    return blocks.select("bucket", "pos", F.md5(strip(F.col("block"))).alias("block_md5"))


@query(_BLOCKS)
def dump_split(spark, sf_dir):
    return _blocks(spark, sf_dir)


@contextmanager
def many_splits(spark, folder: str):
    """Files are cut into splits of 64 kB, of which a task reads many.

    The number of tasks is bounded, not that of splits: as many tasks as the files of ``folder`` have parts of
    ``PART_BYTES``, but at least four for each core.
    """
    size, most = "spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum"
    before = {key: spark.conf.get(key, None) for key in (size, most)}
    n_bytes = dumps.list_files(spark, folder).agg(F.sum("n_bytes")).first()[0] or 0
    try:
        spark.conf.set(size, "64k")
        spark.conf.set(most, max(4 * spark.sparkContext.defaultParallelism, n_bytes // PART_BYTES))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@query(_BLOCKS)
def dump_split_large_files(spark, sf_dir):
    """The same with files cut into many splits."""
    with many_splits(spark, bucket_dumps(spark, sf_dir)):
        return written(_blocks(spark, sf_dir), "blocks")


@query(v.with_(v.DOCUMENTS, v.ARTICLES, select="""
  SELECT source_name, date, link, section, supertitle, title, subtitle, author, text, source, year,
    1 AS label FROM articles"""))
def dump_parse(spark, sf_dir):
    articles = dumps.read_articles(spark, bucket_dumps(spark, sf_dir))
    header = ("source_name", "section", "supertitle", "subtitle", "author")
    kept = articles.select("*", *(F.col(c).alias(f"_{c}") for c in header))
    rows = corpus_rows(kept, label=1).drop("path", *dumps.PLACE)
    return rows.withColumnsRenamed({f"_{c}": c for c in header})


@fixture
def category_dumps(spark, sf_dir, path):
    """One folder per category, under its own name."""
    rows = v.dump_articles(spark, sf_dir).select("category", "article")
    for category in sorted(r.category for r in rows.select("category").distinct().collect()):
        rows.where(F.col("category") == category).select("article").write.text(f"{path}/{category}")


@query(v.with_(v.DOCUMENTS, v.ARTICLES, select="""
  SELECT category, text, 0 AS label,
    CASE source WHEN 'unknown' THEN 'arhiva' ELSE source END AS source, year, title, date, link
  FROM articles WHERE category <> 'Karikature i stripovi'"""))
def category_scan(spark, sf_dir):
    """All categories but the one that is left out by default."""
    folder = category_dumps(spark, sf_dir)
    rows = dumps.load_categories(spark, folder, label=0, default_source="arhiva")
    return rows.drop("path", *dumps.PLACE)


@query(v.with_(v.DOCUMENTS, v.ARTICLES, v.scored_view("articles"), select=FAMILY_SQL
    .replace("FROM scored", "FROM scored WHERE category <> 'Karikature i stripovi'")))
def category_analysis(spark, sf_dir):
    """Scan, parse and score a folder of categories, then all reports."""
    folder = category_dumps(spark, sf_dir)
    return summary.summarize_family(validate.score_categories(spark, folder, v.stand_in_expression()))


# --- CSV ---------------------------------------------------------------------------------


def _write_csv(df: DataFrame, path: str, name: str, most_rows: int = 0) -> None:
    """CSV files whose names start with ``name``, of at most ``most_rows`` rows if that is not 0."""
    df.write.options(**tables.CSV_FORMAT, maxRecordsPerFile=most_rows).option(
        "mapreduce.output.basename", name
    ).mode("append").csv(path)


def _write_csv_parts(df: DataFrame, path: str, name: str) -> None:
    """The same in files that one task can read each, however wide the scan behind ``df``."""
    _write_csv(df, path, name, sinks.rows_per_file(df))


_QUOTED = r"""'  "citat", ' || text || ' \ kraj "'"""


@query(v.with_(v.CORPUS, select=f"""
  SELECT CAST(article_id AS VARCHAR) AS article_id, {_QUOTED} AS text, label, source, year,
    CASE WHEN article_id % 5 <> 0 THEN source || ', ' || category END AS title FROM corpus"""))
def csv_roundtrip(spark, sf_dir):
    """Quotes, commas, line ends, backslashes and outer blanks survive; NA words do not."""
    path = scratch_path(spark, "csv")
    rows = v.corpus(spark, sf_dir)
    title = F.when(F.col("article_id") % 5 == 0, "NA").otherwise(
        F.concat_ws(", ", "source", "category")
    )
    text = F.concat(F.lit('  "citat", '), "text", F.lit(' \\ kraj "'))
    sinks.write_corpus(
        rows.select("article_id", text.alias("text"), "label", "source", "year", title.alias("title")),
        path,
        "csv",
    )
    return tables.read_csv(spark, path).drop("path", "pos")


# Every document is in one file: those with a number 3 mod 4 in a dump, others in a table.
@fixture
def mixed_files(spark, sf_dir, path):
    """CSV files of three headers and dumps that name their class, or none, in one folder."""
    rows, a = v.corpus(spark, sf_dir), F.col("article_id")
    full = rows.where(a % 2 == 0).select("text", "label", "source", "year")
    _write_csv_parts(full, f"{path}/tables", "clanci")
    _write_csv_parts(rows.where(a % 4 == 1).select("label", "text"), f"{path}/tables", "dodatak")
    others = v.documents(spark, sf_dir).where(a % 4 != 3).join(rows.select("article_id"), "article_id", "left_anti")
    _write_csv_parts(others.select("source", "text"), f"{path}/tables", "ostalo")
    articles = v.dump_articles(spark, sf_dir)
    for name, chosen in (
        ("avaz_ai", a % 8 == 3),
        ("avaz_human", a % 16 == 7),
        ("avaz", a % 16 == 15),
    ):
        _write_dump(articles.where(chosen), f"{path}/dumps/{name.replace('_', '-')}", name)


_OTHERS = "others AS (SELECT * FROM docs WHERE article_id % 4 <> 3 AND article_id NOT IN (SELECT article_id FROM corpus))"


@query(v.with_(v.DOCUMENTS, v.CORPUS, v.ARTICLES, _OTHERS, select="""
  SELECT text, label, source, year, NULL AS title, NULL AS date, NULL AS link
  FROM corpus WHERE article_id % 2 = 0
  UNION ALL SELECT text, label, NULL, NULL, NULL, NULL, NULL FROM corpus WHERE article_id % 4 = 1
  UNION ALL SELECT text, NULL, source, NULL, NULL, NULL, NULL FROM others
  UNION ALL
  SELECT text, CASE WHEN article_id % 8 = 3 THEN 1 ELSE 0 END, source, year, title, date, link
  FROM articles WHERE article_id % 4 = 3 AND article_id % 16 <> 15"""))
def mixed_corpus_scan(spark, sf_dir):
    return tables.read_mixed(spark, mixed_files(spark, sf_dir)).drop("kind", "path", "pos")


@query(v.with_(v.DOCUMENTS, v.CORPUS, _OTHERS, select="""
  SELECT 'csv' AS kind, 'clanci' AS file, NULL::BIGINT AS n_blocks, NULL::BIGINT AS n_articles, count(*) AS n_rows
  FROM corpus WHERE article_id % 2 = 0
  UNION ALL SELECT 'csv', 'dodatak', NULL, NULL, count(*) FROM corpus WHERE article_id % 4 = 1
  UNION ALL SELECT 'csv', 'ostalo', NULL, NULL, count(*) FROM others
  UNION ALL SELECT 'dump', 'avaz_ai', count(*) + 1, count(*), NULL FROM docs WHERE article_id % 8 = 3
  UNION ALL SELECT 'dump', 'avaz_human', count(*) + 1, count(*), NULL FROM docs WHERE article_id % 16 = 7"""))
def file_counts(spark, sf_dir):
    """Blocks and articles of every dump, rows of every table; a table is in several files here."""
    counts = tables.file_counts(spark, mixed_files(spark, sf_dir))
    name = F.regexp_extract("path", r"([a-z_]+)-[^/]*\z", 1)
    return counts.groupBy("kind", name.alias("file")).agg(
        *(F.sum(c).alias(c) for c in ("n_blocks", "n_articles", "n_rows"))
    )


@fixture
def named_dumps(spark, sf_dir, path):
    """One dump for each way in which a file name tells a class, or does not."""
    articles = v.dump_articles(spark, sf_dir)
    for i, (stem, _) in enumerate(STEMS):
        _write_dump(articles.where(F.col("article_id") % len(STEMS) == i), path, f"novine_{stem}")


@query(f"""
  SELECT {sql_choice([s for s, _ in STEMS], f'doc_id % {len(STEMS)}')} AS stem, count(*) AS n_articles
  FROM documents WHERE {sql_label(f'doc_id % {len(STEMS)}')} IS NULL GROUP BY 1""")
def unlabelled_files(spark, sf_dir):
    """Dumps left out because their name tells no class, with what they hold."""
    folder = named_dumps(spark, sf_dir)
    rejected = tables.unlabelled_dumps(spark, folder)
    held = dumps.count_blocks(dumps.read_blocks(spark, folder))
    stem = F.regexp_extract("path", r"novine_([^/]*)-[0-9]{5}-[^/]*\z", 1)
    return rejected.join(held, "path").groupBy(stem.alias("stem")).agg(F.sum("n_articles").alias("n_articles"))


# --- the whole job on files ------------------------------------------------------------------


@fixture
def job_files(spark, sf_dir, path):
    """The labelled corpus: even numbers in a table, odd ones in a dump for each class."""
    rows, a = v.corpus(spark, sf_dir), F.col("article_id")
    table, _ = _in_order(rows.where(a % 2 == 0), F.octet_length("text"))
    _write_csv_parts(table.select("text", "label", "source", "year"), path, "clanci")
    articles = v.dump_articles(spark, sf_dir).where(a % 2 == 1).join(rows.select("article_id", "label"), "article_id")
    for name, label in (("avaz_ai", 1), ("avaz_human", 0)):
        _write_dump(articles.where(F.col("label") == label), path, name)


_JOB = (v.DOCUMENTS, v.CORPUS, v.ARTICLES, f"""loaded AS (
  SELECT 0 AS place, article_id, text, label FROM corpus WHERE article_id % 2 = 0
  UNION ALL
  SELECT 2 - c.label, a.article_id, a.text, c.label
  FROM articles a JOIN corpus c ON c.article_id = a.article_id WHERE a.article_id % 2 = 1),
measured AS (SELECT place, article_id AS number, label, {v.sql_clean("text")} AS text FROM loaded),
unique_rows AS (
  SELECT upper(sha256(text)) AS article_id, label, text FROM measured WHERE length(text) BETWEEN 200 AND 50000
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY place, number) = 1)""",
        balanced_view("unique_rows"), split_view("balanced"))


@query(v.with_(*_JOB, select="SELECT md5(text) AS text_md5, label, split FROM splits"))
def prepare_dataset_job(spark, sf_dir):
    """From files to stored splits, read back; rows are drawn by the hash of their text."""
    target = scratch_path(spark, "prepared")
    prepare_files(spark, job_files(spark, sf_dir), target)
    rows = tables.read_splits(spark, f"{target}/splits")
    return rows.select(F.md5("text").alias("text_md5"), "label", "split")


# --- stored predictions -------------------------------------------------------------------------


@fixture
def batch_files(spark, sf_dir, path):
    """Two batches: even documents in tables, odd ones in a dump."""
    docs, a = v.documents(spark, sf_dir), F.col("article_id")
    _write_csv_parts(docs.where(a % 2 == 0).select("article_id", "text"), f"{path}/tablice", "clanci")
    _write_dump(v.dump_articles(spark, sf_dir).where(a % 2 == 1), f"{path}/izvod.txt", "izvod")


def _stored_batches(spark, sf_dir) -> str:
    """Both batches stored, one of them twice, as after a failure."""
    folder, target = batch_files(spark, sf_dir), scratch_path(spark, "predictions")
    for name in ("tablice", "izvod.txt", "tablice"):
        validate.store_batch(spark, f"{folder}/{name}", v.stand_in_expression(), target, name.split(".")[0])
    return target


_BATCHES = """batches AS (
  SELECT 'tablice' AS batch, article_id, text FROM docs WHERE article_id % 2 = 0
  UNION ALL SELECT 'izvod', article_id, text FROM articles WHERE article_id % 2 = 1)"""


@query(v.with_(v.DOCUMENTS, v.ARTICLES, _BATCHES, v.scored_view("batches"), select="""
  SELECT batch, CASE batch WHEN 'tablice' THEN CAST(article_id AS VARCHAR)
      ELSE 'https://arhiva.example/' || article_id END AS article, md5(text) AS text_md5, pred_label, pred_label_name,
    round(prob_human, 6) AS prob_human, round(prob_ai, 6) AS prob_ai, round(confidence, 6) AS confidence
  FROM scored"""))
def stored_predictions(spark, sf_dir):
    """Predictions of two batches, stored in one table; a batch that runs again replaces itself."""
    stored = spark.read.option("mergeSchema", "true").parquet(f"{_stored_batches(spark, sf_dir)}/predictions")
    return stored.select(
        "batch", F.coalesce("article_id", "link").alias("article"), F.md5("text").alias("text_md5"),
        "pred_label", "pred_label_name", *(F.round(c, 6).alias(c) for c in ("prob_human", "prob_ai", "confidence")),
    )


@query(v.with_(v.DOCUMENTS, v.ARTICLES, _BATCHES, v.scored_view("batches"), select=f"""
  SELECT batch, count(*) AS n_articles, count(*) FILTER (WHERE pred_label = 1) AS n_ai,
    {v.sql_round1("100e0 * count(*) FILTER (WHERE pred_label = 1) / count(*)")} AS ai_pct,
    {v.sql_round1("100e0 * avg(confidence)")} AS mean_conf_pct
  FROM scored GROUP BY batch"""))
def stored_totals(spark, sf_dir):
    """The totals of each batch, as the pass that stored it counted them."""
    return spark.read.parquet(f"{_stored_batches(spark, sf_dir)}/totals")


# --- CSV by year ------------------------------------------------------------------------------


@fixture
def yearly_csv(spark, sf_dir, path):
    """One set of files per year, 2015 to 2024; every second one has no year column."""
    docs = v.documents(spark, sf_dir).withColumnRenamed("article_id", "doc")
    for i in range(10):
        rows = docs.where(F.col("doc") % 10 == i)
        columns = ("doc", "text", "source", "year") if i % 2 else ("text", "doc", "source")
        _write_csv(rows.select(*columns), path, f"{2015 + i}_articles")


_YEARLY = """yearly AS (
  SELECT article_id, text, source,
    CASE WHEN article_id % 2 = 1 THEN year ELSE CAST(2015 + article_id % 10 AS INTEGER) END AS year
  FROM docs)"""


@query(v.with_(v.DOCUMENTS, _YEARLY, select="""
  SELECT CAST(article_id AS VARCHAR) AS doc, text, source, year FROM yearly"""))
def yearly_csv_scan(spark, sf_dir):
    """A null year stays null where the file has the column."""
    folder = yearly_csv(spark, sf_dir)
    rows = tables.read_csv(spark, f"{folder}/*.csv", year_from_name=True)
    return rows.select("doc", "text", "source", "year")


@query(v.with_(v.DOCUMENTS, _YEARLY, v.scored_view("yearly"), select=f"""
  SELECT CASE grouping_id(year, source) WHEN 0 THEN 'summary_by_year_source'
      ELSE 'summary_by_year' END AS report, year, source, {v.SQL_PERCENTAGES}
  FROM scored GROUP BY GROUPING SETS ((year, source), (year))"""))
def yearly_analysis(spark, sf_dir):
    """Scan and score a folder of yearly files, then the reports its columns allow."""
    scored = validate.score_years(spark, yearly_csv(spark, sf_dir), v.stand_in_expression())
    return summary.summarize_family(scored)


# --- stored splits ---------------------------------------------------------------------------


@query(v.with_(*PREPARED, select="SELECT md5(text) AS text_md5, label, split FROM splits"))
def read_splits(spark, sf_dir):
    path = scratch_path(spark, "splits")
    sinks.write_splits(prepare(v.corpus(spark, sf_dir)), path)
    rows = tables.read_splits(spark, path)
    return rows.select(F.md5("text").alias("text_md5"), "label", "split")


@query(v.with_(*PREPARED, select="""
  SELECT 'total' AS split, NULL AS label, count(*) AS n FROM splits
  UNION ALL SELECT split, NULL, count(*) FROM splits GROUP BY split
  UNION ALL SELECT split, CAST(label AS VARCHAR), count(*) FROM splits GROUP BY split, label"""))
def split_stats_json(spark, sf_dir):
    """The statistics as nested JSON, read back and laid out flat."""
    path = scratch_path(spark, "statistics")
    statistics = counters.split_statistics(prepare(v.corpus(spark, sf_dir)))
    sinks.write_small(statistics, path)
    stored = spark.read.schema(statistics.schema).json(path)
    sizes = stored.select("total", "train", "val", "test").unpivot(
        [], ["total", "train", "val", "test"], "split", "n"
    )
    classes = stored.select(F.explode("class_distribution").alias("split", "classes"))
    classes = classes.select("split", F.explode("classes").alias("label", "n"))
    return sizes.withColumn("label", F.lit(None).cast("string")).unionByName(classes)
