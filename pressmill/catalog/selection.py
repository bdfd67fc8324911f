"""Queries for filters, de-duplication, sampling, splits and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.metadata import ai_era
from ..operators import counters, filters
from ..operators.cleaning import with_clean_text
from ..operators.dedup import keep_first
from ..operators.sampling import balance, shuffle_rank, stratified_split
from ..plans.prepare import cleaned, prepare, prepared
from . import views as v
from .registry import query

# --- the preparation job in SQL --------------------------------------------------------

MEASURED = f"""measured AS (
  SELECT article_id, label, source, year, category, clean AS text,
    CAST(length(clean) AS INTEGER) AS text_len
  FROM (SELECT *, {v.sql_clean('text')} AS clean FROM corpus))"""
UNIQUE = """kept AS (SELECT * FROM measured WHERE text_len BETWEEN 200 AND 50000),
unique_rows AS (
  SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY text ORDER BY article_id) = 1)"""


def balanced_view(base: str, name: str = "balanced", seed: int = 42) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY label ORDER BY md5('{seed}:b:' || article_id), article_id) AS nth FROM {base})
  WHERE nth <= (SELECT min(n) FROM (SELECT count(*) AS n FROM {base} GROUP BY label)))"""


def split_view(base: str, name: str = "splits", seed: int = 42) -> str:
    """Sizes in whole numbers: a fifth is held out, half of it (rounded up) is test."""
    return f"""{name}_n AS (
  SELECT label, count(*) AS n, sum(count(*)) OVER () AS n_all FROM {base} GROUP BY label),
{name}_take AS (
  SELECT *, n_all - (n_all + 4) // 5 AS train, (n_all + 4) // 5 - ((n_all + 4) // 5 + 1) // 2 AS val
  FROM {name}_n),
{name}_train AS (
  SELECT *, train * n // n_all + CAST(row_number() OVER (ORDER BY train * n % n_all DESC, label)
      <= train - sum(train * n // n_all) OVER () AS INTEGER) AS n_train
  FROM {name}_take),
{name}_left AS (SELECT *, n - n_train AS m, sum(n - n_train) OVER () AS m_all FROM {name}_train),
{name}_val AS (
  SELECT *, val * m // m_all + CAST(row_number() OVER (ORDER BY val * m % m_all DESC, label)
      <= val - sum(val * m // m_all) OVER () AS INTEGER) AS n_val
  FROM {name}_left),
{name} AS (
  SELECT r.* EXCLUDE (nth), CASE WHEN nth <= n_train THEN 'train'
      WHEN nth <= n_train + n_val THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (
      PARTITION BY label ORDER BY md5('{seed}:s:' || article_id), article_id) AS nth FROM {base}) r
  JOIN {name}_val s ON s.label = r.label)"""


PREPARED = (v.CORPUS, MEASURED, UNIQUE, balanced_view("unique_rows"), split_view("balanced"))


@query(v.with_(*PREPARED, select="""
  SELECT article_id, label, source, year, category, text, text_len, split FROM splits"""))
def prepare_dataset(spark, sf_dir):
    """The flagship: clean, filter, de-duplicate, balance and split the labelled corpus."""
    return prepare(v.corpus(spark, sf_dir))


# --- filters -----------------------------------------------------------------------------


@query(v.with_(v.CORPUS, MEASURED, select="""
  SELECT article_id, label, text_len, md5(text) AS text_md5 FROM measured
  WHERE text_len >= 200 AND text_len <= 50000"""))
def length_filter(spark, sf_dir):
    kept = filters.within_length(cleaned(v.corpus(spark, sf_dir)))
    return kept.select("article_id", "label", "text_len", F.md5("text").alias("text_md5"))


@query(v.with_(v.DOCUMENTS, select="""
  SELECT article_id, category, source FROM docs WHERE category NOT IN ('fr', 'de')"""))
def category_exclude(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("article_id"), F.col("lang").alias("category"), "source"
    )
    return filters.without_categories(docs, {"fr", "de"})


@query(v.with_(v.CORPUS, select="""
  SELECT article_id, year, label FROM corpus WHERE year IS NOT NULL AND year <= 2022 AND year >= 2017"""))
def year_range(spark, sf_dir):
    rows = v.corpus_keys(spark, sf_dir).select("article_id", "year", "label")
    return filters.within_years(rows, first=2017, last=2022)


@query(v.with_(v.CORPUS, select="""
  SELECT source, count(*) FILTER (WHERE label = 0 AND year >= 2023) AS n_ai_era,
    count(*) FILTER (WHERE label = 0) AS n_human
  FROM corpus GROUP BY source"""))
def ai_era_contamination(spark, sf_dir):
    return counters.contamination(v.corpus_keys(spark, sf_dir), "source")


# --- set operations ------------------------------------------------------------------------


@query(v.with_(v.DOCUMENTS, v.CORPUS, select="""
  SELECT article_id, source, year, category, label FROM corpus
  UNION ALL SELECT article_id, source, NULL, NULL, 1 FROM docs WHERE category = 'en'
  UNION ALL SELECT article_id, NULL, year, category, NULL FROM docs WHERE category <> 'en'"""))
def union_sources(spark, sf_dir):
    """Frames with different columns, joined by name."""
    keys = v.corpus_keys(spark, sf_dir)
    docs = v.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("article_id"),
        "source",
        v.year(F.col("doc_id")).alias("year"),
        F.col("lang").alias("category"),
    )
    english = docs.where("category = 'en'").select("source", "article_id", F.lit(1).alias("label"))
    others = docs.where("category <> 'en'").select("year", "article_id", "category")
    return keys.unionByName(english, allowMissingColumns=True).unionByName(
        others, allowMissingColumns=True
    )


@query(v.with_(v.DOCUMENTS, select=f"""
  SELECT article_id, source, text FROM (SELECT article_id, source, {v.sql_clean('text')} AS text FROM docs)
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY article_id) = 1"""))
def dedup_keep_first(spark, sf_dir):
    docs = v.documents(spark, sf_dir)
    docs = with_clean_text(docs.select("article_id", "source", "text"))
    return keep_first(docs, "article_id")


# --- sampling ---------------------------------------------------------------------------------


@query(v.with_(v.CORPUS, balanced_view("corpus"), select="""
  SELECT article_id, label, source FROM balanced"""))
def balance_classes(spark, sf_dir):
    return balance(v.corpus_keys(spark, sf_dir).select("article_id", "label", "source"))


@query(v.with_(v.CORPUS, split_view("corpus"), select="SELECT article_id, label, split FROM splits"),
       name="stratified_split")
def split_labelled(spark, sf_dir):
    """The split on its own, over classes of very different size."""
    return stratified_split(v.corpus_keys(spark, sf_dir).select("article_id", "label"))


@query(v.with_(v.DOCUMENTS, select="""
  SELECT article_id, row_number() OVER (ORDER BY md5('42:o:' || article_id), article_id) AS position
  FROM docs"""))
def seeded_shuffle(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_id"))
    return shuffle_rank(docs)


# --- counts --------------------------------------------------------------------------------------


@query(v.with_(v.CORPUS, select="SELECT label, count(*) AS n FROM corpus GROUP BY label"))
def class_distribution(spark, sf_dir):
    return counters.class_distribution(v.corpus_keys(spark, sf_dir))


@query("SELECT lang AS category, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang")
def category_counts(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents").select(F.col("lang").alias("category"))
    return counters.frequency(docs, "category")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source")
def source_counts(spark, sf_dir):
    return counters.frequency(v.table(spark, sf_dir, "documents").select("source"), "source")


@query(v.with_(v.DOCUMENTS, select="""
  SELECT year, count(*) AS n FROM docs WHERE year IS NOT NULL GROUP BY year ORDER BY year"""))
def year_counts(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents").select(v.year(F.col("doc_id")).alias("year"))
    return counters.counts_by_year(docs)


@query(v.with_(v.DOCUMENTS, select="""
  SELECT count(*) AS n_articles, min(year) AS first_year, max(year) AS last_year,
    count(*) FILTER (WHERE year >= 2023) AS n_ai_era FROM docs"""))
def year_range_profile(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents").select(v.year(F.col("doc_id")).alias("year"))
    return counters.year_profile(docs)


def _prepared(spark, sf_dir):
    return prepared(v.corpus(spark, sf_dir).select("article_id", "label", "year", "text"))


@query(v.with_(*PREPARED, select="""
  SELECT split, label, count(*) AS n FROM splits GROUP BY ROLLUP (split, label)"""))
def split_stats(spark, sf_dir):
    return counters.split_counts(_prepared(spark, sf_dir).chosen)


@query(v.with_(*PREPARED, select="""
  SELECT 'loaded' AS stage, count(*) AS n FROM measured
  UNION ALL SELECT 'length', count(*) FROM kept
  UNION ALL SELECT 'unique', count(*) FROM unique_rows
  UNION ALL SELECT 'balanced', count(*) FROM balanced
  UNION ALL SELECT split, count(*) FROM splits GROUP BY split"""))
def stage_counts(spark, sf_dir):
    """Rows left after every stage, as the passes of the preparation count them."""
    done = _prepared(spark, sf_dir)
    early = spark.createDataFrame(list(done.stages.items()), "stage string, n long")
    by_split = done.chosen.groupBy(F.col("split").alias("stage")).agg(F.count("*").alias("n"))
    balanced = done.chosen.agg(F.lit("balanced").alias("stage"), F.count("*").alias("n"))
    return early.unionByName(balanced).unionByName(by_split)


@query(v.with_(v.CORPUS, select="""
  SELECT article_id, label, year, label = 0 AND coalesce(year >= 2023, FALSE) AS in_doubt FROM corpus"""))
def ai_era_flag(spark, sf_dir):
    rows = v.corpus_keys(spark, sf_dir).select("article_id", "label", "year")
    return rows.withColumn("in_doubt", ai_era(F.col("label"), F.col("year")))
