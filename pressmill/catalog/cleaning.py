"""Queries for the cleaning and metadata columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from ..functions import cleaning, metadata as meta
from ..functions.blanks import squeeze
from ..functions.prediction import head_words, prediction_columns, softmax_pair
from ..operators.cleaning import with_clean_text
from ..operators.filters import with_length
from . import views as v
from .registry import query


def _clean_step(name: str, step: Callable[[Column], Column], sql: Callable[[str], str]) -> None:
    @query(v.with_(v.NOISY, select=f"SELECT article_id, {sql('text')} AS text FROM noisy"), name)
    def run(spark, sf_dir):
        return v.noisy(spark, sf_dir).select("article_id", step(F.col("text")).alias("text"))


for _name, _step, _sql in (
    ("clean_delimiter", cleaning.drop_delimiters, v.sql_delimiter),
    ("clean_headers", cleaning.drop_header_lines, v.sql_headers),
    ("clean_tags", cleaning.drop_tags, v.sql_tags),
    ("clean_entities", cleaning.drop_entities, v.sql_entities),
    ("clean_byline", cleaning.drop_byline, v.sql_byline),
    ("clean_whitespace", squeeze, v.sql_whitespace),
):
    _clean_step(_name, _step, _sql)


@query(v.with_(v.NOISY, select=f"SELECT article_id, {v.sql_clean('text')} AS text FROM noisy"))
def clean_text(spark, sf_dir):
    return with_clean_text(v.noisy(spark, sf_dir))


@query(v.with_(v.NOISY, select=f"SELECT article_id, {v.sql_clean('text')} AS text FROM noisy"))
def clean_text_column(spark, sf_dir):
    """The same as one column expression."""
    return v.noisy(spark, sf_dir).withColumn("text", cleaning.clean_text(F.col("text")))


@query(f"""
  SELECT page_id, text, CAST(length(text) AS INTEGER) AS text_len
  FROM (SELECT page_id, {v.sql_clean('html')} AS text FROM pages)""")
def clean_html_pages(spark, sf_dir):
    pages = v.spread(v.table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    return with_length(with_clean_text(pages, "html", "text").drop("html"))


@query(v.with_(v.NOISY, select=f"""
  SELECT article_id, array_to_string(list_slice(string_split(t, ' '), 1, 50), ' ') AS text
  FROM (SELECT article_id, {v.sql_clean('text')} AS t FROM noisy)"""))
def head_truncate(spark, sf_dir):
    cleaned = v.noisy(spark, sf_dir).withColumn("text", cleaning.clean_text(F.col("text")))
    return cleaned.select("article_id", head_words(F.col("text"), 50).alias("text"))


# --- metadata columns; the raw values are made from the documents --------------------

_RAW_VALUES = ("N/A", "NA", "-", "n/a", "", "N/a", "na", None)


def _choice(values, of: Column) -> Column:
    chosen = F.lit(None).cast("string")
    for i, value in enumerate(values):
        chosen = F.when(of == i, F.lit(value)).otherwise(chosen)
    return chosen


def sql_choice(values, of: str) -> str:
    cases = " ".join(
        f"WHEN {i} THEN {'NULL' if value is None else v.quoted(value)}"
        for i, value in enumerate(values)
    )
    return f"CASE {of} {cases} END"


@query(v.with_(v.DOCUMENTS, select=f"""
  SELECT article_id, CASE WHEN raw IN ('', 'N/A', 'NA', '-', 'n/a') THEN '' ELSE raw END AS value
  FROM (SELECT article_id, CASE WHEN article_id % 9 = 8 THEN source
          ELSE {sql_choice(_RAW_VALUES, 'article_id % 9')} END AS raw FROM docs)"""))
def na_normalize(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents")
    raw = F.when(F.col("doc_id") % 9 == 8, F.col("source")).otherwise(
        _choice(_RAW_VALUES, F.col("doc_id") % 9)
    )
    return docs.select(
        F.col("doc_id").alias("article_id"), meta.blank_if_unavailable(raw).alias("value")
    )


@query("""
  SELECT doc_id AS article_id,
    CASE doc_id % 6 WHEN 0 THEN 'Redakcija ' || source WHEN 1 THEN '' WHEN 2 THEN 'Neko'
      WHEN 3 THEN '' WHEN 4 THEN 'Sam ' || lang ELSE '' END AS author
  FROM documents""")
def author_fallback(spark, sf_dir):
    """An empty AUTOR(I) wins over a filled AUTORI, which wins over AUTOR."""
    turn = F.col("doc_id") % 6
    several = F.when(turn == 0, F.concat(F.lit("Redakcija "), "source")).when(turn == 1, "")
    plural = F.when(turn.isin(0, 1, 2), "Neko").when(turn == 3, "")
    single = F.when(turn < 5, F.concat(F.lit("Sam "), "lang"))
    docs = v.table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("article_id"),
        meta.first_present(several, plural, single).alias("author"),
    )


_NAMES = ("Dnevni Avaz ", "  ČĆŽŠĐ čćžšđ/", "Oslobođenje — ", "...", " \xa0 ")


@query(f"""
  SELECT doc_id AS article_id, coalesce(nullif(trim(regexp_replace(
      translate(lower(name), 'čćžšđ', 'cczsd'), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unknown') AS slug
  FROM (SELECT doc_id, {sql_choice(_NAMES, 'doc_id % 5')}
          || CASE WHEN doc_id % 5 < 3 THEN source ELSE '' END AS name FROM documents)""")
def slugify_source(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents")
    name = F.concat(
        _choice(_NAMES, F.col("doc_id") % 5),
        F.when(F.col("doc_id") % 5 < 3, F.col("source")).otherwise(""),
    )
    return docs.select(F.col("doc_id").alias("article_id"), meta.source_slug(name).alias("slug"))


@query("""
  SELECT doc_id AS article_id, CAST(CASE doc_id % 6 WHEN 0 THEN 2000 + doc_id % 26 WHEN 1 THEN 1902
      WHEN 3 THEN 1900 + doc_id % 100 WHEN 4 THEN 2010 END AS INTEGER) AS year
  FROM documents""")
def parse_year(spark, sf_dir):
    d = F.col("doc_id")
    turn = d % 6
    two_digits = F.lpad((d % 100).cast("string"), 2, "0")
    date = (
        F.when(turn == 0, F.concat(F.lit("06.05."), (2000 + d % 26).cast("string"), F.lit(".")))
        .when(turn == 1, "11902005")
        .when(turn == 2, "")
        .when(turn == 3, F.concat(F.lit("god. 19"), two_digits, F.lit("/2024")))
        .when(turn == 4, "1.1.2010, izmjena 2011")
        .otherwise("1.1.05 / 18. vijek 1875")
    )
    docs = v.table(spark, sf_dir, "documents")
    return docs.select(d.alias("article_id"), meta.year_of(date).alias("year"))


@query(v.with_(v.DOCUMENTS, select="""
  SELECT article_id, CASE WHEN article_id % 3 = 0 THEN text ELSE source || '. ' || text END AS text
  FROM docs"""))
def title_prepend(spark, sf_dir):
    docs = v.documents(spark, sf_dir)
    title = F.when(F.col("article_id") % 3 == 0, "").otherwise(F.col("source"))
    return docs.select("article_id", meta.with_title(title, F.col("text")).alias("text"))


# File stems and the class they announce.
STEMS = (
    ("human", 0), ("AI", 1), ("", None), ("gpt_human", 1), ("ai-x", 1), ("original", 0),
    ("avaiz", None), ("x_ai.v2", 1), ("ljudski", 0), ("chatgpt", 1), ("aitekst", None),
    ("ai_rewritten", 1),
)


def sql_label(of: str) -> str:
    cases = " ".join(
        f"WHEN {i} THEN {'NULL' if label is None else label}" for i, (_, label) in enumerate(STEMS)
    )
    return f"CAST(CASE {of} {cases} END AS INTEGER)"


def _file_path(d: Column) -> Column:
    stems = _choice([stem for stem, _ in STEMS], d % len(STEMS))
    return F.concat(F.lit("file:/arhiva/gpt/"), "source", F.lit("_"), stems, F.lit(".txt"))


@query(f"SELECT doc_id AS article_id, {sql_label(f'doc_id % {len(STEMS)}')} AS label FROM documents")
def label_from_filename(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents")
    label = meta.label_from_stem(meta.stem_of(_file_path(F.col("doc_id"))))
    return docs.select(F.col("doc_id").alias("article_id"), label.cast("int").alias("label"))


@query("""
  SELECT doc_id AS article_id,
    CASE doc_id % 3 WHEN 2 THEN source ELSE 'arhiva' END AS source FROM documents""")
def source_default(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents")
    turn = F.col("doc_id") % 3
    source = F.when(turn == 0, "").when(turn == 1, "unknown").otherwise(F.col("source"))
    return docs.select(
        F.col("doc_id").alias("article_id"), meta.source_or_default(source, "arhiva").alias("source")
    )


@query("""
  SELECT article_id, pred_label, pred_label_name, round(prob_human, 6) AS prob_human,
    round(prob_ai, 6) AS prob_ai, round(greatest(prob_human, prob_ai), 6) AS confidence
  FROM (SELECT doc_id AS article_id,
      CASE WHEN a > h THEN 1 ELSE 0 END AS pred_label,
      CASE WHEN a > h THEN 'AI-generated/rewritten' ELSE 'Human-written' END AS pred_label_name,
      exp(h) / (exp(h) + exp(a)) AS prob_human, exp(a) / (exp(h) + exp(a)) AS prob_ai
    FROM (SELECT doc_id, CAST(n_chars % 7 AS DOUBLE) AS h, CAST(doc_id % 7 AS DOUBLE) AS a
          FROM documents))""")
def softmax_predict(spark, sf_dir):
    """Two logits per row, equal in a seventh of them."""
    docs = v.table(spark, sf_dir, "documents")
    human, ai = softmax_pair(
        (F.col("n_chars") % 7).cast("double"), (F.col("doc_id") % 7).cast("double")
    )
    pairs = docs.select(F.col("doc_id").alias("article_id"), human.alias("h"), ai.alias("a"))
    columns = prediction_columns(F.col("h"), F.col("a"))
    return pairs.select(
        "article_id",
        *(
            (F.round(c, 6) if name.startswith(("prob", "conf")) else c).alias(name)
            for name, c in columns.items()
        ),
    )
