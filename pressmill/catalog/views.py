"""The corpus as seen in the given tables, in Spark and in SQL.

Every view exists twice: as a DataFrame and as a common table expression of the same
name. The SQL side states the expected rows directly; it never parses, reads a file or
uses a function of this package.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.fixed import AGENCIES, HEADER_KEYS
from ..operators.scoring import Scorer, expression_scorer
from ..session import spread

NL = "\n"


# --- tables ------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def year(doc_id: Column) -> Column:
    return F.when(doc_id % 17 != 0, (F.lit(2015) + doc_id % 10).cast("int"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as unlabelled articles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return spread(docs, "doc_id").select(
        F.col("doc_id").alias("article_id"),
        "text",
        "source",
        year(F.col("doc_id")).alias("year"),
        F.col("lang").alias("category"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that have a label."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("article_id"), F.col("quality").alias("label")
    )
    return documents(spark, sf_dir).join(labels, "article_id")


def corpus_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows without their text, for queries that do not look at it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("article_id"),
        "source",
        year(F.col("doc_id")).alias("year"),
        F.col("lang").alias("category"),
        "label",
    )


_DOCUMENT_COLUMNS = """d.doc_id AS article_id, d.text, d.source,
    CASE WHEN d.doc_id % 17 <> 0 THEN CAST(2015 + d.doc_id % 10 AS INTEGER) END AS year,
    d.lang AS category"""

DOCUMENTS = f"docs AS (SELECT {_DOCUMENT_COLUMNS} FROM documents d)"
CORPUS = f"""corpus AS (
  SELECT {_DOCUMENT_COLUMNS}, l.quality AS label
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""


def with_(*views: str, select: str) -> str:
    return f"WITH {', '.join(views)} {select}"


# --- SQL expressions -----------------------------------------------------------------

SQL_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_SQL_KEYS = "|".join(k.replace("(", r"\(").replace(")", r"\)") for k in HEADER_KEYS)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replaced(expression: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({expression}, {quoted(pattern)}, {quoted(by)}, 'g')"


def sql_strip(e: str) -> str:
    return replaced(replaced(e, f"^{SQL_BLANK}+", ""), f"{SQL_BLANK}+$", "")


def sql_delimiter(e: str) -> str:
    return f"replace({e}, '<***>', ' ')"


def sql_headers(e: str) -> str:
    return replaced(e, rf"(?m)^({_SQL_KEYS}){SQL_BLANK}*:[^\n]*")


def sql_tags(e: str) -> str:
    return replaced(e, "<[^>]+>")


def sql_entities(e: str) -> str:
    return replaced(e, "&[a-z]+;")


def sql_byline(e: str) -> str:
    agencies = "|".join(AGENCIES)
    return replaced(
        e,
        rf"{SQL_BLANK}*[(\-–—]{SQL_BLANK}*({agencies})[^)]*\)?\.?{SQL_BLANK}*$",
        "",
    )


def sql_whitespace(e: str) -> str:
    return f"trim({replaced(e, f'{SQL_BLANK}+')})"


def sql_clean(e: str) -> str:
    e = sql_headers(sql_delimiter(f"coalesce({e}, '')"))
    return sql_whitespace(sql_byline(sql_entities(sql_tags(e))))


def sql_round1(e: str) -> str:
    """One decimal of the exact value, ties to even."""
    return f"CAST(printf('%.1f', {e}) AS DOUBLE)"


SQL_PERCENTAGES = f"""
    count(*) AS n_articles,
    {sql_round1("100e0 * (1e0 - count(*) FILTER (WHERE pred_label = 1) / count(*))")} AS human_pct,
    {sql_round1("100e0 * count(*) FILTER (WHERE pred_label = 1) / count(*)")} AS ai_pct,
    round_even(100e0 * avg(confidence) * 10e0, 0) / 10e0 AS mean_conf_pct"""


# --- texts with everything the cleaner removes ---------------------------------------

# By article_id % 12: what is put before and behind the text.
NOISE = (
    ("<***>\nNASLOV: stari naslov\n", ""),
    ("uvod <***> nastavak ", " <***>"),
    ("DATUM : 01.02.2020\nAUTOR(I): N/A\n naslov: ostaje\n NASLOV: ostaje\n", ""),
    ('<p class="x">', "</p>\n<br/> 1 < 2"),
    ("A&nbsp;B &#160; &Amp; &quot;", " a<b i c>d "),
    ("", " (FENA)"),
    ("LINK\n: http://a.example\n", "\n— SRNA.  "),
    ("", " - Avaz piše"),
    (" \x1c", " \x85 (\xa0Tanjug )"),
    ("", " (APELACIJA) kraj"),
    ("NASLOV: abc\rdef\nčćžšđ ČĆŽŠĐ 😀 ", "\r\n"),
    ("<***>NASLOV: ostaje ", " (AP) i (Reuters)."),
)


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents wrapped in what the cleaner has to deal with."""
    docs = documents(spark, sf_dir).select("article_id", "text")
    turn = F.col("article_id") % len(NOISE)
    before, behind = F.lit(""), F.lit("")
    for i, (head, tail) in enumerate(NOISE):
        before = F.when(turn == i, head).otherwise(before)
        behind = F.when(turn == i, tail).otherwise(behind)
    return docs.withColumn("text", F.concat(before, "text", behind))


def _noise_case(side: int) -> str:
    cases = " ".join(
        f"WHEN {i} THEN {quoted(pair[side])}" for i, pair in enumerate(NOISE)
    )
    return f"CASE doc_id % {len(NOISE)} {cases} END"


NOISY = f"""noisy AS (
  SELECT doc_id AS article_id, {_noise_case(0)} || text || {_noise_case(1)} AS text
  FROM documents)"""


# --- a stand-in model ----------------------------------------------------------------
# It tells texts with many commas from others and is no detector of anything.


def stand_in_logit(text: Column) -> Column:
    commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
    return F.lit(100.0) * commas / F.greatest(F.length(text), F.lit(1)) - F.lit(1.0)


def stand_in_expression() -> Scorer:
    return expression_scorer(stand_in_logit)


def make_stand_in_model():
    """The same as a batch model, loaded once per worker."""
    import numpy as np

    def predict(texts):
        commas = np.array([text.count(",") for text in texts], dtype=np.float64)
        lengths = np.array([max(len(text), 1) for text in texts], dtype=np.float64)
        return np.stack([np.zeros(len(commas)), 100.0 * commas / lengths - 1.0], axis=1)

    return predict


def scored_view(base: str, name: str = "scored") -> str:
    """``base`` with the prediction columns of the stand-in model."""
    t = sql_clean("text")
    return f"""{name}_seen AS (SELECT *, {t} AS seen FROM {base}),
  {name}_logit AS (
    SELECT *, 100e0 * (length(seen) - length(replace(seen, ',', ''))) / greatest(length(seen), 1)
      - 1e0 AS z FROM {name}_seen),
  {name} AS (
    SELECT * EXCLUDE (seen, z),
      CASE WHEN z > 0 THEN 1 ELSE 0 END AS pred_label,
      CASE WHEN z > 0 THEN 'AI-generated/rewritten' ELSE 'Human-written' END AS pred_label_name,
      1e0 / (1e0 + exp(z)) AS prob_human,
      1e0 / (1e0 + exp(-z)) AS prob_ai,
      1e0 / (1e0 + exp(-abs(z))) AS confidence
    FROM {name}_logit)"""


# --- documents as newspaper dumps ------------------------------------------------------


def dump_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(article_id, category, article)``: every document as a dump article."""
    docs = documents(spark, sf_dir)
    d = F.col("article_id")

    def line(key: str, value: Column | str, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{key}: "), value if isinstance(value, Column) else F.lit(value))
        return text if when is None else F.when(when, text)

    date = F.when(F.col("year").isNull(), "N/A").otherwise(
        F.concat(F.lit("01.02."), F.col("year").cast("string"))
    )
    header = F.concat_ws(
        NL,
        F.lit("<***>"),
        line("NOVINA", "N/A", (d % 15 == 0) & (d % 21 != 0)),
        line("NOVINA", F.col("source"), d % 3 != 0),
        line("PORTAL", F.concat(F.lit("Portal Žurnal "), "source"), (d % 3 == 0) & (d % 21 != 0)),
        line("DATUM", date),
        F.when(d % 6 == 0, F.lit("  ")),
        line("RUBRIKA", F.when(d % 5 == 0, "N/A").otherwise(F.col("category"))),
        line("NADNASLOV", "-", d % 5 == 0),
        line("NASLOV", "stari naslov", d % 7 == 0),
        line("NASLOV ", F.translate(F.substring("text", 1, 40), NL, " ")),
        line("STRANA", "n/a"),
        line("AUTOR(I)", "Redakcija", d % 4 == 0),
        line("AUTOR(I)", "N/A", d % 4 == 1),
        line("AUTORI", "Neko Drugi", d % 4 == 1),
        line("AUTOR", "Sam Autor", d % 4 == 2),
        line("LINK", F.concat(F.lit("https://arhiva.example/"), d.cast("string"))),
        F.lit(""),
    )
    tail = F.when(d % 11 == 0, "\nDalje <***> ovdje.").otherwise("")
    return docs.select(
        "article_id",
        "year",
        F.when(d % 10 == 0, "Karikature i stripovi").otherwise(F.col("category")).alias("category"),
        F.concat(header, F.lit(NL), "text", tail).alias("article"),
    )


_TITLE = "trim(replace(substr(text, 1, 40), chr(10), ' '))"

# What a parser must find in those dumps, stated without them.
ARTICLES = f"""articles AS (
  SELECT article_id,
    CASE WHEN article_id % 10 = 0 THEN 'Karikature i stripovi' ELSE category END AS category,
    CASE WHEN article_id % 21 = 0 THEN '' WHEN article_id % 3 = 0 THEN 'Portal Žurnal ' || source
      ELSE source END AS source_name,
    CASE WHEN article_id % 21 = 0 THEN 'unknown' WHEN article_id % 3 = 0
      THEN 'portal_zurnal_' || source ELSE source END AS source,
    coalesce('01.02.' || CAST(year AS VARCHAR), '') AS date,
    year,
    CASE WHEN article_id % 5 = 0 THEN '' ELSE category END AS section,
    '' AS supertitle,
    {_TITLE} AS title,
    '' AS subtitle,
    CASE article_id % 4 WHEN 0 THEN 'Redakcija' WHEN 2 THEN 'Sam Autor' ELSE '' END AS author,
    'https://arhiva.example/' || article_id AS link,
    {sql_strip("text || CASE WHEN article_id % 11 = 0 THEN chr(10) || 'Dalje <***> ovdje.' ELSE '' END")}
      AS text
  FROM docs)"""

# The dump text itself, for the queries that compare it before parsing.
DUMPS = """dumps AS (
  SELECT article_id, article_id // 250 AS bucket, concat_ws(chr(10), '<***>',
    CASE WHEN article_id % 15 = 0 AND article_id % 21 <> 0 THEN 'NOVINA: N/A' END,
    CASE WHEN article_id % 3 <> 0 THEN 'NOVINA: ' || source END,
    CASE WHEN article_id % 3 = 0 AND article_id % 21 <> 0
      THEN 'PORTAL: Portal Žurnal ' || source END,
    'DATUM: ' || coalesce('01.02.' || CAST(year AS VARCHAR), 'N/A'),
    CASE WHEN article_id % 6 = 0 THEN '  ' END,
    'RUBRIKA: ' || CASE WHEN article_id % 5 = 0 THEN 'N/A' ELSE category END,
    CASE WHEN article_id % 5 = 0 THEN 'NADNASLOV: -' END,
    CASE WHEN article_id % 7 = 0 THEN 'NASLOV: stari naslov' END,
    'NASLOV : ' || replace(substr(text, 1, 40), chr(10), ' '),
    'STRANA: n/a',
    CASE WHEN article_id % 4 = 0 THEN 'AUTOR(I): Redakcija' END,
    CASE WHEN article_id % 4 = 1 THEN 'AUTOR(I): N/A' END,
    CASE WHEN article_id % 4 = 1 THEN 'AUTORI: Neko Drugi' END,
    CASE WHEN article_id % 4 = 2 THEN 'AUTOR: Sam Autor' END,
    'LINK: https://arhiva.example/' || article_id,
    '') || chr(10) || text
    || CASE WHEN article_id % 11 = 0 THEN chr(10) || 'Dalje <***> ovdje.' ELSE '' END AS article
  FROM docs)"""


# --- predictions of five runs ----------------------------------------------------------


def run_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled corpus once per run, with the label flipped in some rows."""
    runs = corpus_keys(spark, sf_dir).select("article_id", "label").withColumn(
        "run_id", F.explode(F.sequence(F.lit(1), F.lit(5)))
    )
    run = F.col("run_id").cast("string")
    digit = F.substring(F.md5(F.concat(run, F.lit(":"), F.col("article_id").cast("string"))), 1, 1)
    wrong = digit < run
    return runs.select(
        "run_id",
        "label",
        F.when(wrong, 1 - F.col("label")).otherwise(F.col("label")).alias("pred_label"),
    )


RUN_PREDICTIONS = """run_predictions AS (
  SELECT CAST(run_id AS INTEGER) AS run_id, label,
    CASE WHEN substr(md5(run_id || ':' || article_id), 1, 1) < CAST(run_id AS VARCHAR)
      THEN 1 - label ELSE label END AS pred_label
  FROM corpus CROSS JOIN range(1, 6) AS r(run_id))"""
