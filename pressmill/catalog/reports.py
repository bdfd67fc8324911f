"""Queries for scoring, summaries, metrics, training and rewriting."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ..operators import metrics, summary
from ..operators.rewriting import attach_rewrites as attach
from ..operators.rewriting import rewrite_requests as requests
from ..operators.scoring import model_scorer, score_table as score
from ..operators.dedup import keep_first
from ..plans.prepare import cleaned
from ..plans.training import RunStore, runs_table, train_runs
from ..session import scratch_path
from ..sources import sinks
from ..operators.filters import within_length
from . import views as v
from .registry import query
from .selection import MEASURED, UNIQUE, balanced_view, split_view

PREPARED_UNIQUE = (v.CORPUS, MEASURED, UNIQUE)
SCORED = (v.DOCUMENTS, v.scored_view("docs"))


def scored(spark, sf_dir) -> DataFrame:
    """All documents with the stand-in model's predictions, by expression."""
    return score(v.documents(spark, sf_dir), v.stand_in_expression()).drop("text")


@query(v.with_(*SCORED, select="""
  SELECT article_id, text, pred_label, pred_label_name, round(prob_human, 6) AS prob_human,
    round(prob_ai, 6) AS prob_ai, round(confidence, 6) AS confidence FROM scored"""))
def score_table(spark, sf_dir):
    """Batch scoring through a model that Python workers load; the text stays raw."""
    docs = v.documents(spark, sf_dir).select("article_id", "text")
    table = score(docs, model_scorer(v.make_stand_in_model))
    rounded = {c: F.round(c, 6) for c in ("prob_human", "prob_ai", "confidence")}
    return table.withColumns(rounded)


# --- summaries --------------------------------------------------------------------------


def _summary(name: str, keys: tuple[str, ...], order: bool = False) -> None:
    listed = ", ".join(keys)
    ordering = f"ORDER BY {', '.join(f'{k} NULLS LAST' for k in keys)}" if order else ""
    sql = f"SELECT {listed}, {v.SQL_PERCENTAGES} FROM scored GROUP BY {listed} {ordering}"

    @query(v.with_(*SCORED, select=sql), name)
    def run(spark, sf_dir):
        return summary.summarize(scored(spark, sf_dir), keys, ordered=order)


_summary("summary_by_year_source", ("year", "source"))
_summary("summary_by_year_category", ("year", "category"))
_summary("summary_by_year", ("year",))
_summary("summary_sorted", ("year", "category", "source"), order=True)


@query(v.with_(*SCORED, select=f"SELECT 'all' AS _all, {v.SQL_PERCENTAGES} FROM scored"))
def summary_all(spark, sf_dir):
    """Group columns the table lacks are left out; here none is left."""
    return summary.summarize(scored(spark, sf_dir).drop("year", "source"), ["year", "source"])


FAMILY_SQL = f"""
  SELECT CASE grouping_id(year, source, category) WHEN 1 THEN 'summary_by_year_source'
      WHEN 2 THEN 'summary_by_year_category' ELSE 'summary_by_year' END AS report,
    year, source, category, {v.SQL_PERCENTAGES}
  FROM scored GROUP BY GROUPING SETS ((year, source), (year, category), (year))"""


@query(v.with_(*SCORED, select=FAMILY_SQL))
def summary_grouping_sets(spark, sf_dir):
    """All three reports from one pass."""
    return summary.summarize_family(scored(spark, sf_dir))


@query(v.with_(*SCORED, select=FAMILY_SQL))
def stored_reports(spark, sf_dir):
    """Predictions and reports written as files, and the three reports read back."""
    folder = scratch_path(spark, "scored")
    sinks.write_predictions(scored(spark, sf_dir), folder, report_fmt="parquet")
    reports = [
        spark.read.parquet(f"{folder}/{name}").withColumn("report", F.lit(name)) for name in summary.FAMILY
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports).select(
        "report", "year", "source", "category", "n_articles", "human_pct", "ai_pct", "mean_conf_pct"
    )


@query(v.with_(*SCORED, select=f"""
  SELECT count(*) AS n_articles, count(*) FILTER (WHERE pred_label = 1) AS n_ai,
    {v.sql_round1("100e0 * count(*) FILTER (WHERE pred_label = 1) / count(*)")} AS ai_pct,
    {v.sql_round1("100e0 * avg(confidence)")} AS mean_conf_pct
  FROM scored"""))
def batch_totals(spark, sf_dir):
    return summary.batch_totals(scored(spark, sf_dir))


# --- metrics ------------------------------------------------------------------------------

# Per class from the two sides of each row; macro means over the classes that occur.
METRICS = """classes AS (
  SELECT DISTINCT run_id, unnest([label, pred_label]) AS class FROM run_predictions),
per_class AS (
  SELECT c.run_id, c.class,
    count(*) FILTER (WHERE p.label = c.class) AS support,
    count(*) FILTER (WHERE p.pred_label = c.class) AS predicted,
    count(*) FILTER (WHERE p.label = c.class AND p.pred_label = c.class) AS hits
  FROM classes c JOIN run_predictions p ON p.run_id = c.run_id GROUP BY c.run_id, c.class),
scores AS (
  SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r,
    coalesce(2 * hits / nullif(support + predicted, 0), 0) AS f FROM per_class),
runs AS (
  SELECT run_id, sum(hits) / sum(support) AS accuracy, avg(f) AS f1, avg(p) AS precision,
    avg(r) AS recall FROM scores GROUP BY run_id)"""
RUNS = (v.CORPUS, v.RUN_PREDICTIONS, METRICS)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query(v.with_(*RUNS, select="""
  SELECT run_id, round(accuracy, 9) AS accuracy, round(f1, 9) AS f1,
    round(precision, 9) AS precision, round(recall, 9) AS recall FROM runs"""))
def classification_metrics(spark, sf_dir):
    table = metrics.classification_metrics(v.run_predictions(spark, sf_dir), ["run_id"])
    return _rounded(table, *metrics.METRICS)


@query(v.with_(*RUNS, select="""
  SELECT run_id, CASE class WHEN 0 THEN 'Human-written' ELSE 'AI-generated' END AS section,
    unnest(['precision', 'recall', 'f1-score', 'support']) AS metric,
    round(unnest([p, r, f, CAST(support AS DOUBLE)]), 9) AS value FROM scores
  UNION ALL SELECT run_id, 'accuracy', 'accuracy', round(accuracy, 9) FROM runs
  UNION ALL SELECT run_id, 'macro avg', unnest(['precision', 'recall', 'f1-score', 'support']),
    round(unnest([avg(p), avg(r), avg(f), CAST(sum(support) AS DOUBLE)]), 9)
    FROM scores GROUP BY run_id
  UNION ALL SELECT run_id, 'weighted avg', unnest(['precision', 'recall', 'f1-score', 'support']),
    round(unnest([sum(p * support) / sum(support), sum(r * support) / sum(support),
      sum(f * support) / sum(support), CAST(sum(support) AS DOUBLE)]), 9)
    FROM scores GROUP BY run_id"""))
def classification_report(spark, sf_dir):
    table = metrics.classification_report(v.run_predictions(spark, sf_dir), ["run_id"])
    return _rounded(table, "value")


@query(v.with_(*RUNS, """long AS (
  SELECT run_id, unnest(['accuracy', 'f1', 'precision', 'recall']) AS metric,
    unnest([accuracy, f1, precision, recall]) AS value FROM runs)""", select="""
  SELECT metric, round(avg(value), 9) AS mean, round(stddev_pop(value), 9) AS std,
    round(min(value), 9) AS min, round(max(value), 9) AS max,
    string_agg(CAST(CAST(value AS DECIMAL(9, 6)) AS VARCHAR), ',' ORDER BY run_id) AS per_run
  FROM long GROUP BY metric"""))
def multi_run_summary(spark, sf_dir):
    runs = metrics.classification_metrics(v.run_predictions(spark, sf_dir), ["run_id"])
    table = _rounded(metrics.multi_run_summary(runs), "mean", "std", "min", "max")
    as_text = F.transform("per_run", lambda x: x.cast("decimal(9,6)").cast("string"))
    return table.withColumn("per_run", F.array_join(as_text, ","))


@query(v.with_(*RUNS, select="""
  SELECT run_id, round(f1, 9) AS f1 FROM runs ORDER BY runs.f1 DESC, run_id LIMIT 1"""))
def best_run(spark, sf_dir):
    runs = metrics.classification_metrics(v.run_predictions(spark, sf_dir), ["run_id"])
    return _rounded(metrics.best_run(runs).select("run_id", "f1"), "f1")


def _training_rows(spark, sf_dir) -> DataFrame:
    """Cleaned, unique texts of both classes."""
    measured = within_length(cleaned(v.corpus(spark, sf_dir).select("article_id", "label", "text")))
    return keep_first(measured, "article_id").select("article_id", "label", "text")


@query()
def train_multi_seed(spark, sf_dir):
    """Five runs of the classifier; no SQL can fit a model."""
    unique = _training_rows(spark, sf_dir)
    return runs_table(unique, train_runs(unique, parallelism=5))


# Metrics, reports, summary and best run once more, in SQL over the stored test predictions.
_RECOMPUTED = """
WITH classes AS (SELECT DISTINCT seed, explode(array(label, pred_label)) AS class FROM predictions),
per_class AS (
  SELECT c.seed, c.class, count_if(p.label = c.class) AS support, count_if(p.pred_label = c.class) AS predicted,
    count_if(p.label = c.class AND p.pred_label = c.class) AS hits
  FROM classes c JOIN predictions p ON p.seed = c.seed GROUP BY c.seed, c.class),
scores AS (
  SELECT *, coalesce(try_divide(hits, predicted), 0) AS p, coalesce(try_divide(hits, support), 0) AS r,
    2 * hits / (support + predicted) AS f FROM per_class)
SELECT seed, sum(hits) / sum(support) AS accuracy, avg(f) AS f1, avg(p) AS precision, avg(r) AS recall,
  sum(support) AS n, max(if(class = 0, f, 0)) AS f_human, sum(f * support) / sum(support) AS f_weighted
FROM scores GROUP BY seed"""


def _runs_sql() -> str:
    views = [*PREPARED_UNIQUE]
    for seed in range(42, 47):
        views += [balanced_view("unique_rows", f"b{seed}", seed), split_view(f"b{seed}", f"s{seed}", seed)]
    runs = " UNION ALL ".join(
        f"""SELECT {seed} AS seed, {seed} - 41 AS run_id, label, count(*) AS n_test, TRUE AS metrics_agree,
        TRUE AS report_agrees, TRUE AS summary_agrees, TRUE AS best_agrees, TRUE AS read_again
        FROM s{seed} WHERE split = 'test' GROUP BY label"""
        for seed in range(42, 47)
    )
    return v.with_(*views, select=runs)


@query(_runs_sql())
def stored_runs(spark, sf_dir):
    """Five stored runs: what they hold is what SQL makes of the stored predictions; a second call fits nothing."""
    unique = _training_rows(spark, sf_dir)
    folder = scratch_path(spark, "runs")
    store = RunStore(spark, folder)
    runs = train_runs(unique, parallelism=5, store=folder)
    again = train_runs(unique, store=folder)
    same = [a.metrics == b.metrics and a.reg_param == b.reg_param for a, b in zip(runs, again, strict=True)]
    store.predictions().createOrReplaceTempView("predictions")
    sql = spark.sql(_RECOMPUTED)

    def near(a, b):
        return F.abs(F.col(a) - F.col(b)) < 1e-9

    results = store.results().withColumnsRenamed({m: f"r_{m}" for m in metrics.METRICS})
    def line(section, metric):
        return F.max(F.when((F.col("section") == section) & (F.col("metric") == metric), F.col("value")))

    lines = store.reports().groupBy("seed").agg(
        line("Human-written", "f1-score").alias("human"), line("weighted avg", "f1-score").alias("weighted"),
        line("macro avg", "support").alias("support"),
    )
    checked = sql.join(results, "seed").join(lines, "seed").select(
        "seed", "run_id", reduce(and_, (near(m, f"r_{m}") for m in metrics.METRICS)).alias("metrics_agree"),
        (near("f_human", "human") & near("f_weighted", "weighted") & near("n", "support")).alias("report_agrees"),
    )
    means = sql.agg(*(F.avg(m).alias(m) for m in metrics.METRICS), *(F.stddev_pop(m).alias(f"{m}_std") for m in metrics.METRICS)).first()
    stored = {r["metric"]: r for r in spark.read.json(store.path("summary")).collect()}
    summary_agrees = all(
        abs(stored[m]["mean"] - means[m]) < 1e-9 and abs(stored[m]["std"] - means[f"{m}_std"]) < 1e-9 for m in metrics.METRICS
    )
    best = sql.orderBy(F.desc(F.round("f1", 12)), "seed").first()["seed"]
    best_agrees = spark.read.json(store.path("best_run")).first()["seed"] == best
    sizes = store.predictions().groupBy("seed", "label").agg(F.count("*").alias("n_test"))
    return sizes.join(checked, "seed").select(
        "seed", "run_id", "label", "n_test", "metrics_agree", "report_agrees",
        F.lit(summary_agrees).alias("summary_agrees"), F.lit(best_agrees).alias("best_agrees"), F.lit(all(same)).alias("read_again"),
    )


# --- rewriting ---------------------------------------------------------------------------------

TEMPLATE = "Prepiši vijest u stilu lista {newspaper_name}.\n\n{article_text}\n\nList: {newspaper_name}"


@query(v.with_(v.DOCUMENTS, select="""
  SELECT article_id, 'Prepiši vijest u stilu lista ' || source || '.' || chr(10) || chr(10)
    || text || ' {newspaper_name}' || chr(10) || chr(10) || 'List: ' || source AS prompt FROM docs"""))
def rewrite_requests(spark, sf_dir):
    """Texts that hold something like a placeholder stay as they are."""
    docs = v.documents(spark, sf_dir)
    docs = docs.withColumn("text", F.concat("text", F.lit(" {newspaper_name}")))
    return requests(docs, TEMPLATE)


@query(v.with_(v.DOCUMENTS, select=f"""
  SELECT CAST(article_id AS VARCHAR) AS article_id, text, source, year, category, 0 AS label FROM docs
  UNION ALL
  SELECT article_id || ':ai', {v.sql_strip("reverse(text)")}, source, year, NULL, 1
  FROM docs WHERE article_id % 4 = 0"""))
def attach_rewrites(spark, sf_dir):
    docs = v.documents(spark, sf_dir).withColumn("label", F.lit(0))
    blanks = F.lit(" \n\xa0")
    answers = (
        v.documents(spark, sf_dir)
        .where(F.col("article_id") % 4 == 0)
        .select("article_id", F.concat(blanks, F.reverse("text"), blanks).alias("ai_text"))
    )
    return attach(docs, answers)
