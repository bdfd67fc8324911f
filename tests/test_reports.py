"""Scoring, summaries, metrics, training and rewriting."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from pressmill.catalog import views
from pressmill.operators import metrics, summary
from pressmill.operators.rewriting import attach_rewrites, rewrite_requests
from pressmill.operators.scoring import model_scorer, score_table
from pressmill.plans.training import RunStore, runs_table, score_with, train_runs


def test_model_and_expression_agree(spark):
    texts = [None, "", "a,b", "<b>,</b> c", "(FENA)", "a, b " * 50]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    by_model = score_table(df, model_scorer(views.make_stand_in_model, batch_size=2)).orderBy("i")
    by_expression = score_table(df, views.stand_in_expression()).orderBy("i")
    assert by_model.columns == ["i", "text", "pred_label", "pred_label_name", "prob_human",
                                "prob_ai", "confidence"]
    pairs = list(zip(by_model.collect(), by_expression.collect()))
    for a, b in pairs:
        assert (a.text, a.pred_label) == (b.text, b.pred_label)
        assert abs(a.prob_ai - b.prob_ai) < 1e-12
    assert [a.text for a, _ in pairs] == texts


def test_head_only(spark):
    df = spark.createDataFrame([("ab ab a,,,,",)], "text string")
    scorer = views.stand_in_expression()
    assert score_table(df, scorer).first().pred_label == 1
    assert score_table(df, scorer, max_words=2).first().pred_label == 0


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice([2020, 2021, None]), rng.choice(["a", "b", None]), rng.choice(["x", None]),
         rng.randint(0, 1), rng.random())
        for _ in range(500)
    ]
    return rows, spark.createDataFrame(
        rows, "year int, source string, category string, pred_label int, confidence double"
    ).repartition(4)


def expected(rows, *keys):
    groups = {}
    for row in rows:
        groups.setdefault(tuple(row[k] for k in keys), []).append(row)
    return {
        key: (len(g), round(100 * (1 - sum(r[3] for r in g) / len(g)), 1),
              round(100 * sum(r[3] for r in g) / len(g), 1),
              pytest.approx(100 * statistics.fmean(r[4] for r in g), abs=0.0501))
        for key, g in groups.items()
    }


def measures(row):
    return (row.n_articles, row.human_pct, row.ai_pct, row.mean_conf_pct)


def test_summary_keeps_null_groups(scored):
    rows, df = scored
    got = summary.summarize(df, ["year", "source", "missing"], ordered=True).collect()
    assert {(r.year, r.source): measures(r) for r in got} == expected(rows, 0, 1)
    years = [r.year for r in got]
    assert years == sorted(years, key=lambda y: (y is None, y))


def test_summary_without_groups(scored):
    rows, df = scored
    row = summary.summarize(df, ["nothing"]).first()
    assert row._all == "all" and measures(row) == expected(rows)[()]


def test_family_equals_single_summaries(scored):
    rows, df = scored
    table = summary.summarize_family(df)
    for name, columns, keys in (
        ("summary_by_year_source", ("year", "source"), (0, 1)),
        ("summary_by_year_category", ("year", "category"), (0, 2)),
        ("summary_by_year", ("year",), (0,)),
    ):
        report = summary.one_report(table, name).collect()
        assert {tuple(r[c] for c in columns): measures(r) for r in report} == expected(rows, *keys)


def test_family_is_one_pass(scored, capsys):
    summary.summarize_family(scored[1]).explain()
    plan = capsys.readouterr().out
    assert plan.count("Expand") == 1 and plan.count("hashpartitioning(year") == 1


def test_totals_of_nothing(spark, scored):
    row = summary.batch_totals(scored[1].limit(0)).first()
    assert (row.n_articles, row.n_ai, row.ai_pct, row.mean_conf_pct) == (0, 0, None, None)


def predictions(spark, pairs):
    return spark.createDataFrame(pairs, "label int, pred_label int")


def test_metrics_are_macro(spark):
    pairs = [(0, 0)] * 90 + [(0, 1)] * 5 + [(1, 1)] * 3 + [(1, 0)] * 2
    row = metrics.classification_metrics(predictions(spark, pairs)).first()
    precision = [90 / 92, 3 / 8]
    recall = [90 / 95, 3 / 5]
    f1 = [2 * p * r / (p + r) for p, r in zip(precision, recall)]
    assert row.accuracy == pytest.approx(0.93)
    assert row.precision == pytest.approx(sum(precision) / 2)
    assert row.recall == pytest.approx(sum(recall) / 2)
    assert row.f1 == pytest.approx(sum(f1) / 2)
    report = {
        (r.section, r.metric): r.value
        for r in metrics.classification_report(predictions(spark, pairs)).collect()
    }
    assert report["Human-written", "f1-score"] == pytest.approx(f1[0])
    assert report["AI-generated", "support"] == 5
    assert report["weighted avg", "precision"] == pytest.approx((95 * precision[0] + 5 * precision[1]) / 100)
    assert report["accuracy", "accuracy"] == pytest.approx(0.93)
    assert len(report) == 17


def test_a_class_nobody_predicts_scores_zero(spark):
    row = metrics.classification_metrics(predictions(spark, [(0, 0), (1, 0)])).first()
    assert (row.accuracy, row.precision, row.recall) == (0.5, 0.25, 0.5)
    assert row.f1 == pytest.approx((2 / 3) / 2)
    only = metrics.classification_metrics(predictions(spark, [(1, 1)])).first()
    assert (only.accuracy, only.f1) == (1.0, 1.0)


def test_runs(spark):
    runs = spark.createDataFrame(
        [(2, 43, 0.9, 0.8, 0.7, 0.6), (1, 42, 0.7, 0.8, 0.9, 0.6), (3, 44, 0.8, 0.5, 0.5, 0.6)],
        "run_id int, seed int, accuracy double, f1 double, precision double, recall double",
    )
    rows = {r.metric: r for r in metrics.multi_run_summary(runs).collect()}
    assert rows["accuracy"].per_run == [0.7, 0.9, 0.8]
    assert rows["accuracy"].std == pytest.approx(statistics.pstdev([0.7, 0.9, 0.8]))
    assert (rows["f1"].min, rows["f1"].max) == (0.5, 0.8)
    assert metrics.best_run(runs).first().run_id == 1
    assert metrics.best_run(runs, "accuracy").first().run_id == 2


def test_training(spark):
    rng = random.Random(2)
    words = {0: ["Vlada", "ministar", "budžet"], 1: ["nadalje", "ključno", "Stoga"]}
    rows = [
        (i, i % 2, " ".join(rng.choice([*words[i % 2], "i", "u", "na"]) for _ in range(30)))
        for i in range(80)
    ]
    unique = spark.createDataFrame(rows, "article_id long, label int, text string")
    runs = train_runs(unique, n_runs=2, reg_params=(0.01,), max_iter=5, features=256)
    table = runs_table(unique, runs).collect()
    assert [(r.run_id, r.seed) for r in table] == [(1, 42), (2, 43)]
    assert all(r.accuracy == r.f1 == 1.0 for r in table)
    out = score_with(runs[0].model, unique.select("article_id", "label", "text"))
    assert out.columns == ["article_id", "label", "text", "pred_label", "pred_label_name",
                           "prob_human", "prob_ai", "confidence"]
    assert out.where("label <> pred_label").count() == 0


def test_stored_runs_are_read_again(spark, folder):
    rng = random.Random(3)
    words = {0: ["Vlada", "ministar"], 1: ["nadalje", "Stoga"]}
    rows = [(i, i % 2, " ".join(rng.choice([*words[i % 2], "i", "u"]) for _ in range(30))) for i in range(60)]
    unique = spark.createDataFrame(rows, "article_id long, label int, text string")
    options = {"reg_params": (0.01,), "max_iter": 3, "features": 64, "store": folder}
    first = train_runs(unique, n_runs=2, **options)
    store = RunStore(spark, folder)
    assert store.finished(42) and store.finished(43) and not store.finished(44)
    # Nothing is fitted again: the table has no rows any more. A new seed would need them.
    again = train_runs(unique.limit(0), n_runs=2, **options)
    assert [(r.run_id, r.seed, r.reg_param, r.metrics) for r in again] == [(r.run_id, r.seed, r.reg_param, r.metrics) for r in first]
    scored = score_with(again[0].model, unique.select("article_id", "label", "text"))
    stored = store.predictions().where("seed = 42").select("article_id", "pred_label", "confidence")
    assert sorted(stored.collect()) == sorted(
        scored.join(stored.select("article_id"), "article_id").select("article_id", "pred_label", "confidence").collect())
    assert len(train_runs(unique, n_runs=3, **options)) == 3 and store.results().count() == 3
    assert store.reports().groupBy("seed").count().count() == 3
    with pytest.raises(ValueError, match="other parameters"):
        train_runs(unique, n_runs=1, **{**options, "max_iter": 4})


def test_rewrites(spark):
    df = spark.createDataFrame(
        [(1, "a {article_text} {newspaper_name}", "L", 2000), (2, "b", None, None)],
        "article_id long, text string, source string, year int",
    )
    template = "{{za}} {newspaper_name}: {article_text} ({newspaper_name})"
    prompts = {r.article_id: r.prompt for r in rewrite_requests(df, template).collect()}
    assert prompts == {1: "{za} L: a {article_text} {newspaper_name} (L)", 2: "{za} : b ()"}
    corpus = df.withColumn("label", F.lit(0))
    answers = spark.createDataFrame([(1, " \n novo\xa0"), (9, "x")], "article_id long, ai_text string")
    got = {r.article_id: r for r in attach_rewrites(corpus, answers).collect()}
    assert set(got) == {"1", "2", "1:ai"}
    new = got["1:ai"]
    assert (new.text, new.source, new.year, new.label) == ("novo", "L", 2000, 1)
