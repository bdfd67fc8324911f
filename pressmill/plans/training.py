"""Training and evaluating a text classifier over several seeds."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.fixed import SEED
from ..functions.prediction import prediction_columns
from ..operators.metrics import METRICS, best_run, classification_metrics, classification_report, multi_run_summary
from ..operators.sampling import balance, stratified_split
from ..session import scratch_path, written
from ..sources.sinks import write_small

RUNS = 5
REGULARIZATION = (0.01, 0.1)
FEATURES = 1 << 18
MAX_ITER = 20
RUN_SCHEMA = "run_id int, seed int, " + ", ".join(f"{m} double" for m in METRICS)


@dataclass(frozen=True)
class Run:
    run_id: int
    seed: int
    model: PipelineModel
    reg_param: float
    val_loss: float
    metrics: dict[str, float]


@dataclass(frozen=True)
class RunStore:
    """A folder of finished runs: models, test predictions, reports, results and their summary.

    Everything of a run has the run's seed in its path and takes the place of what an interrupted run
    left there. Its result is written last, so a run is finished if its result is.
    """

    spark: SparkSession
    folder: str

    def path(self, what: str, seed: int | None = None) -> str:
        return f"{self.folder}/{what}" + ("" if seed is None else f"/seed={seed}")

    def finished(self, seed: int) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path('results', seed)}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def predictions(self) -> DataFrame:
        """``(key, label, pred_label, …, seed)`` of the test rows of all stored runs."""
        return self.spark.read.parquet(self.path("predictions"))

    def reports(self) -> DataFrame:
        """``(section, metric, value, seed)``: the per-class report of every run."""
        return self.spark.read.parquet(self.path("reports"))

    def results(self) -> DataFrame:
        """One row for every run: seed, parameters, the chosen one, metrics."""
        return self.spark.read.parquet(self.path("results"))

    def load(self, run_id: int, seed: int, parameters: str) -> Run:
        row = self.spark.read.parquet(self.path("results", seed)).first()
        if row["parameters"] != parameters:
            raise ValueError(f"{self.folder} holds a run of seed {seed} with other parameters: {row['parameters']}")
        model = PipelineModel.load(self.path("models", seed))
        return Run(run_id, seed, model, row["reg_param"], row["val_loss"], {m: row[m] for m in METRICS})

    def save(self, run: Run, tested: DataFrame, parameters: str) -> Run:
        """Stores a run; its metrics and report are those of the stored predictions."""
        run.model.write().overwrite().save(self.path("models", run.seed))
        tested.write.mode("overwrite").parquet(self.path("predictions", run.seed))
        tested = self.spark.read.parquet(self.path("predictions", run.seed))
        write_small(classification_report(tested), self.path("reports", run.seed), "parquet")
        metrics = classification_metrics(tested)
        result = metrics.select(
            F.lit(run.run_id).alias("run_id"), F.lit(parameters).alias("parameters"),
            F.lit(run.reg_param).alias("reg_param"), F.lit(run.val_loss).alias("val_loss"), *METRICS,
        )
        write_small(result, self.path("results", run.seed), "parquet")
        return replace(run, metrics=metrics.first().asDict())

    def summarize(self, runs: Sequence[Run]) -> None:
        """Stores the summary over runs and the best one, with the folder of its model."""
        table = self.spark.createDataFrame(
            [(r.run_id, r.seed, *(r.metrics[m] for m in METRICS)) for r in runs], RUN_SCHEMA
        )
        write_small(multi_run_summary(table), self.path("summary"))
        best = best_run(table)
        model = F.concat(F.lit(self.path("models") + "/seed="), F.col("seed").cast("string"))
        write_small(best.withColumn("model", model), self.path("best_run"))


def _words(features: int = FEATURES) -> list:
    """Stages without a state: cased words and their hashed counts."""
    return [
        RegexTokenizer(inputCol="text", outputCol="words", toLowercase=False),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=features),
    ]


def _predicted(df: DataFrame) -> DataFrame:
    probabilities = vector_to_array("probability")
    columns = prediction_columns(probabilities[0], probabilities[1])
    return df.withColumns(dict(columns))


def score_with(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Appends the prediction columns of a trained model to a table of cleaned texts."""
    scored = _predicted(model.transform(df))
    return scored.drop("words", "counts", "features", "rawPrediction", "probability", "prediction")


def _without_summary(model: LogisticRegressionModel, spark: SparkSession) -> LogisticRegressionModel:
    """The model, stored and loaded.

    A model fresh from its fit holds a summary with the session inside, and such a model cannot be
    sent to tasks once the session has observed metrics.
    """
    path = scratch_path(spark, "model")
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def train_run(
    counts: DataFrame,
    run_id: int,
    seed: int,
    reg_params: Sequence[float] = REGULARIZATION,
    max_iter: int = MAX_ITER,
    store: RunStore | None = None,
    parameters: str = "",
) -> Run:
    """One run on ``(label, counts, split)``: fit on train, select on val, measure on test.

    The regularization with the least log-loss on val wins; test is used once. Other columns go
    with the predictions into the store.
    """
    idf = IDF(inputCol="counts", outputCol="features").fit(counts.where("split = 'train'"))
    weighted = idf.transform(counts).drop("counts")
    weighted.persist(StorageLevel.MEMORY_AND_DISK)
    loss = MulticlassClassificationEvaluator(metricName="logLoss")
    candidates = []
    for reg_param in reg_params:
        fitted = LogisticRegression(regParam=reg_param, maxIter=max_iter).fit(
            weighted.where("split = 'train'")
        )
        fitted = _without_summary(fitted, counts.sparkSession)
        val_loss = loss.evaluate(fitted.transform(weighted.where("split = 'val'")))
        candidates.append((val_loss, reg_param, fitted))
    val_loss, reg_param, fitted = min(candidates, key=lambda c: c[:2])
    tested = _predicted(fitted.transform(weighted.where("split = 'test'")))
    tested = tested.drop("split", "features", "rawPrediction", "probability", "prediction")
    model = PipelineModel([*_words(fitted.numFeatures), idf, fitted])
    run = Run(run_id, seed, model, reg_param, val_loss, {})
    if store is None:
        run = replace(run, metrics=classification_metrics(tested).first().asDict())
    else:
        run = store.save(run, tested, parameters)
    weighted.unpersist()
    return run


def train_runs(
    unique: DataFrame,
    n_runs: int = RUNS,
    seed: int = SEED,
    key: str = "article_id",
    reg_params: Sequence[float] = REGULARIZATION,
    max_iter: int = MAX_ITER,
    features: int = FEATURES,
    parallelism: int = 1,
    store: str | None = None,
) -> list[Run]:
    """Runs with seeds ``seed, seed + 1, …`` on a corpus of cleaned, unique texts.

    The fit has no random start, so the seed draws the sample and the split. Words
    are counted and stored once for all runs. ``features`` is the width of the hashed word space,
    which bounds the model and what a fit sends around, whatever the corpus.
    ``parallelism`` runs share the cluster at a time, as in Spark's own tuning; it
    helps where a single fit leaves cores idle. With ``store``, a folder, models, test predictions,
    reports, results and their summary are kept there, and a finished run is read instead of fitted again.
    """
    kept = RunStore(unique.sparkSession, store) if store else None
    parameters = f"runs by {key}, reg_params={[*reg_params]}, max_iter={max_iter}, features={features}"
    done = {seed + i: kept.load(i + 1, seed + i, parameters) for i in range(n_runs) if kept and kept.finished(seed + i)}
    if len(done) == n_runs:
        return list(done.values())
    counts = PipelineModel(_words(features)).transform(unique.select(key, "label", "text"))
    counts = written(counts.select(key, "label", "counts"), "word-counts")

    @inheritable_thread_target(counts.sparkSession)
    def run(i: int) -> Run:
        if seed + i in done:
            return done[seed + i]
        chosen = stratified_split(balance(counts, seed + i, key), seed + i, key)
        return train_run(chosen, i + 1, seed + i, reg_params, max_iter, kept, parameters)

    with ThreadPoolExecutor(parallelism) as pool:
        runs = list(pool.map(run, range(n_runs)))
    if kept:
        kept.summarize(runs)
    return runs


def runs_table(df: DataFrame, runs: Sequence[Run]) -> DataFrame:
    """``(run_id, seed, accuracy, f1, precision, recall)``: one row per run."""
    rows = [(r.run_id, r.seed, *(r.metrics[m] for m in METRICS)) for r in runs]
    return df.sparkSession.createDataFrame(rows, RUN_SCHEMA)
