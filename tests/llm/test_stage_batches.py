"""What the pipeline's stages return passes no whole text through workers in large batches."""

import pytest

import corpus_pipeline as pipeline
from pressmill.llm import jaccard
from tests.llm.test_pipeline import tables  # noqa: F401

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [name for name, _ in pipeline.STAGES])
def test_stages_return_no_python_over_texts(spark, tables, name):  # noqa: F811
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = dict(pipeline.STAGES)[name](spark, docs, tables)
    assert "MapInArrow" not in plan(out)


def test_tokens_are_counted_in_small_batches(spark, tables, monkeypatch):  # noqa: F811
    """The bit maps of tokens come by one job over all texts; workers report their largest batch."""
    largest, docs = spark.sparkContext.accumulator(0), spark.createDataFrame(
        [(i, f"w{i} is one of many words") for i in range(3000)], "doc_id long, text string").coalesce(1)
    seen, blobs = [], jaccard._token_blobs

    def watched(*args):
        run = blobs(*args)

        def counted(batches):
            def noted():
                for batch in batches:
                    largest.add(batch.num_rows > 1000)
                    yield batch
            yield from run(noted())

        seen.append(args)
        return counted

    monkeypatch.setattr(jaccard, "_token_blobs", watched)
    before = spark.conf.get(BATCH)
    jaccard.token_flags(docs, "text", 3, True, jaccard.FREQUENT, jaccard.FLAG_BITS)
    assert seen and largest.value == 0 and spark.conf.get(BATCH) == before
