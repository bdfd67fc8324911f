"""Removal of runs of lines that occur earlier in the corpus, by winnowing.

A unit is a line without the blanks around it; blank lines are skipped. Of every ``window``
consecutive lines the smallest line hash is selected, so any two equal runs of at least that
many lines select the same fingerprint at the same place. Selected fingerprints are joined by
their hash; places where the lines around them agree too are extended both ways, line by line,
to maximal runs. Of equal runs the earliest stays, the others are deleted.

Matching shares the machinery of the substring operator: windows travel with their selected
minimum, copies inside a stretch of texts are settled there, and neighbouring matches that go
on from each other are one run. A line is identified by its 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .limits import inner_names, small_enough, written
from .substrings import candidate_runs, key_of
from .words import split_lines

WINDOW = 2


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = WINDOW) -> DataFrame:
    """``doc, start, end, ref_doc, ref_start``: later runs of lines and an earlier place of them.

    Lines are counted from 0 without blank ones; ``end`` is exclusive. Runs may overlap. A null
    id counts as the smallest; null and empty texts have no lines.
    """
    rows = docs.select(key_of(id_col).alias("doc"), F.col(text_col).alias("text"))
    runs = candidate_runs(rows, window, anchor_size=1, by=split_lines)
    return runs.select("doc", "start", (F.col("start") + F.col("len") + window - 1).alias("end"), "ref_doc", "ref_start")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["kept", "n_lines", "n_removed"]
    for batch in batches:
        texts, spans = batch.column("run_text"), batch.column("run_spans").to_pylist()
        kept, count, removed = [], [], []
        for text, own in zip(texts, spans):
            lines = [] if not text.is_valid else text.as_buffer().to_pybytes().split(b"\n")
            solid = [k for k, line in enumerate(lines) if line.strip(b" \t\n\v\f\r")]
            gone = {solid[i] for span in own or () for i in range(span["start"], span["end"])}
            count.append(len(solid))
            removed.append(len(gone))
            kept.append(b"\n".join(line for k, line in enumerate(lines) if k not in gone).decode() if text.is_valid else None)
        others = [i for i, f in enumerate(batch.schema) if f.name not in ("run_text", "run_spans")]
        columns = [pa.array(kept, pa.string()), pa.array(count, pa.int64()), pa.array(removed, pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in others] + columns, [batch.schema[i].name for i in others] + names)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = WINDOW,
                carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns of ``carry``, ``kept, n_lines, n_removed``: every row less its later runs.

    ``kept`` is null for a null text. Rows with null or repeated ids stay; rows of one id are
    places of one document. Columns that are not carried are not read; a carried column may have any
    name but that of a result, which is an error.
    """
    if {"kept", "n_lines", "n_removed"} & set(carry):
        raise ValueError("a carried column has the name of a result")
    spans = repeated_runs(docs, id_col, text_col, window=window)
    spans = written(spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("run_spans")), "line-spans")
    into, inner, back = inner_names([id_col, *[c for c in carry if c != id_col]])
    rows = docs.select(key_of(id_col).alias("doc"), *into, F.col(text_col).alias("run_text"))
    rows = rows.join(small_enough(spans, F.size("run_spans")), "doc", "left").drop("doc")
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in inner)
    kept = rows.mapInArrow(_kept, f"{kinds}, kept string, n_lines long, n_removed long")
    return kept.select(*back, "kept", "n_lines", "n_removed")


def line_dedup(spark, sf_dir: str) -> DataFrame:
    """op9: every document with its kept lines (digest) and how many lines went."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return written(kept, "line-digests")  # whole texts pass through workers in small batches
