"""CSV tables, mixed folders and stored splits."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import metadata as meta
from ..functions.fixed import CSV_NULLS
from ..operators.articles import corpus_rows, parse_blocks
from ..operators.filters import complete, require_columns
from ..session import broadcast_if_small, stored
from .dumps import PLACE, count_blocks, file_path, list_files, read_blocks

# Quoted cells may hold line ends, and a quote inside is doubled.
CSV_FORMAT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

INTEGERS = ("label", "year")


# A quoted cell, in which a comma is text.
_QUOTED = r'"(?:[^"]|"")*"'
_ROW_BITS = 33


def _csv_reader(spark: SparkSession, recursive: bool):
    reader = spark.read.option("pathGlobFilter", "*.csv")
    return reader.option("recursiveFileLookup", "true") if recursive else reader


def csv_headers(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> DataFrame:
    """``(path, header)``: the column names of every file that has a first line. Stored.

    In a session of its own no two files share a task, so the first row of the task
    that reads a file's beginning is its header; nothing is sorted, shuffled or brought to the driver
    but the greatest number of columns.
    """
    own = spark.newSession()
    own.conf.set(
        "spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    lines = _csv_reader(own, recursive).text(paths).select(
        file_path().alias("path"), F.col("_metadata.file_block_start").alias("cut"), row.alias("row"), "value"
    )
    first = lines.where("cut = 0 and row = 0").select("path", F.col("value").alias("line"))
    bare = F.regexp_replace("line", _QUOTED, "")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    first = stored(spark, first.withColumn("n", cells), "csv-headers")
    width = first.agg(F.max("n")).first()[0] or 1
    # The reader of one line as a table of that many columns.
    parsed = F.from_csv("line", ", ".join(f"c{i} string" for i in range(width)), CSV_FORMAT | {"header": "false"})
    names = F.array(*(F.coalesce(parsed[f"c{i}"], F.lit(f"_c{i}")) for i in range(width)))
    return first.select("path", F.slice(names, 1, F.col("n")).alias("header"))


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    recursive: bool = False,
    year_from_name: bool = False,
) -> DataFrame:
    """CSV files of any mix of headers, joined by column name, with ``path`` and ``pos``.

    ``label`` and ``year`` become integers, all else stays text. With
    ``year_from_name`` a file without a ``year`` column gets the number before the
    first underscore of its name; a null year in a file that has one stays null.
    A row with too few cells is filled up with nulls, one with too many raises.

    Files are read by place, in one scan; rows learn their file's header by its name. Cells may hold line
    ends (a CRLF is read as LF where rows end in CRLF too), so a CSV file cannot be cut: each is
    read by one task. Large corpora should be stored as Parquet.
    """
    headers = csv_headers(spark, paths, recursive)
    kinds = sorted(tuple(r.header) for r in headers.select("header").distinct().collect())
    if not kinds:
        raise FileNotFoundError(f"no .csv files found in {paths}")
    width = max(map(len, kinds)) + 1  # one more, to see cells that have no column
    number = F.coalesce(
        *(F.when(F.col("header") == F.array(*map(F.lit, kind)), F.lit(i)) for i, kind in enumerate(kinds))
    )
    headers = headers.select("path", number.alias("_kind"))
    scan = (
        _csv_reader(spark, recursive)
        .options(**CSV_FORMAT)
        .schema(", ".join(f"_c{i} string" for i in range(width)))
        .csv(paths, multiLine=True, mode="PERMISSIVE")
    )
    rows = scan.select(
        file_path().alias("path"), F.monotonically_increasing_id().alias("pos"), *scan.columns
    ).join(broadcast_if_small(headers), "path")
    kind = F.col("_kind")

    def of_kind(value: Callable[[tuple[str, ...]], Column | None]) -> Column:
        found = [(i, value(names)) for i, names in enumerate(kinds)]
        return F.coalesce(*(F.when(kind == i, v) for i, v in found if v is not None), F.lit(None))

    surplus = of_kind(lambda names: F.coalesce(*(f"_c{i}" for i in range(len(names), width))))
    too_long = F.raise_error(F.concat(F.lit("more cells than columns in "), F.col("path"))).cast("boolean")
    rows = rows.where(F.when(surplus.isNull(), True).otherwise(too_long))

    def cell(name: str) -> Column:
        value = of_kind(lambda names: F.col(f"_c{names.index(name)}") if name in names else None)
        value = F.when(~value.isin(*CSV_NULLS), value)
        return meta.as_int(value) if name in INTEGERS else value

    columns = {name: cell(name) for kind_ in kinds for name in kind_}
    if year_from_name:
        prefix = F.split(meta.stem_of(F.col("path")), "_")[0].try_cast("int")
        given = [i for i, names in enumerate(kinds) if "year" in names]
        columns["year"] = F.when(kind.isin(*given), columns["year"]).otherwise(prefix) if given else prefix
    return rows.select("path", "pos", *(c.alias(name) for name, c in columns.items()))


def unlabelled_dumps(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, n_bytes)`` of dumps whose name tells no class, from the file listing alone."""
    label = meta.label_from_stem(meta.stem_of(F.col("path")))
    return list_files(spark, folder).where(label.isNull())


def _place(*numbers: str) -> Column:
    """A text that sorts like the numbers."""
    return F.concat_ws(".", *(F.lpad(F.col(n).cast("string"), 20, "0") for n in numbers))


def read_mixed(spark: SparkSession, folder: str, txt_label: int | None = None) -> DataFrame:
    """All CSV tables and dumps below a folder as one corpus.

    The class of a dump is ``txt_label`` or told by its file name; other dumps are
    left out without being opened (see ``unlabelled_dumps``). ``kind, path, pos`` is
    the load order: CSV before dumps, then by path, then by place in the file.
    """
    frames = []
    try:
        tables = read_csv(spark, folder, recursive=True).withColumn("pos", _place("pos"))
        frames.append(tables.withColumn("kind", F.lit(0)))
    except FileNotFoundError:
        pass
    files = list_files(spark, folder)

    def label(path: Column) -> Column:
        return F.lit(txt_label) if txt_label is not None else meta.label_from_stem(meta.stem_of(path))

    if not files.where(label(F.col("path")).isNotNull()).isEmpty():
        named = None if txt_label is not None else label(file_path()).isNotNull()
        articles = parse_blocks(read_blocks(spark, folder, files=named))
        rows = corpus_rows(articles, label(F.col("path")))
        frames.append(rows.select("*", _place(*PLACE).alias("pos"), F.lit(1).alias("kind")).drop(*PLACE))
    if not frames:
        raise FileNotFoundError(f"no CSV tables or labelled dumps found in {folder}")
    corpus = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return require_columns(corpus, "text", "label")


def file_counts(spark: SparkSession, folder: str, txt_label: int | None = None) -> DataFrame:
    """``(path, kind, n_blocks, n_articles, n_rows)`` of every file that ``read_mixed`` takes.

    Blocks and articles of dumps, rows of CSV tables (null for the other kind); Spark does not list files
    without a byte. One narrow pass, combined in the tasks: one row for each file and task is shuffled.
    """
    none = F.lit(None).cast("long")
    frames = []
    try:
        rows = read_csv(spark, folder, recursive=True).groupBy("path").agg(F.count("*").alias("n_rows"))
        found = list_files(spark, folder, suffix="csv").join(rows, "path", "left")
        frames.append(found.select("path", F.lit("csv").alias("kind"), none.alias("n_blocks"),
                                   none.alias("n_articles"), F.coalesce("n_rows", F.lit(0)).alias("n_rows")))
    except FileNotFoundError:
        pass
    label = None if txt_label is not None else meta.label_from_stem(meta.stem_of(file_path())).isNotNull()
    listed = list_files(spark, folder, files=label)
    if not listed.isEmpty():
        found = listed.join(count_blocks(read_blocks(spark, folder, files=label)), "path", "left")
        frames.append(found.select("path", F.lit("dump").alias("kind"), F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"),
                                   F.coalesce("n_articles", F.lit(0)).alias("n_articles"), none.alias("n_rows")))
    if not frames:
        raise FileNotFoundError(f"no CSV tables or labelled dumps found in {folder}")
    return reduce(DataFrame.unionByName, frames)


SPLITS = ("train", "val", "test")


def read_splits(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """``(text, label, split)`` of a stored corpus without incomplete rows.

    Reads what ``write_splits`` wrote, or one CSV file per split.
    """
    frames, missing = [], []
    for split in SPLITS:
        try:
            if fmt == "parquet":
                frame = spark.read.parquet(f"{folder}/split={split}")
            else:
                try:
                    frame = read_csv(spark, f"{folder}/split={split}")
                except AnalysisException:
                    frame = read_csv(spark, f"{folder}/{split}.csv")
        except (AnalysisException, FileNotFoundError):
            missing.append(split)
            continue
        frames.append(
            complete(require_columns(frame, "text", "label")).select(
                "text", F.col("label").cast("int").alias("label"), F.lit(split).alias("split")
            )
        )
    if missing:
        raise FileNotFoundError(f"missing splits in {folder}: {missing}")
    return reduce(DataFrame.unionByName, frames)
