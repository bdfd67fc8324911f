"""Readers of newspaper dumps.

A dump of any size is read by as many tasks as it has splits. The reader cuts a file behind
every line that ends in front of a mark, so a piece starts behind a mark and ends with a whole
line: all delimiters are whole inside one piece or are the cut itself, and a piece is split
into blocks where it was scanned. Two things need more than one piece, a mark with text behind
it on its line, which is no delimiter, and a byte order mark, which the reader drops. One narrow pass
finds the files that have either, from a small row for each split; only their pieces are touched again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import metadata as meta
from ..functions.blanks import fold_newlines
from ..functions.fixed import DEFAULT_EXCLUDED_CATEGORIES
from ..operators.articles import DELIMITER_LINE, corpus_rows, has_body, parse_blocks
from ..session import broadcast_if_small, written

MARK = "<***>"
CUT = "\n" + MARK
BOM = chr(0xFEFF)

# Blanks that do not end a line, with or without a line end behind them.
_REST_OF_LINE = r"\A[\t\x0b\x0c\x1c-\x1f\x85\p{Z}]*(?:[\r\n]|\z)"
# The place of a piece in its file, then of a block in its piece.
_PLACE = ("path", "cut", "seq")
PLACE = ("cut", "seq", "inner")


def _text(value: Column) -> Column:
    """Invalid bytes become U+FFFD; any newline becomes \\n."""
    return fold_newlines(F.make_valid_utf8(value))


def _reader(spark: SparkSession, recursive: bool):
    reader = spark.read.option("pathGlobFilter", "*.txt")
    return reader.option("recursiveFileLookup", "true") if recursive else reader


def file_path() -> Column:
    """The path of a scanned file, as a condition that is settled when files are listed."""
    return meta.decoded_path(F.col("_metadata.file_path"))


def list_files(
    spark: SparkSession,
    paths: str | list[str],
    recursive: bool = True,
    files: Column | None = None,
    suffix: str = "txt",
) -> DataFrame:
    """``(path, n_bytes)`` of every file, from the listing alone."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    found = reader.load(paths)
    if files is not None:
        found = found.where(files)
    return found.select(file_path().alias("path"), F.col("length").alias("n_bytes"))


def scan_dumps(
    spark: SparkSession,
    paths: str | list[str],
    recursive: bool = True,
    strip_bom: bool = False,
    files: Column | None = None,
) -> DataFrame:
    """Dump files as rows ``(path, value)``: one ``.txt`` file or a tree of them.

    A byte order mark stays in the text by default; it hides a delimiter that
    stands right behind it. ``files`` is a condition on ``file_path()``.
    """
    value = _text(F.col("value"))
    if strip_bom:
        value = F.regexp_replace(value, rf"\A{BOM}", "")
    scan = _reader(spark, recursive).text(paths, wholetext=True)
    if files is not None:
        scan = scan.where(files)
    return scan.select(file_path().alias("path"), value.alias("value"))


def scan_pieces(
    spark: SparkSession,
    paths: str | list[str],
    recursive: bool = True,
    files: Column | None = None,
) -> DataFrame:
    """The raw text between cuts, with its split (``cut``) and its order in it (``seq``).

    ``files`` stands below the row numbers, so files that it rules out are never opened.
    Cuts are ASCII and never part a character.
    """
    scan = _reader(spark, recursive).text(paths, lineSep=CUT)
    if files is not None:
        scan = scan.where(files)
    return scan.select(
        file_path().alias("path"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_block_start").alias("cut"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
        F.col("value").rlike(_REST_OF_LINE).alias("opens"),
    )


def _odd_files(pieces: DataFrame) -> DataFrame:
    """Files with a byte order mark, with stray marks, or with a mark at their very end.

    What the reader left out of a file is the cuts, three bytes of a byte order mark and a cut at the
    very end. The first piece of a file (``first``) has no mark in front of it and opens a block anyway.
    """
    splits = pieces.groupBy("path", "cut").agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length("value")).alias("n_bytes"),
        F.max("file_bytes").alias("file_bytes"),
        F.count_if(~F.col("opens")).alias("strays"),
        F.min("seq").alias("first"),
        F.min_by("opens", "seq").alias("first_opens"),
    )
    start = F.col("cut") == 0
    files = splits.groupBy("path").agg(
        F.max(F.when(start, F.col("first"))).alias("first"),
        F.max("file_bytes").alias("file_bytes"),
        (F.max("file_bytes") - F.sum("n_bytes") - len(CUT) * (F.sum("n") - 1)).alias("unread"),
        (F.sum("strays") - F.count_if(start & ~F.col("first_opens"))).alias("strays"),
    )
    return files.select(
        "path",
        "first",
        "file_bytes",
        F.col("unread").isin(3, 3 + len(CUT)).alias("has_bom"),
        (F.col("strays") > 0).alias("has_strays"),
        (F.col("unread") >= len(CUT)).alias("ends_with_mark"),
    ).where("has_bom or has_strays or ends_with_mark")


def _heads(pieces: DataFrame) -> DataFrame:
    """``(path, cut, seq, head)`` of the pieces that stray marks tie together.

    ``head`` is the place of the piece with which the text begins. Windows run over flags, within
    one split and then over one row for each split of a file.
    """
    flags = pieces.select(*_PLACE, "opens")
    in_split = Window.partitionBy("path", "cut").orderBy("seq")
    own = F.last(F.when(F.col("opens"), F.col("seq")), ignorenulls=True).over(in_split)
    ties = ~F.col("opens") | ~F.coalesce(F.lead("opens").over(in_split), F.lit(True))
    last = F.lead("seq").over(in_split).isNull()
    flags = flags.select(*_PLACE, "opens", own.alias("own"), ties.alias("ties"), last.alias("last"))

    by_split = Window.partitionBy("path").orderBy("cut")
    place = F.struct("cut", F.col("tail").alias("seq"))
    splits = flags.groupBy("path", "cut").agg(
        F.max("own").alias("tail"), F.min_by("opens", "seq").alias("first_opens")
    )
    before = by_split.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "path",
        "cut",
        F.last(F.when(F.col("tail").isNotNull(), place), ignorenulls=True).over(before).alias("earlier"),
        F.coalesce(~F.lead("first_opens").over(by_split), F.lit(False)).alias("goes_on"),
    )
    head = F.when(F.col("own").isNotNull(), F.struct("cut", F.col("own").alias("seq"))).otherwise(F.col("earlier"))
    return (
        flags.join(splits, ["path", "cut"])
        .where(F.col("ties") | (F.col("last") & F.col("goes_on")))
        .select(*_PLACE, head.alias("head"))
    )


def read_units(
    spark: SparkSession,
    paths: str | list[str],
    recursive: bool = True,
    strip_bom: bool = False,
    files: Column | None = None,
) -> DataFrame:
    """``(path, cut, seq, value)``: texts that begin and end with whole blocks.

    Bodies stay where they are scanned. Only pieces that stray marks tie together are brought
    together, by a join with their places.
    """
    pieces = scan_pieces(spark, paths, recursive, files)
    odd = written(_odd_files(pieces), "odd-files")
    kinds = odd.agg(
        *(F.bool_or(c).alias(c) for c in ("has_bom", "has_strays", "ends_with_mark"))
    ).first()
    units = pieces.select(*_PLACE, "value", "opens")
    if kinds["ends_with_mark"]:  # the empty text behind it
        last = odd.where("ends_with_mark").select("path", F.col("file_bytes").alias("cut"))
        units = units.unionByName(
            last.select("*", F.lit(0).cast("long").alias("seq"), F.lit("").alias("value"), F.lit(True).alias("opens"))
        )
    if not strip_bom:
        starts = odd.where("has_bom").select("path", F.lit(0).alias("cut"), F.col("first").alias("seq"), F.lit(BOM).alias("bom"))
        if kinds["has_bom"]:
            units = units.join(broadcast_if_small(written(starts, "starts")), [*_PLACE], "left").select(
                *_PLACE, F.concat(F.coalesce("bom", F.lit("")), "value").alias("value"), "opens"
            )
        # Of a file that holds nothing else the reader makes no row.
        lone = F.col("_metadata.file_size") == len(BOM.encode())
        lone = lone if files is None else lone & files
        if not list_files(spark, paths, recursive, lone).isEmpty():
            whole = _reader(spark, recursive).text(paths, wholetext=True).where(lone)
            place = (file_path().alias("path"), F.lit(0).alias("cut"), F.lit(0).alias("seq"), "value", F.lit(True).alias("opens"))
            units = units.unionByName(whole.select(*place).where(F.col("value") == BOM))
    if not kinds["has_strays"]:
        return units.drop("opens")
    tied = odd.where("has_strays").select("path", "first")
    tied = pieces.select(*_PLACE, "opens").join(broadcast_if_small(tied), "path")
    first = (F.col("cut") == 0) & (F.col("seq") == F.col("first"))
    heads = written(_heads(tied.withColumn("opens", F.col("opens") | first)), "tied-pieces")
    units = units.join(broadcast_if_small(heads), [*_PLACE], "left")
    # Both passes must see the same splits; a stray piece that the first one did not place says otherwise.
    lost = F.col("head").isNull() & ~F.col("opens") & (F.col("cut") > 0)
    sure = F.when(lost, F.raise_error(F.lit("the splits of a dump changed while it was read"))).otherwise(F.col("value"))
    alone = units.where("head is null").select(*_PLACE, sure.alias("value"))
    part = F.struct("cut", "seq", "value")
    joined = (
        units.where("head is not null")
        .groupBy("path", "head")
        .agg(F.sort_array(F.collect_list(part)).alias("parts"))
        .select("path", "head.cut", "head.seq", F.array_join("parts.value", CUT).alias("value"))
    )
    return alone.unionByName(joined)


def read_blocks(
    spark: SparkSession,
    paths: str | list[str],
    recursive: bool = True,
    strip_bom: bool = False,
    files: Column | None = None,
    positions: bool = False,
) -> DataFrame:
    """Blocks ``(path, cut, seq, inner, block)`` of all files.

    ``cut, seq, inner`` is the order of blocks in their file. ``positions`` adds ``pos``, which counts them
    from 0; that takes a second narrow pass, and a join with the place of every text.
    ``files`` is a condition on ``file_path()``; other files are not opened.
    """
    units = read_units(spark, paths, recursive, strip_bom, files)
    parts = F.split(_text(F.col("value")), DELIMITER_LINE)
    if not positions:
        return units.select(*_PLACE, F.posexplode(parts).alias("inner", "block"))
    in_split = Window.partitionBy("path", "cut").orderBy("seq")
    sizes = units.select(*_PLACE, F.size(parts).alias("n"))
    sizes = sizes.withColumn("upto", F.sum("n").over(in_split))
    splits = sizes.groupBy("path", "cut").agg(F.sum("n").alias("total"))
    earlier = Window.partitionBy("path").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("path", "cut", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    places = sizes.join(splits, ["path", "cut"]).select(*_PLACE, (F.col("before") + F.col("upto") - F.col("n")).alias("base"))
    placed = units.join(broadcast_if_small(written(places, "places")), [*_PLACE])
    blocks = placed.select(*_PLACE, "base", F.posexplode(parts).alias("inner", "block"))
    return blocks.withColumn("pos", (F.col("base") + F.col("inner")).cast("int")).drop("base")


def count_blocks(blocks: DataFrame) -> DataFrame:
    """``(path, n_blocks, n_articles)``: blocks of every file, and those that have a body."""
    return (
        blocks.select("path", has_body(F.col("block")).alias("_body"))
        .groupBy("path")
        .agg(F.count("*").alias("n_blocks"), F.count_if("_body").alias("n_articles"))
    )


def read_articles(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """Parsed articles with their place (see ``read_blocks`` for the options)."""
    if list_files(spark, paths, options.get("recursive", True)).isEmpty():
        raise FileNotFoundError(f"no .txt files found in {paths}")
    return parse_blocks(read_blocks(spark, paths, **options))


def load_dumps(
    spark: SparkSession,
    paths: str | list[str],
    label: int | None,
    include_title: bool = False,
    **options,
) -> DataFrame:
    """Corpus rows of one dump file or a tree of them, all of one class."""
    return corpus_rows(read_articles(spark, paths, **options), label, include_title)


def _has_folders(spark: SparkSession, base: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(path) and any(entry.isDirectory() for entry in files.listStatus(path))


def load_categories(
    spark: SparkSession,
    base: str,
    label: int | None = 0,
    exclude: set[str] | tuple[str, ...] | None = None,
    include_title: bool = False,
    default_source: str | None = None,
    fallback: bool = True,
) -> DataFrame:
    """Corpus rows of a folder with one subfolder per category.

    Only files directly in a subfolder count. With ``fallback``, a base folder
    without any subfolder is a category itself. ``exclude=None`` leaves out the default
    categories, an empty set none. Excluded folders are never opened: the category
    comes from the file's path, which Spark looks at when it lists the files.
    """
    excluded = DEFAULT_EXCLUDED_CATEGORIES if exclude is None else tuple(exclude)
    category = meta.folder_of(file_path())
    options = {"recursive": False, "files": ~category.isin(*excluded) if excluded else None}
    try:
        blocks = read_blocks(spark, f"{base}/*/*.txt", **options)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        blocks = None
        if fallback and not _has_folders(spark, base):
            try:
                blocks = read_blocks(spark, f"{base}/*.txt", **options)
            except AnalysisException as inner:
                if inner.getCondition() != "PATH_NOT_FOUND":
                    raise
    if blocks is None:
        raise FileNotFoundError(f"no .txt files in the category folders of {base}")
    blocks = blocks.withColumn("category", meta.folder_of(F.col("path")))
    articles = parse_blocks(blocks)
    # Stops at the first article; no row is exchanged for it.
    if articles.select("path").isEmpty():
        raise FileNotFoundError(f"no articles in the category folders of {base}")
    return corpus_rows(articles, label, include_title, default_source)
