"""URL filter: a tree of path templates per host, judged by the labels of the pages below.

1. A url is cut into host and path, the path into segments. Numbers, dates and long hex or
   mixed ids are replaced by wildcards of their kind at once, so few shapes stay.
2. Level by level, a node with many different children that rarely repeat turns them into one
   wildcard. What is left is the template tree of the host.
3. Sibling branches whose shares of bad pages do not differ significantly are merged and
   share their labels.
4. A branch is rejected if its share of good pages, smoothed towards its host's, and the
   host's towards that of all labels, is below ``least_purity``.

All steps are DataFrame operations on shapes with counts. A hot host is combined in the tasks
before each shuffle, and pages only meet the verdicts of their shapes in the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .limits import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rules of the contract (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty without ``://`` or for null."""
    after = F.instr(url, "://")
    rest = F.when(after > 0, F.substring(url, after + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits host (or a parent of it) and path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, own_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == own_host) | F.endswith(host, F.lit("." + own_host))) & F.startswith(path, F.lit(own_path))
        name = F.when(fits, own_host + own_path).otherwise(name)
        verdict = F.when(fits, own_verdict).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """The segments with variable kinds as wildcards."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")

    def shape(s: Column) -> Column:
        stem = F.regexp_extract(s, r"^(.*?)(\.[A-Za-z]{2,5})?$", 1)
        return (
            F.when(stem.rlike(r"^\d{4}-\d{2}-\d{2}$"), "{date}")
            .when(stem.rlike(r"^\d+$"), "{n}")
            .when(stem.rlike(r"^[0-9a-fA-F]{8,}$|^[0-9a-fA-F-]{36}$"), "{hex}")
            .when((F.length(s) > 12) & s.rlike(r"\d"), "{id}")
            .otherwise(s)
        )

    return F.transform(parts, shape)


def generalised(shapes: DataFrame, many: int) -> DataFrame:
    """``shapes`` (host, shape, n, good, bad) with ``template``, wildcards put in level by level.

    Children of a node become ``{*}`` if there are more than ``many`` and at least a third of
    all pages below the node are first visits of a child. That ends when no node has more than ``many``
    shapes below it: none of them, and nothing deeper, can have so many children.
    """
    out, level = shapes.select("*", F.lit("").alias("template")), 0
    while True:
        level += 1
        own = F.get("shape", F.lit(level - 1))
        below = out.where(own.isNotNull()).groupBy("host", "template").agg(F.count("*").alias("n"))
        if (below.agg(F.max("n")).first()[0] or 0) <= many:
            rest = F.slice("shape", level, F.greatest(F.size("shape") - level + 1, F.lit(0)))
            tail = F.when(own.isNotNull(), F.concat(F.lit("/"), F.array_join(rest, "/"))).otherwise("")
            return written(out.select(*shapes.columns, F.concat("template", tail).alias("template")), "templates")
        nodes = out.where(own.isNotNull()).groupBy("host", "template", own.alias("child")).agg(F.sum("n").alias("n"))
        nodes = nodes.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("n").alias("pages"))
        wide = nodes.where((F.col("children") > many) & (F.col("children") * 3 >= F.col("pages")))
        out = out.join(wide.select("host", "template", F.lit(True).alias("wide")), ["host", "template"], "left").select(
            *shapes.columns,
            F.when(own.isNull(), F.col("template")).otherwise(
                F.concat("template", F.lit("/"), F.when(F.col("wide"), "{*}").otherwise(own))).alias("template"),
        )
        out = written(out, "templates")


def merged(branches: DataFrame, z: float) -> DataFrame:
    """``branches`` (host, template, good, bad) with ``branch``: similar siblings share a number.

    Siblings are ordered by their smoothed share of good pages. A new branch begins where two
    neighbours differ by more than ``z`` standard errors. Siblings are few: a node with many
    children has one wildcard instead.
    """
    share = (F.col("good") + 1) / (F.col("good") + F.col("bad") + 2)
    spread = share * (1 - share) / (F.col("good") + F.col("bad") + 3)
    parent = F.regexp_replace("template", "/[^/]*$", "")
    siblings = Window.partitionBy("host", "parent").orderBy("share", "template")
    apart = F.abs(F.col("share") - F.lag("share").over(siblings)) > z * F.sqrt(
        F.col("spread") + F.lag("spread").over(siblings))
    rows = branches.select("*", share.alias("share"), spread.alias("spread"), parent.alias("parent"))
    rows = rows.select("*", F.coalesce(apart.cast("int"), F.lit(0)).alias("new"))
    return rows.select("host", "parent", "template", "good", "bad", F.sum("new").over(siblings).alias("branch"))


def judged_templates(pages: DataFrame, *, many: int = 20, z: float = 1.645, weight: float = 10.0,
                     least_purity: float = 0.5) -> DataFrame:
    """``host, shape, template, purity, verdict`` for the shapes of ``pages`` (host, path, label)."""
    good, bad = (F.sum(F.when(F.col("label") == v, 1).otherwise(0)) for v in (1, 0))
    shapes = pages.select("host", segments(F.col("path")).alias("shape"), "label").groupBy("host", "shape").agg(
        F.count("*").alias("n"), good.alias("good"), bad.alias("bad"))
    shapes = written(shapes, "shapes")
    templates = generalised(shapes, many)
    branches = merged(templates.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), z)
    branches = written(branches, "branches")
    total = shapes.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.coalesce(F.sum(F.col("good") + F.col("bad")), F.lit(0)) + 2)).alias("share"))
    hosts = shapes.groupBy("host").agg(F.sum("good").alias("hg"), F.sum(F.col("good") + F.col("bad")).alias("hn"))
    hosts = hosts.join(F.broadcast(total)).select(
        "host", ((F.col("hg") + weight * F.col("share")) / (F.col("hn") + weight)).alias("host_share"))
    pooled = branches.groupBy("host", "parent", "branch").agg(
        F.sum("good").alias("bg"), F.sum(F.col("good") + F.col("bad")).alias("bn"))
    purity = (F.col("bg") + weight * F.col("host_share")) / (F.col("bn") + weight)
    verdicts = branches.join(pooled, ["host", "parent", "branch"]).join(hosts, "host").select(
        "host", "template", purity.alias("purity"),
        F.when(purity < least_purity, "block").otherwise("allow").alias("verdict"))
    return templates.select("host", "shape", "template").join(verdicts, ["host", "template"])


def filter_urls(pages: DataFrame, labels: DataFrame | None = None, *, id_col: str = "page_id", url_col: str = "url",
                rules=RULES, **options) -> DataFrame:
    """``id_col, host, path, rule, verdict, template, purity`` for every row of ``pages``.

    ``labels`` (``id_col``, ``label`` 1 good, 0 bad) may cover some pages; pages of one id count
    with its smallest label. Rules come before templates. A null url, or one without ``://``, has an empty host and
    path and is judged by the labels of its like. Null ids and repeated rows stay; they only
    have no label or the same one. Without any label every template is as pure as the prior
    (one half) and allowed. Other columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(host, F.lit("")).alias("host"),
                        F.coalesce(path, F.lit("")).alias("path"))
    if labels is None:
        rows = rows.select("*", F.lit(None).cast("int").alias("label"))
    else:
        known = labels.select(F.col(id_col).cast("long").alias("id"), "label").groupBy("id").agg(F.min("label").alias("label"))
        rows = rows.join(known, "id", "left")
    rows = written(rows, "pages")
    judged = judged_templates(rows, **options).withColumnRenamed("verdict", "judged")
    rule, ruled = longest_rule(F.col("host"), F.col("path"), rules)
    return rows.select("*", segments(F.col("path")).alias("shape")).join(judged, ["host", "shape"]).select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(ruled, "judged").alias("verdict"),
        "template", "purity")


def url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract of op10. Pages are labelled by the quality of the document of the same number."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("label"))
    return filter_urls(pages, labels)
