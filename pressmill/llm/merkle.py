"""Merkle manifest of a table: a digest for every row, a proof that it belongs to the root.

Rows are the leaves of one tree for each value of a column; every ``FAN`` neighbours become
one node until one is left, the subroot of the tree. The subroots are the leaves of one more tree.

Leaves are numbered within their tree (a range partitioning and one count for each partition and
tree, no window over a tree) and belong to superblocks of ``FAN ** DEPTH`` neighbours. Up: a
superblock becomes the nodes above it, down to one, in one task; these are dealt into
superblocks again until every tree has one node. Down: each superblock is cogrouped with the one
row it needs from outside, the siblings of its own top node up to the root, and joins
them behind the siblings inside. So a task holds one superblock, whatever the size of a tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .limits import small_enough, written

FAN = 8
DEPTH = 3
HEX = 64  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(values: Sequence[Column]) -> Column:
    """sha256 over ``-`` for null, else the bytes of the value as text, a colon and the value."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)), 256)


def levels_of(nodes: Sequence[str], depth: int, fan: int = FAN) -> list[list[str]]:
    """The nodes and what stands above them, at most ``depth`` levels and until one is left."""
    levels = [list(nodes)]
    while len(levels) <= depth:
        own = levels[-1]
        levels.append([digest(own[k : k + fan]) for k in range(0, len(own), fan)])
    return levels


def _height(size: int, fan: int = FAN) -> int:
    height = 0
    while size > 1:
        size, height = -(-size // fan), height + 1
    return height


# A proof as text: for each level the place in its run and the siblings, as in "2|ab…cd…;0|;".
def step(run: Sequence[str], place: int) -> str:
    return f"{place}|{''.join(run[:place])}{''.join(run[place + 1 :])};"


def siblings(proof: str) -> str:
    """All siblings of a proof, level by level, left to right."""
    return "".join(level.split("|")[1] for level in proof.split(";")[:-1])


def folded(node: str, proof: str) -> str:
    """The root that a node and a proof give."""
    for level in proof.split(";")[:-1]:
        place, others = level.split("|")
        at = int(place) * HEX
        node = digest((others[:at], node, others[at:]))
    return node


def numbered(rows: DataFrame, tree: str | None, order: Sequence[str]) -> DataFrame:
    """Adds ``pos``, from 0 in each tree by ``order``, and ``size``, the rows of the tree. Stored.

    Rows equal in all of ``order`` come in any order. Nulls come first, strings by bytes.
    """
    keys = [*([tree] if tree else []), *order]
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(width, *keys).sortWithinPartitions(*keys)
    dealt = written(dealt.withColumn("seq", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("seq", 33).alias("part")
    group = [tree] if tree else []
    counts = dealt.groupBy(*group, part).agg(F.count("*").alias("n"), F.min("seq").alias("least"))
    whole = Window.partitionBy(*group)
    counts = counts.select(
        *(F.col(c).alias("of_tree") for c in group), F.col("part").alias("of_part"), "least",
        F.sum("n").over(whole).alias("size"),
        (F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    same = F.shiftright("seq", 33) == F.col("of_part")
    if tree:
        same &= F.col(tree).eqNullSafe(F.col("of_tree"))
    placed = dealt.join(small_enough(written(counts, "merkle-parts")), same)
    return placed.select(*rows.columns, (F.col("before") + F.col("seq") - F.col("least")).alias("pos"), "size")


def _frame(columns: dict[str, Iterable]) -> pd.DataFrame:
    """Columns as plain objects: Arrow-backed strings may come in several chunks, which Spark rejects."""
    return pd.DataFrame({name: pd.Series(list(values), dtype=object) for name, values in columns.items()})


def _block(depth: int) -> Column:
    return F.expr(f"pos div {FAN**depth}").alias("block")


def climbed(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One node for each superblock of trees with more than one node, numbered in their tree."""

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        tree, pos, size = (int(rows[c].iloc[0]) for c in ("tree", "pos", "size"))
        up = min(depth, _height(size))
        top = levels_of(rows["node"].tolist(), up)[-1]
        return _frame({"tree": [tree], "pos": [pos // FAN**depth], "size": [-(-size // FAN**up)], "node": top})

    grouped = nodes.where("size > 1").groupBy("tree", _block(depth))
    return grouped.applyInPandas(reduce, "tree long, pos long, size long, node string")


def _inner(nodes: Sequence[str], size: int, depth: int) -> list[str]:
    """The part of each node's proof that lies in its superblock."""
    up = min(depth, _height(size))
    levels = levels_of(nodes, up)
    proofs = [""] * len(nodes)
    for k in range(up):
        runs = [levels[k][lo : lo + FAN] for lo in range(0, len(levels[k]), FAN)]
        steps = [step(run, place) for run in runs for place in range(len(run))]
        proofs = [p + steps[i // FAN**k] for i, p in enumerate(proofs)]
    return proofs


def descended(nodes: DataFrame, outer: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(tree, pos, proof)`` of nodes, given ``(tree, pos, proof)`` of what stands above their superblocks."""

    def joined(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        inner = _inner(rows["node"].tolist(), int(rows["size"].max()) if len(rows) else 1, depth)
        rest = above["proof"].iloc[0] if len(rows) else ""
        return _frame({"tree": rows["tree"], "pos": rows["pos"], "proof": [p + rest for p in inner]})

    blocks = nodes.groupBy("tree", _block(depth))
    return blocks.cogroup(outer.groupBy("tree", "pos")).applyInPandas(joined, "tree long, pos long, proof string")


def ascent(leaves: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """The leaves and the stored tables of nodes above them; the last has only trees' single nodes."""
    levels = [leaves.select("tree", "pos", "size", "node")]
    while not levels[-1].where("size > 1").isEmpty():
        levels.append(written(climbed(levels[-1], depth), "merkle-nodes"))
    return levels


def manifest(docs: DataFrame, key: str = "doc_id", tree: str = "lang", fields: Sequence[str] = FIELDS,
             tampered: dict[str, Column] | None = None, depth: int = DEPTH) -> DataFrame:
    """``(key, leaf, subroot, root, proof, proof_sha256, folded_root, verified)`` for every row.

    Leaves stand in the order of ``key`` in their tree, rows with one key in the order of their
    digests; trees in the order of their values, null first. Null keys come first. ``proof`` is text
    for ``folded``. ``tampered`` replaces columns before the leaf is computed that is
    folded with the original proof; by default nothing is replaced and all rows verify. Repeated rows are
    leaves of their own; other columns of ``docs`` are not read; no rows give no rows.
    """
    claimed = [(tampered or {}).get(name, F.col(name)) for name in fields]
    leaves = docs.select(F.col(key).alias("key"), F.col(tree).alias("name"),
                         leaf_digest([F.col(f) for f in fields]).alias("node"), leaf_digest(claimed).alias("claim"))
    leaves = numbered(written(leaves, "merkle-leaves"), "name", ["key", "node", "claim"])
    trees = numbered(written(leaves.groupBy("name").agg(F.count("*").alias("n")), "merkle-trees"), None, ["name"])
    trees = written(trees.select("name", F.col("pos").alias("tree"), F.col("size").alias("trees")), "merkle-trees")
    same = F.col("name").eqNullSafe(F.col("tree_name"))
    # Pandas has no column of whole numbers with nulls, so keys go through it as text.
    leaves = leaves.join(small_enough(trees.withColumnRenamed("name", "tree_name")), same).select(
        "tree", "pos", "size", "node", F.col("key").cast("string").alias("key"), "claim", "trees")
    leaves = written(leaves, "merkle-leaves")

    ups = ascent(leaves, depth)
    subroots = ups[0].where("size = 1").select("tree", "node")
    for nodes in ups[1:]:
        subroots = subroots.unionByName(nodes.where("size = 1").select("tree", "node"))
    subroots = subroots.join(trees.select("tree", "trees"), "tree")
    subroots = written(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"),
                                       F.col("trees").alias("size"), "node"), "merkle-subroots")
    tops = ascent(subroots, depth)
    root = tops[-1].where("size = 1").select(F.col("node").alias("root"))

    def proofs(levels: list[DataFrame], outer: DataFrame) -> DataFrame:
        """Proofs of the lowest nodes; ``outer`` has the proofs of trees' single nodes at position 0."""
        at = outer
        for nodes in reversed(levels[1:]):
            below = descended(nodes.where("size > 1"), at, depth)
            done = nodes.where("size = 1").join(outer.select("tree", "proof"), "tree").select("tree", "pos", "proof")
            at = written(below.unionByName(done), "merkle-proofs")
        if len(levels) > 1:  # trees of one leaf have nothing above it
            alone = levels[0].where("size = 1").select("tree").join(outer, "tree")
            at = at.unionByName(alone.select("tree", "pos", "proof"))
        return at

    none = subroots.select("tree", F.lit(0).cast("long").alias("pos"), F.lit("").alias("proof")).distinct()
    above = descended(subroots, proofs(tops, none), depth)
    own = above.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "proof")
    own = written(own, "merkle-trees")
    outer = proofs(ups, own)
    facts = subroots.select(F.col("pos").alias("tree"), F.col("node").alias("subroot")).join(F.broadcast(root))
    outer = written(outer.join(small_enough(written(facts, "merkle-facts")), "tree"), "merkle-outer")
    columns = ("key", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified")

    def finished(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        if not len(rows):
            return _frame(dict.fromkeys(columns, ()))
        nodes, top = rows["node"].tolist(), above.iloc[0]
        proof = [p + top["proof"] for p in _inner(nodes, int(rows["size"].iloc[0]), depth)]
        fold = [folded(claim, p) for claim, p in zip(rows["claim"], proof)]
        return _frame({
            "key": rows["key"], "leaf": nodes, "subroot": [top["subroot"]] * len(rows), "root": [top["root"]] * len(rows), "proof": proof,
            "proof_sha256": [digest([siblings(p)]) for p in proof], "folded_root": fold,
            "verified": [f == top["root"] for f in fold]})

    blocks = leaves.groupBy("tree", _block(depth)).cogroup(outer.groupBy("tree", "pos"))
    rows = blocks.applyInPandas(finished, "key string, leaf string, subroot string, root string, proof string, "
                                          "proof_sha256 string, folded_root string, verified boolean")
    return rows.select(F.col("key").cast(docs.schema[key].dataType).alias(key), *columns[1:])


def merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Contract of op13: texts of every third document are lower-cased before verification."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = F.when(chosen, F.translate("text", letters, letters.lower())).otherwise(F.col("text"))
    rows = manifest(docs, tampered={"text": changed})
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _field_sql(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE_SQL = rf"""
WITH RECURSIVE crcs AS (
    SELECT DISTINCT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
        string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
            lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
    FROM documents),
changed AS (
    SELECT d.doc_id, source, lang, n_chars, text, CASE WHEN crc % 3 = 0
        THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other
    FROM documents d LEFT JOIN crcs c ON c.doc_id = d.doc_id),
leaves AS (
    SELECT doc_id, lang, {_leaf_sql("text")} AS leaf, {_leaf_sql("other")} AS claim FROM changed),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS pos,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree
    FROM leaves),
nodes AS (
    SELECT tree, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM placed
    UNION ALL
    SELECT tree, level, pos, node, count(*) OVER (PARTITION BY tree) FROM (
        SELECT tree, level + 1 AS level, pos // {FAN} AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node
        FROM nodes WHERE n > 1 GROUP BY tree, level, pos // {FAN})),
upper AS (
    SELECT 0 AS level, tree - 1 AS pos, node, count(*) OVER () AS n FROM nodes WHERE n = 1
    UNION ALL
    SELECT level, pos, node, count(*) OVER () FROM (
        SELECT level + 1 AS level, pos // {FAN} AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node
        FROM upper WHERE n > 1 GROUP BY level, pos // {FAN})),
runs AS (
    SELECT tree, level, pos, n, node FROM nodes WHERE n > 1
    UNION ALL
    SELECT tree, h.height + u.level, u.pos, u.n, u.node
    FROM upper u JOIN (SELECT tree, max(level) AS height FROM nodes GROUP BY tree) h
        ON u.pos = (h.tree - 1) // power({FAN}, u.level)::BIGINT OR u.pos // {FAN} = (h.tree - 1) // power({FAN}, u.level + 1)::BIGINT
    WHERE u.n > 1),
heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
path AS (
    SELECT p.tree, p.pos AS leaf_pos, r.level,
           CASE WHEN r.level < h.height THEN p.pos // power({FAN}, r.level)::BIGINT
                ELSE (p.tree - 1) // power({FAN}, r.level - h.height)::BIGINT END AS at
    FROM placed p JOIN heights h ON h.tree = p.tree JOIN (SELECT DISTINCT tree, level FROM runs) r ON r.tree = p.tree),
sides AS (
    SELECT q.tree, q.leaf_pos, q.level,
           coalesce(string_agg(r.node, '' ORDER BY r.pos) FILTER (r.pos < q.at), '') AS lhs,
           coalesce(string_agg(r.node, '' ORDER BY r.pos) FILTER (r.pos > q.at), '') AS rhs
    FROM path q JOIN runs r ON r.tree = q.tree AND r.level = q.level AND r.pos // {FAN} = q.at // {FAN}
    GROUP BY ALL),
proofs AS (
    SELECT tree, leaf_pos, sha256(string_agg(lhs || rhs, '' ORDER BY level)) AS proof_sha256, count(*) AS steps
    FROM sides GROUP BY ALL),
folds AS (
    SELECT tree, pos, 0 AS level, claim AS node FROM placed
    UNION ALL
    SELECT f.tree, f.pos, f.level + 1, sha256(s.lhs || f.node || s.rhs)
    FROM folds f JOIN sides s ON s.tree = f.tree AND s.leaf_pos = f.pos AND s.level = f.level)
SELECT doc_id, leaf, (SELECT any_value(node) FROM nodes t WHERE t.tree = p.tree AND t.n = 1) AS subroot,
       (SELECT node FROM upper WHERE n = 1) AS root,
       coalesce(proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root,
       f.node = (SELECT node FROM upper WHERE n = 1) AS verified
FROM placed p LEFT JOIN proofs o ON o.tree = p.tree AND o.leaf_pos = p.pos
JOIN folds f ON f.tree = p.tree AND f.pos = p.pos AND f.level = coalesce(o.steps, 0)
"""
