"""Near-duplicate vectors by NN-descent.

1. Equal vectors become one node with a count. Every node starts with the best of its
   neighbours from a few tables of random hyperplane signs, compared in blocks.
2. NN-descent: the neighbours and reverse neighbours of a node meet each other in a local
   join, and every one of them keeps what is nearer than its farthest neighbour. Rounds go on
   until an audit, exact for a fixed set of nodes against all others, finds enough recall.
3. Lists and rounds are bounded, so links may be left over. An exact check compares all nodes of
   different groups, strip by strip, and joins the groups that it finds linked.
4. Groups are dealt into blocks, and blocks compared with each other count the links of each
   vector. No pair is written out, and no task holds a group.

Candidates are searched in single precision; links are decided in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .graph import components
from .limits import small_enough, written

NEIGHBOURS = 12
TABLES = 6
BLOCK = 256
AUDIT = 256
RECALL = 0.98
ROUNDS = (1, 5)
# Vectors, in bytes of single precision, that a task of the exact check holds.
STRIP_BYTES = 8 << 20
STRIPS = 8
_EDGE = "a long, b long, near float"


def _stacked(column: pa.Array) -> np.ndarray:
    """Vectors of one length, as rows of doubles of length one."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # Scaled first, so that squares neither overflow nor vanish.
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _best(ids: np.ndarray, near: np.ndarray, least: np.ndarray, many: int) -> pa.RecordBatch | None:
    """Up to ``many`` best of each row that beat the row's ``least``."""
    np.fill_diagonal(near, -2.0)
    many = min(many, len(ids) - 1)
    if many < 1:
        return None
    top = np.argpartition(-near, many - 1, axis=1)[:, :many]
    value = np.take_along_axis(near, top, axis=1)
    row, col = np.nonzero((value > least[:, None]) & (ids[top] != ids[:, None]))
    if not len(row):
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[row]), pa.array(ids[top[row, col]]), pa.array(value[row, col].astype(np.float32))], ["a", "b", "near"])


def _signs(tables: int, bits: int):
    """(node, vector) -> one row per table with the signs of ``bits`` random projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                unit = _stacked(part.column(1))
                planes = np.random.default_rng(size).standard_normal((tables * bits, size))
                signs = (unit @ planes.T > 0).reshape(len(unit), tables, bits)
                codes = signs @ (1 << np.arange(bits, dtype=np.int64))
                single = pa.array([v.tobytes() for v in unit.astype(np.float32)], pa.binary())
                for table in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(unit), size * tables + table)), pa.array(codes[:, table]), part.column(0), single],
                        ["kind", "code", "node", "unit"])

    return run


def _in_blocks(many: int):
    """Rows in order of (table, code): neighbours among at most ``BLOCK`` rows at a time."""

    def compared(rows) -> pa.RecordBatch | None:
        unit = np.stack([np.frombuffer(r, np.float32) for _, r in rows])
        return _best(np.array([n for n, _ in rows]), unit @ unit.T, np.full(len(rows), -1.5), many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for kind, node, unit in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if kind != now or len(held) == BLOCK:
                    if len(held) > 1 and (out := compared(held)) is not None:
                        yield out
                    held, now = [], kind
                held.append((node, unit))
        if len(held) > 1 and (out := compared(held)) is not None:
            yield out

    return run


def _local_join(many: int):
    """Rows in order of (center, chunk): members of a neighbourhood meet each other."""

    def met(rows) -> pa.RecordBatch | None:
        seen = {r[0]: r for r in rows}
        ids = np.array(list(seen))
        unit = np.stack([np.frombuffer(r[1], np.float32) for r in seen.values()])
        return _best(ids, unit @ unit.T, np.array([r[2] for r in seen.values()], np.float32), many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for center, chunk, node, unit, least in zip(*columns):
                if (center, chunk) != now:
                    if len(held) > 1 and (out := met(held)) is not None:
                        yield out
                    held, now = [], (center, chunk)
                held.append((node, unit, least))
        if len(held) > 1 and (out := met(held)) is not None:
            yield out

    return run


def nearest(edges: DataFrame, many: int) -> DataFrame:
    """The ``many`` best of each node's list; a list holds a bounded number of candidates."""
    best = edges.groupBy("a", "b").agg(F.max("near").alias("near"))
    order = Window.partitionBy("a").orderBy(F.desc("near"), "b")
    return best.select("*", F.row_number().over(order).alias("place")).where(F.col("place") <= many).drop("place")


def descend(edges: DataFrame, units: DataFrame, many: int) -> DataFrame:
    """One round: neighbours of neighbours become neighbours where they are nearer."""
    last = edges.groupBy("a").agg(F.count("*").alias("n"), F.min("near").alias("least")).select(
        F.col("a").alias("node"), F.when(F.col("n") < many, F.lit(-1.5)).otherwise(F.col("least")).cast("float").alias("least"))
    # A node many others point to has its visitors dealt into chunks; its own list joins each.
    around = edges.select(F.col("b").alias("center"), F.col("a").alias("node"))
    visits = around.groupBy("center").agg(F.count("*").alias("visits"))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("visits") / (4 * many)).cast("int"))
    visitors = around.join(visits, "center").select(
        "center", F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk"), "node")
    own = edges.select(F.col("a").alias("center"), F.col("b").alias("node")).join(visits, "center", "left").select(
        "center", F.explode(F.sequence(F.lit(0), F.coalesce(chunks, F.lit(1)) - 1)).alias("chunk"), "node")
    members = visitors.union(own).join(units, "node").join(last, "node", "left").select(
        "center", "chunk", "node", "unit", F.coalesce("least", F.lit(-1.5).cast("float")).alias("least"))
    met = members.repartition("center", "chunk").sortWithinPartitions("center", "chunk").mapInArrow(_local_join(4), _EDGE)
    return nearest(edges.union(met), many)


def _audited(queries, least: float):
    """Nodes against all queries, in blocks: the true links of the queries."""
    names, vectors = queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = {len(v) for v in vectors}
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy()
            for size in sizes:
                part = batch.filter(pa.array(lengths == size))
                mine = [i for i, v in enumerate(vectors) if len(v) == size]
                if part.num_rows:
                    ids = part.column(0).to_numpy()
                    asked = np.array([names[i] for i in mine])
                    row, col = np.nonzero(_stacked(part.column(1)) @ np.stack([vectors[i] for i in mine]).T >= least)
                    other = ids[row] != asked[col]
                    yield pa.RecordBatch.from_arrays([pa.array(asked[col[other]]), pa.array(ids[row[other]])], ["a", "b"])

    return run


def audit(nodes: DataFrame, groups: DataFrame, least: float, queries: int = AUDIT) -> float:
    """Share of the true links of at most ``queries`` nodes, by hash, that lie inside a group.

    The queries are exact against all nodes. A link inside a group is counted in the end.
    """
    asked = nodes.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(queries).collect()
    if not asked:
        return 1.0
    vectors = [_stacked(pa.array([r["vector"]]))[0] for r in asked]
    true = nodes.select("node", "vector").mapInArrow(_audited(([r["node"] for r in asked], vectors), least), "a long, b long")
    one, two = (groups.select(F.col("id").alias(c), F.col("component").alias(f"g{c}")) for c in "ab")
    met = true.join(one, "a", "left").join(two, "b", "left")
    row = met.agg(F.count("*").alias("n"), F.count_if(F.col("ga") == F.col("gb")).alias("found")).first()
    return row["found"] / row["n"] if row["n"] else 1.0


def _exact(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [float(_stacked(pa.array([x]))[0] @ _stacked(pa.array([y]))[0]) >= least
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _across(least: float):
    """Rows in order of (kind, one, two, side): the strip ``one`` is held while the strip ``two`` passes.

    Of links between the same two groups that are beyond doubt in single precision one is enough; all
    that are in doubt are given out.
    """

    def met(held, rows) -> Iterator[pa.RecordBatch]:
        ids, groups, unit = held
        slack = (unit.shape[1] + 8) * 2.0**-23
        for k in range(0, len(rows[0]), BLOCK):
            mine, own, vectors = (column[k:k + BLOCK] for column in rows)
            near = vectors @ unit.T
            row, col = np.nonzero((near >= least - slack) & (own[:, None] != groups[None, :]))
            if not len(row):
                continue
            sure = near[row, col] >= least + slack
            pairs = np.stack([own[row[sure]], groups[col[sure]]])
            keep = np.concatenate([np.flatnonzero(sure)[np.unique(pairs, axis=1, return_index=True)[1]], np.flatnonzero(~sure)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(mine[row[keep]]), pa.array(ids[col[keep]]), pa.array(sure[keep])], ["a", "b", "sure"])

    def stacked(held):
        return tuple(np.concatenate(column) for column in zip(*held))

    def inside(cell, held) -> Iterator[pa.RecordBatch]:
        if held and cell[1] == cell[2]:
            whole = stacked(held)
            for rows in held:
                yield from met(whole, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, whole = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            nodes, groups, units = batch.column(4).to_numpy(), batch.column(5).to_numpy(), batch.column(6).to_pylist()
            ends = [*(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for start, end in zip([0, *ends], ends if len(keys) else []):
                *cell, side = keys[start].tolist()
                if cell != now:
                    yield from inside(now, held)
                    now, held, whole = cell, [], None
                unit = np.frombuffer(b"".join(units[start:end]), np.float32).reshape(end - start, -1)
                rows = nodes[start:end], groups[start:end], unit
                if side == 0:
                    held.append(rows)
                elif held:
                    whole = whole or stacked(held)
                    yield from met(whole, rows)
        yield from inside(now, held)

    return run


def missed(nodes: DataFrame, units: DataFrame, groups: DataFrame, least: float) -> DataFrame:
    """``a, b``: links between different groups, at least one for each two groups that have any.

    Exact: all nodes of different groups are compared. They are dealt into strips of bounded size, and any
    two strips meet in a task of which one is held: the work is quadratic, memory is not.
    """
    kind = F.octet_length("unit").alias("kind")
    strips = F.greatest(F.ceil(F.col("n") * F.col("kind") / STRIP_BYTES), F.least(F.lit(STRIPS), F.ceil(F.col("n") / 1024)))
    sizes = units.groupBy(kind).agg(F.count("*").alias("n")).select("kind", strips.cast("int").alias("strips"))
    rows = units.join(groups.select(F.col("id").alias("node"), F.col("component").alias("group")), "node", "left").select(
        "node", F.coalesce("group", "node").alias("group"), "unit", kind).join(small_enough(written(sizes, "strips")), "kind")
    strip, other = F.pmod(F.xxhash64("node", F.lit(9)), F.col("strips")).cast("int"), F.col("other")
    cells = rows.select("*", strip.alias("strip"), F.explode(F.sequence(F.lit(0), F.col("strips") - 1)).alias("other")).select(
        "kind", F.least("strip", other).alias("one"), F.greatest("strip", other).alias("two"),
        (F.col("strip") > other).cast("int").alias("side"), "node", "group", "unit")
    cell = ("kind", "one", "two")
    met = cells.repartition(*cell).sortWithinPartitions(*cell, "side").mapInArrow(_across(least), "a long, b long, sure boolean")
    met = written(met, "across")
    doubted = met.where("not sure").join(nodes.select(F.col("node").alias("a"), F.col("vector").alias("x")), "a").join(
        nodes.select(F.col("node").alias("b"), F.col("vector").alias("y")), "b")
    exact = doubted.select("a", "b", "x", "y").mapInArrow(_exact(least), "a long, b long")
    return written(met.where("sure").select("a", "b").union(exact), "missed")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, block, node, times, vector) in order -> blocks of at most ``BLOCK`` vectors."""
    names = ["group", "ids", "times", "units"]

    def block(rows) -> pa.RecordBatch:
        unit = _stacked(pa.array([r[2] for r in rows]))
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]]), pa.array([np.array([r[0] for r in rows]).tobytes()], pa.binary()),
             pa.array([np.array([r[1] for r in rows]).tobytes()], pa.binary()), pa.array([unit.tobytes()], pa.binary())], names)

    held, now = [], None
    for batch in batches:
        for group, part, node, times, vector in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if (group, part) != now or len(held) == BLOCK:
                if held:
                    yield block(held)
                held, now = [], (group, part)
            held.append((node, times, vector))
    if held:
        yield block(held)


def _counted(least: float):
    """Pairs of blocks -> how many vectors each node of the one links to in the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, other = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["other_ids"], np.int64)
                x = np.frombuffer(row["units"], np.float64).reshape(len(ids), -1)
                y = np.frombuffer(row["other_units"], np.float64).reshape(len(other), -1)
                linked = (x @ y.T >= least) & (ids[:, None] != other[None, :])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array((linked @ np.frombuffer(row["other_times"], np.int64)).astype(np.int64))], ["node", "links"])

    return run


def _links_inside(nodes: DataFrame, groups: DataFrame, least: float) -> DataFrame:
    """``node, links``: how many vectors of its group each node links to."""
    members = groups.select(F.col("id").alias("node"), F.col("component").alias("group")).join(nodes, "node")
    size = groups.groupBy(F.col("component").alias("group")).agg(F.count("*").alias("size"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("size") / (BLOCK // 2)).cast("int"))
    dealt = members.join(size, "group").select(
        "group", F.pmod(F.xxhash64("node", F.lit(5)), parts).cast("int").alias("part"), "node", "times", "vector")
    blocks = written(
        dealt.repartition("group", "part").sortWithinPartitions("group", "part").mapInArrow(
            _packed, "group long, ids binary, times binary, units binary"), "blocks")
    other = blocks.select("group", *[F.col(c).alias(f"other_{c}") for c in ("ids", "times", "units")])
    met = blocks.join(other, "group").drop("group")
    return written(met.mapInArrow(_counted(least), "node long, links long"), "counted", 16).groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, least: float = 0.9,
                 many: int = NEIGHBOURS, tables: int = TABLES) -> DataFrame:
    """``id_col, n_links, component_id, kept``, a row per row of ``vectors``.

    Links are pairs with a cosine of at least ``least``. A null id or vector, an empty or zero
    vector, and one with a null or non-finite component link with nothing; so do vectors of
    different length. ``component_id`` is then the row's own id. Repeated ids keep their rows;
    equal vectors are one node and link with each other. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.select("id", F.when(sound, F.transform("vector", lambda x: x + F.lit(0).cast("float"))).alias("vector"))
    rows = written(rows.select("id", "vector", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")).alias("node")), "vectors")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.first("vector").alias("vector"), F.count("*").alias("times"), F.min("id").alias("least_id"))
    nodes = written(nodes, "nodes")
    bits = max(1, (nodes.count() // (BLOCK // 2)).bit_length())
    signed = nodes.select("node", "vector").mapInArrow(_signs(tables, bits), "kind long, code long, node long, unit binary")
    signed = written(signed, "signed")
    units = signed.where(f"kind % {tables} = 0").select("node", "unit")
    sorted_ = signed.repartitionByRange("kind", "code", "node").sortWithinPartitions("kind", "code", "node")
    edges = written(nearest(sorted_.mapInArrow(_in_blocks(many), _EDGE), many), "neighbours")
    for done in range(1, ROUNDS[1] + 1):
        edges = written(descend(edges, units, many), "neighbours")
        close = edges.where(F.col("near") >= least - 1e-3).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = close.join(nodes.select(F.col("node").alias("a"), F.col("vector").alias("x")), "a").join(
            nodes.select(F.col("node").alias("b"), F.col("vector").alias("y")), "b")
        links = written(pairs.select("a", "b", "x", "y").mapInArrow(_exact(least), "a long, b long"), "links")
        groups = written(components(links), "groups")
        if done >= ROUNDS[0] and audit(nodes, groups, least) >= RECALL:
            break
    rest = missed(nodes, units, groups, least)
    if not rest.isEmpty():
        groups = written(components(groups.select(F.col("id").alias("a"), F.col("component").alias("b")).union(rest)), "groups")
    inside = _links_inside(nodes.select("node", "times", "vector"), groups, least)
    roots = nodes.select("node", "least_id").join(groups.select(F.col("id").alias("node"), "component"), "node", "left").select(
        "node", "least_id", F.coalesce("component", "node").alias("component"))
    smallest = roots.groupBy("component").agg(F.min("least_id").alias("smallest"))
    known = roots.join(smallest, "component").join(inside, "node", "left").join(nodes.select("node", "times"), "node").select(
        "node", "smallest", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("found"))
    return rows.join(known, "node", "left").select(
        F.col("id").alias(id_col), F.coalesce("found", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("smallest", "id").alias("component_id"),
        (F.coalesce("smallest", "id") == F.col("id")).alias("kept"))


def embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract of op8: all embeddings, cosine 0.9."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
