import numpy as np

from pressmill.llm.embeddings import audit, embedding_near_dedup, near_vectors


def brute(rows, least=0.9):
    good = [(i, np.array(v, float) / np.linalg.norm(np.array(v, float))) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    parent, links = {k: k for k in range(len(good))}, [0] * len(good)

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for k, (_, x) in enumerate(good):
        for m, (_, y) in enumerate(good[:k]):
            if len(x) == len(y) and x @ y >= least:
                links[k] += 1
                links[m] += 1
                parent[find(k)] = find(m)
    least_id = {}
    for k, (i, _) in enumerate(good):
        least_id[find(k)] = min(least_id.get(find(k), i), i)
    return {(i, links[k], least_id[find(k)]) for k, (i, _) in enumerate(good)}


def test_groups_of_all_sizes(spark):
    rng, rows = np.random.default_rng(1), []
    for size in (1, 2, 3, 40, 300):
        for _ in range(3 if size < 40 else 1):
            center = rng.standard_normal(24)
            center /= np.linalg.norm(center)
            rows += [(c + 0.06 * rng.standard_normal(24)).tolist() for c in [center] * size]
    rows += [rng.standard_normal(24).tolist() for _ in range(400)]
    order = rng.permutation(len(rows))
    rows = [(int(i), [float(np.float32(x)) for x in rows[k]]) for i, k in enumerate(order)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as node", "2 as label")
    got = {(r.vec_id, r.n_links, r.component_id) for r in near_vectors(df).collect()}
    assert got == brute(rows)


def test_links_beyond_full_lists(spark):
    """Lists of the nearest are full of copies, so no list holds a link to the other clump."""
    rng, rows = np.random.default_rng(4), []
    one, two, far = np.linalg.qr(rng.standard_normal((24, 3)))[0].T
    for center in (one, 0.93 * one + np.sqrt(1 - 0.93**2) * two, far):
        rows += [(center + 0.002 * rng.standard_normal(24)).tolist() for _ in range(40)]
    rows += [rng.standard_normal(24).tolist() for _ in range(1500)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r.vec_id, r.n_links, r.component_id) for r in near_vectors(df).collect()}
    assert got == brute(rows)
    assert {(n, c) for i, n, c in got if i < 80} == {(79, 0)}
    # Lists of one neighbour from one table leave still more over.
    got = {(r.vec_id, r.n_links, r.component_id) for r in near_vectors(df.where("vec_id < 200"), many=1, tables=1).collect()}
    assert got == brute(rows[:200])


def test_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]),
            (8, [float("inf"), 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [0.0, 1.0]), (11, [0.0, -1.0]),
            (12, [1e30, 1e30]), (13, [1e-30, 1e-30])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.vec_id or -1, r.n_links, r.component_id or -1, bool(r.kept)) for r in near_vectors(df).collect())
    want = [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (12, 1, 12, True), (13, 1, 12, False), (-1, 0, -1, False)]
    want += [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 11)]
    assert got == sorted(want)
    assert near_vectors(df.limit(0)).count() == 0


def test_audit_counts_missing_links(spark):
    nodes = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])], "node long, vector array<float>")
    none = spark.createDataFrame([], "id long, component long")
    both = spark.createDataFrame([(1, 1), (2, 1)], "id long, component long")
    assert audit(nodes, none, 0.9) == 0.0 and audit(nodes, both, 0.9) == 1.0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {(r.vec_id, r.n_links, r.component_id) for r in embedding_near_dedup(spark, sf_dir).collect()}
    assert got == brute(rows)
