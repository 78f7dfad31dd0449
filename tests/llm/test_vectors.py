"""Vector search against all pairs in double precision."""

import numpy as np

from delayworks.llm import queries, vectors


def plain(rows, threshold=0.98):
    """rows: (id, vector or None, label). Links and smallest reachable id by brute force."""
    def usable(v, label):
        if label is None or not v or any(x is None for x in v):
            return None
        x = np.array(v, float)
        return x / np.sqrt((x * x).sum()) if np.isfinite(x).all() and x.any() else None

    units = [usable(v, label) for _, v, label in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    low = {}
    for i in range(n):
        if rows[i][0] is not None:
            low[find(i)] = min(low.get(find(i), rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], links[i], low.get(find(i))) for i in range(n)), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def found(df):
    return sorted((tuple(r) for r in vectors.near_duplicates(df).collect()), key=str)


def rounded(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def clusters(seed=0, size=8):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for c in range(60):
        centre = rng.normal(size=size)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((i, (centre + rng.normal(scale=0.08, size=size)).tolist(), int(c % 3)))
            i += 1
    return rounded(rows)


def test_clusters_against_all_pairs(spark):
    rows = clusters()
    assert found(frame(spark, rows).repartition(4)) == plain(rows)


def test_a_dense_group_is_dealt_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=16)
    rows = rounded([(i, (centre + rng.normal(scale=0.02, size=16)).tolist(), 1) for i in range(120)] + [(200 + i, centre.tolist(), 1) for i in range(30)])
    assert found(frame(spark, rows).repartition(3)) == plain(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, [2.0, 4.0], 1), (4, [1.0, 2.0], 2), (5, [1.0, 2.0], None),
            (6, None, 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [], 1),
            (12, [1.0, 2.0, 0.0], 1), (None, [5.0, -1.0], 3), (None, [5.0, -1.0], 3), (13, [-0.0, 1.0], 4), (14, [0.0, 1.0], 4),
            (15, [1e-30, 1e-30], 5), (16, [1e30, 1e30], 5)]
    df = frame(spark, rows).selectExpr("*", "'x' AS id", "'y' AS digest", "1 AS n")
    assert found(df) == plain(rows)
    assert found(df.where("false")) == []


def test_recall_of_the_whole_table(spark, small):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = [tuple(r)[:3] for r in queries.QUERIES["op4_vectors"](spark, small).collect()]
    assert sorted(got, key=str) == plain(rows)


def test_settings_follow_the_number_of_vectors():
    few, many = vectors.settings(1000), vectors.settings(10 ** 9)
    assert few[0] == many[0] and few[1] < many[1] and few[2] < many[2] < 1000
