import numpy as np

from tillstream.llm import embeddings
from tillstream.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, rep string, kept int"


def brute(rows, threshold=0.98):
    """(n_links, component) per row, rows with an id and a label."""
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    usable = [i for i, (d, v, label) in enumerate(rows) if d is not None and label is not None and ok(v)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in usable}
    for n, i in enumerate(usable):
        for j in usable[n + 1:]:
            if rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[b] = a
    members = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            members.setdefault(find(i), []).append(d)
    return [(d, links[i], None if d is None else min(members[find(i)])) for i, (d, _, _) in enumerate(rows)]


def test_against_brute_force(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    base = rnd.standard_normal((8, 16))
    rows = [(i, (base[i % 8] + rnd.standard_normal(16) * rnd.choice([0, 0.05, 0.2])).tolist(), int(rnd.integers(0, 3))) for i in range(250)]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 16, 1), (303, [float("nan")] + [1.0] * 15, 1), (304, [float("inf")] + [1.0] * 15, 1),
             (305, [None] + [1.0] * 15, 1), (306, rows[0][1], None), (307, rows[0][1], None), (None, rows[0][1], rows[0][2]), (308, [1.0, 2.0], 1), (309, [2.0, 4.0], 1)]
    frame = spark.createDataFrame([(i, v, n, "x", 0) for i, v, n in rows + [rows[1]]], SCHEMA)
    expected = sorted(brute(rows + [rows[1]]), key=repr)
    for tile in (embeddings.TILE, 6):
        monkeypatch.setattr(embeddings, "TILE", tile)
        found = embeddings.near_duplicates(frame).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=repr) == expected
        assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in found)
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []


def test_recall_at_the_threshold(spark):
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(400):  # pairs with a cosine just over 0.98
        a = rnd.standard_normal(32)
        a /= np.linalg.norm(a)
        b = rnd.standard_normal(32)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (0.9801 * a + np.sqrt(1 - 0.9801**2) * b).tolist(), 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert sum(r.n_links > 0 for r in embeddings.near_duplicates(frame).collect()) >= 796


def test_query(spark, sf):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = QUERIES["op10_embedding_near_dup"](spark, sf).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == sorted(brute(rows))
