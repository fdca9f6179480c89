import math
import random

import numpy as np
import pytest

from wearcast.llm import near_vectors as N


def frame(spark, rows, entry="float"):
    return spark.createDataFrame([(i, v, l, 7, "x") for i, v, l in rows],
                                 f"vec_id long, embedding array<{entry}>, label int, copies int, node string")


def cosine(x, y):
    x, y = ([a / max(map(abs, v)) for a in v] for v in (x, y))  # squares of tiny entries would vanish
    return sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x)) / math.sqrt(sum(b * b for b in y))


def usable(v, label):
    return label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)


def brute(rows, threshold, cast=float):
    rows = [(i, None if v is None else [None if c is None else float(cast(c)) for c in v], l) for i, v, l in rows]
    parent, n = list(range(len(rows))), [0] * len(rows)

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            (_, x, l), (_, y, m) = rows[a], rows[b]
            if l == m and usable(x, l) and usable(y, m) and len(x) == len(y) and cosine(x, y) >= threshold:
                n[a] += 1
                n[b] += 1
                parent[root(a)] = root(b)
    first = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            first[root(k)] = min(first.get(root(k), i), i)
    return sorted(((i, n[k], first.get(root(k)), i == first.get(root(k))) for k, (i, _, _) in enumerate(rows)), key=str)


def clusters(seed, groups, size, dim, noise):
    rng = np.random.default_rng(seed)
    rows, i = [], 100
    for g in range(groups):
        base = rng.normal(size=dim)
        for _ in range(size):
            v = base + rng.normal(size=dim) * noise * rng.uniform(0.2, 2)
            rows.append((i, (v * 10.0 ** rng.integers(-3, 4)).tolist(), int(g % 3)))
            i += 1
    random.Random(seed).shuffle(rows)
    return rows


NASTY = [(1, None, 0), (2, [], 0), (3, [0.0] * 8, 0), (4, [1.0] * 7 + [None], 0), (5, [float("nan")] * 8, 0),
         (6, [float("inf")] + [1.0] * 7, 0), (7, [1.0] * 8, None), (8, [1.0] * 8, None), (9, [1.0] * 5, 0),
         (10, [2.0] * 5, 0), (None, [3.0] * 5, 0), (None, [-1.0] * 6, 1), (11, [1.0] * 8, 2), (11, [1.0] * 8, 2),
         (12, [1.0] * 8, 1), (13, [-1.0] * 8, 2), (11, [-2.0] * 8, 2), (14, [0.0, -0.0] + [5e-324] * 6, 1)]


@pytest.mark.parametrize("entry,noise,tile", [("float", 0.15, 1 << 20), ("double", 0.3, 40 * 64), ("double", 0.22, 9 * 64)])
def test_equals_brute_force(spark, entry, noise, tile):
    rows = NASTY + clusters(int(noise * 100), 9, 25, 8, noise)
    if entry == "float":
        rows = [r for r in rows if r[0] != 14]  # no such float
    got = N.near_duplicates(frame(spark, rows, entry), tile_bytes=tile)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    have = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got.collect()), key=str)
    assert have == brute(rows, 0.93, np.float32 if entry == "float" else float)


def test_sql_says_the_same(spark):
    import duckdb
    import pyarrow as pa

    rows = [r for r in NASTY if r[0] not in (None, 11, 14)] + clusters(8, 7, 12, 8, 0.2)
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": [r[0] for r in rows], "label": pa.array([r[2] for r in rows], pa.int32()),
                                         "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))}))
    got = N.near_duplicates(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted(con.execute(N.SQL).fetchall())
    assert sum(r["n_links"] for r in got) > 100


def test_copies_count_as_links(spark):
    v = [0.3, -0.2, 0.9, 0.1]
    rows = [(i, v, 1) for i in range(40, 10, -1)] + [(99, [0.3, -0.2, 0.9, 0.11], 1), (98, v, 2)]
    got = {r["vec_id"]: r for r in N.near_duplicates(frame(spark, rows)).collect()}
    assert all(got[i]["n_links"] == 30 and got[i]["component_id"] == 11 and got[i]["kept"] == (i == 11)
               for i in [*range(11, 41), 99])
    assert got[98]["n_links"] == 0 and got[98]["kept"]


def test_bounds_hold_and_few_pairs_are_computed_again():
    rng = np.random.default_rng(5)
    for d in (3, 64, 1500):
        m = np.concatenate([rng.normal(size=(300, d)), rng.normal(size=(40, 1)) * np.ones(d)])
        m[:100] += 4 * rng.normal(size=d)
        t = N.Tile(m)
        exact = t.unit @ t.unit.T
        near = N._products(t.codes, t.codes) * t.step[:, None] * t.step
        gap = t.error[:, None] + (1 + t.error[:, None]) * t.error
        assert (np.abs(exact - near) <= gap + 1e-12).all() and gap.max() < 0.1
        found = {(i, j) for a, b in N.links(t, None, 0.93) for i, j in zip(a.tolist(), b.tolist())}
        assert found == {(i, j) for i, j in zip(*np.nonzero(exact >= 0.93)) if i < j}


def test_connect_joins_chains():
    rng = np.random.default_rng(2)
    root = np.arange(3000)
    order = rng.permutation(3000)
    cut = rng.permutation(2999)
    for part in np.array_split(cut[:2900], 7):
        root = N.connect(root, order[part], order[part + 1])
    assert len(np.unique(root)) == 100
    for c in np.unique(root):
        assert c == np.flatnonzero(root == c).min()


def test_empty_table(spark):
    assert N.near_duplicates(frame(spark, [])).collect() == []
