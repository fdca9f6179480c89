import json
import math

import numpy as np
import pandas as pd
import pytest

from wearcast.operators import trees as H

COLS = ["a", "b", "c", "d"]


def table(spark, n=500, seed=0, parts=3, holes=False):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"reading_id": [f"r{i}" for i in range(n)], "a": rng.normal(size=n).round(1), "b": rng.uniform(0, 9, n),
                        "c": rng.integers(0, 4, n).astype(float), "d": 1.0})
    z = pdf.a + (pdf.b > 6) * 2 * (pdf.c - 1) + rng.normal(size=n) * 0.3
    pdf["target"] = (z > 1.2).astype("int32")
    pdf["weight"] = np.where(pdf.target == 1, 3.25, 0.75)
    pdf["fold"] = rng.integers(0, 3, n).astype("int32")
    if holes:
        pdf.loc[::17, "a"] = np.nan
        pdf.loc[5::50, "target"] = np.nan
    return pdf, spark.createDataFrame(pdf).repartition(parts)


def local(pdf, edges, weight=True):
    pdf = pdf[pdf.target.isin([0, 1])]
    x = np.stack([np.searchsorted(e, pdf[c].to_numpy(float)) for c, e in zip(COLS, edges)]).astype(np.uint8)
    return x, pdf.target.to_numpy(int), pdf.weight.to_numpy() if weight else np.ones(len(pdf))


def newton(x, y, w, s, edges):
    """Second-order boosting by plain loops: nested (feature, bin, left, right) or a leaf value."""
    margin, out = np.zeros(len(y)), []
    w = w * np.where(y == 1, s.scale_pos_weight, 1)
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)

        def grow(rows, depth):
            G, H_ = g[rows].sum(), h[rows].sum()
            best = None
            if depth < s.max_depth:
                for f in range(len(x)):
                    for b in range(max(map(len, edges))):
                        left = rows[x[f, rows] <= b]
                        right = rows[x[f, rows] > b]
                        hl, hr = h[left].sum(), h[right].sum()
                        if hl < s.min_child_weight or hr < s.min_child_weight:
                            continue
                        gain = 0.5 * (g[left].sum() ** 2 / (hl + s.reg_lambda) + g[right].sum() ** 2 / (hr + s.reg_lambda)
                                      - G**2 / (H_ + s.reg_lambda))
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, f, b, left, right)
            if best is None or best[0] - s.gamma <= 1e-9:
                value = -s.learning_rate * G / (H_ + s.reg_lambda)
                margin[rows] += value
                return value
            return best[1], best[2], grow(best[3], depth + 1), grow(best[4], depth + 1)

        out.append(grow(np.arange(len(y)), 0))
    return out, margin


def nested(tree, node=0):
    if tree.left[node] < 0:
        return tree.value[node]
    return tree.feature[node], tree.bin[node], nested(tree, tree.left[node]), nested(tree, tree.left[node] + 1)


def alike(a, b, tol=1e-6):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return abs(a - b) <= tol
    return a[:2] == b[:2] and alike(a[2], b[2], tol) and alike(a[3], b[3], tol)


@pytest.mark.parametrize("spw,gamma,lam,weighted", [(1.0, 0.0, 1.0, False), (4.5, 0.3, 0.5, False), (0.1, 0.0, 2.0, True)])
def test_boosting_equals_plain_newton_steps(spark, spw, gamma, lam, weighted):
    pdf, df = table(spark)
    s = H.Boosting(rounds=6, max_depth=3, subsample=1.0, colsample_bytree=1.0, scale_pos_weight=spw, gamma=gamma,
                   reg_lambda=lam, learning_rate=0.3)
    data = H.binned(df, COLS, "target", "weight" if weighted else None)
    trees = H.boost(data, s)
    x, y, w = local(pdf, data.edges, weighted)
    want, margin = newton(x, y, w, s, data.edges)
    assert len(trees) == 6 and all(alike(nested(t), v) for t, v in zip(trees, want))
    p = H.Scorer(H.to_json(trees, data.edges, "boosted"))(pdf[COLS].to_numpy(float))
    assert np.allclose(p, 1 / (1 + np.exp(-margin)), atol=1e-6)
    assert np.mean((p > 0.5) == y) > 0.8


def test_fits_do_not_depend_on_partitions_and_sampling_works(spark):
    s, f = H.Boosting(rounds=8, max_depth=4), H.Forest(trees=6, max_depth=6, features=2)
    made = []
    for parts in (1, 5):
        pdf, df = table(spark, 700, 3, parts, holes=True)
        edges = None if not made else made[0][2]
        data = H.binned(df, COLS, "target", "weight", edges=edges)
        assert data.rows == int(pdf.target.isin([0, 1]).sum())
        made.append((H.to_json(H.boost(data, s), data.edges, "boosted"),
                     H.to_json(H.grow_forests(data, [(f, None)])[0], data.edges, "forest"), data.edges))
    assert made[0][0] == made[1][0] and made[0][1] == made[1][1]
    used = {tuple(sorted(set(t["feature"]) - {-1})) for t in json.loads(made[0][0])["trees"]}
    assert all(len(u) <= 3 for u in used) and len(used) > 1  # 0.8 of four columns: three a tree
    block = H.Block(np.zeros((1, 40_000), np.uint8), np.zeros(40_000, np.uint8), np.ones(40_000), np.zeros(40_000, np.int32),
                    np.arange(40_000).astype(np.uint64))
    assert abs(len(H._rows_of(block, s, 1)) / 40_000 - 0.8) < 0.01
    bag = H._copies(block, f, 1, None)
    assert abs(bag.mean() - 1) < 0.03 and abs((bag == 0).mean() - math.exp(-1)) < 0.01
    assert (bag != H._copies(block, f, 2, None)).any()


def cart(x, y, w, n, subsets, f):
    """A weighted Gini tree by plain loops; subsets(path) gives a node's features."""

    def gini(r):
        c = np.array([(w[r] * n[r])[y[r] == k].sum() for k in (0, 1)])
        return (c**2).sum() / c.sum() if c.sum() > 0 else 0.0

    def grow(r, depth, path):
        c = np.array([(w[r] * n[r])[y[r] == k].sum() for k in (0, 1)])
        best = None
        if depth < f.max_depth and len(r) >= f.min_split and c.min() > 0:
            for j in subsets(path):
                for b in range(int(x.max())):
                    left, right = r[x[j, r] <= b], r[x[j, r] > b]
                    if min(len(left), len(right)) < f.min_leaf:
                        continue
                    gain = gini(left) + gini(right) - gini(r)
                    if best is None or gain > best[0] + 1e-7:
                        best = (gain, j, b, left, right)
        if best is None:
            return c[1] / c.sum()
        return int(best[1]), best[2], grow(best[3], depth + 1, 2 * path), grow(best[4], depth + 1, 2 * path + 1)

    return grow(np.flatnonzero(n), 0, 1)


@pytest.mark.parametrize("bootstrap,features,split,leaf", [(False, 4, 2, 1), (True, 2, 5, 2), (True, 2, 9, 4)])
def test_forest_equals_plain_trees(spark, bootstrap, features, split, leaf):
    pdf, df = table(spark, 300, 1)
    f = H.Forest(trees=4, max_depth=5, min_split=split, min_leaf=leaf, features=features, bootstrap=bootstrap)
    data = H.binned(df, COLS, "target", "weight", fold="fold")
    got = H.grow_forests(data, [(f, None), (f, 1)])
    whole = data.blocks.collect()
    block = H.Block(np.concatenate([b.x for b in whole], 1), *[np.concatenate([getattr(b, c) for b in whole])
                                                              for c in ("y", "w", "fold", "key")])
    for held, forest in zip((None, 1), got):
        for number, tree in enumerate(forest):
            def subsets(path, number=number):
                t = H.Tree(path=[path])
                return H._subsets(t, [0], len(COLS), f, number)[0].tolist()

            n = H._copies(block, f, number, held)
            assert alike(nested(tree), cart(block.x, block.y, block.w, n, subsets, f)), (held, number)


def test_cut_trees_are_the_trees_of_other_settings(spark):
    _, df = table(spark, 600, 2)
    data = H.binned(df, COLS, "target", "weight", fold="fold")
    deep = H.grow_forests(data, [(H.Forest(trees=5, max_depth=8, min_split=2, min_leaf=1, features=2), None)])[0]
    for depth, split in ((8, 2), (4, 2), (8, 12), (3, 25)):
        own = H.grow_forests(data, [(H.Forest(trees=5, max_depth=depth, min_split=split, min_leaf=1, features=2), None)])[0]
        assert [nested(t) for t in own] == [nested(t.cut(depth, split)) for t in deep]


def test_forests_that_differ_in_the_leaf_minimum_share_the_sums_of_common_nodes(spark, monkeypatch):
    _, df = table(spark, 600, 4)
    data = H.binned(df, COLS, "target", "weight", fold="fold")
    settings = [H.Forest(trees=4, max_depth=6, min_split=2, min_leaf=k, features=2) for k in (1, 5)]
    asked, plain = [], H._subsets
    monkeypatch.setattr(H, "_subsets", lambda tree, nodes, *a: asked.append(len(nodes)) or plain(tree, nodes, *a))
    together = H.grow_forests(data, [(f, 1) for f in settings])
    shared, asked[:] = sum(asked), []
    alone = [H.grow_forests(data, [(f, 1)])[0] for f in settings]
    assert [[nested(t) for t in forest] for forest in together] == [[nested(t) for t in forest] for forest in alone]
    assert shared < 0.9 * sum(asked)


def test_one_walk_serves_all_cuts_and_only_asked_branches(spark):
    _, df = table(spark, 600, 2)
    data = H.binned(df, COLS, "target", "weight", fold="fold")
    x = np.concatenate([b.x for b in data.blocks.collect()], axis=1)
    for tree in H.grow_forests(data, [(H.Forest(trees=3, max_depth=8, min_split=2, min_leaf=1, features=2), None)])[0]:
        ends = H._places(tree.arrays(), x)
        for depth, split in ((8, 2), (4, 2), (8, 12), (3, 25), (0, 2)):
            own = tree.cut(depth, split).arrays()
            assert np.array_equal(H._stops(tree, depth, split)[ends], own[3][H._places(own, x)])
        some = np.unique(ends)[::3]
        part = H._places(H._toward(tree, some), x)
        assert np.array_equal(np.isin(ends, some), np.isin(part, some)) and (part[np.isin(part, some)] == ends[np.isin(ends, some)]).all()


def test_grid_has_a_score_for_every_setting_and_fold(spark):
    pdf, df = table(spark, 600, 4)
    data = H.binned(df, COLS, "target", "weight", fold="fold")
    grid = [H.Forest(trees=t, max_depth=d, min_split=m, min_leaf=k, features=2)
            for t in (3, 6) for d in (2, 6) for m in (2, 40) for k in (1, 20)]
    got = H.grid_search(data, grid)
    assert len(got.test) == len(got.train) == 16 * 3
    for f, k in list(got.test)[::7]:
        trees = H.grow_forests(data, [(f, k)])[0]
        assert [nested(t) for t in trees] == [nested(t) for t in got.trees(f, k)]
        p = H.Scorer(H.to_json(trees, data.edges, "forest"))(pdf[COLS].to_numpy(float)) > 0.5
        for part, counts in ((pdf.fold != k, got.train), (pdf.fold == k, got.test)):
            cell = pdf.target[part] * 2 + p[part]
            assert np.bincount(cell, minlength=4).tolist() == counts[f, k]
    distinct = {tuple(map(tuple, [got.test[f, k] for k in got.folds])) for f in grid}
    assert len(distinct) > 8  # the settings differ in effect


def test_degenerate_tables(spark):
    _, df = table(spark, 50, 5)
    for part in (df.limit(0), df.where("target = 0"), df.withColumns({c: df["d"] for c in COLS})):
        data = H.binned(part, COLS, "target", "weight")
        p = H.Scorer(H.to_json(H.boost(data, H.Boosting(rounds=2)), data.edges, "boosted"))(np.ones((3, 4)))
        q = H.Scorer(H.to_json(H.grow_forests(data, [(H.Forest(trees=2), None)])[0], data.edges, "forest"))(np.ones((3, 4)))
        assert np.isfinite(p).all() and ((q >= 0) & (q <= 1)).all()


def test_tree_table_and_importances(spark):
    _, df = table(spark)
    data = H.binned(df, COLS, "target")
    trees = H.boost(data, H.Boosting(rounds=3, max_depth=2))
    rows = H.tree_table(spark, H.to_json(trees, data.edges, "boosted"), COLS).collect()
    assert len(rows) == sum(len(t.left) for t in trees)
    assert all((r["left_child"] is None) == (r["feature"] is None) for r in rows)
    imp = H.importances(trees, 4)
    assert imp.sum() == pytest.approx(1) and imp[3] == 0 and imp.max() == max(imp[:3])


def test_partitions_follow_the_cores_and_sums_travel_without_empty_cells(spark):
    """A pass over many rows used to have a task for 5,000 of them, each with a dense table of all nodes."""
    many = spark.sparkContext.parallelize(range(600), 300)
    assert H.few(many, 1e9, H.PART_ROWS).getNumPartitions() == H.PARTS_PER_CORE * spark.sparkContext.defaultParallelism
    rng, nodes, bins = np.random.default_rng(0), 400, 64
    x, place = rng.integers(0, bins, (5, 90)).astype(np.uint8), rng.integers(0, nodes, 90)
    feats = np.stack([rng.choice(5, 2, replace=False) for _ in range(nodes)])
    y, w = rng.integers(0, 2, 90), rng.integers(1, 9, 90).astype(float)
    whole, parts = H._no_sums(nodes, 2, bins, 3), []
    for rows in np.array_split(np.arange(90), 3):
        stats = [np.where(y[rows] == 0, w[rows], 0), np.where(y[rows] == 1, w[rows], 0), None]
        H._add_sums(whole, x, rows, place[rows], feats, bins, stats)
        own = H._no_sums(nodes, 2, bins, 3)
        H._add_sums(own, x, rows, place[rows], feats, bins, stats)
        parts.append(H._packed(own))
    assert np.array_equal(H._unpacked(parts), whole)
    assert all(len(at) <= 60 and values.shape == (len(at), 3) for _, at, values in parts)
    by_node = H._by_node(whole, bins)
    for i in (0, 17, 89):
        for s in (0, 1):
            f = feats[place[i], s]
            alike_ = (place == place[i]) & (x[f] == x[f, i])
            assert by_node[place[i], s, x[f, i]].tolist() == [w[alike_ & (y == 0)].sum(), w[alike_ & (y == 1)].sum(), alike_.sum()]


def test_margins_go_on_from_the_round_before(spark, monkeypatch):
    """Stored blocks used to apply all trees from the first again."""
    _, df = table(spark, 400, 6)
    data, made = H.binned(df, COLS, "target"), []
    for every in (1, 3, 50):
        monkeypatch.setattr(H, "REBASE_EVERY", every)
        made.append(H.to_json(H.boost(data, H.Boosting(rounds=8, max_depth=3)), data.edges, "boosted"))
    assert made[0] == made[1] == made[2]
    blocks = list(H._joined(iter(data.blocks.collect())))
    assert len(blocks) == 1 and len(blocks[0].y) == 400
