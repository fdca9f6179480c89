import numpy as np
import pandas as pd
import pytest

from wearcast.operators import kernel as K


def data(spark, n=400, seed=0, parts=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = ((x[:, 0] ** 2 + x[:, 1] ** 2 > 2.5) ^ (rng.uniform(size=n) < 0.04)).astype(int)
    pdf = pd.DataFrame({"reading_id": [f"r{i}" for i in range(n)], "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "target": y,
                        "weight": np.where(y == 1, 4.0, 0.6), "fold": rng.integers(0, 3, n)})
    return pdf, spark.createDataFrame(pdf).repartition(parts)


def blocks_of(df, **k):
    return K.row_blocks(df, ["a", "b", "c"], "target", "weight", fold="fold", **k)


def whole(blocks):
    rows = blocks.collect()
    return [np.concatenate([getattr(b, c) for b in rows]) for c in ("x", "y", "w")]


def test_landmarks_on_all_rows_give_the_kernel_and_fewer_a_bounded_error(spark):
    _, df = data(spark, 200)
    blocks = blocks_of(df)
    x, _, _ = whole(blocks)
    marks = K.landmarks(blocks, np.unique(x, axis=0), 0.5)
    z = marks.kernel(x) @ marks.root
    exact = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(z @ z.T - exact).max() < 1e-6 and marks.error < 1e-6
    errors = []
    for m in (5, 20, 80):
        points = K.choose_points(blocks, m)
        assert len(points) <= m and len(np.unique(points, axis=0)) == len(points)
        few = K.landmarks(blocks, points, 0.5)
        z = few.kernel(x) @ few.root
        assert few.error == pytest.approx(np.mean(1 - (z * z).sum(1)), abs=1e-9)
        errors.append(few.error)
    assert errors[0] > errors[1] > errors[2] and errors[2] < 0.02
    random = K.landmarks(blocks, x[:80], 0.5)
    assert errors[2] < random.error  # spread-out points beat a plain sample


def test_solution_closes_the_duality_gap(spark):
    """The dual point of the smoothed solution certifies it: primal minus dual
    value is within a few thousandths."""
    _, df = data(spark, 300, 1)
    blocks = blocks_of(df)
    x, y, w = whole(blocks)
    marks = K.landmarks(blocks, np.unique(x, axis=0), 0.7)
    ready = K.mapped(blocks, marks)
    for c in (0.5, 1.0, 10.0):
        sol = K.solve(ready, [K.Problem(c)], tolerance=1e-6, most=60)[:, 0]
        z = marks.kernel(x) @ marks.root
        margin = y * (z @ sol[:-1] + sol[-1])
        primal = 0.5 * (sol[:-1] ** 2).sum() + (c * w * np.maximum(0, 1 - margin)).sum()
        alpha = c * w * np.clip((1 - margin) / K.WIDTHS[-1], 0, 1)
        assert abs((alpha * y).sum()) < 1e-2 * alpha.sum()  # the intercept is free
        v = z.T @ (alpha * y)
        dual = alpha.sum() - 0.5 * (v**2).sum()
        assert (primal - dual) / primal < 0.01, (c, primal, dual)


def test_weights_move_the_class_and_probabilities_are_calibrated_out_of_sample(spark):
    pdf, df = data(spark, 900, 2)
    x = pdf[["a", "b", "c"]].to_numpy()
    plain = K.fit(K.row_blocks(df, ["a", "b", "c"], "target"), 0.5, m=120)
    heavy = K.fit(blocks_of(df), 0.5, m=120)
    for machine in (plain, heavy):
        f = machine.margin(x)
        p = machine.probability(f)
        assert machine.a < 0 and (np.diff(p[np.argsort(f)]) >= 0).all()
        assert ((f > 0) == pdf.target).mean() > 0.85
        assert abs(p.mean() - pdf.target.mean()) < 0.03  # targets are not weighted
    recall = [((m.margin(x) > 0) & (pdf.target == 1)).sum() / (pdf.target == 1).sum() for m in (plain, heavy)]
    assert recall[1] > recall[0]
    back = K.Machine.from_json(heavy.to_json())
    assert np.allclose(back.margin(x), heavy.margin(x)) and back.a == heavy.a


def test_calibration_equals_a_plain_fit_on_held_out_margins(spark):
    _, df = data(spark, 300, 3)
    blocks = blocks_of(df)
    marks = K.landmarks(blocks, K.choose_points(blocks, 60), 0.5)
    ready = K.mapped(blocks, marks)
    w = K.solve(ready, [K.Problem(1.0, without_part=i) for i in range(K.CALIBRATION)])
    a, b = K._curve(ready, w, 42)
    f, y = [], []
    for r in ready.collect():
        part = K._part(r, 42)
        f += [float(r.z[i].astype(float) @ w[:-1, p] + w[-1, p]) for i, p in enumerate(part)]
        y += r.y.tolist()
    f, y = np.array(f), np.array(y)
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))

    def loss(a, b):
        s = a * f + b
        return (np.logaddexp(0, s) - (1 - t) * s).sum()

    for da, db in ((0.02, 0), (-0.02, 0), (0, 0.02), (0, -0.02), (0.01, -0.01)):
        assert loss(a, b) <= loss(a + da, b + db)


def test_same_machine_for_any_partitioning_and_search_scores_folds(spark):
    pdf, df = data(spark, 500, 4)
    points = [K.choose_points(blocks_of(df.repartition(p)), 40) for p in (1, 6)]
    assert np.array_equal(points[0], points[1])
    blocks = blocks_of(df)
    settings = [(c, g) for g in (0.1, 0.8) for c in (1.0, 10.0)]
    train, test, machines = K.grid_search(blocks, settings, [0, 1, 2], m=60)
    assert len(train) == len(test) == 12
    x = pdf[["a", "b", "c"]].to_numpy()
    for (c, g, k), machine in machines.items():
        cell = pdf.target * 2 + (machine.margin(x) > 0)
        diff = np.bincount(cell[pdf.fold == k], minlength=4) - test[c, g, k]
        assert np.abs(diff).max() <= 1 and sum(test[c, g, k]) + sum(train[c, g, k]) == 500


def test_one_class_and_missing_values(spark):
    pdf, df = data(spark, 60, 5)
    with pytest.raises(ValueError):
        K.fit(blocks_of(df.where("target = 0")), 0.5, m=10)
    with pytest.raises(ValueError):
        K.choose_points(blocks_of(df.limit(0)), 5)
    pdf.loc[::5, "a"] = np.nan
    blocks = blocks_of(spark.createDataFrame(pdf))
    assert len(whole(blocks)[1]) == 48
    same = K.row_blocks(df.selectExpr("reading_id", "1D AS a", "1D AS b", "1D AS c", "target"), ["a", "b", "c"], "target")
    assert len(K.choose_points(same, 10)) == 1


def test_mapped_rows_are_not_kept_and_curved_rows_are_bounded(spark, monkeypatch):
    """Blocks used to hold a number per row and landmark, in memory and on disk, and every block its own curved rows."""
    import pickle

    _, df = data(spark, 600, 7)
    blocks = blocks_of(df)
    marks = K.landmarks(blocks, K.choose_points(blocks, 80), 0.5)
    ready = K.mapped(blocks, marks)
    assert not ready.is_cached
    b = ready.first()
    assert sum(v.nbytes for v in vars(b).values() if isinstance(v, np.ndarray)) < 100 * len(b.y)
    w = np.random.default_rng(0).normal(size=(marks.root.shape[1] + 1, 2))
    assert np.allclose(b.margins(w), b.z @ w[:-1] + w[-1], atol=1e-6) and len(pickle.dumps(b.x)) < 100 * len(b.y)
    asked = [K.Problem(1.0), K.Problem(10.0, without_fold=1)]
    monkeypatch.setattr(K, "CURVED_BLOCKS", 1)
    few = K.solve(ready, asked, tolerance=1e-6, most=60)
    monkeypatch.setattr(K, "CURVED", 1000)
    exact = K.solve(ready, asked, tolerance=1e-6, most=60)
    x, _, _ = whole(blocks)
    near = [marks.kernel(x) @ marks.root @ v[:-1] + v[-1] for v in (few, exact)]
    assert np.abs(near[0] - near[1]).max() < 0.05


def test_kernel_values_are_held_for_a_few_rows_at_a_time():
    """Products with the kernel, nearest points: memory does not follow the rows of a block."""
    import tracemalloc

    rng = np.random.default_rng(3)
    x, points, beta = rng.normal(size=(20_000, 4)), rng.normal(size=(200, 4)), rng.normal(size=(200, 2))
    marks = K.Landmarks(points, np.eye(200), 0.3)
    tracemalloc.start()
    got, (far, at) = marks.product(x, beta), K._nearest(x, points)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000 * 200 * 8 / 8
    square = ((x[:, None, :] - points) ** 2).sum(2)
    assert np.allclose(got, np.exp(-0.3 * square) @ beta, atol=1e-10)
    assert np.allclose(far, square.min(1), atol=1e-10) and (at == square.argmin(1)).mean() > 0.999
