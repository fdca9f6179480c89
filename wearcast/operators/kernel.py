"""Support vector classification with an RBF kernel (L2, L4).

The kernel k(x, y) = exp(-gamma |x - y|^2) is approximated from landmarks
(Nystroem): z(x) = k(x, landmarks) K^-1/2, so that z(x).z(y) is the kernel
projected on the landmarks' span.  Landmarks come from k-means|| rounds over
all rows, thinned to ``m`` points by weighted k-means++ on the driver, which
holds m x m numbers.  The error of the approximation is measured: ``error`` is
the mean of k(x, x) - z(x).z(x) over all rows, 0 (exact) to 1.

The machine minimises |w|^2 / 2 + C sum(weight * hinge(y (w.z + b))), the
usual soft margin with class weights and a free intercept.  Newton steps on a
smoothed hinge follow its width down to ``WIDTHS[-1]``; a step is one pass over
the rows for gradients and Hessians, and one for the step length.  Several
problems (folds, penalties) share each pass.

The class is the side of the weighted margin.  Probabilities are Platt's: a
logistic curve fitted, with smoothed targets and without weights, to margins
of machines that did not see the row (``CALIBRATION`` folds by row hash).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .trees import _draw, _total, few

CALIBRATION, ROUNDS = 5, 3
#: Widths of the smoothed part of the hinge, one after the other.
WIDTHS = (4.0, 1.6, 0.64, 0.25, 0.12, 0.06, 0.03, 0.015)
STEPS = np.array([1.0, 0.6, 0.35, 0.2, 0.1, 0.04, 0.01])
#: Below the width WIDE, rows within REACH widths of the curved part count for a step's shape.
WIDE, REACH = 0.2, 0.5
#: Damping of a Newton step: raised tenfold after a step without gain, up to the last value.
DAMPING = (1e-4, 1e3)
#: Steps at each width before the last; rows of a block for a Hessian, per column; blocks that give so many.
ON_THE_WAY, CURVED, CURVED_BLOCKS = 3, 4, 16
#: Rows whose kernel values are computed, and used, at a time: few enough to stay in a core's cache.
KERNEL_ROWS = 1 << 8
BLOCK_ROWS, PART_ROWS = 1 << 13, 5_000


@dataclass
class Rows:
    """A block of rows: features, labels (-1, 1), weights, folds, row hashes; later z."""

    x: np.ndarray
    y: np.ndarray
    w: np.ndarray
    fold: np.ndarray
    key: np.ndarray
    z: np.ndarray | None = None


@dataclass
class Landmarks:
    points: np.ndarray
    root: np.ndarray
    gamma: float
    error: float = 0.0

    def __post_init__(self):
        own = -self.gamma * (self.points * self.points).sum(1)
        self.inner = np.vstack([2 * self.gamma * self.points.T, np.full(len(own), -self.gamma), own])

    def parts(self, x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """The kernel values of a few rows after the other.  The next part is written over the last one."""
        outer = np.column_stack([x, (x * x).sum(1), np.ones(len(x))])
        held = np.empty((min(KERNEL_ROWS, len(x)), len(self.points)))
        for i in range(0, len(x), KERNEL_ROWS):
            at = slice(i, min(i + KERNEL_ROWS, len(x)))
            far = held[: at.stop - i]
            np.matmul(outer[at], self.inner, out=far)
            np.minimum(far, 0, out=far)
            yield at, np.exp(far, out=far)

    def kernel(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.points)))
        for at, values in self.parts(x):
            out[at] = values
        return out

    def product(self, x: np.ndarray, beta: np.ndarray) -> np.ndarray:
        """Kernel values times beta."""
        out = np.empty((len(x), *beta.shape[1:]))
        for at, values in self.parts(x):
            out[at] = values @ beta
        return out


class Mapped(Rows):
    """A block whose rows are mapped when they are asked for: z has a number
    per row and landmark, too many to keep for all rows.  Margins and slopes
    come from kernel values: z.w = k.(root w)."""

    def __init__(self, b: Rows, marks: Landmarks):
        self.x, self.y, self.w, self.fold, self.key, self.marks = b.x, b.y, b.w, b.fold, b.key, marks

    @property
    def z(self) -> np.ndarray:
        return self.kernel() @ self.marks.root

    def kernel(self) -> np.ndarray:
        return self.marks.kernel(self.x)

    def margins(self, w: np.ndarray) -> np.ndarray:
        return self.marks.product(self.x, self.marks.root @ w[:-1]) + w[-1]


@dataclass
class Machine:
    """Margin k(x, points).beta + bias; probability 1 / (1 + exp(a * margin + b))."""

    points: np.ndarray
    gamma: float
    beta: np.ndarray
    bias: float
    a: float = -1.0
    b: float = 0.0
    error: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return Landmarks(self.points, self.points, self.gamma).product(x, self.beta) + self.bias

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.a * margin + self.b, -700, 700)))

    def to_json(self) -> str:
        return json.dumps({"points": self.points.tolist(), "gamma": self.gamma, "beta": self.beta.tolist(),
                           "bias": self.bias, "a": self.a, "b": self.b, "error": self.error})

    @staticmethod
    def from_json(text: str) -> Machine:
        d = json.loads(text)
        return Machine(np.array(d["points"], float), d["gamma"], np.array(d["beta"], float), d["bias"], d["a"], d["b"], d["error"])


# ----------------------------------------------------------------- rows ---
def row_blocks(df: DataFrame, cols: Sequence[str], label: str, weight: str | None = None, fold: str | None = None,
               key: str = "reading_id"):
    """Labelled rows without missing features, as an RDD of blocks behind a checkpoint."""
    cols = list(cols)
    names = [key] if key in df.columns else [*cols, label]
    known = df.where(F.col(label).isin(0, 1)).select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.col(label).cast("int").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        (F.coalesce(F.col(fold).cast("int"), F.lit(-1)) if fold else F.lit(-1)).alias("fold"), F.xxhash64(*names).alias("key"))
    d = len(cols)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, BLOCK_ROWS):
                b = whole.slice(i, BLOCK_ROWS)
                x = np.stack([b.column(j).to_numpy(zero_copy_only=False).astype(float) for j in range(d)], axis=1)
                ok = np.isfinite(x).all(1)
                y, w, f, k = (b.column(c).to_numpy(zero_copy_only=False)[ok] for c in ("y", "w", "fold", "key"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v.tobytes()], pa.binary()) for v in (
                        x[ok], (2.0 * y - 1), w.astype(float), f.astype(np.int32), k.astype(np.int64))],
                    ["x", "y", "w", "fold", "key"])

    def unpack(r) -> Rows:
        y = np.frombuffer(r["y"], float)
        return Rows(np.frombuffer(r["x"], float).reshape(len(y), d), y, np.frombuffer(r["w"], float),
                    np.frombuffer(r["fold"], np.int32), np.frombuffer(r["key"], np.int64).view(np.uint64))

    table = cut_lineage(known.mapInArrow(pack, "x binary, y binary, w binary, fold binary, key binary"))
    n = table.agg(F.sum(F.length("y") / 8)).first()[0] or 0
    return few(table.rdd, n, PART_ROWS).map(unpack).persist(StorageLevel.MEMORY_AND_DISK)


# ------------------------------------------------------------ landmarks ---
def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, far, at = (c * c).sum(1), np.empty(len(x)), np.empty(len(x), np.int64)
    for i in range(0, len(x), KERNEL_ROWS):
        part = x[i : i + KERNEL_ROWS]
        d = part @ (-2 * c.T)
        d += (part * part).sum(1)[:, None]
        d += own
        at[i : i + KERNEL_ROWS] = best = d.argmin(1)
        far[i : i + KERNEL_ROWS] = d[np.arange(len(part)), best]
    return np.maximum(far, 0), at


def choose_points(blocks, m: int, seed: int = 42, rounds: int = ROUNDS) -> np.ndarray:
    """At most m distinct rows, far from each other and near to all others:
    ``rounds`` of k-means|| draw about m candidates each (a row with a chance
    in proportion to its squared distance from those already drawn), weighted
    k-means++ chooses among them.  The draws follow from row hashes."""
    def lowest(b: Rows) -> list:
        u = _draw(b.key, seed, 6)
        return [(int(u.min()), tuple(b.x[u.argmin()].tolist()))] if len(u) else []

    first = blocks.map(lowest).fold([], lambda a, b: min(a, b) if a and b else a or b)
    if not first:
        raise ValueError("no rows")
    found = np.array([first[0][1]])
    for r in range(rounds):
        spread = blocks.map(lambda b, c=found: float(_nearest(b.x, c)[0].sum())).sum()
        if spread <= 0:
            break

        def draw(b: Rows, c=found, r=r, spread=spread) -> np.ndarray:
            chance = _nearest(b.x, c)[0] * (m / spread)
            u = (_draw(b.key, seed, 7, r) >> np.uint64(11)) * 2.0**-53
            return b.x[u < chance]

        new = [p for p in blocks.map(draw).collect() if len(p)]
        found = np.unique(np.concatenate([found, *new]), axis=0)
    if len(found) <= m:
        return found
    weight = blocks.map(lambda b, c=found: np.bincount(_nearest(b.x, c)[1], minlength=len(c)).astype(float)).reduce(np.add)
    rng, chosen = np.random.default_rng(seed), [int(weight.argmax())]
    far = ((found - found[chosen[0]]) ** 2).sum(1)
    while len(chosen) < m and (far > 0).any():
        chance = np.maximum(weight, 1) * far
        chosen.append(int(rng.choice(len(found), p=chance / chance.sum())))
        far = np.minimum(far, ((found - found[chosen[-1]]) ** 2).sum(1))
    return found[sorted(chosen)]


def landmarks(blocks, points: np.ndarray, gamma: float) -> Landmarks:
    """The map of these points, with its error over all rows (one pass)."""
    out = Landmarks(points, np.eye(len(points)), gamma)
    values, vectors = np.linalg.eigh(out.kernel(points))
    keep = values > 1e-9 * values[-1]
    out.root = vectors[:, keep] / np.sqrt(values[keep])

    def missed(b: Rows) -> tuple[float, int]:
        return float(sum((1 - np.square(values @ out.root).sum(1)).sum() for _, values in out.parts(b.x))), len(b.y)

    total = blocks.map(missed).reduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
    out.error = max(0.0, total[0] / max(1, total[1]))
    return out


def mapped(blocks, marks: Landmarks):
    """Blocks with their map, made anew in each of the solver's passes: nothing but the features is kept."""
    shared = blocks.ctx.broadcast(marks)
    return blocks.map(lambda b: Mapped(b, shared.value))


# --------------------------------------------------------------- solver ---
@dataclass(frozen=True)
class Problem:
    """Penalty C, and which rows are left out: those of a fold, or of a calibration part."""

    c: float
    without_fold: int | None = None
    without_part: int | None = None


def _part(b: Rows, seed: int) -> np.ndarray:
    return (_draw(b.key, seed, 8) % np.uint64(CALIBRATION)).astype(np.int64)


def _penalties(b: Rows, problems: Sequence[Problem], seed: int) -> np.ndarray:
    part = _part(b, seed)
    out = np.empty((len(b.y), len(problems)))
    for i, p in enumerate(problems):
        out[:, i] = p.c * b.w * (part != p.without_part if p.without_part is not None else True) * (
            b.fold != p.without_fold if p.without_fold is not None else True)
    return out


def _smooth(u: np.ndarray, h: float) -> np.ndarray:
    return np.where(u >= h, u - h / 2, np.square(np.clip(u, 0, h)) / (2 * h))


def solve(blocks, problems: Sequence[Problem], seed: int = 42, tolerance: float = 3e-4, most: int = 20) -> np.ndarray:
    """Weights of every problem as columns, the intercept in the last row."""
    r = blocks.map(lambda b: b.marks.root.shape[1]).first()
    each = CURVED * (r + 1) * min(1.0, CURVED_BLOCKS / max(1, blocks.count()))  # bounded over all blocks
    k = len(problems)
    w = np.zeros((r + 1, k))
    ridge = np.append(np.ones(r), 0.0)

    upper, scale = np.triu_indices(r + 1), np.append(0.0, STEPS)

    def pass_over(it: Iterable[Mapped], w: np.ndarray, step: np.ndarray, live: np.ndarray, h: float) -> list[tuple]:
        """Losses along the step (by scale and problem), and gradients and
        Hessians (upper triangles) of the losses at its end.  A Hessian only
        shapes the step: of many rows on the curved part, every n-th stands
        for n.  Only rows with a loss somewhere on the step count."""
        loss, pulled = np.zeros((len(scale), k)), np.zeros(len(live))
        hess, grad, root = np.zeros((len(live), len(upper[0]))), None, None
        near = REACH * h if h < WIDE else 0.0
        for b in it:
            if root is None:
                root = b.marks.root
                both, bias = root @ np.hstack([w[:-1], step[:-1]]), np.append(w[-1], step[-1])
                grad = np.zeros((len(live), len(root)))
            c, inside = _penalties(b, problems, seed), np.empty((len(b.y), len(live)), bool)
            for at, kernel in b.marks.parts(b.x):
                m, y, penalty = kernel @ both + bias, b.y[at, None], c[at]
                u, v = 1 - y * m[:, :k], -y * m[:, k:]
                row, of = np.nonzero((np.maximum(u, u + v) > 0) & (penalty > 0))
                start, slope, cost = u[row, of], v[row, of], penalty[row, of]
                for i, s in enumerate(scale):
                    loss[i] += np.bincount(of, cost * _smooth(start + s * slope, h), k)
                u, penalty = (u + v)[:, live], penalty[:, live]
                inside[at] = (u > -near) & (u < h + near) & (penalty > 0)
                pull = y * penalty * np.clip(u / h, 0, 1)
                rows = np.flatnonzero(pull.any(1))
                grad -= pull[rows].T @ kernel[rows]
                pulled -= pull.sum(0)
            picked = []
            for i in range(len(live)):
                rows = np.flatnonzero(inside[:, i])
                n = max(1, int(len(rows) / each))
                picked.append((rows[::n], n))
            rows = np.unique(np.concatenate([p for p, _ in picked]))
            z = np.column_stack([b.marks.product(b.x[rows], root), np.ones(len(rows))])
            for i, (p, n) in enumerate(picked):
                part = z[np.searchsorted(rows, p)]
                hess[i] += ((part * (n * c[p, live[i]] / h)[:, None]).T @ part)[upper]
        if root is None:
            return []
        return [(loss, np.vstack([root.T @ grad.T, pulled]), hess)]

    def add(a, b):
        return tuple(x + y for x, y in zip(a, b))

    for h in WIDTHS:
        open_, damp, known = np.ones(k, bool), np.full(k, DAMPING[0]), None
        for _ in range(most if h == WIDTHS[-1] else ON_THE_WAY):
            now, live = w.copy(), np.flatnonzero(open_)
            if known is None:
                def slopes(it, w=now, live=live, h=h):
                    return pass_over(it, w, np.zeros_like(w), live, h)

                known = _total(blocks.mapPartitions(slopes), add)[1:]
            step = np.zeros_like(w)
            for i, p in enumerate(live):
                curved = np.zeros((r + 1, r + 1))
                curved[upper] = known[1][i]
                curved += np.triu(curved, 1).T + np.diag(ridge)
                curved += damp[p] * np.diag(curved.diagonal() + curved.diagonal().mean())
                step[:, p] = -np.linalg.solve(curved, known[0][:, i] + ridge * w[:, p])

            def trial(it, w=now, step=step, live=live, h=h):
                return pass_over(it, w, step, live, h)

            loss, *after = _total(blocks.mapPartitions(trial), add)
            loss = loss + np.stack([0.5 * ((w + s * step)[:-1] ** 2).sum(0) for s in scale])
            best = loss.argmin(0)
            w = w + step * scale[best]
            gained = (loss[0] - loss[best, np.arange(k)]) / np.maximum(loss[0], 1e-12)
            stuck = gained <= 0
            damp = np.where(scale[best] <= 0.2, damp * 10, np.where(scale[best] >= 0.6, np.maximum(damp / 10, DAMPING[0]), damp))
            open_ &= (gained > (tolerance if h == WIDTHS[-1] else 10 * tolerance)) | (stuck & (damp <= DAMPING[1]))
            if not open_.any():
                break
            # whole steps everywhere: the slopes at the new place are known already
            whole = (scale[best[live]] == 1.0).all()
            kept = np.searchsorted(live, np.flatnonzero(open_))
            known = (after[0][:, kept], after[1][kept]) if whole else None
    return w


def _curve(blocks, w: np.ndarray, seed: int) -> tuple[float, float]:
    """Platt's a and b on margins of the machine (column) that did not see the row's part."""

    held = blocks.map(lambda b: (b.margins(w)[np.arange(len(b.y)), _part(b, seed)], b.y > 0)).persist(StorageLevel.MEMORY_AND_DISK)
    pos, neg = held.map(lambda b: (int(b[1].sum()), int((~b[1]).sum()))).reduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
    high, low = (pos + 1) / (pos + 2), 1 / (neg + 2)

    def sums(a: float, c: float):
        def run(b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
            f, t = b[0], np.where(b[1], high, low)
            s = a * f + c
            p = 1 / (1 + np.exp(np.clip(s, -700, 700)))
            q = p * (1 - p)
            loss = (np.logaddexp(0, s) - (1 - t) * s).sum()
            return np.array([loss, ((t - p) * f).sum(), (t - p).sum(), (q * f * f).sum(), (q * f).sum(), q.sum()])

        return held.map(run).reduce(np.add)

    a, c = 0.0, float(np.log((neg + 1) / (pos + 1)))
    now = sums(a, c)
    for _ in range(50):
        hess = np.array([[now[3], now[4]], [now[4], now[5]]]) + 1e-10 * np.eye(2)
        da, dc = -np.linalg.solve(hess, now[1:3])
        if max(abs(now[1]), abs(now[2])) < 1e-7 * (pos + neg):
            break
        s = 1.0
        while s > 1e-6:
            new = sums(a + s * da, c + s * dc)
            if new[0] <= now[0] + 1e-4 * s * (now[1] * da + now[2] * dc):
                break
            s /= 2
        else:
            break
        a, c, now = a + s * da, c + s * dc, new
    held.unpersist()
    return a, c


def _machine(marks: Landmarks, w: np.ndarray) -> Machine:
    return Machine(marks.points, marks.gamma, marks.root @ w[:-1], float(w[-1]), error=marks.error)


def fit(blocks, gamma: float, c: float = 1.0, m: int = 300, seed: int = 42, points: np.ndarray | None = None) -> Machine:
    """A calibrated machine.  The full problem and those of the calibration
    parts are solved together."""
    classes = set().union(*blocks.map(lambda b: set(np.unique(b.y).tolist())).collect())
    if len(classes) < 2:
        raise ValueError("a support vector machine needs rows of both classes")
    marks = landmarks(blocks, choose_points(blocks, m, seed) if points is None else points, gamma)
    ready = mapped(blocks, marks)
    w = solve(ready, [Problem(c), *[Problem(c, without_part=i) for i in range(CALIBRATION)]], seed)
    out = _machine(marks, w[:, 0])
    out.a, out.b = _curve(ready, w[:, 1:], seed)
    return out


def grid_search(blocks, settings: Sequence[tuple[float, float]], folds: Sequence[int], m: int = 300,
                seed: int = 42) -> tuple[dict, dict, dict]:
    """For every (c, gamma) and fold: counts (tn, fp, fn, tp) of the margin's
    sign on the other folds and on the fold, and the machine.  Landmarks are
    shared; each gamma maps the rows once and solves its problems together."""
    train, test, machines = {}, {}, {}
    points = choose_points(blocks, m, seed)
    for gamma in dict.fromkeys(g for _, g in settings):
        marks = landmarks(blocks, points, gamma)
        ready = mapped(blocks, marks)
        asked = [(c, k) for c, g in settings if g == gamma for k in folds]
        w = solve(ready, [Problem(c, without_fold=k) for c, k in asked], seed)

        def count(b: Mapped, w=w) -> dict:
            side = b.margins(w) > 0
            out = {}
            for k in np.unique(b.fold).tolist():
                rows = b.fold == k
                cell = (b.y[rows, None] > 0) * 2 + side[rows]
                out[k] = np.stack([np.bincount(cell[:, i], minlength=4) for i in range(cell.shape[1])])
            return out

        counts = ready.map(count).reduce(lambda a, b: {k: a.get(k, 0) + b.get(k, 0) for k in a.keys() | b.keys()})
        for i, (c, k) in enumerate(asked):
            train[c, gamma, k] = sum((counts[j][i] for j in folds if j != k and j in counts), np.zeros(4, int)).tolist()
            test[c, gamma, k] = counts[k][i].tolist()
            machines[c, gamma, k] = _machine(marks, w[:, i])
    return train, test, machines
