"""Histogram trees (L1, L3, L6): Newton boosting and random forests.

Features are binned once at approximate quantiles, and a training set is a
table of blocks: one byte per row and feature, label, weight, fold and a row
hash.  Trees grow level by level.  In a pass every task adds up the statistics
of its rows per (node, feature, bin); the sums meet, and the best split of
each node is found from them.  Only splits reach the driver.

Statistics are fixed-point integers, so sums do not depend on the order of
rows or on their partitions, and all random choices (rows and features of a
tree) follow from hashes of seed, tree and row.  A fit gives the same trees for
any partitioning.

* ``boost``: second-order boosting of the logistic loss.  Gain and leaf
  value from the sums of gradients and hessians, with an L2 penalty, a least
  gain, ``scale_pos_weight``, row and column subsampling.
* ``grow_forests``: weighted Gini forests with Poisson bootstrap and a feature
  subset per node.  Several forests (folds, leaf sizes) grow in the same
  passes.  A tree cut at a smaller depth or a larger split minimum is the tree
  that these settings would grow, so a grid needs one forest per fold and leaf
  size (``grid_search``).

The per-partition steps run over an RDD of numpy blocks: iterative work on
partition state, with a job per level whose latency is the cost of small data.
Blocks are rebuilt from the checkpointed table if an executor is lost.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Bins per feature at most (a bin number is one byte).
BINS = 128
#: Rows of a block, rows that are worth a partition, and bytes of statistics that a task holds in one pass.
BLOCK_ROWS, PART_ROWS, PASS_BYTES = 1 << 16, 5_000, 32 << 20
#: Up to so many partitions their sums go to the driver directly, beyond through a tree of tasks.
DIRECT_PARTITIONS = 64
#: Partitions per core at most: each sends its sums in every pass, so more rows make them longer, not more.
PARTS_PER_CORE = 3
#: Margins follow from those of the round before; every so many rounds from the source blocks, so that lineage stays short.
REBASE_EVERY = 20

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """Splitmix64: a well-spread value of each 64-bit number."""
    x = (x + _A).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _draw(key: np.ndarray, *choice: int) -> np.ndarray:
    """A 64-bit number for each key that depends on the choice alone."""
    salt = np.zeros(1, np.uint64)
    for c in choice:
        salt = _mix(salt ^ np.array([c], np.int64).view(np.uint64))
    return _mix(key ^ salt)


# ---------------------------------------------------------------- binning ---
@dataclass
class Block:
    """Rows of a partition: bins (features × rows), labels, weights, folds, row hashes."""

    x: np.ndarray
    y: np.ndarray
    w: np.ndarray
    fold: np.ndarray
    key: np.ndarray
    margin: np.ndarray | None = None


def few(rdd, rows: float, per_part: int):
    """No more partitions than the rows need or the cores can use: a pass over
    small data costs mostly its tasks, and every partition sends sums."""
    most = PARTS_PER_CORE * rdd.ctx.defaultParallelism
    return rdd.coalesce(max(1, min(rdd.getNumPartitions(), math.ceil(rows / per_part), most)))


def _joined(blocks: Iterable[Block]) -> Iterator[Block]:
    """The blocks of a partition in fewer ones of up to ``BLOCK_ROWS`` rows: sums are made once per block."""
    held, n = [], 0
    for b in chain(blocks, [None]):
        if held and (b is None or n + len(b.y) > BLOCK_ROWS):
            yield Block(np.concatenate([h.x for h in held], axis=1), *[np.concatenate([getattr(h, c) for h in held])
                                                                      for c in ("y", "w", "fold", "key")])
            held, n = [], 0
        if b is not None:
            held.append(b)
            n += len(b.y)


def bin_edges(df: DataFrame, cols: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Distinct approximate quantiles of each column (one aggregation); a
    value's bin is the number of edges below it, missing values come last."""
    if not 2 <= bins <= 256:
        raise ValueError("2 to 256 bins")
    at = [(i + 1) / bins for i in range(bins - 1)]
    row = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), at, F.lit(20_000)).alias(f"e{i}")
                   for i, c in enumerate(cols)]).first()
    return [np.unique(np.array(row[f"e{i}"] or [], float)) for i in range(len(cols))]


@dataclass
class Binned:
    """A training set: blocks, and what the driver knows of it."""

    blocks: object
    cols: list[str]
    edges: list[np.ndarray]
    rows: int
    weight: float
    widest: float
    folds: list[int] = field(default_factory=list)

    @property
    def bins(self) -> int:
        return max((len(e) for e in self.edges), default=0) + 1

    def release(self) -> None:
        self.blocks.unpersist()


def binned(df: DataFrame, cols: Sequence[str], label: str, weight: str | None = None, fold: str | None = None,
           key: str = "reading_id", edges: list[np.ndarray] | None = None) -> Binned:
    """Rows with a label of 0 or 1, binned and stored.  ``key`` gives each row
    its hash for sampling; without such a column the features and the label
    do."""
    cols = list(cols)
    known = df.where(F.col(label).isin(0, 1))
    edges = bin_edges(known, cols) if edges is None else edges
    names = [key] if key in df.columns else [*cols, label]
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    at = F.col(fold).cast("int") if fold else F.lit(-1)
    rows = known.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.col(label).cast("int").alias("y"),
                        w.alias("w"), at.alias("fold"), F.xxhash64(*names).alias("key"))
    d = len(cols)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, BLOCK_ROWS):
                p = b.slice(i, BLOCK_ROWS)
                x = np.stack([np.searchsorted(edges[j], p.column(j).to_numpy(zero_copy_only=False).astype(float))
                              for j in range(d)]).astype(np.uint8)
                y, w, f, k = (p.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "fold", "key"))
                f = np.where(np.isnan(f.astype(float)), -1, f)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v.tobytes()], pa.binary()) for v in (
                        x, y.astype(np.uint8), w.astype(float), f.astype(np.int32), k.astype(np.int64))],
                    ["x", "y", "w", "fold", "key"])

    def unpack(r) -> Block:
        y = np.frombuffer(r["y"], np.uint8)
        return Block(np.frombuffer(r["x"], np.uint8).reshape(d, len(y)), y, np.frombuffer(r["w"], float),
                     np.frombuffer(r["fold"], np.int32), np.frombuffer(r["key"], np.int64).view(np.uint64))

    table = cut_lineage(rows.mapInArrow(pack, "x binary, y binary, w binary, fold binary, key binary"))
    n = table.agg(F.sum(F.length("y"))).first()[0] or 0
    blocks = few(table.rdd, n, PART_ROWS).map(unpack).mapPartitions(_joined).persist(StorageLevel.MEMORY_AND_DISK)
    facts = blocks.map(lambda b: (len(b.y), float(b.w.sum()), float(b.w.max(initial=0)), set(b.fold.tolist()))).collect()
    folds = sorted(set().union(*[f[3] for f in facts]) - {-1})
    return Binned(blocks, cols, edges, sum(f[0] for f in facts), math.fsum(f[1] for f in facts),
                  max((f[2] for f in facts), default=0.0), folds)


def _scale(data: Binned, largest: float) -> float:
    """Power of two that makes statistics up to ``largest`` integers whose
    sums are exact: doubles within a block, 64 bits over all rows."""
    if largest <= 0 or not data.rows:
        return 1.0
    within = 52 - math.log2(min(data.rows, BLOCK_ROWS)) - math.log2(largest)
    overall = 62 - math.log2(data.rows) - math.log2(largest)
    return 2.0 ** min(40, math.floor(min(within, overall)))


# ------------------------------------------------------------------ trees ---
@dataclass
class Tree:
    """Nodes in order of creation; the right child follows the left one.
    ``value`` is a leaf's contribution, and an inner node's, were it a leaf."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])
    path: list[int] = field(default_factory=lambda: [1])
    active: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, at: int, gain: float) -> int:
        left = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, at, left, gain
        for side in (0, 1):
            for column, first in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.value, 0.0), (self.gain, 0.0),
                                  (self.rows, 0), (self.path, 2 * self.path[node] + side)):
                column.append(first)
        return left

    def depth(self, node: int) -> int:
        return self.path[node].bit_length() - 1

    def cut(self, max_depth: int, min_split: int) -> Tree:
        """The tree as it grows with these settings."""
        out = Tree(list(self.feature), list(self.bin), list(self.left), list(self.value), list(self.gain),
                   list(self.rows), list(self.path), [])
        for i, left in enumerate(out.left):
            if left >= 0 and (self.depth(i) >= max_depth or self.rows[i] < min_split):
                out.left[i], out.feature[i], out.gain[i] = -1, -1, 0.0
        return out

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature, np.int16), np.array(self.bin, np.uint8), np.array(self.left, np.int32),
                np.array(self.value))


def _places(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """The node in which each column of x ends."""
    feature, at, left, _ = tree
    node = np.zeros(x.shape[1], np.int32)
    open_ = np.arange(x.shape[1]) if left[0] >= 0 else np.zeros(0, np.int64)
    while len(open_):
        n = node[open_]
        n = left[n] + (x[feature[n], open_] > at[n])
        node[open_] = n
        open_ = open_[left[n] >= 0]
    return node


def _no_sums(nodes: int, slots: int, bins: int, stats: int) -> np.ndarray:
    return np.zeros((slots, stats, nodes * bins), np.int64)


def _add_sums(out: np.ndarray, x: np.ndarray, rows: np.ndarray, place: np.ndarray, feats: np.ndarray, bins: int,
              stats: Sequence[np.ndarray | None]) -> None:
    """Adds the statistics (None: one a row) of these rows of a block by feature slot, node place
    and bin; feats[place, slot] is the feature."""
    base, same = place * bins, (feats == feats[:1]).all()
    for s in range(feats.shape[1]):
        cell = base + (x[feats[0, s]][rows] if same else x[feats[place, s], rows])
        for c, v in enumerate(stats):
            out[s, c] += np.bincount(cell, v, out.shape[2]).astype(np.int64)


def _by_node(out: np.ndarray, bins: int) -> np.ndarray:
    """Sums by node place, feature slot, bin and statistic."""
    slots, stats, cells = out.shape
    return out.reshape(slots, stats, cells // bins, bins).transpose(2, 0, 3, 1)


def _packed(out: np.ndarray) -> tuple:
    """Sums of a partition as they travel: most cells of deep levels are empty."""
    at = np.flatnonzero(out[:, -1])  # the last statistic counts rows
    return out.shape, at, out.transpose(0, 2, 1).reshape(-1, out.shape[1])[at]


def _unpacked(parts: Iterable[tuple]) -> np.ndarray:
    total = None
    for shape, at, values in parts:
        if total is None:
            total = np.zeros((shape[0] * shape[2], shape[1]), np.int64)
        total[at] += values  # a part names each cell once
    return np.ascontiguousarray(total.reshape(shape[0], shape[2], shape[1]).transpose(0, 2, 1))


def _best(left: np.ndarray, total: np.ndarray, score, allowed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, slot, bin) of each node's best split, the first of equals; a
    gain of -inf without one.  left: sums up to each bin; total: whole nodes."""
    right = total[:, None, None, :] - left
    gain = score(left) + score(right) - score(total)[:, None, None]
    gain = np.where(allowed(left, right), gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(1)
    return flat[np.arange(len(flat)), best], best // gain.shape[2], best % gain.shape[2]


# --------------------------------------------------------------- boosting ---
@dataclass
class Boosting:
    """Settings of ``boost``; the names follow the usual ones."""

    rounds: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    scale_pos_weight: float = 1.0
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    seed: int = 42


def _rows_of(block: Block, s: Boosting, round_: int) -> np.ndarray:
    if s.subsample >= 1:
        return np.arange(len(block.y))
    return np.flatnonzero(_draw(block.key, s.seed, 1, round_) < np.uint64(int(s.subsample * 2.0**64)))


def _columns_of(d: int, s: Boosting, round_: int) -> np.ndarray:
    keep = max(1, int(s.colsample_bytree * d))
    return np.sort(np.argsort(_draw(np.arange(d, dtype=np.uint64), s.seed, 2, round_), kind="stable")[:keep])


def _margins(block: Block, trees: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    m = np.zeros(len(block.y)) if block.margin is None else block.margin.copy()
    for t in trees:
        m += t[3][_places(t, block.x)]
    return m


def _total(parts, combine):
    """Sum over partitions: on the driver for few, through a tree of tasks for many."""
    if parts.getNumPartitions() <= DIRECT_PARTITIONS:
        out = None
        for p in parts.collect():
            out = p if out is None else combine(out, p)
        return out
    return parts.treeReduce(combine, depth=2)


def boost(data: Binned, settings: Boosting | None = None) -> list[Tree]:
    """Trees whose values add up to the log odds of label 1.

    Each level is one pass: gradient p - y and hessian p (1 - p), times the
    row's weight (``scale_pos_weight`` more for label 1), summed by node,
    feature and bin.  A split gains half the rise of G^2 / (H + lambda) less
    gamma, both children having ``min_child_weight`` of H; a leaf's value is
    -learning_rate * G / (H + lambda)."""
    s = settings or Boosting()
    unit = _scale(data, data.widest * max(1.0, s.scale_pos_weight))
    lam, bins, done = s.reg_lambda, data.bins, []
    blocks, last, before = data.blocks, None, None

    def score(t):
        return 0.5 * t[..., 0] ** 2 / (t[..., 1] + lam)

    def allowed(a, b):
        return (a[..., 1] >= s.min_child_weight) & (b[..., 1] >= s.min_child_weight)

    for round_ in range(s.rounds):
        if round_:
            again = round_ % REBASE_EVERY == 0
            trees = [t.arrays() for t in (done if again else done[-1:])]
            before, last = last, (data.blocks if again else blocks).map(lambda b, trees=trees: Block(
                b.x, b.y, b.w, b.fold, b.key, _margins(b, trees))).persist(StorageLevel.MEMORY_AND_DISK)
            blocks = last
        cols = _columns_of(len(data.cols), s, round_)
        tree = Tree()
        while tree.active:
            grown, active = tree.arrays(), list(tree.active)

            def level(it, grown=grown, active=active, round_=round_, cols=cols):
                feats = np.tile(cols, (len(active), 1))
                out = _no_sums(len(active), len(cols), bins, 2)
                where = np.full(len(grown[0]), -1)
                where[active] = np.arange(len(active))
                for b in it:
                    rows = _rows_of(b, s, round_)
                    place = where[_places(grown, b.x)[rows]]
                    rows, place = rows[place >= 0], place[place >= 0]
                    y, p = b.y[rows], 1 / (1 + np.exp(-_margins(b, [])[rows]))
                    w = b.w[rows] * np.where(y == 1, s.scale_pos_weight, 1.0)
                    _add_sums(out, b.x, rows, place, feats, bins, [np.rint(w * (p - y) * unit), np.rint(w * p * (1 - p) * unit)])
                return [_by_node(out, bins)]

            sums = _total(blocks.mapPartitions(level), np.add)
            if before is not None:  # the margins of this round are stored now
                before, _ = None, before.unpersist()
            if sums is None:
                return done
            total = sums[:, 0].sum(1) / unit
            left = np.cumsum(sums, axis=2)[:, :, :-1] / unit
            gain, slot, at = _best(left, total, score, allowed) if bins > 1 else (np.full(len(active), -np.inf), [], [])
            tree.active = []
            for k, node in enumerate(active):
                tree.value[node] = float(-s.learning_rate * total[k, 0] / (total[k, 1] + lam))
                if gain[k] - s.gamma > 1e-9 and tree.depth(node) < s.max_depth:
                    first = tree.split(node, int(cols[slot[k]]), int(at[k]), float(gain[k]))
                    below = left[k, slot[k], at[k]]
                    for child, t in ((first, below), (first + 1, total[k] - below)):
                        tree.value[child] = float(-s.learning_rate * t[0] / (t[1] + lam))
                        if tree.depth(child) < s.max_depth:
                            tree.active.append(child)
        done.append(tree)
    if last is not None:
        last.unpersist()
    return done


# ---------------------------------------------------------------- forests ---
@dataclass(frozen=True)
class Forest:
    """Settings of a random forest."""

    trees: int = 100
    max_depth: int = 10
    min_split: int = 5
    min_leaf: int = 2
    features: int = 3
    seed: int = 42
    bootstrap: bool = True


#: Poisson(1) by inversion: a draw below the i-th bound gives i copies.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(13)])


def _copies(block: Block, f: Forest, tree: int, held: int | None) -> np.ndarray:
    """How often each row is in the bag of a tree (rows of the held-out fold never)."""
    n = np.ones(len(block.y), np.int64)
    if f.bootstrap:
        u = (_draw(block.key, f.seed, 3, tree) >> np.uint64(11)) * 2.0**-53
        n = np.searchsorted(_POISSON, u, "right")
    return n if held is None else np.where(block.fold == held, 0, n)


def _subsets(tree: Tree, active: list[int], d: int, f: Forest, number: int) -> np.ndarray:
    """Features of each active node: a hashed choice by seed, tree and path."""
    keep = min(max(1, f.features), d)
    path = np.array([tree.path[a] for a in active], np.uint64)
    rank = _draw((path[:, None] << np.uint64(8)) + np.arange(d, dtype=np.uint64), f.seed, 4, number)
    return np.sort(np.argsort(rank, axis=1, kind="stable")[:, :keep], axis=1)


def _toward(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, ...]:
    """The tree's arrays without the branches that do not lead to these nodes."""
    feature, at, left, value = tree.arrays()
    parent, inner = np.full(len(left), -1), np.flatnonzero(left >= 0)
    parent[left[inner]] = parent[left[inner] + 1] = inner
    needed, up = np.zeros(len(left), bool), parent[nodes]
    while len(up := np.unique(up[up >= 0])):
        needed[up] = True
        up = parent[up]
    return feature, at, np.where(needed, left, -1).astype(left.dtype), value


def _gini(t: np.ndarray) -> np.ndarray:
    w = t[..., 0] + t[..., 1]
    return np.divide(t[..., 0] ** 2 + t[..., 1] ** 2, w, out=np.zeros_like(w), where=w > 0)


def grow_forests(data: Binned, wanted: Sequence[tuple[Forest, int | None]]) -> list[list[Tree]]:
    """A forest for each (settings, held-out fold or None), all in the same
    passes.

    A node splits where the weighted Gini impurity falls most, if it is impure,
    has ``min_split`` rows in the bag, and leaves ``min_leaf`` of them on both
    sides.  A tree's value is the weighted share of label 1.  Trees of one bag
    that differ in ``min_leaf`` alone share the sums of their common nodes."""
    out = [[Tree() for _ in range(f.trees)] for f, _ in wanted]
    unit, bins, d = _scale(data, data.widest * len(_POISSON)), data.bins, len(data.cols)
    sc = data.blocks.ctx
    same = [(f.features, f.seed, f.bootstrap, held) for f, held in wanted]
    #: each active node's number; nodes of a level have the same one if they came by the same splits
    number = {(g, t): {0: 0} for g, forest in enumerate(out) for t in range(len(forest))}
    while True:
        todo = [(g, t) for g, forest in enumerate(out) for t, tree in enumerate(forest) if tree.active]
        if not todo or not data.rows:
            return out
        todo.sort(key=lambda gt: (gt[1], str(wanted[gt[0]][1])))  # trees with the same bag together
        owner, own, leasts = {}, {gt: [] for gt in todo}, {}
        for g, t in todo:
            for node in out[g][t].active:
                at = owner.setdefault((t, same[g], number[g, t][node]), ((g, t), len(own[g, t])))
                if at == ((g, t), len(own[g, t])):
                    own[g, t].append(node)
                leasts.setdefault(at[0], set()).add(wanted[g][0].min_leaf)
        size = [len(own[gt]) * min(max(1, wanted[gt[0]][0].features), d) * bins * 3 * 8 for gt in todo]
        first, found = 0, {}
        while first < len(todo):
            last = first + 1
            while last < len(todo) and sum(size[first : last + 1]) <= PASS_BYTES:
                last += 1
            work = []
            for g, t in todo[first:last]:
                tree, f = out[g][t], wanted[g][0]
                if own[g, t]:
                    nodes = np.array(own[g, t])
                    work.append((g, t, _toward(tree, nodes), nodes, _subsets(tree, own[g, t], d, f, t)))
            first = last
            if not work:
                continue
            shared = sc.broadcast(work)

            def level(it, shared=shared):
                sums = [None] * len(shared.value)
                for b in it:
                    bags = {}
                    for k, (g, t, grown, active, feats) in enumerate(shared.value):
                        f, held = wanted[g]
                        bag = (t, f.seed, f.bootstrap, held)
                        if bag not in bags:
                            n = _copies(b, f, t, held)
                            rows = np.flatnonzero(n)
                            bags = {bag: (b.x[:, rows], b.y[rows], np.rint(n[rows] * b.w[rows] * unit))}
                        x, y, w = bags[bag]
                        where = np.full(len(grown[0]), -1)
                        where[active] = np.arange(len(active))
                        place = where[_places(grown, x)]
                        in_ = np.flatnonzero(place >= 0)
                        if len(in_):
                            if sums[k] is None:
                                sums[k] = _no_sums(len(active), feats.shape[1], bins, 3)
                            y, w = y[in_], w[in_]
                            _add_sums(sums[k], x, in_, place[in_], feats, bins, [np.where(y == 0, w, 0), np.where(y == 1, w, 0), None])
                return [((g, t), _packed(v)) for (g, t, *_), v in zip(shared.value, sums) if v is not None]

            def decide(item, leasts={(g, t): sorted(leasts[g, t]) for g, t, *_ in work}):
                (g, t), sums = item[0], _by_node(_unpacked(item[1]), bins)
                total = sums[:, 0].sum(1).astype(float)
                if bins < 2:
                    none = np.full(len(total), -1)
                    return (g, t), {least: (total, np.full(len(total), -np.inf), none, none, total) for least in leasts[g, t]}
                left, splits = np.cumsum(sums, axis=2)[:, :, :-1].astype(float), {}
                for least in leasts[g, t]:
                    gain, slot, at = _best(left, total, _gini, lambda a, b: (a[..., 2] >= least) & (b[..., 2] >= least))
                    splits[least] = total, gain, slot, at, left[np.arange(len(total)), slot, at]
                return (g, t), splits

            parts = max(1, min(len(work), data.blocks.getNumPartitions()))
            sent = {(g, t): feats for g, t, _, _, feats in work}
            for gt, splits in data.blocks.mapPartitions(level).groupByKey(parts).map(decide).collect():
                found[gt] = splits, sent[gt]
            shared.unpersist()
        known = {}
        for g, t in todo:
            tree, f, numbers, active = out[g][t], wanted[g][0], {}, out[g][t].active
            tree.active = []
            for node in active:
                from_, k = owner[t, same[g], number[g, t][node]]
                if from_ not in found:
                    continue
                splits, feats = found[from_]
                total, gain, slot, at, below = splits[f.min_leaf]
                tree.rows[node] = int(total[k, 2])
                tree.value[node] = float(total[k, 1] / max(total[k, 0] + total[k, 1], 1e-300))
                pure = total[k, 0] == 0 or total[k, 1] == 0
                if pure or gain[k] == -np.inf or total[k, 2] < f.min_split or tree.depth(node) >= f.max_depth:
                    continue
                split = int(feats[k, slot[k]]), int(at[k])
                child = tree.split(node, *split, float(max(gain[k], 0.0) / unit))
                for i, part in ((child, below[k]), (child + 1, total[k] - below[k])):
                    tree.rows[i] = int(part[2])
                    tree.value[i] = float(part[1] / max(part[0] + part[1], 1e-300))
                    if part[0] > 0 and part[1] > 0 and part[2] >= f.min_split and tree.depth(i) < f.max_depth:
                        tree.active.append(i)
                        numbers[i] = known.setdefault((number[g, t][node], *split, i - child), len(known) + 1)
            number[g, t] = numbers


def _stops(tree: Tree, max_depth: int, min_split: int) -> np.ndarray:
    """For the end of a row in the tree, its value in the tree cut at these settings."""
    left, value = np.array(tree.left), np.array(tree.value)
    depth = np.array([p.bit_length() - 1 for p in tree.path])
    cut, inner = (depth >= max_depth) | (np.array(tree.rows) < min_split), np.flatnonzero(left >= 0)
    for level in range(int(depth.max())):
        at = inner[depth[inner] == level]
        at = at[cut[at]]
        for child in (left[at], left[at] + 1):
            cut[child], value[child] = True, value[at]
    return value


def _grid_counts(data: Binned, grid: Sequence[Forest], grown: dict) -> dict:
    """Confusion counts {(setting's place in the grid, held-out fold, fold of
    the row): [tn, fp, fn, tp]} over all rows in one pass.  A row walks each
    grown tree once; the settings that cut the tree have their values where it
    ends."""
    tasks = []
    for (family, held), (_, forest) in grown.items():
        mine = [(i, f) for i, f in enumerate(grid) if _family(f) == family]
        cuts = list(dict.fromkeys((f.max_depth, f.min_split) for _, f in mine))
        tasks.append((held, [(i, f.trees, cuts.index((f.max_depth, f.min_split))) for i, f in mine], len(cuts),
                      [(t.arrays(), [_stops(t, *c) for c in cuts]) for t in forest]))
    shared = data.blocks.ctx.broadcast(tasks)

    def count(it):
        out = {}
        for b in it:
            folds = [(k, b.fold == k) for k in np.unique(b.fold).tolist()]
            for held, settings, cuts, trees in shared.value:
                p = np.zeros((cuts, len(b.y)))
                for n, (tree, values) in enumerate(trees, 1):
                    end = _places(tree, b.x)
                    for total, value in zip(p, values):
                        total += value[end]
                    for i, size, c in settings:
                        if size == n:
                            cell = b.y * 2 + (p[c] / n > 0.5)
                            for fold, rows in folds:
                                out[i, held, fold] = out.get((i, held, fold), 0) + np.bincount(cell[rows], minlength=4)
        return list(out.items())

    found = dict(data.blocks.mapPartitions(count).reduceByKey(np.add).collect())
    shared.unpersist()
    return found


@dataclass
class Search:
    """A grid search: confusion counts (tn, fp, fn, tp) by setting and fold, on
    the other folds and on the fold itself, and the forests behind them."""

    grid: list[Forest]
    folds: list[int]
    train: dict
    test: dict
    grown: dict

    def trees(self, setting: Forest, fold: int) -> list[Tree]:
        """The forest of a setting that was grown without ``fold``."""
        base, forest = self.grown[_family(setting), fold]
        return [t.cut(setting.max_depth, setting.min_split) for t in forest[: setting.trees]]


def _family(f: Forest) -> tuple:
    """Settings that agree in these are cuts of one forest."""
    return f.min_leaf, f.features, f.seed, f.bootstrap


def grid_search(data: Binned, grid: Sequence[Forest]) -> Search:
    """Every setting on every fold.  One forest grows per fold and family of
    settings, all in the same passes; one more pass counts the hits of all."""
    base: dict[tuple, Forest] = {}
    for f in grid:
        b = base.get(_family(f), f)
        base[_family(f)] = Forest(max(f.trees, b.trees), max(f.max_depth, b.max_depth), min(f.min_split, b.min_split),
                                  *_family(f))
    wanted = [(b, k) for b in base.values() for k in data.folds]
    grown = {(_family(b), k): (b, forest) for (b, k), forest in zip(wanted, grow_forests(data, wanted))}
    out = Search(list(grid), list(data.folds), {}, {}, grown)
    counts, none = _grid_counts(data, grid, grown), np.zeros(4, np.int64)
    for i, f in enumerate(grid):
        for k in data.folds:
            out.train[f, k] = sum((counts.get((i, k, j), none) for j in data.folds if j != k), none).tolist()
            out.test[f, k] = np.asarray(counts.get((i, k, k), none)).tolist()
    return out


# ----------------------------------------------------------------- models ---
def importances(trees: Sequence[Tree], d: int) -> np.ndarray:
    """Gain by feature, each tree's gains adding up to one, averaged over trees
    that split."""
    out, n = np.zeros(d), 0
    for t in trees:
        own = np.bincount([f for f in t.feature if f >= 0], [g for f, g in zip(t.feature, t.gain) if f >= 0], d)
        if own.sum() > 0:
            out, n = out + own / own.sum(), n + 1
    return out / max(1, n)


def to_json(trees: Sequence[Tree], edges: Sequence[np.ndarray], kind: str) -> str:
    """A fitted ensemble as text: per tree its features, thresholds (values up
    to one go left), left children, values, gains and row counts."""
    rows = [{"feature": t.feature, "threshold": [float(edges[f][b]) if f >= 0 else 0.0 for f, b in zip(t.feature, t.bin)],
             "left": t.left, "value": t.value, "gain": t.gain, "rows": t.rows} for t in trees]
    return json.dumps({"kind": kind, "trees": rows})


class Scorer:
    """Probability of label 1 for rows of raw features."""

    #: Row-tree pairs that are walked at a time.
    CELLS = 1 << 20

    def __init__(self, text: str):
        model = json.loads(text)
        self.kind, trees = model["kind"], model["trees"]
        size = np.cumsum([0] + [len(t["left"]) for t in trees])
        self.root = size[:-1]
        join = lambda name, kind: np.concatenate([np.asarray(t[name], kind) for t in trees] or [np.zeros(0, kind)])
        self.feature, self.threshold = join("feature", np.int64), join("threshold", float)
        self.left, self.value = join("left", np.int64), join("value", float)
        for i, t in enumerate(trees):
            own = self.left[size[i] : size[i + 1]]
            own[own >= 0] += size[i]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        n, trees = len(x), len(self.root)
        out = np.zeros(n)
        step = max(1, self.CELLS // max(1, trees))
        for i in range(0, n, step):
            part = x[i : i + step]
            node = np.repeat(self.root[:, None], len(part), axis=1).reshape(-1)
            row = np.tile(np.arange(len(part)), trees)
            open_ = np.flatnonzero(self.left[node] >= 0)
            while len(open_):
                at = node[open_]
                at = self.left[at] + ~(part[row[open_], self.feature[at]] <= self.threshold[at])
                node[open_] = at
                open_ = open_[self.left[at] >= 0]
            out[i : i + step] = self.value[node].reshape(trees, len(part)).sum(0)
        return 1 / (1 + np.exp(-out)) if self.kind == "boosted" else out / max(1, trees)


def tree_table(spark, text: str, cols: Sequence[str]) -> DataFrame:
    """The ensemble as a table: tree, node, feature, threshold, left_child,
    right_child, value, gain, rows (children null at a leaf)."""
    rows = []
    for i, t in enumerate(json.loads(text)["trees"]):
        for k, (f, th, left, v, g, n) in enumerate(zip(*(t[c] for c in ("feature", "threshold", "left", "value", "gain", "rows")))):
            inner = left >= 0
            rows.append((i, k, cols[f] if inner else None, th if inner else None, left if inner else None,
                         left + 1 if inner else None, v, g, n))
    return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, left_child int, "
                                       "right_child int, value double, gain double, rows long")
