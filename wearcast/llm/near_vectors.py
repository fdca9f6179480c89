"""Embedding near-duplicates by int8 tile products with error bounds.

Equal vectors of a label collapse to one with a number of copies.  A label's
vectors are dealt into tiles of bounded size, and every two tiles of a label
(a tile with itself too) form a unit, one task's work.  In a unit

* each vector is scaled to length 1 and quantised to int8 codes with a step of
  its own; the length of what the codes miss is its error bound;
* codes are multiplied tile by tile, a bounded stretch at a time.  The product
  is exact (integers below 2^24 in float32, so that it is one matrix product);
* by the triangle inequality a pair's cosine lies within e + (1 + e) f of the
  product, e and f being the two bounds.  Pairs that cannot reach the
  threshold end there, pairs that reach it for certain are links, and only the
  pairs in between are computed again in double precision.

A unit returns a row per linked vector: its number of links and a
representative of the vectors that it is connected with in the unit.  No pair
leaves the task.  Components follow from those rows.

Every vector is compared with all others of its label, as the method says: a
label of N vectors costs N^2 / 2 short products, and each vector is copied
once per tile of its label.  Labels are independent, and large ones are split
evenly over units.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .book import query
from .common import cut, drop_cut, table
from .graph import components
from .vectors import by_length, packed, pieces, unpacked

THRESHOLD = 0.93
#: Bytes of a tile's vectors as doubles.
TILE_BYTES = 16 << 20
#: Products held at a time, and pairs that are computed again at a time.
PRODUCTS, PAIRS = 1 << 21, 1 << 16
#: Covers the rounding of the scaled product and of the bounds.
SLACK = 1e-5
#: Codes of so many entries sum exactly in float32 (127 * 127 * 1,024 < 2^24).
EXACT_ENTRIES = 1024


def unit_vectors(m: np.ndarray) -> np.ndarray:
    """Rows as doubles, scaled to length 1 (rows must be finite and not zero)."""
    m = m.astype(float)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, step, error bound) of each unit vector."""
    step = np.abs(u).max(axis=1) / 127
    codes = np.rint(u / step[:, None]).astype(np.int8)
    missed = u - codes * step[:, None]
    return codes, step, np.sqrt((missed * missed).sum(axis=1)) * (1 + 1e-9) + 1e-12


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of all codes in a with all in b."""
    d = a.shape[1]
    if d <= EXACT_ENTRIES:
        return a.astype(np.float32) @ b.astype(np.float32).T
    return sum(_products(a[:, i : i + EXACT_ENTRIES], b[:, i : i + EXACT_ENTRIES]).astype(float)
               for i in range(0, d, EXACT_ENTRIES))


class Tile:
    def __init__(self, vectors: np.ndarray):
        self.unit = unit_vectors(vectors)
        self.codes, self.step, self.error = quantise(self.unit)

    def __len__(self) -> int:
        return len(self.unit)


def links(a: Tile, b: Tile | None, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (in a, in b) of all pairs with a cosine of ``threshold`` or
    more, a stretch at a time; without b, the pairs of a with later rows of a."""
    other = a if b is None else b
    if not len(a) or not len(other):
        return
    rows, widest = max(1, PRODUCTS // len(other)), other.error.max()
    codes = other.codes.astype(np.float32) if other.codes.shape[1] <= EXACT_ENTRIES else other.codes
    for at in range(0, len(a), rows):
        low = at if b is None else 0
        part = slice(at, at + rows)
        near = _products(a.codes[part], codes[low:]) * other.step[low:].astype(np.float32)
        e = a.error[part]
        least = (threshold - SLACK - e - (1 + e) * widest) / a.step[part]
        i, j = np.nonzero(near >= least[:, None])
        product = near[i, j].astype(float) * a.step[part][i]
        i, j = i + at, j + low
        if b is None:
            later = i < j
            i, j, product = i[later], j[later], product[later]
        gap = a.error[i] + (1 + a.error[i]) * other.error[j] + SLACK
        possible = product + gap >= threshold
        i, j, product, gap = i[possible], j[possible], product[possible], gap[possible]
        link = product - gap >= threshold
        open_ = np.flatnonzero(~link)
        for k in range(0, len(open_), PAIRS):
            p = open_[k : k + PAIRS]
            link[p] = np.einsum("ij,ij->i", a.unit[i[p]], other.unit[j[p]]) >= threshold
        yield i[link], j[link]


def connect(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (each node's smallest known companion) after joining a[i] with b[i]."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


def compare(vectors: np.ndarray, side: np.ndarray, copies: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each row's connected rows, number of links counted in
    copies) among the rows of a unit; of two sides, only links across count."""
    n, root = np.zeros(len(side), np.int64), np.arange(len(side))
    first = np.flatnonzero(side == side.min())
    second = np.flatnonzero(side != side.min())
    a, b = Tile(vectors[first]), Tile(vectors[second]) if len(second) else None
    for i, j in links(a, b, threshold):
        x, y = first[i], (second if b is not None else first)[j]
        np.add.at(n, x, copies[y])
        np.add.at(n, y, copies[x])
        root = connect(root, x, y)
    return root, n


def _read(vectors: DataFrame) -> tuple[DataFrame, str]:
    """(vec_id, label, vec): vec holds the entries' bytes, null if unusable."""
    entry = vectors.schema["embedding"].dataType.elementType
    dtype = "<f4" if isinstance(entry, T.FloatType) else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "embedding"):
            out = np.full(b.num_rows, None, object)
            for rows, m in by_length(b.column("embedding")):
                good = np.isfinite(m).all(1) & (m != 0).any(1)
                out[rows[good]] = packed(m[good].astype(dtype))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(out.tolist(), pa.binary())], ["vec_id", "label", "vec"])

    kind = vectors.schema["label"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    return rows.mapInArrow(run, f"vec_id long, label {kind}, vec binary"), dtype


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors of its label at or
    above the cosine), component_id (smallest vec_id reachable by links,
    itself included) and kept (vec_id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite entries, and
    those without a label, link with nothing and stay; so do vectors of
    different lengths among each other.  Each row counts as a vector of its
    own, repeated rows and repeated ids too.  A row without an id has its
    companions' smallest id, or null, and is kept if that is null.  Only
    vec_id, embedding and label are read; an empty table gives no rows."""
    read, dtype = _read(vectors)
    known = cut(read)
    usable = known.where("vec IS NOT NULL AND label IS NOT NULL")
    sets = usable.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    same = F.unhex(F.sha2("vec", 256)).alias("same")
    sets = cut(sets.select("label", "vec", "rep", "copies", same, F.monotonically_increasing_id().alias("node")))

    width = F.length("vec").alias("bytes")
    entry = 8 // np.dtype(dtype).itemsize
    sizes = sets.groupBy("label", width).agg(F.count("*").alias("rows")).where("rows > 1").select(
        "label", "bytes", F.ceil(F.col("rows") * F.col("bytes") * entry / tile_bytes).cast("int").alias("tiles"))
    dealt = sets.select("label", width, "node", "copies", "vec").join(sizes, ["label", "bytes"]).withColumn(
        "side", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    units = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "label", "bytes", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node",
        "copies", "vec")

    def verify(unit: pa.Table) -> pa.Table:
        vec = unit.column("vec").combine_chunks()
        m = unpacked(vec, np.dtype(dtype), len(vec[0].as_py()) // np.dtype(dtype).itemsize)
        node, side, copies = (np.asarray(unit.column(c)) for c in ("node", "side", "copies"))
        if unit.column("i")[0].as_py() != unit.column("j")[0].as_py() and len(np.unique(side)) < 2:
            root, n = np.arange(len(side)), np.zeros(len(side), np.int64)  # the other tile got no vector
        else:
            root, n = compare(m, side, copies, threshold)
        at = np.flatnonzero(n)
        return pa.table({"a": node[at], "b": node[root[at]], "links": n[at]})

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = ["label", "bytes", "i", "j"]
    linked = cut(units.repartition(parts, *keys).groupBy(*keys).applyInArrow(verify, "a long, b long, links long"))
    degree = linked.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = cut(components(linked.select("a", "b")).join(degree, "node").join(sets.select("node", "rep"), "node"))
    drop_cut(linked)
    first = classes.groupBy("component").agg(F.min("rep").alias("first"))
    found = classes.join(first, "component").select("node", "first", "links")
    named = sets.select("label", "same", "node", "rep", "copies").join(found, "node", "left").select(
        "label", "same", F.coalesce("first", "rep").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    rows = usable.select("vec_id", "label", same).join(named, ["label", "same"]).select("vec_id", "n_links", "component_id")
    alone = known.where("vec IS NULL OR label IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return rows.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach AS (SELECT DISTINCT x AS node, x AS other FROM pairs UNION SELECT r.node, p.y FROM reach r JOIN pairs p ON r.other = p.x),
lowest AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
n AS (SELECT x, count(*) AS n_links FROM pairs GROUP BY x)
SELECT t.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(f.component_id, t.vec_id) AS component_id,
       coalesce(f.component_id, t.vec_id) = t.vec_id AS kept
FROM embeddings t LEFT JOIN lowest f ON f.node = t.vec_id LEFT JOIN n ON n.x = t.vec_id
"""


@query("op11_int8_tiles", SQL)
def op11(spark, sf_dir):
    """Near-duplicate classes of all embeddings, within each label."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
