"""Shared pieces: scratch tables, byte-bounded Arrow blocks, vectorised words.

Python operators work on Arrow batches with numpy.  A batch is cut into blocks
of at most ``BLOCK_BYTES`` of text (one longer text is a block of its own), so
a task's memory does not follow the batch's row count.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from wearcast.session import ensure_checkpoint_dir

BLOCK_BYTES = 1 << 19

U64 = np.uint64
_C1, _C2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write to a new table in the shared checkpoint folder and read it back:
    the lineage ends there, lost executors cost nothing, later reads prune
    columns.  The shuffle files of the write go with it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files when they end: else
    those stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Actions inside send at most ``rows`` rows to Python at a time: long
    texts would otherwise pile up outside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tidy(fn):
    """``fn`` over Arrow batches, giving free memory back when the task ends
    (an idle worker would keep it beside the next stage)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def drop_cut(df: DataFrame) -> None:
    """Delete the table behind a frame that ``cut`` returned."""
    spark = df.sparkSession
    jvm = spark._jvm
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        if path.getName().startswith("cut-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _bytes_of(col: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)


def blocks(batches: Iterable[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text each."""
    for b in batches:
        if b.num_rows == 0:
            continue
        size = _bytes_of(b.column(text))
        at = 0
        while at < b.num_rows:
            n = int(np.searchsorted(np.cumsum(size[at:]), limit, "right"))
            yield b.slice(at, max(1, n))
            at += max(1, n)


def raw_text(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a block, and the offsets of each (nulls: empty)."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser of 64-bit values."""
    x = (x ^ (x >> U64(30))) * _C1
    x = (x ^ (x >> U64(27))) * _C2
    return x ^ (x >> U64(31))


_IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = _IDENTITY.copy()
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_VALUES = np.random.default_rng(20240607).integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64, up to n."""
    if len(_powers[0]) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def _value(code: np.ndarray) -> np.ndarray:
    """Pseudo-random value of a (place in the word, byte) code."""
    return mix(code.astype(U64) * U64(_BASE) + _C1)


_PLACES = 64
_NEAR = _value(np.arange(_PLACES * 256))


class Words:
    """The words of a block: byte spans, document numbers and 64-bit hashes.

    The hash sums one pseudo-random value a (place in the word, byte) pair
    modulo 2^64, finalised with the length: equal words have equal hashes,
    and no arrangement of the same bytes cancels out, as it can in a
    polynomial modulo a power of two."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: np.ndarray | None = LOWER,
                 separator: np.ndarray = SPACE, cuts: np.ndarray | None = None):
        n = len(buf)
        gap = separator[buf]
        first = np.empty(n, bool)
        if n:
            first[0] = True
            first[1:] = gap[:-1]
            inner = offsets[offsets < n]
            first[inner] = True
            if cuts is not None:  # more places where a word begins
                first |= cuts
            last = np.empty(n, bool)
            last[:-1] = first[1:] | gap[1:]
            last[-1] = True
            first &= ~gap
            last &= ~gap
        else:
            last = first
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        #: words of document i are first[i]:first[i+1]
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)
        kind = np.int32 if n < 1 << 23 else np.int64  # a code is 256 times a place
        opens = np.append(0, self.start).astype(kind)
        size = np.diff(opens, append=kind(n))
        code = np.arange(n, dtype=kind)
        code -= np.repeat(opens, size)  # place in the word
        code <<= 8
        code |= lower[buf] if lower is not None else buf
        value = _NEAR.take(code, mode="clip")
        if size.max(initial=0) > _PLACES:
            far = np.flatnonzero(code >= len(_NEAR))
            value[far] = _value(code[far])
        total = np.zeros(n + 1, U64)
        np.cumsum(value, out=total[1:])
        h = total[self.end] - total[self.start]
        self.hash = mix(h + (self.end - self.start).astype(U64) * U64(_BASE))


_SALT = mix(np.arange(1, 65, dtype=np.uint64) * U64(_BASE)) | U64(1)


def shingles(words: Words, k: int, whole_short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(document number, hash) of every k-word window, repeats included; a
    text of fewer words gives its whole sequence as one (or nothing)."""
    h, first, count = words.hash, words.first, words.count
    n = len(h)
    acc = np.zeros(max(0, n - k + 1), U64)
    for j in range(k):
        acc += mix(h[j : n - k + 1 + j] + _SALT[j]) * _SALT[j]
    inside = words.doc[: len(acc)] == words.doc[k - 1 :] if len(acc) else np.zeros(0, bool)
    doc, out = words.doc[: len(acc)][inside], mix(acc[inside])
    if whole_short:
        short = np.flatnonzero((count > 0) & (count < k))
        if len(short):
            extra = np.zeros(len(short), U64)
            for j in range(k - 1):
                has = count[short] > j
                extra[has] += mix(h[first[short[has]] + j] + _SALT[j]) * _SALT[j]
            extra = mix(extra + count[short].astype(U64) * _SALT[-1])
            doc, out = np.concatenate([doc, short]), np.concatenate([out, extra])
    return doc, out


def distinct_sets(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs, ordered by both."""
    order = np.argsort(h, kind="stable")
    doc, h = doc[order], h[order]
    order = np.argsort(doc, kind="stable")
    doc, h = doc[order], h[order]
    if len(h):
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        doc, h = doc[keep], h[keep]
    return doc, h


def segment_sum(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[start:end] modulo 2^64."""
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
