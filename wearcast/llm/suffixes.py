"""Removal of repeated passages by backward extension on a Burrows-Wheeler transform.

A byte goes if it lies in a ``length``-byte string that also starts earlier (in
a document with a smaller id, or before in the same one).

Every string of that length has an anchor: its ``ANCHOR``-byte gram of least
hash, the leftmost of equals.  Equal strings have equal anchors at the same
place, so only documents' stretches around the same anchor can hold equal
strings.  The starts that share an anchor form a run, and the run's bytes are
its context.

1. Equal contexts: the first occurrence stands, every later one is removed
   whole.  Blocks of documents settle this among themselves first, so a hot
   group of copies sends a few rows to a shuffle on the anchor.
2. Anchors with several different contexts: their first occurrences are
   gathered by anchor.  A task sorts the suffixes of a bounded batch, forms the
   transform, and starts from the intervals of strings of half the length.
   Breadth-first backward extension turns the intervals of length l into those
   of l + 1, keeps the ones with two or more suffixes, and stops at ``length``.
   All but the first suffix of a final interval are repeats.
3. An anchor with more than ``MOST_CONTEXTS`` different contexts would not be
   bounded: the strings of its contexts are hashed (128 bits) and ranked by a
   shuffle on the hash instead.

The spans of each document are then merged and cut out of its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .book import query
from .common import U64, _VALUES, _tables, blocks, cut, drop_cut, mix, raw_text, small_batches, table, tidy

LENGTH, ANCHOR = 100, 40
MOST_CONTEXTS = 4000
BATCH_BYTES = 1 << 19
GATHER = 100_000
#: Per-document lists are broadcast up to this many bytes, else joined by shuffle.
BROADCAST_BYTES = 48 << 20
_NO_ID = -(2**63)


def _prefix_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _tables(len(buf))
    total = np.zeros(len(buf) + 1, U64)
    np.cumsum(_VALUES[buf] * power[: len(buf)], out=total[1:])
    return total, inverse


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = ANCHOR):
    """(anchor hash, context hash, document, first start, last start) of every
    run of starts with the same anchor, in order."""
    none = (np.zeros(0, U64), np.zeros(0, U64), *[np.zeros(0, np.int64)] * 3)
    if len(buf) < length:
        return none
    total, inverse = _prefix_hashes(buf)
    value = mix((total[gram:] - total[: len(buf) - gram + 1]) * inverse[: len(buf) - gram + 1])
    # the least of each `width` grams, doubling the covered stretch
    width, covered = length - gram + 1, 1
    best, low = np.arange(len(value), dtype=np.int64), value
    while covered < width:
        step = min(covered, width - covered)
        n = len(low) - step
        later = low[step:] < low[:n]
        best, low = np.where(later, best[step:], best[:n]), np.where(later, low[step:], low[:n])
        covered += step
    start = np.arange(len(best))
    after = np.searchsorted(offsets, start, "right")
    inside = start + length <= offsets[after]
    start, best, doc = start[inside], best[inside], after[inside] - 1
    if not len(start):
        return none
    new = np.ones(len(start), bool)
    new[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    first, last, best = start[at], start[np.append(at[1:], len(start)) - 1], best[at]
    content = (total[last + length] - total[first]) * inverse[first]
    context = mix(content + mix((last - first).astype(U64) * U64(2**32) + (best - first).astype(U64)))
    return value[best], context, doc[at], first, last


def _merged(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the spans, sorted by group and start, within each group."""
    if not len(group):
        return group, start, end
    reach = np.empty_like(end)
    edge = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    for a, z in zip(edge, np.append(edge[1:], len(end))):
        reach[a:z] = np.maximum.accumulate(end[a:z])
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return group[at], start[at], reach[np.append(at[1:], len(end)) - 1]


def repeated_starts(texts: list[bytes], order: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each text, the starts of ``length``-byte strings that also occur at
    an earlier place; ``order`` ranks the texts' places (text, then start:
    row i holds the key columns of text i, the last one its first start)."""
    size = np.array([len(t) for t in texts])
    base = np.concatenate([[0], np.cumsum(size + 1)])
    n = int(base[-1])
    owner = np.repeat(np.arange(len(texts)), size + 1)
    symbol = np.zeros(n, np.int64)
    inside = np.ones(n, bool)
    inside[base[1:] - 1] = False
    symbol[inside] = np.frombuffer(b"".join(texts), np.uint8)
    symbol[~inside] = 256 + np.arange(len(texts))  # no string runs across a text's end
    # ranks of the first 1, 2, 4, ... symbols
    rank, covered, half = np.unique(symbol, return_inverse=True)[1], 1, None
    while covered < length:
        following = np.zeros(n, np.int64)
        following[: max(0, n - covered)] = rank[covered:] + 1
        rank = np.unique(rank * (n + 1) + following, return_inverse=True)[1]
        covered *= 2
        if covered * 2 >= length and half is None:
            half, level = rank, covered
    if half is None:
        half, level = symbol, 1
    suffix = np.argsort(rank, kind="stable")
    place = np.empty(n, np.int64)
    place[suffix] = np.arange(n)
    left = np.append(symbol[-1:], symbol[:-1])[suffix]  # the transform
    head = symbol[suffix]
    # intervals of strings of `level` symbols: neighbours of equal rank, twice or more
    name = half[suffix]
    room = (base[1:] - 1)[owner] - np.arange(n)
    slot = np.flatnonzero((room >= level)[suffix])
    label = name[slot]
    while True:
        same = label[1:] == label[:-1] if len(label) else np.zeros(0, bool)
        twice = np.append(same, False) | np.append(False, same)
        slot, label = slot[twice[: len(slot)]], label[twice[: len(label)]]
        if level == length or not len(slot):
            break
        # one step back: interval (label) and the symbol before it name the new interval
        open_ = left[slot] < 256
        to = place[suffix[slot[open_]] - 1]
        mark = np.full(n, -1, np.int64)
        mark[to] = label[open_]
        slot = np.flatnonzero(mark >= 0)
        before = mark[slot]
        new = np.ones(len(slot), bool)
        new[1:] = (before[1:] != before[:-1]) | (head[slot[1:]] != head[slot[:-1]])
        label = np.cumsum(new)
        level += 1
    out = [np.zeros(0, np.int64)] * len(texts)
    if len(slot):
        at = suffix[slot]
        text = owner[at]
        start = at - base[text]
        keys = (order[text, -1] + start, *[order[text, c] for c in range(order.shape[1] - 2, -1, -1)], label)
        rank = np.lexsort(keys)
        later = np.zeros(len(slot), bool)
        later[rank[1:]] = label[rank[1:]] == label[rank[:-1]]
        text, start = text[later], start[later]
        by = np.lexsort((start, text))
        text, start = text[by], start[by]
        for i, a, z in zip(*np.unique(text, return_index=True), np.append(np.unique(text, return_index=True)[1][1:], len(text))):
            out[int(i)] = start[a:z]
    return out


_ROW = "key long, context long, doc_id long, th long, first long, last long, closed boolean"


def _open_and_closed(parts: list[tuple], length: int) -> pa.RecordBatch:
    """Settle equal contexts among gathered rows: the first stays open, later
    ones become merged spans (closed), the same place twice counts once."""
    key, context, doc, th, first, last = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((first, th, doc, context))
    key, context, doc, th, first, last = (x[order] for x in (key, context, doc, th, first, last))
    new = np.ones(len(key), bool)
    new[1:] = context[1:] != context[:-1]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    same_place = (doc == doc[lead]) & (th == th[lead]) & (first == first[lead])
    late = ~same_place
    by = np.lexsort((first[late], th[late], doc[late]))
    d, t, a, z = doc[late][by], th[late][by], first[late][by], last[late][by] + length
    group = np.cumsum(np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1]))) if len(d) else np.zeros(0, np.int64)
    run, a, z = _merged(group, a, z)
    at = np.searchsorted(group, run)
    d, t = d[at], t[at]
    own = mix(a.astype(U64) + mix(d.view(U64) + mix(t.view(U64))))  # closed rows need no company
    columns = [np.concatenate([key[new], own]).view(np.int64), np.concatenate([context[new], own]).view(np.int64),
               np.concatenate([doc[new], d]), np.concatenate([th[new], t]), np.concatenate([first[new], a]),
               np.concatenate([last[new], z - length])]
    flag = np.repeat([False, True], [int(new.sum()), len(d)])
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(flag)],
                                      ["key", "context", "doc_id", "th", "first", "last", "closed"])


def _packed(spans: DataFrame, length: int | None = None) -> DataFrame:
    """One row per document: its (first, last, key) rows as packed integers;
    with ``length``, runs of starts whose strings touch are merged into one."""
    rows = spans.groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("first", "last", "key"))).alias("rows"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("rows")
            flat, off = col.flatten(), np.asarray(col.offsets) - col.offsets[0].as_py()
            raw = np.stack([np.asarray(flat.field(k)) for k in range(3)], axis=1).astype("<i8")
            if length:
                run, first, end = _merged(np.repeat(np.arange(len(off) - 1), np.diff(off)), raw[:, 0], raw[:, 1] + length)
                raw = np.stack([first, end - length, np.zeros_like(first)], axis=1).astype("<i8")
                off = np.searchsorted(run, np.arange(len(off)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"),
                 pa.array([raw[a:z].tobytes() for a, z in zip(off[:-1], off[1:])], pa.binary())], ["doc_id", "th", "rows"])

    return rows.mapInArrow(pack, "doc_id long, th long, rows binary")


def _beside(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    size = lists.agg(F.coalesce(F.sum(F.octet_length("rows") + 48), F.lit(0))).first()[0]
    return docs.join(F.broadcast(lists) if size <= BROADCAST_BYTES else lists, ["doc_id", "th"], how)


def repeated_spans(docs: DataFrame, length: int = LENGTH, most: int = MOST_CONTEXTS) -> tuple[DataFrame, list[DataFrame]]:
    """(doc_id, th, first, last): runs of starts of repeated strings, of
    ``docs`` with doc_id, th and text; and the tables that hold them."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in blocks(batches, "text"):
            buf, offsets = raw_text(b.column("text"))
            key, context, doc, first, last = anchors(buf, offsets, length, ANCHOR * length // LENGTH)
            if len(key):
                ids, th = np.asarray(b.column("doc_id")), np.asarray(b.column("th"))
                parts.append((key, context, ids[doc], th[doc], first - offsets[doc], last - offsets[doc]))
                held += len(key)
            if held >= GATHER:
                yield _open_and_closed(parts, length)
                parts, held = [], 0
        if parts:
            yield _open_and_closed(parts, length)

    found = docs.mapInArrow(tidy(find), _ROW).repartition("key")
    place = Window.partitionBy("key", "context").orderBy("doc_id", "th", "first")
    whole = Window.partitionBy("key")
    judged = found.withColumn("rank", F.rank().over(place)).withColumn(
        "several", F.min("context").over(whole) != F.max("context").over(whole))
    with small_batches(docs.sparkSession):
        settled = cut(judged.where("closed OR rank > 1 OR several").select(
            "doc_id", "th", "first", "last", "key", (F.col("closed") | (F.col("rank") > 1)).alias("repeat")))

    wanted = cut(_packed(settled.where("NOT repeat").distinct()))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            out = []
            texts = b.column("text").cast(pa.large_binary())
            for doc, th, rows, text in zip(b.column("doc_id").to_pylist(), b.column("th").to_pylist(), b.column("rows"), texts):
                raw = memoryview(text.as_buffer())
                for first, last, key in np.frombuffer(rows.as_buffer(), "<i8").reshape(-1, 3).tolist():
                    out.append((key, doc, th, first, bytes(raw[first : last + length])))
            cols = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 4 + [pa.binary()])], ["key", "doc_id", "th", "first", "bytes"])

    gathered = _beside(docs, wanted, "inner").mapInArrow(
        tidy(contexts), "key long, doc_id long, th long, first long, bytes binary").dropDuplicates(["key", "doc_id", "th", "first"])
    with small_batches(docs.sparkSession):
        gathered = cut(gathered)
    hot = F.broadcast(cut(gathered.groupBy("key").count().where(F.col("count") > most).select("key"))) \
        if gathered.count() > most else None  # at most count / most keys
    mild = gathered.join(hot, "key", "left_anti") if hot is not None else gathered

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("key", "doc_id", "th", "first", "bytes"))):
                if size >= BATCH_BYTES and r[0] != rows[-1][0]:
                    yield _batch_spans(rows, length)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[4]) + 1
        if rows:
            yield _batch_spans(rows, length)

    spans = "doc_id long, th long, first long, last long"
    out = settled.where("repeat").select("doc_id", "th", "first", "last").unionAll(
        mild.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(extend), spans))
    if hot is not None:
        def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                buf, offsets = raw_text_of(b.column("bytes"))
                total, inverse = _prefix_hashes(buf)
                size = np.maximum(0, np.diff(offsets) - length + 1)
                row = np.repeat(np.arange(len(size)), size)
                shift = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                at = offsets[row] + shift
                h = (total[at + length] - total[at]) * inverse[at]
                other = mix(buf.astype(U64) + U64(977))
                power, inv = _tables(len(buf))
                second = np.zeros(len(buf) + 1, U64)
                np.cumsum(other * power[: len(buf)], out=second[1:])
                g = (second[at + length] - second[at]) * inv[at]
                col = lambda c: np.asarray(b.column(c))[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(h).view(np.int64)), pa.array(mix(g).view(np.int64)), pa.array(col("doc_id")),
                     pa.array(col("th")), pa.array(col("first") + shift)], ["h", "g", "doc_id", "th", "at"])

        every = gathered.join(hot, "key", "left_semi").select("doc_id", "th", "first", "bytes").mapInArrow(
            tidy(strings), "h long, g long, doc_id long, th long, at long")
        ranked = every.withColumn("rank", F.rank().over(Window.partitionBy("h", "g").orderBy("doc_id", "th", "at")))
        out = out.unionAll(ranked.where("rank > 1").select(
            "doc_id", "th", F.col("at").alias("first"), F.col("at").alias("last")))
    return out, [settled, wanted, gathered]


def raw_text_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column."""
    col = col.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def _batch_spans(rows: list[tuple], length: int) -> pa.RecordBatch:
    order = np.array([r[1:4] for r in rows], np.int64)
    starts = repeated_starts([r[4] for r in rows], order, length)
    out = []
    for (doc, th, first), s in zip(order.tolist(), starts):
        if len(s):
            edge = np.flatnonzero(np.append(True, np.diff(s) > 1))
            out += [(doc, th, first + int(s[a]), first + int(s[z - 1])) for a, z in zip(edge, np.append(edge[1:], len(s)))]
    cols = zip(*out) if out else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "th", "first", "last"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, most: int = MOST_CONTEXTS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 and kept (the remaining bytes).

    Null text is empty.  Documents without an id come before all others.  Rows
    with the same id and text are one document and get the same result; rows
    with the same id and different texts follow each other by text hash.
    Other columns are not read; an empty table gives an empty result."""
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    hashed = base.withColumn("th", F.xxhash64("text"))
    if not hashed.groupBy("doc_id").agg(F.min("th").alias("a"), F.max("th").alias("b")).where("a <> b").limit(1).count():
        hashed = base.withColumn("th", F.lit(0).cast("long"))  # ids tell the documents apart
    found, held = repeated_spans(hashed, length, most)
    with small_batches(docs.sparkSession, 10_000):
        lists = cut(_packed(found.withColumn("key", F.lit(0).cast("long")), length))
    for done in held:
        drop_cut(done)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            out = []
            for text, rows in zip(b.column("text").cast(pa.large_binary()), b.column("rows")):
                raw = memoryview(text.as_buffer())
                kept, at, gone, runs = [], 0, 0, 0
                if rows.is_valid:
                    s = np.frombuffer(rows.as_buffer(), "<i8").reshape(-1, 3)
                    _, first, end = _merged(np.zeros(len(s), np.int64), s[:, 0], s[:, 1] + length)
                    runs = len(first)
                    for a, z in zip(first.tolist(), end.tolist()):
                        kept.append(raw[at:a])
                        gone += z - a
                        at = z
                kept.append(raw[at:])
                rest = b"".join(kept)
                out.append((len(raw), gone, runs, hashlib.sha256(rest).hexdigest(), rest))
            cols = zip(*out) if out else [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = _beside(hashed, lists, "left").select("doc_id", "text", "rows").mapInArrow(
        tidy(remove), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return done.withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))


@query("op3_bwt_expansion")
def op3(spark, sf_dir):
    """Repeated 100-byte strings removed from all documents; digests."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
