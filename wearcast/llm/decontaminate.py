"""Benchmark decontamination: BM25 over test items with block-max WAND.

The test items form an inverted index: for each term the items that hold it,
with BM25 impacts scaled so that an item's own text scores 1 against it.
Items lie in blocks; beside its postings a term has its largest impact in each
block where it occurs, and overall.  Every document is cut into overlapping
passages of whole words, and every passage is a query:

* its terms are ordered by their largest impacts; from the pivot on, where the
  running sum can reach the threshold, a term is essential, and only blocks
  with an essential term are looked at;
* the block maxima of all its terms bound what an item of a block can score,
  and blocks below the threshold are skipped;
* the items of the other blocks get their exact score from the postings.

So every item at or above the threshold is retrieved.

A retrieved item counts as a leak if a retrieved passage (with a margin of a
quarter passage on both sides) holds at least ``OVERLAP`` of the shingles of
its question and of its answer (3 words each; a shorter part is one shingle of
all its words).

Passages have twice the words of the longest of all items and start every half
passage, so a copied item lies whole in one.  Term statistics are Spark
aggregates over all items.  The index is built for at most ``SHARD_BYTES`` of
item text at a time, in sparse arrays (some 20 bytes a posting), and
``PASS_SHARDS`` of them are shipped to the tasks and searched in one scan of
the documents.  Neither bound changes a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .book import query
from .common import Words, blocks, cut, drop_cut, raw_text, shingles, table

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, SHINGLE = 0.5, 0.6, 3
ITEMS_PER_BLOCK = 8
MIN_PASSAGE = 32
SHARD_BYTES, PASS_SHARDS = 8 << 20, 4
_BLOOM = 1 << 20

#: Words are runs of letters, digits and non-ASCII bytes; case is dropped for
#: ASCII and (in ``_folded``) for the Latin-1 letters.
SEPARATOR = np.ones(256, bool)
SEPARATOR[48:58] = SEPARATOR[65:91] = SEPARATOR[97:123] = SEPARATOR[128:] = False


def _folded(buf: np.ndarray) -> np.ndarray:
    """Bytes with the capital Latin-1 letters (C3 80 to C3 9E) made small."""
    if len(buf) < 2:
        return buf
    big = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)) + 1
    out = buf.copy()
    out[big] += 0x20
    return out


def words_of(col: pa.Array) -> Words:
    buf, offsets = raw_text(col)
    return Words(_folded(buf), offsets, separator=SEPARATOR)


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item that is one text: the last sentence is
    the answer; a single sentence is a question without an answer."""
    parts = [p for p in text.replace("\n", " ").replace("? ", "?\x00").replace(". ", ".\x00").split("\x00") if p.strip()]
    return (text, "") if len(parts) < 2 else (" ".join(parts[:-1]), parts[-1])


@dataclass
class Index:
    """Inverted index of one shard of items.

    Term t's postings are ``item`` and ``impact`` from start[t] to start[t + 1],
    by item; its block maxima are ``block`` and ``highest`` from first[t] to
    first[t + 1]; ``most[t]`` is the largest of them."""

    ids: list
    parts: list[list[tuple[int, np.ndarray]]]
    passage: int
    terms: np.ndarray
    start: np.ndarray
    item: np.ndarray
    impact: np.ndarray
    first: np.ndarray
    block: np.ndarray
    highest: np.ndarray
    most: np.ndarray
    bloom: np.ndarray = field(repr=False)

    @property
    def blocks(self) -> int:
        return -(-len(self.ids) // ITEMS_PER_BLOCK)


def _part_shingles(words: Words, i: int) -> tuple[int, np.ndarray]:
    """(words a shingle, distinct shingle hashes) of text i of a block."""
    size = min(SHINGLE, int(words.count[i]))
    doc, h = shingles(words, size, whole_short=False) if size else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    return size, np.unique(h[doc == i])


@dataclass(frozen=True)
class Facts:
    """Of all items: their number, mean and largest number of words."""

    items: int
    average: float
    longest: int

    @property
    def passage(self) -> int:
        return 2 * max(self.longest, MIN_PASSAGE)


def build_index(shard: list, facts: Facts) -> Index:
    """Index of rows (item_id, question, answer, words, postings of (term, count, items with it))."""
    parts, item, term, value = [], [], [], []
    for i, r in enumerate(shard):
        w = words_of(pa.array([r["question"], r["answer"]], pa.string()))
        parts.append([_part_shingles(w, k) for k in (0, 1)])
        t, c, n = (np.array([p[k] for p in r["postings"]], kind) for k, kind in enumerate((np.int64, float, float)))
        idf = np.log(1 + (facts.items - n + 0.5) / (n + 0.5))
        raw = idf * c * (K1 + 1) / (c + K1 * (1 - B + B * r["words"] / max(1.0, facts.average)))
        item.append(np.full(len(t), i))
        term.append(t.view(np.uint64))
        value.append(raw / raw.sum())
    item, term, value = np.concatenate(item), np.concatenate(term), np.concatenate(value)
    order = np.lexsort((item, term))
    item, term, value = item[order], term[order], value[order]
    terms, start = np.unique(term, return_index=True)
    own = item // ITEMS_PER_BLOCK
    opens = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (own[1:] != own[:-1])))
    highest = np.maximum.reduceat(value, opens)
    first = np.searchsorted(opens, np.append(start, len(term)))
    bloom = np.zeros(_BLOOM, bool)
    bloom[terms & np.uint64(_BLOOM - 1)] = True
    return Index([r["item_id"] for r in shard], parts, facts.passage, terms, np.append(start, len(term)), item.astype(np.int32),
                 value, first, own[opens].astype(np.int32), highest, np.maximum.reduceat(highest, first[:-1]), bloom)


def _term_numbers(index: Index, h: np.ndarray) -> np.ndarray:
    """Term number of every word, -1 if it is in no item."""
    out = np.full(len(h), -1, np.int32)
    maybe = np.flatnonzero(index.bloom[h & np.uint64(_BLOOM - 1)])
    at = np.searchsorted(index.terms, h[maybe])
    at[at == len(index.terms)] = 0
    known = index.terms[at] == h[maybe]
    out[maybe[known]] = at[known]
    return out


def _passages(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first and last word (exclusive) of every passage."""
    stride = size // 2
    n = np.where(words.count > 0, np.maximum(1, -(-np.maximum(words.count - size, 0) // stride) + 1), 0)
    doc = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = words.first[doc] + k * stride
    return doc, first, np.minimum(first + size, words.first[doc + 1])


def _lists(bounds: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Places of all entries of the terms' lists."""
    size = bounds[terms + 1] - bounds[terms]
    ends = np.cumsum(size)
    return np.repeat(bounds[terms] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def retrieve(index: Index, own: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(items, scores) at or above the threshold for a query of distinct terms."""
    most = index.most[own]
    order = np.argsort(most, kind="stable")
    essential = own[order[np.cumsum(most[order]) >= threshold - 1e-6]]
    if not len(essential):
        return np.zeros(0, np.int64), np.zeros(0)
    candidate = np.zeros(index.blocks, bool)
    candidate[index.block[_lists(index.first, essential)]] = True
    at = _lists(index.first, own)
    candidate &= np.bincount(index.block[at], index.highest[at], index.blocks) >= threshold - 1e-6
    if not candidate.any():
        return np.zeros(0, np.int64), np.zeros(0)
    at = _lists(index.start, own)
    at = at[candidate[index.item[at] // ITEMS_PER_BLOCK]]
    score = np.bincount(index.item[at], index.impact[at], len(index.ids))
    found = np.flatnonzero(score >= threshold - 1e-9)
    return found, score[found]


def search(index: Index, words: Words, threshold: float) -> dict[tuple[int, int], list[tuple[float, int, int]]]:
    """(score, first, last word) of the passages that retrieve an item, by (document, item)."""
    found: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
    if not len(index.ids) or not len(words.hash):
        return found
    term = _term_numbers(index, words.hash)
    at = np.flatnonzero(term >= 0)
    term = term[at]
    doc, first, last = _passages(words, index.passage)
    low, high = np.searchsorted(at, first), np.searchsorted(at, last)
    # the sum over all words, repeats included, bounds the sum over terms
    total = np.zeros(len(term) + 1)
    np.cumsum(index.most[term], out=total[1:])
    alive = np.flatnonzero(total[high] - total[low] >= threshold - 1e-6)
    # the distinct terms of each of those, and their sum as the next bound
    size = high[alive] - low[alive]
    ends = np.cumsum(size)
    places = np.repeat(low[alive] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
    pairs = np.unique(np.repeat(np.arange(len(alive)), size) * len(index.terms) + term[places])
    of, term = np.divmod(pairs, len(index.terms))
    bound = np.bincount(of, index.most[term], len(alive))
    edge = np.searchsorted(of, np.arange(len(alive) + 1))
    for k in np.flatnonzero(bound >= threshold - 1e-6):
        p = alive[k]
        for i, score in zip(*(x.tolist() for x in retrieve(index, term[edge[k] : edge[k + 1]], threshold))):
            found.setdefault((int(doc[p]), i), []).append((score, int(first[p]), int(last[p])))
    return found


class _Shingles:
    """Shingles of a block by their number of words, with the word each begins at."""

    def __init__(self, words: Words):
        self.words, self.by = words, {}

    def share(self, part: tuple[int, np.ndarray], first: int, last: int) -> float:
        """Share of a part's shingles between two words (an absent part: 1)."""
        size, wanted = part
        if not size:
            return 1.0
        if size not in self.by:
            doc = self.words.doc
            begins = np.flatnonzero(doc[: max(0, len(doc) - size + 1)] == doc[size - 1 :])
            self.by[size] = begins, shingles(self.words, size, whole_short=False)[1]
        begins, h = self.by[size]
        held = h[np.searchsorted(begins, first) : np.searchsorted(begins, last - size, "right")]
        return float(np.isin(wanted, held).mean())


def leaks_of(index: Index, words: Words, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
    """(document, item, score, question overlap, answer overlap) of the leaks in
    a block, each by the passage with the largest overlaps, then score."""
    held, out, margin = _Shingles(words), [], index.passage // 4
    for (d, i), passages in sorted(search(index, words, threshold).items()):
        best = None
        for score, first, last in passages:
            first, last = max(first - margin, int(words.first[d])), min(last + margin, int(words.first[d + 1]))
            question, answer = (held.share(p, first, last) for p in index.parts[i])
            if question >= overlap and answer >= overlap:
                best = max(best or (0.0, 0.0, 0.0, 0.0), (question + answer, score, question, answer))
        if best:
            out.append((d, i, *best[1:]))
    return out


def _item_rows(items: DataFrame) -> DataFrame:
    """(at, item_id, question, answer, words, terms, counts) of the items with words."""
    split = "question" in items.columns and "answer" in items.columns
    base = items.select(F.col("item_id").cast("long").alias("item_id"),
                        *(["question", "answer"] if split else [F.col("text").alias("question"), F.lit("").alias("answer")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "question"):
            pairs = [(q or "", a or "") if split else split_item(q or "")
                     for q, a in zip(b.column("question").to_pylist(), b.column("answer").to_pylist())]
            rows = []
            for item, (q, a) in zip(b.column("item_id").to_pylist(), pairs):
                terms, counts = np.unique(words_of(pa.array([q, a], pa.string())).hash, return_counts=True)
                if len(terms):
                    rows.append((item, q, a, int(counts.sum()), terms.view(np.int64).tolist(), counts.tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((
                pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                ["item_id", "question", "answer", "words", "terms", "counts"])

    rows = base.mapInArrow(run, "item_id long, question string, answer string, words long, terms array<long>, counts array<long>")
    return rows.select(F.monotonically_increasing_id().alias("at"), "*")


def indexes(items: DataFrame, limit: int = SHARD_BYTES) -> Iterator[Index]:
    """One index per shard of at most ``limit`` bytes of item text (or one
    item); statistics are over all items.  Items without words are left out."""
    rows = cut(_item_rows(items))
    n = rows.agg(F.count("*"), F.avg("words"), F.max("words")).first()
    facts = Facts(n[0], n[1] or 0.0, n[2] or 0)
    posting = rows.select("at", F.explode(F.arrays_zip("terms", "counts")).alias("p")).select(
        "at", F.col("p.terms").alias("term"), F.col("p.counts").alias("count"))
    held = posting.groupBy("term").agg(F.count("*").alias("items"))
    lists = posting.join(held, "term").groupBy("at").agg(F.collect_list(F.struct("term", "count", "items")).alias("postings"))
    ready = cut(rows.drop("terms", "counts").join(lists, "at"))
    shard, size = [], 0
    for r in ready.orderBy("at").toLocalIterator():  # a partition at a time
        n = len(r["question"].encode()) + len(r["answer"].encode())
        if shard and size + n > limit:
            yield build_index(shard, facts)
            shard, size = [], 0
        shard.append(r)
        size += n
    if shard:
        yield build_index(shard, facts)
    drop_cut(rows)
    drop_cut(ready)


def _passes(items: DataFrame, limit: int) -> Iterator[list[Index]]:
    """The indexes that one scan of the documents searches."""
    held: list[Index] = []
    for index in indexes(items, limit):
        held.append(index)
        if len(held) == PASS_SHARDS:
            yield held
            held = []
    if held:
        yield held


_LEAK = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
               shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per leak: doc_id, item_id, score, question and answer overlap.

    Null and empty texts have none; repeated rows and repeated items give
    repeated leaks; a leak in several passages is one row, by the passage with
    the largest overlaps, then score.  Texts are searched whole, passage by
    passage.  Other columns are not read.  Without items, or without documents,
    it is empty."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], _LEAK)
    for held in _passes(items, shard_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in blocks(batches, "text"):
                words, ids = words_of(b.column("text")), b.column("doc_id").to_pylist()
                for own in shared.value:
                    rows = leaks_of(own, words, threshold, overlap)
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([ids[r[0]] for r in rows], pa.int64()),
                             pa.array([own.ids[r[1]] for r in rows], pa.int64()),
                             *[pa.array([round(r[k], 6) for r in rows], pa.float64()) for k in (2, 3, 4)]],
                            ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        out = out.unionAll(base.mapInArrow(run, _LEAK))
    return out


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows of ``docs`` without a leak, all columns kept; cases as in ``find_leaks``."""
    for held in _passes(items, shard_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in blocks(batches, "text"):
                keep, words = np.ones(b.num_rows, bool), words_of(b.column("text"))
                for own in shared.value:
                    keep[[r[0] for r in leaks_of(own, words, threshold, overlap)]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


@query("op2_bm25_wand")
def op2(spark, sf_dir):
    """Leaks of benchmark items in all documents."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
