"""Packing along a space-filling curve.

A document's hashed bag of words is projected to three dimensions; its place
on a Hilbert curve through them is its sort key, so neighbours on the curve
have similar words.  Key ranges of near-equal bytes (the histogram splitters
of ``sharding``) become cells; each cell is sorted in a task of its own, and
the token stream along the curve is cut every ``length`` tokens.  Only the
last sequence has padding.

Tokens are produced piece by piece with a bounded cache: the tokenizer's
normaliser and pre-tokenizer never join text across white space, nor letters,
digits and punctuation with each other, so a document's ids are those of its
pieces in order (a test compares them with whole texts).
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .book import query
from .common import LOWER, SPACE, U64, Words, blocks, cut, drop_cut, mix, raw_text, table
from .sharding import KEY_BYTES, MOST_CELLS, histogram_splitters, text_size

SEQUENCE, END_ID = 2048, 1
DIMENSIONS, BITS, BUCKETS = 3, 10, 256
CACHE_IDS, JOIN = 6_000_000, 1000
CELL_BYTES = 16 << 20

_PROJECT = np.random.default_rng(31).standard_normal((BUCKETS, DIMENSIONS))


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows) in [0, 2^bits)
    (Skilling, 2004): undo the curve's rotations from the top bit down, then
    take the Gray code of the transposed bits."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve_keys(words: Words) -> np.ndarray:
    """Hilbert place of every text of a block (a text without words: 0)."""
    n = len(words.count)
    bucket = (words.hash & U64(BUCKETS - 1)).astype(np.int64)
    counts = np.bincount(words.doc * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    norm = np.sqrt((counts.astype(float) ** 2).sum(axis=1, keepdims=True))
    vector = counts / np.maximum(norm, 1) @ _PROJECT
    grid = np.clip((vector + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return np.where(words.count > 0, hilbert(grid), 0)


#: Byte classes: 0 white space, 1 letters, 2 ASCII punctuation, 4 digits, 8 others.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[SPACE], _CLASS[128:], _CLASS[48:58] = 0, 8, 4
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[:9], _CLASS[14:32], _CLASS[127] = 8, 8, 8
#: One pre-token: a run of letters, a run of punctuation without quotes, a digit.
_PLAIN = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[!-&(-/:-@\[-`{-~]+|[0-9]")


def tokens_of(col: pa.Array) -> tuple[Words, np.ndarray]:
    """Pieces of text that the tokenizer treats apart, and the bytes they lie in.

    White space separates; letters, punctuation and digits part from each
    other.  A word with an apostrophe (contractions are one pre-token) or a
    ``<`` (marks of special tokens) stays whole and keeps its case; bytes
    outside ASCII and the Latin-1 letters never part from their neighbours."""
    buf, offsets = raw_text(col)
    n = len(buf)
    if not n:
        return Words(buf, offsets), buf
    kind = _CLASS[buf]
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    lead = lead[(buf[lead + 1] != 0x97) & (buf[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    cuts = np.zeros(n, bool)
    cuts[1:] = ((kind[1:] != kind[:-1]) & (kind[1:] != 8) & (kind[:-1] != 8)) | ((kind[1:] == 4) & (kind[:-1] == 4))
    folded = LOWER[buf]
    held = np.flatnonzero((buf == 39) | (buf == 60))
    if len(held):
        edge = np.union1d(np.flatnonzero(kind == 0), offsets)
        after = np.searchsorted(edge, held, "right")
        inside = np.zeros(n + 1, np.int32)
        np.add.at(inside, np.where(after > 0, edge[after - 1], 0), 1)
        np.add.at(inside, np.where(after < len(edge), edge[np.minimum(after, len(edge) - 1)], n), -1)
        whole = np.cumsum(inside[:-1]) > 0
        cuts &= ~whole
        folded = np.where(whole, buf, folded)
    return Words(folded, offsets, lower=None, separator=SPACE, cuts=cuts), buf


class Encoder:
    """Ids of words, cached by word hash; the cache starts anew beyond ``CACHE_IDS`` ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.known, self.at = np.zeros(0, U64), np.zeros(0, np.int64)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        count = np.array([len(x) for x in made], np.int64)
        return np.fromiter(chain.from_iterable(made), np.uint32, int(count.sum())), count

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, encoded as one text: a token with the word-end
        mark closes each.  Without such marks the words are encoded apart."""
        made = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.closes[made]) + 1
        if len(last) != len(words) or last[-1] != len(made):
            return self._apart(words)
        return made, np.diff(last, prepend=0)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        plain = np.array([_PLAIN.fullmatch(w) is not None for w in words], bool)
        order = np.argsort(~plain, kind="stable")
        words, split = [words[i] for i in order.tolist()], int(plain.sum())
        made = [self._joined(words[i : min(i + JOIN, split)]) for i in range(0, split, JOIN)]
        if split < len(words):
            made.append(self._apart(words[split:]))
        flat, count = (np.concatenate([m[k] for m in made]) for k in (0, 1))
        if self.used + len(flat) > len(self.ids):
            grown = np.zeros(max(2 * len(self.ids), self.used + len(flat)), np.uint32)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used : self.used + len(flat)] = flat
        entry = np.empty(len(words), np.int64)
        entry[order] = np.arange(len(self.start), len(self.start) + len(words))
        self.start = np.concatenate([self.start, self.used + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.used += len(flat)
        place = np.searchsorted(self.known, hashes)
        self.known, self.at = np.insert(self.known, place, hashes), np.insert(self.at, place, entry)

    def encode(self, words: Words, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text)."""
        if self.used > CACHE_IDS:
            self._clear()
        h, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, h)
        place[place == len(self.known)] = 0
        fresh = self.known[place] != h if len(self.known) else np.ones(len(h), bool)
        if fresh.any():
            raw = buf.tobytes()
            w = first[fresh]
            self._learn(h[fresh], [raw[a:b].decode() for a, b in zip(words.start[w].tolist(), words.end[w].tolist())])
            place = np.searchsorted(self.known, h)
        entry = self.at[place][inverse] if len(h) else np.zeros(0, np.int64)
        count = self.count[entry]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(self.start[entry] - (ends - count), count) + np.arange(total)
        bounds = np.concatenate([[0], ends])
        return self.ids[source], bounds[words.first]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder a worker process: its cache outlives the task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _key_bytes(curve: np.ndarray, ids: pa.Array, salt: np.ndarray) -> pa.Array:
    """Sort key: curve place, document id, tie-break."""
    parts = np.empty((len(curve), 3), ">u8")
    parts[:, 0] = curve
    parts[:, 1] = np.asarray(ids.fill_null(0)).astype(np.int64).view(np.uint64)
    parts[:, 2] = salt
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(KEY_BYTES), len(curve), [None, pa.py_buffer(parts.tobytes())]).cast(pa.binary())


def _keys_of(b: pa.RecordBatch, words: Words) -> pa.Array:
    content = np.zeros(len(words.count), U64)
    np.add.at(content, words.doc, mix(words.hash))
    return _key_bytes(curve_keys(words), b.column("doc_id"), content)


def _keyed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            key = _keys_of(b, tokens_of(b.column("text"))[0])
            yield pa.RecordBatch.from_arrays([key, b.column("size")], ["key", "size"])

    return docs.withColumn("size", text_size()).mapInArrow(run, "key binary, size long")


def pack_documents(docs: DataFrame, tokenizer: str, length: int = SEQUENCE, end_id: int = END_ID,
                   cell_bytes: int = CELL_BYTES) -> DataFrame:
    """Pieces of all documents, packed into sequences of ``length`` tokens.

    Returns doc_id, start (the document's ids before the piece), length,
    ids_crc32 and ids (little-endian unsigned 32-bit), doc_tokens (with the
    end id), sequence_id and offset.  Null and empty texts are their end id
    alone; repeated rows are packed each; other columns are not read; an empty
    table has no pieces.  ``tokenizer`` is a file every worker can read."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = cut(_keyed(docs))
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    cells = max(1, min(MOST_CELLS, -(-total // cell_bytes)))
    splitters = np.array(histogram_splitters(keyed, cells, tolerance=0.1), dtype=f"S{KEY_BYTES}")
    drop_cut(keyed)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for b in blocks(batches, "text"):
            words, buf = tokens_of(b.column("text"))
            ids, at = encoder.encode(words, buf)
            raw = ids.astype("<u4").tobytes()
            end = np.uint32(end_id).astype("<u4").tobytes()
            key = _keys_of(b, words)
            cell = np.searchsorted(splitters, np.array(key.to_pylist(), dtype=f"S{KEY_BYTES}"), "right")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), key, pa.array(cell.astype(np.int32)),
                 pa.array([raw[4 * a : 4 * z] + end for a, z in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())],
                ["doc_id", "key", "cell", "ids"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = None, 0
        for b in batches:
            cell = np.asarray(b.column("cell"))
            n = np.asarray(pa.compute.binary_length(b.column("ids"))).astype(np.int64) // 4
            local = np.empty(len(n), np.int64)
            for i, (c, k) in enumerate(zip(cell.tolist(), n.tolist())):
                if c != last:
                    last, before = c, 0
                local[i] = before
                before += k
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("cell"), pa.array(local), pa.array(n), b.column("ids")],
                ["doc_id", "cell", "local", "n", "ids"])

    encoded = docs.mapInArrow(encode, "doc_id long, key binary, cell int, ids binary")
    sorted_cells = encoded.repartitionById(cells, F.col("cell")).sortWithinPartitions("cell", "key")
    placed = cut(sorted_cells.select("doc_id", "cell", "ids").mapInArrow(
        place, "doc_id long, cell int, local long, n long, ids binary"))
    per = {r["cell"]: r["t"] for r in placed.groupBy("cell").agg(F.sum("n").alias("t")).collect()}
    begins = np.cumsum([0] + [per.get(c, 0) for c in range(cells)])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            begin = begins[np.asarray(b.column("cell"))] + np.asarray(b.column("local"))
            for doc, at, n, ids in zip(b.column("doc_id").to_pylist(), begin.tolist(), b.column("n").to_pylist(),
                                       b.column("ids")):
                view, start = memoryview(ids.as_buffer()), 0
                while start < n:
                    offset = (at + start) % length
                    take = min(n - start, length - offset)
                    piece = view[4 * start : 4 * (start + take)]
                    out.append((doc, start, take, zlib.crc32(piece), bytes(piece), n, (at + start) // length, offset))
                    start += take
            kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 3
            cols = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], _PIECE_NAMES)

    return placed.mapInArrow(pieces, ", ".join(
        f"{c} {'binary' if c == 'ids' else 'long'}" for c in _PIECE_NAMES))


_PIECE_NAMES = ["doc_id", "start", "length", "ids_crc32", "ids", "doc_tokens", "sequence_id", "offset"]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op6_hilbert_packing")
def op6(spark, sf_dir):
    """All documents packed along the curve; digests of the pieces."""
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer()).drop("ids")
