"""N-gram Jaccard join by PartEnum signatures.

Texts become sets of word shingles.  Sizes fall into bands; a set takes part
in the group of its band and in that of the band below, so two sets that can
be similar meet in one group, where they differ in at most k elements.  The
feature domain is partitioned by hash:

* for k >= 4 into k + 1 + s parts: s + 1 of them must agree, and each part's
  content is a signature;
* for k of 1 to 3 into k + 2 parts, of which two must agree: each pair of
  parts is a signature.  With k = 0 only equal sets are similar.

An agreement of empty parts proves nothing.  A set with so many empty parts
that the agreeing ones could all be empty also signs under another hash of the
domain, and after ``SCHEMES`` of them it signs the elements of its prefix (two
similar sets share one), so no link is lost.  The spare parts s keep such sets
rare: a few of a hundred parts are empty.

With s spare parts, at most s / 2 of them empty, two similar sets share more
than s / 2 signatures.  So each set may leave out its s / 2 most frequent ones
(in the same order for all sets, by count and value): the rarest shared one
stays.  That drops the parts that consist of a widely shared passage alone.

Signatures are counted and matched by shuffles, in ``ROUNDS`` rounds over the
bands' groups, whose files end with their round: signatures of all groups at
once would take several times the disk of the texts.  Each member is joined to the
first of its signature, and the connected groups hold every possible link.  Groups
are verified exactly, as units of bounded size: a larger group is cut into
blocks, and every two blocks form a unit.  Equal sets are one set throughout:
only the first is signed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .book import query
from .common import U64, Words, blocks, cut, distinct_sets, drop_cut, mix, raw_text, segment_sum, shingles, table
from .graph import components

SHINGLE, PERCENT = 5, 80
SCHEMES, SPARE = 4, 10
#: A signature's low bits: group parity, then how many frequent ones may be left out.
_PARITY, _DROP = U64(1), 127
UNIT_SHINGLES = 150_000
#: Members of the groups (about 100 bytes each) are broadcast up to this count, else joined by shuffle.
BROADCAST_ROWS = 500_000
#: Ids alone (8 bytes each) are broadcast up to this count.
BROADCAST_IDS = 2_000_000
#: Rounds of signing; up to so many shingles all signatures fit one.
ROUNDS, ONE_ROUND = 4, 5_000_000
_SEEN = 200_000
_TAG = U64(0xD6E8FEB86659FD93)
_DOMAINS = mix(np.arange(1, 33, dtype=U64) * _TAG)


def size_bands(percent: int, largest: int) -> np.ndarray:
    """Lower ends of the size bands; band i's upper end is floor(low / threshold)."""
    low = [1]
    while low[-1] <= largest:
        low.append(low[-1] * 100 // percent + 1)
    return np.array(low + [low[-1] * 100 // percent + 1], np.int64)


def _sums(doc: np.ndarray, h: np.ndarray, docs: np.ndarray, parts: np.ndarray, scheme: int):
    """Content hash and count of each part, for the documents ``docs`` (each
    with its number of ``parts``); (doc, h) are their elements, by document."""
    base = np.concatenate([[0], np.cumsum(parts)])
    row = np.searchsorted(docs, doc)
    place = h if scheme == 0 else mix(h ^ _DOMAINS[scheme])
    part = base[row] + ((place >> U64(32)) * parts[row].astype(U64) >> U64(32)).astype(np.int64)
    value = mix(h + _TAG)
    if scheme:
        order = np.argsort(part, kind="stable")
        value, part = value[order], part[order]
    count = np.bincount(part, minlength=base[-1])
    ends = np.cumsum(count)
    return segment_sum(value, ends - count, ends), count, base


def signatures(doc: np.ndarray, h: np.ndarray, n: np.ndarray, percent: int, turn: int = 0,
               turns: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(document, signature) pairs of sorted distinct (doc, h) sets of sizes n,
    of the groups that are up in this of so many turns."""
    low = size_bands(percent, int(n.max(initial=1)) * 100 // percent + 1)
    band = np.searchsorted(low, n, "right") - 1
    out_doc, out_sig = [], []
    for down in (0, 1):
        group = band - down
        docs = np.flatnonzero((n > 0) & (group >= 0) & (group % turns == turn))
        both = low[group[docs] + 1] - 1 + low[group[docs] + 2] - 1
        k = both * (100 - percent) // (100 + percent)
        docs, k = docs[k > 0], k[k > 0]
        for scheme in range(SCHEMES + 1):
            if not len(docs):
                break
            chosen = np.zeros(len(n), bool)
            chosen[docs] = True
            mine = chosen[doc]
            d, e = doc[mine], h[mine]
            tag = mix((group[docs].astype(U64) * U64(SCHEMES + 2) + U64(scheme + 1)) * _TAG)
            if scheme == SCHEMES:
                row = np.searchsorted(docs, d)
                rank = mix(e ^ _TAG)
                order = np.lexsort((rank, row))
                first = np.searchsorted(row, np.arange(len(docs)))
                keep = np.arange(len(row)) - first[row[order]] < (n[docs] + (-(percent * n[docs]) // 100) + 1)[row[order]]
                out_doc.append(docs[row[order]][keep])
                out_sig.append(mix(e[order][keep] + tag[row[order]][keep]) & ~U64(255) | (group[docs] & 1).astype(U64)[row[order]][keep])
                break
            few, spare = k <= 3, 2 + k // SPARE
            low_bits = (group[docs] & 1).astype(U64)
            sums, count, base = _sums(d, e, docs, np.where(few, k + 2, k + 1 + spare), scheme)
            empty = np.zeros(len(docs), bool)
            wide = np.flatnonzero(~few)
            if len(wide):
                at = np.concatenate([np.arange(base[i], base[i + 1]) for i in wide])
                owner = np.repeat(wide, k[wide] + 1 + spare[wide])
                full = count[at] > 0
                empty |= ~few & (np.bincount(owner[~full], minlength=len(docs)) > spare // 2)
                inner = (at - base[owner]).astype(U64)
                out_doc.append(docs[owner[full]])
                drop = np.minimum(spare // 2, _DROP) if scheme == 0 else np.zeros(len(docs), np.int64)
                end = low_bits | (drop.astype(U64) << _PARITY)
                out_sig.append(mix(sums[at[full]] + mix(inner[full] * _TAG + tag[owner[full]])) & ~U64(255) | end[owner[full]])
            for size in np.unique(k[few]):
                rows = np.flatnonzero(few & (k == size))
                for a, b in combinations(range(int(size) + 2), 2):
                    x, y = base[rows] + a, base[rows] + b
                    full = count[x] + count[y] > 0
                    empty[rows[~full]] = True
                    out_doc.append(docs[rows[full]])
                    out_sig.append(mix(sums[x[full]] + mix(sums[y[full]] + mix(_DOMAINS[a * 5 + b] + tag[rows[full]])))
                                   & ~U64(255) | low_bits[rows[full]])
            docs, k = docs[empty], k[empty]
    if not out_doc:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.concatenate(out_doc), np.concatenate(out_sig)


def _set_hashes(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(n)
    return tuple(mix(segment_sum(mix(h ^ s), ends - n, ends)) for s in mix(np.array([1, 2], U64)))


def _sets(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = Words(*raw_text(col))
    doc, h = distinct_sets(*shingles(words, k))
    return doc, h, np.bincount(doc, minlength=len(words.count)).astype(np.int64)


def linked_groups(ids: np.ndarray, doc: np.ndarray, h: np.ndarray, side: np.ndarray, weight: np.ndarray, percent: int,
                  cross: bool):
    """Exact links among the sets of a unit: (root of each set's group, number
    of links of each set).  With ``cross``, only links between sides count.

    Each set looks up its shared elements in the unit's inverted lists once."""
    m = len(ids)
    n = np.bincount(doc, minlength=m).astype(np.int64)
    _, term = np.unique(h, return_inverse=True)
    order = np.argsort(term, kind="stable")
    lists, length = doc[order], np.bincount(term)
    begin = np.cumsum(length) - length
    first = np.concatenate([[0], np.cumsum(n)])
    root, links, visited = np.arange(m), np.zeros(m, np.int64), np.zeros(m, bool)
    for seed in range(m):
        if visited[seed]:
            continue
        visited[seed] = True
        todo = [seed]
        while todo:
            f = todo.pop()
            t = term[first[f] : first[f + 1]]
            size = length[t]
            ends = np.cumsum(size)
            places = np.repeat(begin[t] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
            common = np.bincount(lists[places], minlength=m)
            close = 100 * common >= percent * (n + n[f] - common)
            if cross:
                close &= side != side[f]
            close[f] = False
            links[f] = weight[close].sum()
            new = np.flatnonzero(close & ~visited)
            visited[new] = True
            root[new] = seed
            todo.extend(new.tolist())
    return ids[root], links


def _firsts(base: DataFrame, mapped: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The rows whose id is the representative of a set, and the tables that
    they need until they are read."""
    first = mapped.where("doc_id = rep").select(F.col("rep").alias("_first")).distinct()
    other = cut(mapped.select(F.col("doc_id").alias("_first")).distinct().join(first, "_first", "left_anti"))
    same = F.col("doc_id") == F.col("_first")
    if other.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return base.join(F.broadcast(other), same, "left_anti"), [other]
    if first.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return base.join(F.broadcast(first), same, "left_semi"), [other]
    rows = cut(base.join(first, same, "left_semi"))
    return rows, [other, rows]


def similarity_classes(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT,
                       unit_shingles: int = UNIT_SHINGLES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked
    doc_id) and n_links (documents at or above the similarity, itself not).

    Words are runs of anything but ASCII white space, A-Z in lower case.  A
    text of fewer words than ``k`` is one shingle; null, empty and blank texts
    have none and no links.  Rows with the same id share a component.  Rows
    without an id are returned with a null component and no links.  Only doc_id
    and text are read; an empty table gives an empty result."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            doc, h, n = _sets(b.column("text"), k)
            a, c = _set_hashes(doc, h, n)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), pa.array(a.view(np.int64)), pa.array(c.view(np.int64))],
                ["doc_id", "n", "h1", "h2"])

    def sign(batches: Iterator[pa.RecordBatch], turn: int, turns: int) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # equal sets met before in this task need no second signing
        for b in blocks(batches, "text"):
            doc, h, n = _sets(b.column("text"), k)
            a, c = _set_hashes(doc, h, n)
            new = np.zeros(len(n), bool)
            for i, s in enumerate(zip(a.tolist(), c.tolist())):
                if s not in seen:
                    seen.add(s)
                    new[i] = True
            if len(seen) > _SEEN:
                seen.clear()
            keep = new[doc]
            at, sig = signatures(doc[keep], h[keep], np.where(new, n, 0), percent, turn, turns)
            ids = np.asarray(b.column("doc_id"))
            yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(ids[at])], ["sig", "doc_id"])

    known = cut(base.mapInArrow(measure, "doc_id long, n long, h1 long, h2 long"))
    # a representative (the smallest id) and the number of documents of each set
    full = known.where("n > 0 AND doc_id IS NOT NULL")
    sets = full.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    mapped = cut(full.join(sets, ["n", "h1", "h2"]).select("doc_id", "n", "rep", "copies"))

    once, copied = _firsts(base.where("doc_id IS NOT NULL"), mapped)
    turns = ROUNDS if (sets.agg(F.sum("n")).first()[0] or 0) > ONE_ROUND else 1
    rounds = []
    for turn in range(turns):
        signed = once.mapInArrow(partial(sign, turn=turn, turns=turns), "sig long, doc_id long")
        shared = signed.withColumn("count", F.count("*").over(Window.partitionBy("sig"))).where("count > 1")
        # the most frequent signatures of a document in a group, as many as may be left out
        frequent = F.row_number().over(
            Window.partitionBy("doc_id", F.col("sig").bitwiseAND(F.lit(1))).orderBy(F.desc("count"), "sig"))
        drop = F.shiftright(F.col("sig"), 1).bitwiseAND(F.lit(_DROP))
        left = shared.withColumn("nth", frequent).where(F.col("nth") > drop).select("sig", "doc_id")
        hub = F.first("doc_id").over(Window.partitionBy("sig").orderBy("doc_id"))
        rounds.append(cut(left.select(F.col("doc_id").alias("a"), hub.alias("b")).where("a <> b").distinct()))
    near = reduce(DataFrame.unionAll, rounds)
    rep = mapped.select("doc_id", "rep").distinct()
    named = near.join(rep.toDF("a", "ra"), "a").join(rep.toDF("b", "rb"), "b").where("ra <> rb")
    groups = cut(components(named.select(F.col("ra").alias("a"), F.col("rb").alias("b"))))

    members = groups.join(mapped.where("doc_id = rep").select(F.col("rep").alias("node"), "n", "copies").distinct(), "node")
    total = members.groupBy("component").agg(F.sum("n").alias("total"))
    blocked = members.join(total, "component").withColumn(
        "blocks", F.ceil(F.col("total") / unit_shingles).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = cut(blocked.select("node", "copies", "component", "block", "blocks"))

    def verify(unit: pd.DataFrame) -> pd.DataFrame:
        doc, h, n = _sets(pa.array(unit["text"], pa.large_string()), k)
        ids = unit["node"].to_numpy()
        roots, links = linked_groups(ids, doc, h, unit["block"].to_numpy(), unit["copies"].to_numpy(), percent,
                                     bool(unit["i"].iloc[0] != unit["j"].iloc[0]))
        return pd.DataFrame({"a": ids, "b": roots, "links": links})

    small = placed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = base.join(F.broadcast(placed) if small else placed, F.col("doc_id") == F.col("node"))
    if mapped.groupBy("doc_id").count().where("count > 1").limit(1).count():  # the same row, given twice
        texts = texts.dropDuplicates(["node", "text"])
    units = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "copies", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "text")
    linked = cut(units.groupBy(
        "component", "i", "j").applyInPandas(verify, "a long, b long, links long"))
    for done in (near, groups, placed, *copied):
        drop_cut(done)
    classes = components(linked.select("a", "b"))
    degree = linked.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    named = classes.withColumnRenamed("node", "rep").join(degree, "rep", "left")
    linked_rows = mapped.join(named, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    alone = known.where("n = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return linked_rows.unionAll(alone)


@query("op1_partenum_join")
def op1(spark, sf_dir):
    """Classes of all documents linked by 4-word shingles at Jaccard 0.85."""
    return similarity_classes(table(spark, sf_dir, "documents"), k=4, percent=85)
