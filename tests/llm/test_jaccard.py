import itertools
import random
import re
import time

import numpy as np
import pytest

from wearcast.llm import jaccard as J
from wearcast.llm.graph import components


def shingle_set(t, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for (a, x), (b, y) in itertools.combinations(enumerate(sets), 2):
        i, j = rows[a][0], rows[b][0]
        if i is None or j is None or not x or not y:
            continue
        if 100 * len(x & y) >= percent * len(x | y):
            links[a] += 1
            links[b] += 1
            p, q = sorted((root(i), root(j)))
            parent[q] = p
    return sorted(((i, len(s), root(i) if i is not None else None, n) for (i, _), s, n in zip(rows, sets, links)), key=str)


def near_copies(seed, groups=14, size=9):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["The", "of"]
    rows, i = [], 100
    for g in range(groups):
        base = rng.choices(vocab, k=rng.choice([1, 3, 4, 6, 8, 9, 12, 20, 33, 60, 150, 400]))
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((i, " ".join(w)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,percent,unit", [(4, 85, 150_000), (5, 80, 400)])
def test_classes_equal_brute_force(docs_of, nasty, k, percent, unit):
    rows = nasty + near_copies(k)
    got = J.similarity_classes(docs_of(rows), k, percent, unit_shingles=unit).collect()
    have = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got), key=str)
    assert have == brute(rows, k, percent)


@pytest.mark.parametrize("ids", [J.BROADCAST_IDS, 12, 0])
def test_rounds_over_first_copies_equal_brute_force(docs_of, nasty, monkeypatch, ids):
    """Several rounds of signing, the copies of a set left out by each of the joins."""
    monkeypatch.setattr(J, "ONE_ROUND", 0)
    monkeypatch.setattr(J, "BROADCAST_IDS", ids)
    rows = nasty + near_copies(3, groups=10, size=5)
    rows += [(1000 + i, t) for i, t in rows if i is not None]
    got = J.similarity_classes(docs_of(rows), 5, 80).collect()
    have = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got), key=str)
    assert have == brute(rows, 5, 80)


def test_turns_split_the_signatures():
    rng = np.random.default_rng(1)
    n = rng.integers(1, 300, 50)
    doc, h = np.repeat(np.arange(50), n), rng.integers(0, 2**63, n.sum(), dtype=np.uint64)
    whole = sorted(zip(*(x.tolist() for x in J.signatures(doc, h, n, 80))))
    parts = [J.signatures(doc, h, n, 80, turn, J.ROUNDS) for turn in range(J.ROUNDS)]
    assert sorted((d, s) for p in parts for d, s in zip(*(x.tolist() for x in p))) == whole
    assert max(len(p[0]) for p in parts) < 0.5 * len(whole)


@pytest.mark.parametrize("ids", [J.BROADCAST_IDS, 1, 0])
def test_a_set_is_signed_once(spark, docs_of, monkeypatch, ids):
    monkeypatch.setattr(J, "BROADCAST_IDS", ids)
    docs = docs_of([(i, f"one two three four five {i // 10}") for i in range(40)])
    mapped = spark.createDataFrame([(i, 2, i // 10 * 10, 10) for i in range(40)], "doc_id long, n long, rep long, copies long")
    once, _ = J._firsts(docs.select("doc_id", "text"), mapped)
    assert sorted(r["doc_id"] for r in once.collect()) == [0, 10, 20, 30]


def test_a_written_table_leaves_no_shuffle_files(spark):
    from wearcast.llm.common import cut, drop_cut

    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle_")}

    before = shuffled()
    table = cut(spark.range(0, 1000, 1, 4).groupBy("id").count())
    end = time.time() + 20  # files go by messages to the executors
    while shuffled() - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffled() - before
    assert table.count() == 1000
    drop_cut(table)


def test_similar_sets_share_a_signature():
    """Every pair at or above the threshold meets, at all sizes, also with empty parts."""
    rng = np.random.default_rng(5)
    for percent in (80, 85, 95):
        for n in list(range(1, 40)) + [60, 100, 333]:
            for _ in range(6):
                a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
                most = n * (100 - percent) // (100 + percent)
                drop, add = rng.integers(0, most + 1, 2)
                b = np.unique(np.concatenate([a[: len(a) - drop], rng.integers(0, 2**63, add, dtype=np.uint64)]))
                inter = len(np.intersect1d(a, b))
                if 100 * inter < percent * (len(a) + len(b) - inter) or (len(a) == len(b) == inter):
                    continue
                doc = np.repeat([0, 1], [len(a), len(b)])
                d, s = J.signatures(doc, np.concatenate([a, b]), np.array([len(a), len(b)]), percent)
                sigs = [set(s[d == i].tolist()) for i in (0, 1)]
                assert sigs[0] & sigs[1], (percent, n, drop, add)
                # also without the ones that may be left out, whichever order counts give
                for turn in (lambda x: x, lambda x: -x, lambda x: x * 2654435761 % 2**32):
                    left = []
                    for mine in sigs:
                        groups = [sorted((x for x in mine if x & 1 == p), key=turn) for p in (0, 1)]
                        left.append({x for g in groups for nth, x in enumerate(g, 1) if nth > (x >> 1 & 127)})
                    assert left[0] & left[1], (percent, n, drop, add)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(80)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(docs_of):
    assert J.similarity_classes(docs_of([(1, "a b c d e f")]).limit(0)).count() == 0


def test_rearranged_words_are_different_shingles():
    """Words of the same bytes in Thue-Morse order are no copies of each other."""
    import pyarrow as pa

    bits = [bin(i).count("1") & 1 for i in range(2048)]
    a, b = ("".join("ab"[x ^ flip] for x in bits) for flip in (0, 1))
    _, h, n = J._sets(pa.array([f"{a} one two three", f"{b} one two three", f"{a} one two three"]), 4)
    assert n.tolist() == [1, 1, 1] and h[0] == h[2] != h[1]
