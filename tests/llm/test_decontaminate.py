import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from wearcast.llm import decontaminate as D


def words(t):
    return [w.lower() for w in re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", t or "")]


def brute(rows, items, threshold=D.THRESHOLD, overlap=D.OVERLAP):
    bags = {i: Counter(words(t)) for i, t in items}
    bags = {i: b for i, b in bags.items() if b}
    n, df = len(bags), Counter(w for b in bags.values() for w in b)
    avg = sum(sum(b.values()) for b in bags.values()) / n
    size = 2 * max(max(sum(b.values()) for b in bags.values()), D.MIN_PASSAGE)
    idf = {w: math.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    impact = {}
    for i, b in bags.items():
        m = sum(b.values())
        raw = {w: idf[w] * c * (D.K1 + 1) / (c + D.K1 * (1 - D.B + D.B * m / avg)) for w, c in b.items()}
        impact[i] = {w: v / sum(raw.values()) for w, v in raw.items()}
    grams = lambda w, k: {tuple(w[a:a + k]) for a in range(len(w) - k + 1)}
    out = []
    for d, t in rows:
        w = words(t)
        starts = range(0, max(1, len(w) - size // 2), size // 2) if w else []
        for i in impact:
            best = None
            for a in starts:
                score = sum(v for x, v in impact[i].items() if x in set(w[a:a + size]))
                near = w[max(0, a - size // 4):min(a + size, len(w)) + size // 4]
                share = []
                for part in map(words, D.split_item(dict(items)[i])):
                    k = min(D.SHINGLE, len(part))
                    share.append(len(grams(part, k) & grams(near, k)) / len(grams(part, k)) if part else 1.0)
                if score >= threshold - 1e-9 and min(share) >= overlap:
                    best = max(best or (0, 0, 0, 0), (sum(share), score, *share))
            if best:
                out.append((d, i, *(round(x, 5) for x in best[1:])))
    return sorted(out, key=str)


def data(seed, nasty):
    rng = random.Random(seed)
    vocab = ["the", "of", "Ét", "and"] + [f"w{i}" for i in range(120)]
    items = [(i, ". ".join(" ".join(rng.choices(vocab, k=rng.randint(4, 18))) for _ in range(rng.randint(1, 3)))
              + rng.choice([". Er.", ". Un deux", ""])) for i in range(30)]
    items += [(90, None), (91, "  "), (92, items[0][1])]
    rows = list(nasty)
    for i in range(100, 220):
        w = rng.choices(vocab, k=rng.randint(0, 300))
        for _, t in rng.sample(items[:30], rng.randint(0, 2)):
            part = t.split()
            for _ in range(rng.choice([0, 0, 1, 4])):
                part[rng.randrange(len(part))] = "zz"
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() if rng.random() < 0.1 and x.isascii() else x for x in part]
        rows.append((i, rng.choice([" ", "\n", "*** "]).join(w)))
    return rows, items


@pytest.mark.parametrize("shard", [1 << 20, 600])
def test_leaks_equal_exhaustive_search(spark, docs_of, nasty, shard):
    rows, items = data(2, nasty)
    table = spark.createDataFrame(items, "item_id long, text string")
    # one index over all items, or one of a few items each: the same leaks
    got = D.find_leaks(docs_of(rows), table, shard_bytes=shard).collect()
    have = sorted(((r["doc_id"], r["item_id"], round(r["score"], 5), round(r["question_overlap"], 5),
                    round(r["answer_overlap"], 5)) for r in got), key=str)
    want = brute(rows, items)
    assert len(want) > 50
    assert have == want
    kept = D.without_leaks(docs_of(rows), table, shard_bytes=shard)
    assert kept.columns == docs_of(rows).columns
    leaked = {x[0] for x in have}
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(i) for i, _ in rows if i not in leaked)


def test_question_and_answer_columns_and_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "what is the tallest peak here", "mount example of course")],
                                  "item_id long, question string, answer string")
    docs = docs_of([(1, "so what is the tallest peak here? Mount Example, of course!"), (2, "what is the tallest peak here")])
    assert [r["doc_id"] for r in D.find_leaks(docs, items).collect()] == [1]
    assert D.find_leaks(docs.limit(0), items).count() == 0 and D.find_leaks(docs, items.limit(0)).count() == 0


def test_retrieval_equals_exhaustive_scores_and_skips_blocks(spark):
    """Every item at or above the threshold, for queries of any terms; postings stay sparse."""
    rng = np.random.default_rng(8)
    items = [(i, " ".join(f"v{k}" for k in (rng.pareto(0.7, 14) * 8).astype(int) % 3000)) for i in range(700)]
    index, = D.indexes(spark.createDataFrame(items, "item_id long, text string"))
    dense = np.zeros((len(items), len(index.terms)))
    for t in range(len(index.terms)):
        at = slice(index.start[t], index.start[t + 1])
        dense[index.item[at], t] = index.impact[at]
    assert np.allclose(dense.sum(1), 1) and (np.diff(index.first) > 0).all()
    assert sum(a.nbytes for a in (index.item, index.impact, index.block, index.highest)) < 40 * len(index.item)
    for n in (1, 5, 40, 300):
        for _ in range(30):
            own = np.unique(rng.integers(0, len(index.terms), n))
            if n == 40:
                own = np.unique(np.concatenate([own, np.flatnonzero(dense[rng.integers(700)])]))
            want = dense[:, own].sum(1)
            found, score = D.retrieve(index, own, 0.5)
            assert found.tolist() == np.flatnonzero(want >= 0.5 - 1e-9).tolist() and np.allclose(score, want[found])


def test_question_and_answer_in_different_places_are_no_leak(docs_of, spark):
    items = spark.createDataFrame([(1, "what is the tallest peak in the whole northern range of hills", "mount example of course it is")],
                                  "item_id long, question string, answer string")
    far = " ".join(f"filler{i}" for i in range(900))
    q, a = "what is the tallest peak in the whole northern range of hills", "mount example of course it is"
    docs = docs_of([(1, f"{q} {far} {a}"), (2, f"{far} {q} {a} {far}"), (3, f"{q} and {a}")])
    assert sorted(r["doc_id"] for r in D.find_leaks(docs, items).collect()) == [2, 3]
