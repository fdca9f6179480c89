import math
import random
import re
from collections import Counter

import xxhash

from wearcast.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    wins = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cover = {i + j for i in range(len(w) - 2) if wins[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover))


def pair(a, b):
    """Hash of two 64-bit words, the first one's hash seeding the second's."""
    return xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))


def grams(text):
    w = [x.encode() for x in WORD.findall(text or "")]
    one = [xxhash.xxh64_intdigest(x, 42) for x in w]
    two = [pair(a, b) for a, b in zip(one, one[1:])]
    return [h & (Q.BUCKETS - 1) for h in one + two]


def corpus(nasty):
    rng = random.Random(7)
    vocab = ["the", "of", "a", "é😀", "and", "x#", "|", "Z"]
    rows = list(nasty)
    for i in range(100, 160):
        t = "".join(rng.choice(vocab) + rng.choice([" ", "  ", "\n", "\t", " \n", "\x0b"]) for _ in range(rng.randint(0, 120)))
        rows.append((i, t))
    return rows


def test_base_and_score_equal_brute_force(spark, docs_of, nasty):
    rows = corpus(nasty)
    labels = [(i, i % 2, 0) for i in range(100, 150)] + [(101, 1, 1), (None, 1, 0), (102, None, 0)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = Q.quality_rules(docs_of(rows), lab).collect()
    assert len(got) == len(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i in good:
            target.update(grams(t))
    nr, nt = sum(raw.values()), sum(target.values())
    share = lambda c, n: math.log((c + Q.SMOOTHING) / (n + Q.SMOOTHING * Q.BUCKETS))
    want = Counter()
    for i, t in rows:
        b, g = base(t), grams(t)
        score = sum(share(target[x], nt) - share(raw[x], nr) for x in g) / len(g) if g else 0.0
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want[(i, *b, failed, not failed and score >= Q.THRESHOLD, round(score, 6))] += 1
    have = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                    r["base_failed"], r["kept"], round(r["score"], 6)) for r in got)
    assert have == want


def test_empty_tables(spark, docs_of):
    lab = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert Q.quality_rules(docs_of([(1, "a")]).limit(0), lab.limit(0)).count() == 0
    assert Q.quality_rules(docs_of([(1, "a")]), lab.limit(0)).count() == 1
