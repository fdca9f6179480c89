import random
import re

import pytest

from wearcast.llm import licenses as L


def sh(words):
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)}


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(rows):
    out = {}
    for name, t in L.TEMPLATES.items():
        want, n = sh(words(t)), len(words(t))
        stride = max(1, n // 4)
        for i, text in rows:
            w = words(text)
            best = max((len(sh(w[a:a + n + stride]) & want) / len(want) for a in range(0, len(w), stride)), default=0)
            if best >= L.CONTAINMENT:
                out[(i, name)] = max(round(best, 6), out.get((i, name), 0))
    return out


def test_scan_equals_exhaustive_windows(docs_of, nasty):
    rng = random.Random(10)
    vocab = ["under", "the", "license", "licensed", "version", "alpha", "beta", "gamma", "to", "of"]
    rows = list(nasty)
    for i in range(100, 240):
        w = rng.choices(vocab, k=rng.randint(0, 80))
        for name in rng.sample(sorted(L.TEMPLATES), rng.randint(0, 2)):
            t = L.TEMPLATES[name].split()
            if rng.random() < 0.4:
                t[rng.randrange(len(t))] = "edited"
            if rng.random() < 0.3:
                t = [x.upper() + "***" for x in t]
            at = rng.randint(0, len(w))
            w[at:at] = t
        rows.append((i, rng.choice([" ", "\n", " - "]).join(w)))
    got = {(r["doc_id"], r["license"]): r["containment"] for r in L.scan_licenses(docs_of(rows)).collect()}
    want = brute(rows)
    assert len(want) > 80
    assert got == pytest.approx(want)


def test_empty_and_bad_templates(docs_of):
    assert L.scan_licenses(docs_of([(1, "Released under the MIT License.")]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        L.scan_licenses(docs_of([(1, "x")]), {"short": "two words"})


def test_many_templates_by_shuffle_and_long_text(docs_of, monkeypatch):
    """More templates than are broadcast, one text that holds many of them."""
    monkeypatch.setattr(L, "BROADCAST_SHINGLES", 100)
    rng = random.Random(11)
    many = {f"l{i}": " ".join(f"w{rng.randint(0, 5000)}" for _ in range(rng.choice([12, 40, 41]))) for i in range(2500)}
    names = rng.sample(sorted(many), 60)
    filler = " ".join(f"f{i % 977}" for i in range(100_000))
    rows = [(1, filler + " " + " x y ".join(many[n] for n in names)), (2, filler), (3, many["l7"]), (3, "w1 w2 w3"), (4, None)]
    got = {(r["doc_id"], r["license"]): r["containment"] for r in L.scan_licenses(docs_of(rows), many).collect()}
    assert got == {**{(1, n): 1.0 for n in names}, (3, "l7"): 1.0}


def test_no_templates(docs_of):
    assert L.scan_licenses(docs_of([(1, "Released under the MIT License.")]), {}).count() == 0
