import hashlib
import random

import numpy as np
import pytest

from wearcast.llm import suffixes as S


def brute(rows, length):
    """Distinct ids; null ids come first."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        t = (t or "").encode()
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            s = t[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        runs = sum(gone[p] and (p == 0 or not gone[p - 1]) for p in range(len(t)))
        out[i] = (len(t), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest())
    return out


def corpus(seed, vocab=60):
    rng = random.Random(seed)
    words = [f"w{i}é" if i % 9 == 0 else f"word{i}" for i in range(vocab)]
    passages = [" ".join(rng.choices(words, k=rng.randint(5, 40))) for _ in range(8)]
    rows = []
    for i in range(120):
        t = " ".join(rng.choices(words, k=rng.randint(0, 40)))
        for p in rng.sample(passages, rng.randint(0, 3)):
            cut = rng.randint(0, len(t))
            t = t[:cut] + p[rng.randint(0, 20):] + t[cut:]
        rows.append((i, t))
    rows += [(200, "x" * 3000), (201, "x" * 500), (202, "ab" * 700), (203, "Orre " * 400), (204, rows[5][1] * 3)]
    rows += [(210 + i, rows[7][1]) for i in range(30)] + [(300, None), (301, ""), (None, rows[9][1] + " tail " * 30)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("length,most", [(100, 4000), (100, 3), (40, 5)])
def test_removed_bytes_equal_brute_force(docs_of, length, most):
    rows = corpus(length + most)
    got = S.remove_repeats(docs_of(rows), length, most).collect()
    have = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got}
    assert have == brute(rows, length) and len(got) == len(rows)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)


def test_same_rows_are_one_document(docs_of):
    text = " ".join(f"token{i}" for i in range(60))
    got = S.remove_repeats(docs_of([(1, text), (1, text), (2, text), (3, "a"), (3, text[:200])])).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in got) == [
        (1, len(text), 0), (1, len(text), 0), (2, len(text), len(text)), (3, 1, 0), (3, 200, 200)]


def test_backward_extension_finds_all_repeats():
    rng = random.Random(1)
    for length in (4, 9, 33):
        texts = [bytes(rng.choices(b"ab", k=rng.randint(length, 90))) for _ in range(12)]
        order = np.array([[i, 0, 0] for i in range(len(texts))])
        got = S.repeated_starts(texts, order, length)
        seen = set()
        for t, s in zip(texts, got):
            want = []
            for p in range(len(t) - length + 1):
                if t[p:p + length] in seen:
                    want.append(p)
                seen.add(t[p:p + length])
            assert s.tolist() == want


def test_empty_table(docs_of):
    assert S.remove_repeats(docs_of([(1, "x")]).limit(0)).count() == 0
