import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wearcast.llm import infill as I

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, seed=42, rate=50, spm=80):
    t = text or ""
    units = UNIT.findall(t)
    n = len(units)
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i: 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", t, None, None
    if h[3] % 100 < spm:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def texts(seed):
    rng = random.Random(seed)
    bits = ["word", " ", "\n", "\t", "é", "😀", "<", ">", "P", "<P", "S>", "M>", "<S", "\x0b", "\x1f", " ", "x" * 50]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 60)))) for i in range(1000, 1400)]
    return rows + [(2000, "has <P> inside"), (2001, "<S>"), (2002, " "), (2003, "\n\n"), (2004, "a" * 300_000 + " b")]


@pytest.mark.parametrize("rate,spm", [(50, 80), (100, 50), (100, 0), (0, 80)])
def test_equals_brute_force_and_restores(docs_of, nasty, rate, spm):
    rows = nasty + texts(rate + spm)
    done = I.fill_in_middle(docs_of(rows), rate=rate, spm=spm)
    got = done.select("doc_id", "text", "fim.*", "key", "component_id",
                      I.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    assert len(got) == len(rows)
    want = sorted(((i, t, *brute(i, t, rate=rate, spm=spm)) for i, t in rows), key=str)
    have = sorted(((r["doc_id"], r["text"], r["units"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"])
                   for r in got), key=str)
    assert have == want
    assert all(r["back"] == (r["text"] or "") and r["key"] == "x" and r["component_id"] == 2 for r in got)
    forms = {r["form"] for r in got}
    assert forms == ({"plain"} if rate == 0 else {"plain", "psm"} if spm == 0 else {"plain", "psm", "spm"})


def test_rotation_in_place():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 300, 3 * I._SWAP + 5):
        data = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        for a, m, b in {(0, n // 3, n), (0, 0, n), (0, n, n), (n // 4, n // 2, n - n // 8)}:
            buf = bytearray(data)
            I.rotate(buf, a, m, b)
            assert bytes(buf) == data[:a] + data[m:b] + data[a:m] + data[b:]
            I.rotate(buf, a, a + b - m, b)
            assert bytes(buf) == data


def test_choice_follows_the_id_alone(docs_of):
    rows = [(i, f"text number {i} with some words to cut") for i in range(200)]
    a, b = (I.fill_in_middle(docs_of(rows).repartition(p)).select("doc_id", "fim.output") for p in (1, 7))
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.exceptAll(I.fill_in_middle(docs_of(rows), seed=7).select("doc_id", "fim.output")).count() > 0


def test_empty_table_and_taken_name(docs_of):
    assert I.fill_in_middle(docs_of([(1, "x")]).limit(0)).collect() == []
    with pytest.raises(ValueError):
        I.fill_in_middle(docs_of([(1, "x")]), out="key")


def test_one_long_text_in_bounded_memory():
    """A text of 32 MB is cut with a few bytes of memory per byte."""
    import tracemalloc

    text = ("some words é and more\n" * 1_500_000)[: 32 << 20]
    block = pa.RecordBatch.from_arrays([pa.array([text])] + [pa.array([k]) for k in (5_000_000, 123_456, 1, 1)],
                                       ["text", "h1", "h2", "h3", "h4"])
    tracemalloc.start()
    out = I._cut_block(block, 50, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * len(text.encode())
    row = out[0].as_py()
    assert I.rebuild(row["output"].encode(), row["form"]).decode() == text
