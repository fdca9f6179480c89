import random
import zlib

import numpy as np
import pytest

import corpus_pipeline as P
from test_decontaminate import brute as brute_leaks
from test_jaccard import brute as brute_classes
from test_pii import brute as brute_pii
from tokenizers import Tokenizer
from wearcast.llm import compression, packing


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(12)
    vocab = [f"{a}{b}" for a in ("stone", "river", "quiet", "under", "wall") for b in ("", "s", "ing", "er", "ly")]
    items = [(i, " ".join(rng.choices(vocab, k=24)) + ". " + " ".join(rng.choices(vocab, k=8))) for i in range(10)]
    rows, labels = [], []
    for i in range(160):
        w = rng.choices(vocab, k=rng.randint(40, 120))
        if i % 8 == 3:
            w = [x.upper() + rng.choice(["!!", "###"]) for x in w]
        elif i % 8 == 5:
            w[10:10] = rng.choice(items)[1].split()
        elif i % 8 == 6:
            w[10:10] = ["mail", f"a{i}@b.cd", "+1 (743) 555-3824"]
        elif i % 8 == 7:
            w = rows[-7][1].split()
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 8 != 3), 0))
    rows += [(500, None), (501, ""), (None, "no id " * 30), (7, rows[7][1])]
    at = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), items


def test_every_stage_equals_brute_force(spark, sf_dir):
    d, items = sf_dir
    docs = spark.read.parquet(f"{d}/documents.parquet")
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    names = docs.columns

    model = compression.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
    sizes = compression.Sizes(model.good, model.bad)
    mean, scale, w = map(np.array, (model.mean, model.scale, model.weights))

    def score(t):
        z = w[0] + (np.array(sizes.features(t.encode())) - mean) / scale @ w[1:]
        return 1 / (1 + np.exp(-z))

    kept = P.STAGES[0][1](spark, docs, d)
    want = [(i, t) for i, t in pairs(docs) if (score(t) if t else model.prior) >= compression.ACCEPT]
    assert pairs(kept) == want and len(want) < docs.count() and kept.columns == names

    single = P.STAGES[1][1](spark, kept, d)
    classes = {(c[0], c[2]) for c in brute_classes(want, 5, 80)}
    gone = {i for i, c in classes if i is not None and c != i}
    first = sorted({(i, t) for i, t in want if i not in gone}, key=str)
    assert gone and pairs(single) == first and single.columns == names

    clean = P.STAGES[2][1](spark, single, d)
    leaked = {x[0] for x in brute_leaks(first, items)}
    rest = [(i, t) for i, t in first if i not in leaked]
    assert leaked and pairs(clean) == rest and clean.columns == names

    masked = P.STAGES[3][1](spark, clean, d)

    def mask(t):
        out, at = [], 0
        for a, _, z, k in brute_pii(t):
            if a >= at:
                out += [t[at:a], f"<{k.upper()}>"]
            at = max(at, z)
        return "".join(out) + t[at:] if t is not None else None

    plain = sorted(((i, mask(t)) for i, t in rest), key=str)
    assert pairs(masked) == plain and masked.columns == names
    assert any("<EMAIL>" in (t or "") for _, t in plain)
    assert all(r["n_chars"] == len(r["text"] or "") for r in masked.collect())

    pieces = P.STAGES[4][1](spark, masked, d).collect()
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    ids = {}
    for r in sorted(pieces, key=lambda r: r["start"]):
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
        ids.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert ids == {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in plain}
    total = sum(map(len, ids.values()))
    assert len({r["sequence_id"] for r in pieces}) == -(-total // packing.SEQUENCE)

    cols = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in P.run(spark, d).collect()))) == sorted(
        map(str, (tuple(r[c] for c in cols) for r in pieces)))


def test_stages_survive_an_empty_table(spark, sf_dir):
    d, _ = sf_dir
    docs = spark.read.parquet(f"{d}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, d).count() == 0


def test_near_duplicates_go_row_by_row(spark, docs_of):
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    base, clean, other, hot, alone = (text() for _ in range(5))
    near = lambda t: t.rsplit(" ", 1)[0] + " changed"
    rows = [(3, base), (5, near(base)), (5, clean), (8, clean.upper()), (6, text()), (6, other), (6, None), (6, ""),
            (None, alone), (None, text()), (None, near(other)), *[(None, hot + f" x{i}") for i in range(20)],
            (9, hot), (9, hot), (2, near(hot)), (None, None)]
    kept = P.near_duplicates(spark, docs_of(rows), None)
    want = [r for r in rows if r[1] not in (near(base), clean.upper(), near(other), hot) and not (r[1] or "").startswith(hot + " x")]
    assert kept.columns == docs_of(rows).columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_of_row_copies_without_an_id_one_stays(spark, docs_of):
    rows = [(None, "one two three four five six seven")] * 12 + [(None, "others are here to stay as well")]
    kept = P.near_duplicates(spark, docs_of(rows).repartition(5), None)
    assert sorted(r["text"] for r in kept.collect()) == sorted({t for _, t in rows})
