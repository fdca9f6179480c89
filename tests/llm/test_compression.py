import random
import zlib

from wearcast.llm import compression as C


def rows_and_labels(n=240):
    rng = random.Random(9)
    vocab = ["river", "stone", "over", "under", "the", "quiet", "of", "morning", "walks", "and"]
    rows, labels = [], []
    for i in range(n):
        w = rng.choices(vocab, k=rng.randint(20, 200))
        good = i % 3 != 0
        rows.append((i, " ".join(w) if good else " ".join(x.upper() + rng.choice(["!!", "###", "$$$"]) for x in w)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_folds(spark, docs_of, nasty):
    rows, labels = rows_and_labels()
    lab = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    src = docs_of(rows + [(10_000 + (i or 0), t) for i, t in nasty] + [(None, "x")])
    model = C.train(docs_of(rows), lab)
    got = C.score_documents(src, model).collect()
    assert len(got) == len(rows) + len(nasty) + 1
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= C.ACCEPT) for r in got)
    kept = C.accepted(src, model)
    assert kept.columns == src.columns and kept.count() == sum(r["predicted"] for r in got)


def test_labels_of_the_held_out_fold_are_not_read(spark, docs_of):
    rows, labels = rows_and_labels()
    held = {i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    turned = [(i, 1 - q if i in held else q, t) for i, q, t in labels]
    one, two = (C.train(docs_of(rows), spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned))
    assert one == two


def test_without_labels_or_documents(spark, docs_of):
    lab = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for part in (lab, lab.limit(0)):
        out = C.score_documents(docs_of([(1, "a"), (2, None)]), C.train(docs_of([(1, "a")]), part)).collect()
        assert len(out) == 2 and all(0 <= r["score"] <= 1 for r in out)
    assert C.score_documents(docs_of([(1, "a")]).limit(0), C.train(docs_of([(1, "a")]).limit(0), lab)).count() == 0
