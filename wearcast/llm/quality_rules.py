"""Quality rules: text counts, and a hashed n-gram log-likelihood ratio.

DataFrame functions only.  Two multinomials over ``BUCKETS`` hash buckets of
word unigrams and bigrams are counted over whole texts: the trusted target
(documents labelled good) and the raw corpus (all documents).  A document's
score is the mean log ratio of its n-grams; the verdict compares it with
``THRESHOLD``.  The weights are one row of ``BUCKETS`` numbers, whatever the
corpus size.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .book import query
from .common import table

BUCKETS = 1 << 14
SMOOTHING = 1.0
THRESHOLD = -0.07
#: Trusted ids up to this count (80 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_IDS = 500_000
_GAP = "\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """Words: runs of anything but space and the control characters 9 to 13."""
    inner = F.btrim(text, F.lit(_GAP))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+", -1))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def word_hashes(words: Column) -> Column:
    """64-bit hashes of the words: longer grams hash these, not the strings."""
    return F.transform(words, lambda w: F.xxhash64(w))


def ngram_buckets(hashes: Column) -> Column:
    """Hash buckets of a text's unigrams and bigrams, from its word hashes."""
    mask = F.lit(BUCKETS - 1).cast("long")

    def both(hs: Column) -> Column:
        one = F.transform(hs, lambda h: h.bitwiseAND(mask).cast("int"))
        two = F.transform(F.slice(hs, 1, F.greatest(F.size(hs) - 1, F.lit(0))),
                          lambda h, i: F.xxhash64(h, F.get(hs, i + 1)).bitwiseAND(mask).cast("int"))
        return F.concat(one, two)

    return _bound(hashes, both)


def repeated_words(hashes: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice in the text."""

    def windows(hs: Column) -> Column:
        return F.transform(F.slice(hs, 1, F.greatest(F.size(hs) - 2, F.lit(0))),
                           lambda h, i: F.xxhash64(h, F.get(hs, i + 1), F.get(hs, i + 2)))

    def starts(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, j: F.coalesce(F.least(F.get(p, j + 1) - x, F.lit(3)), F.lit(3))),
                           F.lit(0).cast("long"), lambda acc, x: acc + x)

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _bound(_bound(pairs, starts), covered)).otherwise(
            F.lit(0).cast("long"))

    return F.coalesce(_bound(_bound(hashes, windows), count), F.lit(0).cast("long"))


def base_counts(text: Column, hashes: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(_GAP)) != "")
    return {
        "n_words": F.size(hashes).cast("long"),
        "word_chars": F.length(F.translate(text, _GAP, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(hashes),
    }


def ngram_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: the array of log p_target - log p_raw by bucket.

    Raw counts cover all documents.  The target's are those whose id is
    labelled ``quality`` 1 (several labels of an id count once, null ids and
    labels not at all)."""
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_good")).distinct()
    if trusted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        trusted = F.broadcast(trusted)
    text = F.coalesce("text", F.lit(""))
    grams = docs.join(trusted, docs["doc_id"] == F.col("_good"), "left").select(
        F.col("_good").isNotNull().cast("long").alias("t"), F.explode(ngram_buckets(word_hashes(words_of(text)))).alias("b"))
    counted = grams.groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("target"))
    total = counted.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("n_raw"),
                        F.coalesce(F.sum("target"), F.lit(0)).alias("n_target"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b"))
    share = lambda c, n: F.log((F.coalesce(c, F.lit(0)) + SMOOTHING) / (F.col(n) + SMOOTHING * BUCKETS))
    per = every.join(F.broadcast(counted), "b", "left").crossJoin(F.broadcast(total)).select(
        "b", (share("target", "n_target") - share("raw", "n_raw")).alias("w"))
    return per.agg(F.transform(F.sort_array(F.collect_list(F.struct("b", "w"))), lambda x: x["w"]).alias("weights"))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: base counts, base verdict, score and verdict.

    Null text counts as empty: no words, score 0, and the base rules reject
    it.  Other columns of ``docs`` are not read.  Without labels every weight
    follows from the raw counts alone.  Repeated rows are scored one by one
    and an empty table gives an empty result."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    weights = ngram_weights(docs, labels).first()["weights"]
    text = F.coalesce("text", F.lit(""))
    worded = docs.select("doc_id", text.alias("text"), word_hashes(words_of(text)).alias("hashes"))
    counted = worded.select("doc_id", *[c.alias(k) for k, c in base_counts(F.col("text"), F.col("hashes")).items()],
                            ngram_buckets(F.col("hashes")).alias("grams"))
    lookup = F.from_json(F.lit(json.dumps(weights)), "array<double>")  # folded to one literal
    total = F.aggregate("grams", F.lit(0.0), lambda acc, g: acc + F.get(lookup, g))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = counted.withColumn("score", F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(F.lit(0.0)))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & (F.col("score") >= threshold)).alias("kept"), "score")


@query("op7_ngram_quality")
def op7(spark, sf_dir):
    """Base counts and the log-likelihood verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
