"""Exact stratified split and folds, random batch, class weights (M1-M6).

Order within a class is ``md5(id ‖ ':' ‖ seed)`` (hex, identical in every
engine), then a hash of the whole row, so it depends on neither the size nor
the partitioning of the data.  Rows are counted by class and bucket (the first
digits of the md5); a bucket's rank offset is the sum of those before it.  A
split needs ranks in one bucket per class only: every other bucket lies on one
side as a whole, so no row is shuffled.  Folds need every rank: rows are
shuffled once, by bucket, and numbered there.  A bucket far larger than the
others (one id in very many rows) is ranked by distributed running totals over
its distinct rows (``prefix.running_totals``), not in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..session import cut_lineage
from .prefix import running_totals


def hash_key(id_col: str, seed: int) -> F.Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


#: Hex digits of a bucket, and rows (and multiple of its class's mean) beyond which a bucket is not one task's.
DIGITS, HOT_ROWS, HOT_TIMES = 3, 200_000, 8


def _keyed(df: DataFrame, id_col: str, target: str, seed: int) -> DataFrame:
    """The rows with a label, plus ``_h`` (hash), ``_row`` (row hash) and ``_bucket`` (rows without an id come first)."""
    rows = df.where(F.col(target).isNotNull()).withColumn("_hex", hash_key(id_col, seed))
    return rows.withColumns({"_h": F.unhex("_hex"), "_bucket": F.coalesce(F.substring("_hex", 1, DIGITS), F.lit("")),
                             "_row": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])}).drop("_hex")


def _buckets(keyed: DataFrame, target: str) -> DataFrame:
    """(target, _bucket, _n, _start, _hot): rows of each bucket, rows of its class before it, whether it is far too large."""
    counts = cut_lineage(keyed.groupBy(target, "_bucket").agg(F.count("*").alias("_n")))  # one scan of the rows
    w = Window.partitionBy(target)
    start = F.coalesce(F.sum("_n").over(w.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hot = F.col("_n") > F.greatest(F.lit(HOT_ROWS), F.sum("_n").over(w) * (HOT_TIMES / 16**DIGITS))
    return counts.withColumns({"_start": start, "_hot": hot})


def _bucket_ranks(keyed: DataFrame, buckets: DataFrame, target: str) -> DataFrame:
    """Adds ``_at``: the 1-based rank of a row in its bucket.  Copies of a row get consecutive ranks."""
    def numbered(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_at", F.row_number().over(Window.partitionBy(target, "_bucket").orderBy("_h", "_row")).cast("long"))

    hot = cut_lineage(buckets.where("_hot").select(F.col(target).alias("_class"), F.col("_bucket").alias("_large")))
    if hot.isEmpty():
        return numbered(keyed)
    large = (F.col(target) == F.col("_class")) & (F.col("_bucket") == F.col("_large"))
    few = F.broadcast(hot)  # each has more than HOT_ROWS rows
    cols = [F.col(f"`{c}`") for c in keyed.columns]
    rows = keyed.join(few, large, "left_semi").groupBy(*cols).agg(F.count("*").alias("_copies"))
    ranked = running_totals(rows, [target, "_bucket"], ["_h", "_row"], ["_copies"])
    first = F.col("_copies_before").cast("long") + 1
    ranked = ranked.withColumn("_at", F.explode(F.sequence(first, first + F.col("_copies") - 1))).select(*cols, "_at")
    return numbered(keyed.join(few, large, "left_anti")).unionByName(ranked)


def class_ranks(df: DataFrame, id_col: str, target: str = S.TARGET, seed: int = S.SPLIT_SEED) -> DataFrame:
    """The rows with a label, plus ``_rank``: the 1-based rank of the row in
    its class by hash order.  Copies of a row get consecutive ranks."""
    keyed = _keyed(df, id_col, target, seed)
    buckets = _buckets(keyed, target)
    starts = buckets.select(F.col(target).alias("_class"), F.col("_bucket").alias("_of"), "_start")
    ranked = _bucket_ranks(keyed, buckets, target).join(
        _classes(starts), (F.col(target) == F.col("_class")) & (F.col("_bucket") == F.col("_of")))
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + F.col("_at")).alias("_rank"))


def allocation(counts: DataFrame, target: str = S.TARGET, test_size: float = S.SPLIT_TEST_SIZE) -> DataFrame:
    """Per class: train and test sizes.  n_test = ceil(test_size·N); train
    sizes by largest remainder of (n_c / N)·n_train, ties to the lower class
    label; test = rest.  ``counts``: (target, n_c) — one row per class."""
    w_all = Window.partitionBy()
    c = counts.withColumn("_N", F.sum("n_c").over(w_all))
    c = c.withColumn("_n_train", F.col("_N") - F.ceil(F.lit(test_size) * F.col("_N")))
    c = c.withColumn("_cont", F.col("n_c") / F.col("_N") * F.col("_n_train"))
    c = c.withColumn("_fl", F.floor("_cont"))
    c = c.withColumn("_need", F.col("_n_train") - F.sum("_fl").over(w_all))
    c = c.withColumn("_pos", F.row_number().over(Window.orderBy(F.desc(F.col("_cont") - F.col("_fl")), target)))
    c = c.withColumn("n_train", (F.col("_fl") + F.when(F.col("_pos") <= F.col("_need"), 1).otherwise(0)).cast("long"))
    return c.select(target, F.col("n_c").cast("long").alias("n_c"), "n_train",
                    (F.col("n_c") - F.col("n_train")).cast("long").alias("n_test"))


def stratified_split(df: DataFrame, id_col: str = "reading_id", target: str = S.TARGET,
                     test_size: float = S.SPLIT_TEST_SIZE, seed: int = S.SPLIT_SEED) -> DataFrame:
    """Adds ``split`` ∈ {train, test}: exact class-proportional sizes; the
    first n_test rows of each class in hash order are the test rows.  Rows
    without a label are kept with a NULL split and do not count in the sizes."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    keyed = _keyed(df, id_col, target, seed)
    buckets = _buckets(keyed, target)
    sizes = allocation(buckets.groupBy(target).agg(F.sum("_n").alias("n_c")), target, test_size)
    # the bucket of each class's first train row, and how many of its rows are test rows; none if all rows are
    sizes = sizes.select(F.col(target).alias("_class"), "n_test")
    edge = buckets.join(sizes, F.col(target) == F.col("_class")).where("_start <= n_test AND n_test < _start + _n")
    edge = sizes.join(edge.select(F.col("_class").alias("_c"), F.col("_bucket").alias("_edge"),
                                  (F.col("n_test") - F.col("_start")).alias("_left")), F.col("_class") == F.col("_c"), "left")
    edge = cut_lineage(edge.select("_class", "_edge", F.coalesce("_left", F.lit(0)).alias("_left")))
    side = keyed.join(_classes(edge), F.col(target) == F.col("_class"))
    split = (F.col("_bucket") == F.col("_edge")) & (F.col("_left") > 0)
    whole = side.where(F.coalesce(~split, F.lit(True))).select(*cols, F.when(
        F.coalesce(F.col("_bucket") < F.col("_edge"), F.lit(True)), "test").otherwise("train").alias("split"))
    part = side.where(split).drop("_class", "_edge")
    part = _bucket_ranks(part, buckets.join(_classes(edge), (F.col(target) == F.col("_class")) & split), target)
    part = part.select(*cols, F.when(F.col("_at") <= F.col("_left"), "test").otherwise("train").alias("split"))
    return whole.unionByName(part).unionByName(
        df.where(F.col(target).isNull()).withColumn("split", F.lit(None).cast("string")))


def stratified_folds(df: DataFrame, k: int = S.CV_FOLDS, id_col: str = "reading_id", target: str = S.TARGET,
                     seed: int = S.SPLIT_SEED) -> DataFrame:
    """Adds ``fold`` ∈ [0, k): rank in class (hash order) mod k, so every
    fold gets each class in proportion (sizes differ by at most one).  Rows
    without a label are kept with a NULL fold."""
    ranked = class_ranks(df, id_col, target, seed).withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")
    return ranked.unionByName(df.where(F.col(target).isNull()).withColumn("fold", F.lit(None).cast("int")))


def random_batch(df: DataFrame, n: int = S.BATCH_SIZE, id_col: str = "reading_id", seed: int = S.BATCH_SEED,
                 include_target: bool = False, target: str = S.TARGET) -> DataFrame:
    """n = min(n, N) rows without replacement, reproducible by seed.
    ``orderBy(...).limit(n)`` plans as a top-k (TakeOrderedAndProject):
    each task keeps n rows, no full sort."""
    out = df.orderBy(hash_key(id_col, seed), id_col).limit(n)
    if not include_target:
        out = out.drop(target)
    return out


def class_weights(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """(target, count, weight) with weight = N / (k · n_c) ("balanced")."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("count"))
    w = Window.partitionBy()
    return counts.select(
        target,
        "count",
        (F.sum("count").over(w) / (F.count("*").over(w) * F.col("count"))).alias("weight"),
    )


#: Class tables up to this many rows are broadcast, larger ones joined by shuffle.
MAX_BROADCAST_CLASSES = 100_000


def _classes(table: DataFrame) -> DataFrame:
    """One row per class: broadcast after its count is checked (a join by
    shuffle would put the majority class in one task)."""
    small = table.limit(MAX_BROADCAST_CLASSES + 1).count() <= MAX_BROADCAST_CLASSES
    return F.broadcast(table) if small else table


def attach_weights(df: DataFrame, weights: DataFrame, target: str = S.TARGET, weight_col: str = "weight") -> DataFrame:
    """Per-row weight by class; NULL for a label without a weight."""
    table = weights.select(F.col(target).alias("_class"), F.col("weight").cast("double").alias(weight_col))
    return df.join(_classes(table), F.col(target) == F.col("_class"), "left").drop("_class")


def split_summary(split_df: DataFrame, weights: DataFrame, n_features: int, target: str = S.TARGET) -> DataFrame:
    """(metric, value): totals, split sizes, positive ratio, class weights."""
    row = split_df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "test").alias("test"),
        F.avg(F.col(target).cast("double")).alias("pos"),
    )
    wrow = weights.agg(
        F.max(F.when(F.col(target) == 0, F.col("weight"))).alias("w0"),
        F.max(F.when(F.col(target) == 1, F.col("weight"))).alias("w1"),
    )
    r = row.crossJoin(wrow)
    items = [
        ("dataset_size", F.col("total")), ("n_features", F.lit(n_features)), ("train_size", F.col("train")),
        ("test_size", F.col("test")), ("failure_rate", F.col("pos")), ("class_0_weight", F.col("w0")),
        ("class_1_weight", F.col("w1")),
    ]
    arr = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in items])
    return r.select(F.explode(arr).alias("x")).select("x.*")
