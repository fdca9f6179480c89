"""Exact running totals in a global order, without a single-task window.

``Window.orderBy(...)`` with no partition key (or a hot partition key) sends
every row to one task.  Instead:

1. range-partition on ``(group, order)`` into P partitions and sort within
   them; tag each row with its partition id and checkpoint (stable ids,
   lineage cut to the shared checkpoint folder);
2. local running totals per partition in an Arrow batch function (carrying
   state across batches of the same partition; no shuffle);
3. per-partition group totals → offsets for the groups that straddle a
   partition boundary.  Each boundary splits at most one group, so the
   offsets table has at most 2·P rows: a proven bound, safe to broadcast;
4. local total ⊕ offset.

Ties in the order key may land in one partition; for the callers here the
input is already aggregated to distinct order keys, so a hot key is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ship_package, shuffle_partitions

_PID = "_pid"


def _local_running(pdf_iter, group_cols, value_cols, hows, out_names):
    last_key = None
    carry: dict[str, float] = {}
    for pdf in pdf_iter:
        if pdf.empty:
            yield pdf.assign(**{n: pd.Series(dtype="float64") for n in out_names})
            continue
        n = len(pdf)
        if group_cols:
            keys = pdf[group_cols]
            changed = (keys != keys.shift()).any(axis=1).to_numpy()
            first_key = tuple(keys.iloc[0])
            changed[0] = first_key != last_key
            gid = np.cumsum(changed)
            last_key = tuple(keys.iloc[-1])
        else:
            changed = np.zeros(n, dtype=bool)
            changed[0] = last_key is None
            gid = np.cumsum(changed)
            last_key = ()
        continues = not changed[0]
        first_group = gid == gid[0]
        new_carry = {}
        for v, out in zip(value_cols, out_names):
            x = pdf[v].to_numpy(dtype="float64", na_value=np.nan)
            s = pd.Series(x)
            g = s.groupby(gid, sort=False)
            if hows[v] == "sum":
                inc = g.cumsum().to_numpy()
                if continues:
                    inc = np.where(first_group, inc + carry[v], inc)
                exc = np.where(changed, 0.0, np.roll(inc, 1))
                if continues:
                    exc[0] = carry[v]
            else:  # max
                inc = g.cummax().to_numpy()
                if continues:
                    inc = np.where(first_group, np.fmax(inc, carry[v]), inc)
                exc = np.where(changed, np.nan, np.roll(inc, 1))
                if continues:
                    exc[0] = carry[v]
            new_carry[v] = inc[-1]
            pdf[out] = exc
        carry = new_carry
        yield pdf


def running_totals(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    value_cols: Sequence[str],
    how: str | dict[str, str] = "sum",
    num_partitions: int | None = None,
    suffix: str = "_before",
) -> DataFrame:
    """Add ``<v><suffix>`` = running ``sum``/``max`` of ``v`` over the rows
    strictly before each row, within ``group_cols``, ordered by ``order_cols``.

    ``how`` is one of 'sum'/'max' for every column, or a per-column dict (one
    ranking pass for several running aggregates).  For ``sum`` the first row
    of a group gets 0; for ``max`` it gets NULL.  Result values are DOUBLE.
    """
    hows = {v: (how[v] if isinstance(how, dict) else how) for v in value_cols}
    if set(hows.values()) - {"sum", "max"}:
        raise ValueError("how must be 'sum' or 'max'")
    spark = df.sparkSession
    ship_package(spark)
    p = num_partitions or shuffle_partitions(spark)
    group_cols, order_cols, value_cols = list(group_cols), list(order_cols), list(value_cols)
    keys = group_cols + order_cols
    # the range bounds are sampled from the input and the input is then
    # shuffled: keep it (spillable, recomputable cache) so it runs once
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    staged = (
        src.repartitionByRange(p, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PID, F.spark_partition_id())
    )
    staged = cut_lineage(staged)
    src.unpersist()

    outs = [f"{v}{suffix}_local" for v in value_cols]
    out_schema = T.StructType(
        staged.schema.fields + [T.StructField(o, T.DoubleType(), True) for o in outs]
    )

    def fn(it):
        return _local_running(it, group_cols, value_cols, hows, outs)

    local = staged.mapInPandas(fn, out_schema)

    def agg(v):
        return F.sum if hows[v] == "sum" else F.max

    tot = staged.groupBy(_PID, *group_cols).agg(
        *[agg(v)(F.col(v).cast("double")).alias(f"_t_{v}") for v in value_cols]
    )
    if group_cols:
        span = Window.partitionBy(*group_cols)
        tot = tot.withColumn("_span", F.count("*").over(span)).where(F.col("_span") > 1)
        w = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    else:
        w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)  # ≤ P rows
    offs = tot.select(
        _PID, *group_cols, *[agg(v)(f"_t_{v}").over(w).alias(f"_o_{v}") for v in value_cols]
    ).where(F.coalesce(*[F.col(f"_o_{v}").isNotNull() for v in value_cols]))
    # at most 2·P rows (see module doc): bounded, broadcast it
    joined = local.join(F.broadcast(offs), on=[_PID, *group_cols], how="left")
    result = {}
    for v, o in zip(value_cols, outs):
        if hows[v] == "sum":
            result[f"{v}{suffix}"] = F.col(o) + F.coalesce(F.col(f"_o_{v}"), F.lit(0.0))
        else:
            # group starts carry NaN out of numpy; make them SQL NULL explicitly
            local_max = F.when(F.isnan(o), F.lit(None).cast("double")).otherwise(F.col(o))
            result[f"{v}{suffix}"] = F.greatest(local_max, F.col(f"_o_{v}"))
    return joined.withColumns(result).drop(*outs, *[f"_o_{v}" for v in value_cols], _PID)
