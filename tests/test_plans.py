"""Plan shape: pushdown, pruning, no single-partition exchange in the
split, bounded broadcasts."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from wearcast import schema as S
from wearcast.functions.features import extract_features
from wearcast.operators import sampling as M
from wearcast.sources import readings as R


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _readings_table(spark, tmp_path):
    rows = [(f"r{i}", "LMH"[i % 3], 298.0, 308.0, 1500.0 + i, 40.0, float(i % 200), int(i % 30 == 0))
            for i in range(300)]
    df = spark.createDataFrame(rows, S.READINGS_DDL)
    path = str(tmp_path / "readings")
    df.write.parquet(path)
    return path, df


def test_type_filter_and_projection_reach_the_scan(spark, tmp_path):
    path, _ = _readings_table(spark, tmp_path)
    q = extract_features(R.filter_type(R.read_readings(spark, path)), keep=("reading_id",))
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(type), EqualTo(type,L)]" in plan
    read_schema = [l for l in plan.splitlines() if l.startswith("ReadSchema")][0]
    assert "type" in read_schema and "reading_id" in read_schema


def test_type_partition_prunes(spark, tmp_path):
    _, df = _readings_table(spark, tmp_path)
    out = R.type_partition(df, str(tmp_path / "by_type"), "L")
    plan = _plan(out)
    assert "PartitionFilters: [isnotnull(type" in plan and "(type#" in plan
    assert out.count() == 100


def test_split_has_no_window_over_a_class(spark, tmp_path):
    _, df = _readings_table(spark, tmp_path)
    plan = _plan(M.stratified_split(df))
    # ranks come from running totals over range-partitioned rows; rows are never
    # dealt by class, and the class table (k rows) is broadcast
    assert not re.search(r"hashpartitioning\(target#\d+, \d+\)[^\n]*\n[^\n]*Window", plan)
    assert "BroadcastExchange" in plan and "SortMergeJoin" not in plan
