import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearcast.operators.prefix import running_totals
from wearcast.operators.quantiles import quantiles


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_running_sum_matches_bruteforce(spark, parts):
    rng = np.random.default_rng(parts)
    # one hot group holding most rows, so it spans partitions
    g = np.where(rng.random(3000) < 0.7, 0, rng.integers(1, 20, 3000))
    pdf = pd.DataFrame({"g": g, "o": rng.permutation(3000), "v": rng.integers(0, 5, 3000)})
    out = running_totals(spark.createDataFrame(pdf), ["g"], ["o"], ["v"], num_partitions=parts).toPandas()
    exp = pdf.sort_values(["g", "o"]).assign(e=lambda d: d.groupby("g")["v"].cumsum() - d["v"])
    m = out.merge(exp, on=["g", "o"])
    assert len(m) == 3000
    assert (m["v_before"] == m["e"]).all()


def test_running_max_global(spark):
    pdf = pd.DataFrame({"o": range(500), "v": np.random.default_rng(1).random(500)})
    out = running_totals(spark.createDataFrame(pdf), [], ["o"], ["v"], how="max", num_partitions=5).toPandas()
    out = out.sort_values("o")
    exp = pdf["v"].cummax().shift(1)
    assert out["v_before"].isna().iloc[0]
    assert np.allclose(out["v_before"].iloc[1:].to_numpy(), exp.iloc[1:].to_numpy())


def test_exact_quantiles_equal_pandas(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"a": rng.normal(size=2001), "b": rng.integers(0, 10, 2001).astype(float)})
    pdf.loc[::13, "a"] = np.nan
    q = quantiles(spark.createDataFrame(pdf), ["a", "b"], [0.25, 0.5, 0.75]).toPandas()
    for _, r in q.iterrows():
        assert r["quantile"] == pytest.approx(pdf[r["feature"]].quantile(r["prob"]), rel=1e-12, abs=1e-12)


def test_quantiles_single_row_and_ties(spark):
    df = spark.createDataFrame([(5.0,)] * 7 + [(1.0,)], "x double")
    q = {r["prob"]: r["quantile"] for r in quantiles(df, ["x"], [0.0, 0.5, 1.0]).collect()}
    assert q == {0.0: 1.0, 0.5: 5.0, 1.0: 5.0}
    one = spark.createDataFrame([(3.0,)], "x double")
    assert quantiles(one, ["x"], [0.25]).first()["quantile"] == 3.0


def test_brackets_that_miss_are_widened(spark):
    """A coarse sketch gives the same quantiles; a column without values stays as NULL rows."""
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": rng.normal(size=5999), "b": rng.integers(0, 7, 5999).astype(float), "c": np.inf})
    df = spark.createDataFrame(pdf).withColumn("none", F.lit(None).cast("double")).repartition(7)
    for accuracy in (10000, 3):
        got = {(r["feature"], r["prob"]): r["quantile"]
               for r in quantiles(df, ["a", "b", "c", "none"], [0.0, 0.1, 0.5, 0.9, 1.0], accuracy=accuracy).collect()}
        assert len(got) == 20 and all(got["none", p] is None for p in (0.0, 0.5))
        for (c, p), v in got.items():
            if c in "ab":
                assert v == pytest.approx(pdf[c].quantile(p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("few", [0, 3, 40])
def test_many_rounds_of_brackets_give_the_same(spark, monkeypatch, few):
    """With room for few values a bracket is narrowed again and again; heavy
    ties at its ends, extreme and infinite values do not hold it up."""
    import wearcast.operators.quantiles as module

    monkeypatch.setattr(module, "FEW", few)
    monkeypatch.setattr(module, "INNER", 20)
    rng = np.random.default_rng(few)
    n = 4000
    pdf = pd.DataFrame({"a": rng.normal(size=n) * 10.0 ** rng.integers(-200, 200, n), "b": np.where(rng.random(n) < 0.9, 1.0, rng.normal(size=n)),
                        "c": rng.integers(0, 3, n).astype(float), "d": rng.uniform(size=n)})
    pdf.loc[:50, "d"] = np.inf
    probs = [0.0, 0.05, 0.25, 0.5, 0.951, 1.0]
    got = quantiles(spark.createDataFrame(pdf).repartition(5), list(pdf), probs, accuracy=30).collect()
    for r in got:
        values = np.sort(pdf[r["feature"]].to_numpy())
        low = int(r["prob"] * (n - 1))
        a, b = values[low], values[min(low + 1, n - 1)]
        want = a if a == b else a + (b - a) * (r["prob"] * (n - 1) - low)
        assert r["quantile"] == want or r["quantile"] == pytest.approx(want, rel=1e-12)


def test_mixed_running_aggregates_one_pass(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 800), "o": rng.permutation(800), "v": rng.integers(0, 9, 800),
                        "m": rng.random(800)})
    out = running_totals(spark.createDataFrame(pdf), ["g"], ["o"], ["v", "m"], how={"v": "sum", "m": "max"},
                         num_partitions=6).toPandas().sort_values(["g", "o"])
    exp = pdf.sort_values(["g", "o"])
    ev = exp.groupby("g")["v"].cumsum() - exp["v"]
    em = exp.groupby("g")["m"].cummax().groupby(exp["g"]).shift(1)
    assert (out["v_before"].to_numpy() == ev.to_numpy()).all()
    assert np.allclose(out["m_before"].fillna(-1).to_numpy(), em.fillna(-1).to_numpy())


def test_exact_quantiles_run_the_plan_of_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x * 7 % 1000)

    df = spark.range(4000).select(counted.asNondeterministic()("id").alias("a"))
    got = {r["prob"]: r["quantile"] for r in quantiles(df, ["a"], [0.25, 0.5]).collect()}
    want = spark.range(4000).select((F.col("id") * 7 % 1000).alias("a")).agg(F.expr("percentile(a, array(0.25, 0.5))")).first()[0]
    assert [got[0.25], got[0.5]] == want and seen.value == 4000
