import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytoloom.functions import stats


@pytest.fixture(params=["one task per group", "value ranges"])
def path(request, monkeypatch):
    if request.param == "value ranges":
        monkeypatch.setattr(stats, "SMALL_GROUP", 0)


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(
        {
            "k": rng.choice(["a", "b", None], 600, p=[0.7, 0.25, 0.05]),
            "x": np.round(rng.normal(0, 50, 600), 1) * rng.choice([0, 1, 1e-3, 1e4], 600),
        }
    )
    pdf["id"] = np.arange(600)
    return pdf


def table(spark, values):
    rows = [(None if pd.isna(k) else k, float(x), int(i)) for k, x, i in values.itertuples(index=False)]
    return spark.createDataFrame(rows, "k string, x double, id long")


def test_quantiles_match_numpy(spark, values, path):
    got = stats.group_quantiles(table(spark, values), ["k"], "x", {"q10": 0.1, "mid": 0.5, "top": 1.0}).collect()
    assert len(got) == 3
    for r in got:
        x = values[values.k.isna() if r["k"] is None else values.k == r["k"]].x
        assert np.allclose([r["q10"], r["mid"], r["top"]], np.quantile(x, [0.1, 0.5, 1.0]))


def test_quantile_without_keys(spark, values, path):
    got = stats.group_quantiles(table(spark, values), [], "x", {"mid": 0.5}).collect()
    assert len(got) == 1 and math.isclose(got[0]["mid"], values.x.median())


def test_ranked_values(spark, values, path):
    got = stats.ranked_values(stats.value_counts(table(spark, values), ["k"], "x"), ["k"], "x").collect()
    for r in got:
        x = values[values.k.isna() if r["k"] is None else values.k == r["k"]].x
        assert r["below"] == (x < r["x"]).sum() and r["total"] == len(x) and r["n"] == (x == r["x"]).sum()


def test_mad_outliers(spark, values, path):
    got = stats.mad_outliers(table(spark, values), ["k"], {"x": "high"}).toPandas()
    assert len(got) == len(values)
    for key, part in got.groupby(got.k.fillna("missing")):
        med = part.x.median()
        limit = med + 3 * 1.4826 * (part.x - med).abs().median()
        assert np.allclose(part.x_limit, limit) and (part.high == (part.x > part.x_limit)).all()


def test_false_discovery_rate(spark, path):
    rng = np.random.default_rng(3)
    p = np.round(rng.uniform(0, 1, 200) ** 2, 2)
    df = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(p)], "id long, p double")
    got = stats.benjamini_hochberg(df, [], "p", "fdr").orderBy("id").toPandas()
    order = np.argsort(p)[::-1]
    want = np.empty(200)
    want[order] = np.minimum(1, np.minimum.accumulate(p[order] * 200 / np.arange(200, 0, -1)))
    assert np.allclose(got.fdr, want)


def test_value_range_is_monotone(spark):
    x = sorted([0.0, 1e-300, -1e-300, 1.0, 1.0000001, 2.0, -5.0, 1e300, -1e300, 3.5, 50.0, 100.0])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = [r[0] for r in df.orderBy("x").select(stats.value_range("x")).collect()]
    assert got == sorted(got)


def test_dense_index_over_many_partitions(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.md5(F.col("id").cast("string")).alias("name"),
    )
    got = stats.dense_index(df.repartition(16), ["k"], ["name"], "n").toPandas().sort_values(["k", "name"])
    assert len(got) == 5000
    assert (got.n == got.groupby("k").cumcount() + 1).all()


def test_first_per_group_ignores_partitioning(spark):
    df = spark.range(3000).select((F.col("id") % 4).alias("k"), F.col("id"))
    one = stats.first_per_group(df, ["k"], [stats.hash_order("id")], 20).collect()
    two = stats.first_per_group(df.repartition(13), ["k"], [stats.hash_order("id")], 20).collect()
    assert sorted(one) == sorted(two) and len(one) == 80


def test_log_factorial(spark):
    n = [0, 1, 2, 7, 50, 1000, 123456]
    df = spark.createDataFrame([(float(v),) for v in n], "n double")
    got = [r[0] for r in df.select(stats.log_factorial(F.col("n"))).collect()]
    assert np.allclose(got, [math.lgamma(v + 1) for v in n], rtol=1e-11, atol=1e-10)
