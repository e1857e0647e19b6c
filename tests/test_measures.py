import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from firmlens.functions import measures as M
from firmlens.operators import encoding, metrics, outliers, selection


def one(spark, expr):
    return spark.range(1).select(expr).first()[0]


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0)], "debt double, ebitda double")
    assert M.add_ratios(df, ["ratio_debt_ebitda"]).first()["ratio_debt_ebitda"] is None


def test_whole_days(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 23),)], "d timestamp")
    assert M.add_ages(df, dt.datetime(2020, 1, 2, 1), {"age": "d"}).first()["age"] == 0


def test_free_cash_flow(spark):
    rows = [(1, 2021, 130.0, 55.0, 12.0, 40.0, 8.0), (1, 2020, 100.0, 50.0, 10.0, 1.0, 1.0), (2, 2021, 1.0, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(
        rows, "company_id int, year int, fixed_assets double, current_assets double, amort double, ebit double, taxes double"
    )
    got = {(r["company_id"], r["year"]): (r["capex"], r["current_change"], r["free_cash_flow"]) for r in M.free_cash_flow(df).collect()}
    assert got[(1, 2021)] == (40.0, 5.0, -1.0)
    assert got[(1, 2020)][0] == 40.0
    assert got[(2, 2021)] == (None, None, None)


def test_log_and_boxcox(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (-2.0,), (math.e - 1,)], "x double")
    got = [r[0] for r in df.select(M.log1p(F.col("x"))).collect()]
    assert got[:3] == [0.0, None, None] and got[3] == pytest.approx(1.0)
    for lam, want in ((0, math.log(3)), (1, 2.0), (2, 4.0)):
        y = M.boxcox(F.lit(3.0), lam)
        assert one(spark, y) == pytest.approx(want)
        assert one(spark, M.inv_boxcox(y, lam)) == pytest.approx(3.0)


def test_boxcox_fit_finds_the_exponent(spark):
    # The square root of the values is symmetric and near normal, so the exponent is near one half.
    df = spark.range(2000).select(F.pow(F.lit(10.0) + F.randn(7), 2).alias("x"))
    assert M.boxcox_fit(df, "x") == pytest.approx(0.5, abs=0.2)


def test_nan_to_num(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (float("inf"),), (float("-inf"),), (2.0,)], "x double")
    got = [r[0] for r in M.nan_to_num(df, ["x"]).collect()]
    assert got == [0.0, 0.0, M.LARGEST, -M.LARGEST, 2.0]


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 2.0), (3.0, 5.0, 3.0)], "x double, c double, t double")
    std = [tuple(r) for r in encoding.standardize(df, skip=["t"]).orderBy("t").collect()]
    assert std[0][0] == pytest.approx(-1.224745, abs=1e-6) and std[1][0] == 0.0 and std[2][1] == 0.0 and std[2][2] == 3.0
    assert [tuple(r) for r in encoding.minmax(df, skip=["t"]).orderBy("t").collect()] == [(0.0, 0.0, 1.0), (0.5, 0.0, 2.0), (1.0, 0.0, 3.0)]


def test_label_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None)], "id int, s string")
    assert [r["s"] for r in encoding.label_encode(df).orderBy("id").collect()] == [1, 0, 1, 2]


def test_limits(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert outliers.limits(df, ["x"]) == {"x": (1.0, 5.5)}
    assert outliers.limits(df, ["x"], "q1") == {"x": (-0.5, 5.5)}


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (4.0, 4.0)], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert r["mse"] == pytest.approx(1 / 3) and r["mae"] == pytest.approx(1 / 3)
    assert r["mape"] == pytest.approx(1 / 6) and r["r2"] == pytest.approx(1 - 3 / 14)


def test_class_metrics(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (2, 2)], "y int, p int")
    got = {r["class"]: r for r in metrics.classification_metrics(df, "y", "p").collect()}
    assert got["accuracy"]["precision"] == 0.75
    assert got["2"]["precision"] == pytest.approx(2 / 3)
    assert got["1"]["recall"] == 0.0


def test_f_tests(spark):
    rows = [(float(i), float(i % 3), i % 2) for i in range(12)]
    df = spark.createDataFrame(rows, "x double, t double, c int")
    r = df.select(F.corr("x", "t")).first()[0]
    got = selection.f_regression(df, "t", ["x"]).first()
    assert got["f"] == pytest.approx(r * r / (1 - r * r) * 10)
    means = [sum(x for x, _, c in rows if c == g) / 6 for g in (0, 1)]
    between = sum(6 * (m - 5.5) ** 2 for m in means)
    inside = sum((x - means[c]) ** 2 for x, _, c in rows) / 10
    assert selection.f_classif(df, "c", ["x"]).first()["f"] == pytest.approx(between / inside)
