"""The normal family with a log link on labels of which some are zero or negative."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from firmlens.operators import models


def rows(spark, low: float):
    rng = np.random.default_rng(3)
    x = rng.normal(3.0, 2.0, size=(300, 2))
    y = np.exp(0.3 * x[:, 0] - 0.2 * x[:, 1] + 0.5) + rng.normal(0, 0.3, 300)
    y = np.maximum(y, 0.05)
    y[:5] = low
    return x, y, spark.createDataFrame([(Vectors.dense(*map(float, a)), float(b)) for a, b in zip(x, y, strict=True)], ["features", "label"])


@pytest.mark.parametrize("low", [0.0, -0.4])
def test_labels_that_are_not_positive_are_fitted(spark, low):
    x, y, df = rows(spark, low)
    model = models.tweedie("log", 0.02).fit(df)
    mu = np.exp(x @ model.coefficients + model.intercept)
    # Where reweighted least squares stand still.
    assert abs(((y - mu) * mu).sum()) < 1e-5 * (mu**2).sum()
    for j in range(2):
        assert abs(((y - mu) * mu * x[:, j]).sum() - 0.02 * (mu**2).sum() * model.coefficients[j]) < 1e-5 * (mu**2).sum()
    found = np.array([r[0] for r in model.transform(df).select("prediction").collect()])
    assert np.allclose(found, mu, rtol=1e-9)
    assert 1 - ((y - mu) ** 2).sum() / ((y - y.mean()) ** 2).sum() > 0.7


def test_one_zero_label_hardly_moves_the_fit(spark):
    _, _, df = rows(spark, 0.2)
    whole = models.tweedie("log", 0.02)
    spark_model = whole.fit(df)

    # One label of zero with hardly any pull leaves the coefficients where Spark has them.
    many = df.crossJoin(spark.range(0, 100, 1, 1)).select("features", "label").coalesce(2)
    one = spark.createDataFrame([(Vectors.dense(-9.0, 9.0), 0.0)], df.schema)
    near = whole.fit(many.unionByName(one))
    assert np.allclose(near.coefficients, spark_model.coefficients.toArray(), atol=1e-3)
    assert abs(near.intercept - spark_model.intercept) < 5e-3


def test_no_positive_label_is_refused(spark):
    _, _, df = rows(spark, 0.2)
    with pytest.raises(ValueError):
        models.tweedie("log").fit(df.withColumn("label", -df.label))
