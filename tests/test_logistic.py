"""The logistic regression by blocks against Spark's own."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from hexledger.operators import logistic, models


def rows(spark, classes=5, n=400):
    dice = np.random.default_rng(3)
    centres = dice.normal(size=(classes, 3))
    made = []
    for _ in range(n):
        k = int(dice.integers(0, classes))
        made.append((float(k), Vectors.dense([*(centres[k] + dice.normal(size=3)) * [1, 50, 0.01] + [0, 900, 3], 7.0])))
    return spark.createDataFrame(made, ["label", "features"])


@pytest.mark.parametrize("settings", [{}, {"regParam": 0.1}, {"regParam": 0.02, "elasticNetParam": 0.5}, {"maxIter": 3}])
def test_weights_are_those_of_sparks_fit(spark, settings):
    data = rows(spark)
    own, theirs = (kind(**settings).fit(data) for kind in (logistic.BlockLogisticRegression, LogisticRegression))
    scale = np.array([1, 50, 0.01, 1])
    assert np.allclose(own.coefficientMatrix.toArray() * scale, theirs.coefficientMatrix.toArray() * scale, atol=2e-3)
    assert np.allclose(own.interceptVector.toArray(), theirs.interceptVector.toArray(), rtol=2e-3, atol=2e-2)
    assert own.numClasses == theirs.numClasses == 5
    pairs = zip(own.transform(data).collect(), theirs.transform(data).collect(), strict=True)
    assert sum(a.prediction == b.prediction for a, b in pairs) >= 398


def test_many_classes_are_not_added_up_by_sparks_trainer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(LogisticRegression, "_fit", lambda *_: pytest.fail("Spark's trainer was called"))
    data = rows(spark)
    model = models.logistic(regParam=1e6, elasticNetParam=1.0).fit(data)
    assert not model.coefficientMatrix.toArray().any()
    counts = dict(data.groupBy("label").count().collect())
    odds = np.exp(model.interceptVector.toArray())
    assert np.allclose(odds / odds.sum(), [counts[float(k)] / 400 for k in range(5)], atol=2e-3)
    model.write().overwrite().save(str(tmp_path / "m"))
    assert type(model).load(str(tmp_path / "m")).interceptVector == model.interceptVector


def test_two_classes_are_left_to_spark(spark):
    data = rows(spark, classes=2)
    assert models.logistic().fit(data).coefficients == LogisticRegression().fit(data).coefficients


def test_bad_labels_are_named(spark):
    bad = spark.createDataFrame([(0.5, Vectors.dense([1.0])), (1.0, Vectors.dense([2.0])), (3.0, Vectors.dense([2.0]))], ["label", "features"])
    with pytest.raises(Exception, match="(?i)label"):
        models.logistic().fit(bad)
