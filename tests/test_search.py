"""Searches that go on after a stop, boosted fits measured by their first trees, and indexes that are tables."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from hexledger.operators import indexers, models, search


@pytest.fixture(scope="module")
def rows(spark):
    made = [
        (k, Vectors.dense([k % 7, (k * 37) % 11]), float(k % 7 + ((k * 37) % 11) ** 2), float(k % 3), k % 3)
        for k in range(240)
    ]
    return spark.createDataFrame(made, ["id", "features", "lon", "lat", "fold"]).cache()


def test_prefix_is_the_separate_short_fit(spark, rows):
    long = models.regressor("gbt", "lon", "predicted", maxIter=12, maxDepth=3).fit(rows)
    for rounds in (1, 5):
        short = models.regressor("gbt", "lon", "predicted", maxIter=rounds, maxDepth=3).fit(rows)
        both = short.transform(rows).withColumnRenamed("predicted", "own")
        both = models.gbt_prefix(long, rounds).transform(both)
        assert both.where("predicted <> own").count() == 0
        assert both.where("predicted = own").count() == 240


def test_points_and_groups():
    points = search.grid_points(models.GRIDS["gbt"])
    groups = search.by_prefix(points)
    assert len(points) == 8 and len(groups) == 4
    assert all([p["maxIter"] for p in g] == [50, 100] for g in groups)
    assert search.grid_points({}) == [{}] and search.named({"b": 1, "a": 0.5}) == "a=0.5, b=1"


def test_search_measures_what_the_validator_measures(spark, rows, tmp_path):
    grid = {"maxDepth": [2, 3], "maxIter": [2, 4]}
    results, best = models.regression_search(rows, "gbt", grid, str(tmp_path / "s"), minInstancesPerNode=1)
    got = {(r.target, r.settings): r.avg_metric for r in search.report(results).collect()}
    for coord in ("lon", "lat"):
        estimator = models.regressor("gbt", coord, minInstancesPerNode=1)
        points = models.param_grid(estimator, grid)
        evaluator = RegressionEvaluator(labelCol=coord, predictionCol="prediction", metricName="rmse")
        tuned = models.cross_validate(estimator, points, evaluator, rows)
        want = {r.settings: r.avg_metric for r in models.search_report(tuned, points, spark).collect()}
        assert {s: m for (c, s), m in got.items() if c == coord} == pytest.approx(want, abs=1e-9)
        assert want[search.named(best[coord])] == min(want.values())


def test_a_stopped_search_goes_on_where_it_was(spark, rows, tmp_path):
    path, calls = str(tmp_path / "s"), []

    def measure(points, train, test):
        calls.append((points[0]["x"], test.first()["fold"]))
        if stop and points[0]["x"] == 3:
            raise RuntimeError("stopped")
        assert train.where(F.col("fold") == test.first()["fold"]).count() == 0
        return [p["x"] * 10.0 for p in points]

    units = [search.Unit("t", ({"x": x},), measure) for x in (1, 3)] + [
        search.Unit("u", ({"x": 5}, {"x": 4}), measure)
    ]
    stop = True
    with pytest.raises(RuntimeError, match="stopped"):
        search.search(rows, units, path)
    assert len(calls) == 9 and search.stored_results(spark, path).count() == 3 * 3
    stop, calls[:] = False, []
    results = search.search(rows, units, path)
    assert sorted(calls) == [(3, 0), (3, 1), (3, 2)]
    assert {(r.target, r.settings, r.folds, r.avg_metric) for r in search.report(results).collect()} == {
        ("t", "x=1", 3, 10.0),
        ("t", "x=3", 3, 30.0),
        ("u", "x=4", 3, 40.0),
        ("u", "x=5", 3, 50.0),
    }
    assert search.best_points(results, units, larger_is_better=False) == {"t": {"x": 1}, "u": {"x": 4}}
    assert search.best_points(results, units, larger_is_better=True) == {"t": {"x": 3}, "u": {"x": 5}}
    calls[:] = []
    search.search(rows, units, path)
    assert not calls


def test_parallel_fits_do_not_disturb_each_other(spark):
    def task(n):
        return lambda: spark.range(n).groupBy(F.col("id") % 5).count().count()

    assert search.in_threads(spark, [task(n) for n in range(1, 41)], 8) == [min(n, 5) for n in range(1, 41)]


@pytest.fixture(scope="module")
def words(spark):
    made = [(k, w) for k, w in enumerate(["b", "a", "b", None, "c", "a", "b", "", "d"])]
    return spark.createDataFrame(made, "k int, word string")


def test_table_index_is_that_of_the_string_indexer(spark, words, monkeypatch):
    known = words.where("word IS NOT NULL AND word <> 'd'")
    want = StringIndexer(inputCol="word", outputCol="i", handleInvalid="keep").fit(known).transform(words)
    want = {r.k: r.i for r in want.collect()}
    for bound in (100, 0):  # broadcast, and joined by shuffling
        monkeypatch.setattr(indexers, "BROADCAST_ROWS", bound)
        model = indexers.TableIndexer(inputCol="word", outputCol="i").fit(known)
        got = model.transform(words)
        assert {r.k: r.i for r in got.collect()} == want
        assert got.columns == ["k", "word", "i"]
        # The number of indexes is known, the values are not listed.
        assert got.schema["i"].metadata == {"ml_attr": {"type": "nominal", "name": "i", "num_vals": 5}}
        named = {r.k: r.w for r in model.decode(got, "i", "w").collect()}
        assert named == {r.k: r.word if r.word not in (None, "d") else None for r in words.collect()}
    assert model.transform(words.limit(0)).count() == 0
    assert indexers.TableIndexer(inputCol="word", outputCol="i").fit(words.limit(0)).transform(words).first().i == 0


def test_table_index_is_stored_with_its_pipeline(spark, words, tmp_path):
    stages = [indexers.TableIndexer(inputCol="word", outputCol="i"), indexers.TableIndexer(inputCol="k", outputCol="j")]
    fitted = Pipeline(stages=stages).fit(words)
    path = str(tmp_path / "model")
    fitted.write().overwrite().save(path)
    fitted.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(words)
    assert again.schema == fitted.transform(words).schema
    assert sorted(again.collect(), key=str) == sorted(fitted.transform(words).collect(), key=str)


def test_more_classes_than_an_array_of_labels_would_tell(spark):
    """Classifiers take the number of classes from the column's metadata, beyond what they would count themselves."""
    made = spark.range(600).select(
        (F.col("id") % 150).cast("string").alias("cell"), (F.col("id") % 150).cast("double").alias("x")
    )
    indexed = indexers.TableIndexer(inputCol="cell", outputCol="label").fit(made).transform(made)
    vectors = models.stored_vectors(indexed.select("label", F.expr("array(x)").alias("a")).transform(_vector))
    fitted = models.rf_classifier(numTrees=1, maxDepth=2).fit(vectors)
    assert fitted.numClasses == 151


def _vector(df):
    from pyspark.ml.functions import array_to_vector

    return df.select("label", array_to_vector("a").alias("features"))


def test_light_fits_take_more_rows_a_task(spark):
    df = spark.range(0, search.ROWS_PER_TASK * 4, 1, 8)
    assert search.sized(df).rdd.getNumPartitions() == 4
    assert search.sized(df, search.LIGHT_ROWS).rdd.getNumPartitions() == 1
