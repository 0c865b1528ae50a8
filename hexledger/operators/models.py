"""Training, tuning, scoring and storing of models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexledger.functions import values
from hexledger.operators import metrics, search
from hexledger.operators.features import CLASSIFICATION_FEATURES, feature_names
from hexledger.operators.forest import TableForestClassifier
from hexledger.operators.indexers import TableIndexer
from hexledger.operators.logistic import BlockLogisticRegression
from hexledger.operators.perceptron import BlockPerceptronClassifier
from hexledger.session import materialize, scratch_path

SEED = 42
FOLDS = 3

# The published settings of each regression model.
REGRESSION_SETTINGS = {
    "linear": {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.5, "solver": "normal"},
    "decision_tree": {"maxDepth": 2, "minInstancesPerNode": 3, "minInfoGain": 0.0},
    "random_forest": {
        "numTrees": 20,
        "maxDepth": 5,
        "minInstancesPerNode": 10,
        "minInfoGain": 0.0,
        "subsamplingRate": 1.0,
    },
    "gbt": {"maxIter": 20, "maxDepth": 5, "minInstancesPerNode": 10, "subsamplingRate": 1.0},
}
# The published search grids.
GRIDS = {
    "linear": {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]},
    "gbt": {"maxDepth": [3, 5], "maxIter": [50, 100], "stepSize": [0.05, 0.1]},
    "logistic": {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
    "rf_classifier": {"numTrees": [20, 50], "maxDepth": [5, 10]},
}

_REGRESSORS = {
    "linear": LinearRegression,
    "decision_tree": DecisionTreeRegressor,
    "random_forest": RandomForestRegressor,
    "gbt": GBTRegressor,
}


def regressor(kind: str, label: str, prediction: str = "prediction", **settings) -> Estimator:
    """A regression estimator with the published settings, overridden by `settings`."""
    chosen = {**REGRESSION_SETTINGS[kind], **settings}
    estimator = _REGRESSORS[kind](featuresCol="features", labelCol=label, predictionCol=prediction, **chosen)
    return estimator if kind == "linear" else estimator.setSeed(SEED)


def param_grid(estimator: Estimator, grid: dict[str, list]) -> list:
    """All combinations, bound to the parameters of this very estimator."""
    builder = ParamGridBuilder()
    for name, choices in grid.items():
        builder = builder.addGrid(estimator.getParam(name), choices)
    return builder.build()


def with_folds(df: DataFrame, keys: list[str], folds: int = FOLDS) -> DataFrame:
    """A fold number from the md5 of the key, so that folds do not depend on partitioning."""
    return df.withColumn("fold", (values.key_share(F.lit("fold"), *[F.col(k) for k in keys]) % folds).cast("int"))


def cross_validate(
    estimator: Estimator,
    grid: list,
    evaluator: Evaluator,
    train: DataFrame,
    folds: int = FOLDS,
    parallelism: int = 1,
) -> CrossValidatorModel:
    """k-fold grid search by Spark's validator; a `fold` column of `train` decides the folds if there is one.

    One grid point at a time by default: the validator's threads share one set of local properties, and
    now and then one of them fails for it. `search` has parallel fits and can be resumed.
    """
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        numFolds=folds,
        seed=SEED,
        parallelism=parallelism,
    )
    if "fold" in train.columns:
        validator = validator.setFoldCol("fold")
    return validator.fit(train)


def search_report(model: CrossValidatorModel, grid: list, spark: SparkSession) -> DataFrame:
    """One row per grid point: its settings and its mean metric over the folds."""
    rows = [
        (
            ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda e: e[0].name)),
            float(metric),
        )
        for point, metric in zip(grid, model.avgMetrics)
    ]
    return spark.createDataFrame(rows, "settings string, avg_metric double")


def gbt_prefix(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The first `rounds` trees of a boosted model: what a fit of so many rounds would have given."""
    sc = SparkContext._active_spark_context
    kind = sc._jvm.org.apache.spark.ml.regression
    trees, weights = list(model._java_obj.trees())[:rounds], list(model.treeWeights)[:rounds]
    held = sc._gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
    weighed = sc._gateway.new_array(sc._gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        held[i], weighed[i] = tree, weight
    short = GBTRegressionModel(kind.GBTRegressionModel(f"{model.uid}_{rounds}", held, weighed))
    return short.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def measure_regression(
    kind: str, coord: str, settings: dict, points: list[search.Point], train: DataFrame, test: DataFrame
) -> list[float]:
    """The root mean squared error of each point; shorter boosted fits are the first trees of the longest."""
    model = regressor(kind, coord, "predicted", **{**settings, **points[-1]}).fit(train)
    evaluator = RegressionEvaluator(labelCol=coord, predictionCol="predicted", metricName="rmse")
    fits = [gbt_prefix(model, p["maxIter"]) for p in points[:-1]] + [model]
    return [evaluator.evaluate(fit.transform(test)) for fit in fits]


def regression_search(
    train: DataFrame, kind: str, grid: dict[str, list], path: str, **settings
) -> tuple[DataFrame, dict[str, search.Point]]:
    """All grid points on all folds for both coordinates, side by side, and the best point of each."""
    points = search.grid_points(grid)
    groups = search.by_prefix(points) if kind == "gbt" and "maxIter" in grid else search.one_each(points)
    units = [
        search.Unit(coord, tuple(g), partial(measure_regression, kind, coord, settings))
        for coord in ("lon", "lat")
        for g in groups
    ]
    results = search.search(train, units, path, rows_per_task=search.LIGHT_ROWS)
    return results, search.best_points(results, units, larger_is_better=False)


@dataclass(frozen=True)
class CoordinateModels:
    """The two fitted models of a kind, their scored test rows and their test metrics."""

    kind: str
    lon: Model
    lat: Model
    scored: DataFrame
    metrics: DataFrame


def train_coordinates(
    train: DataFrame,
    test: DataFrame,
    kind: str,
    folds: int | None = FOLDS,
    grid: dict[str, list] | None = None,
    search_path: str | None = None,
    **settings,
) -> CoordinateModels:
    """Fit longitude and latitude, each with its own estimator, grid and evaluator.

    Every grid point is measured on all folds first (`regression_search`); `folds=None` skips that and takes
    the settings as they are. Both models score one frame, so no join pairs their predictions. The metrics
    carry the error of the constant predictor next to the model's.
    """
    chosen: dict[str, dict] = {"lon": {}, "lat": {}}
    if folds is not None:
        if "fold" not in train.columns:
            train = with_folds(train, [c for c in train.columns if c in ("customer_id", "h3_09")], folds)
        path = search_path or scratch_path(train.sparkSession, f"search-{kind}")
        chosen = regression_search(train, kind, grid or {}, path, **settings)[1]

    def fit(coord: str) -> Model:
        return regressor(kind, coord, f"predicted_{coord}", **{**settings, **chosen[coord]}).fit(whole)

    whole = search.sized(train, search.LIGHT_ROWS)
    coords = ("lon", "lat")
    fitted = dict(zip(coords, search.in_threads(train.sparkSession, [partial(fit, c) for c in coords]), strict=True))
    scored = fitted["lat"].transform(fitted["lon"].transform(test))
    return CoordinateModels(kind, fitted["lon"], fitted["lat"], scored, coordinate_metrics(train, scored, kind))


def coordinate_metrics(train: DataFrame, scored: DataFrame, kind: str) -> DataFrame:
    """(model, coord, mae, rmse, baseline_mae): the baseline predicts the mean of the training rows."""
    mean = train.agg(F.struct(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"))).scalar()
    with_mean = scored.select(
        "lon", "lat", "predicted_lon", "predicted_lat", mean["lon"].alias("mean_lon"), mean["lat"].alias("mean_lat")
    )

    def error(coord: str, against: str):
        return F.col(against) - F.col(coord)

    measured = with_mean.agg(
        F.array(
            *[
                F.struct(
                    F.lit(kind).alias("model"),
                    F.lit(c).alias("coord"),
                    F.avg(F.abs(error(c, f"predicted_{c}"))).alias("mae"),
                    F.sqrt(F.avg(error(c, f"predicted_{c}") * error(c, f"predicted_{c}"))).alias("rmse"),
                    F.avg(F.abs(error(c, f"mean_{c}"))).alias("baseline_mae"),
                )
                for c in ("lon", "lat")
            ]
        ).alias("m")
    )
    return measured.select(F.inline("m"))


def classifier_stages(mcc: str = "mcc_code", label: str = "h3_09", tags: str | None = "tags_key") -> list:
    """Indexers and assembler in front of a classifier; the label is the cell id."""
    stages = [TableIndexer(inputCol=mcc, outputCol="mcc_index"), TableIndexer(inputCol=label, outputCol="label")]
    columns = [*CLASSIFICATION_FEATURES, "mcc_index"]
    if tags:
        # As a plain number: a tree would need as many bins as there are different tag texts.
        stages.append(TableIndexer(inputCol=tags, outputCol="tags_index"))
        stages.append(SQLTransformer(statement="SELECT *, tags_index + 0 AS tags_number FROM __THIS__"))
        columns.append("tags_number")
    return [*stages, VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip")]


def logistic(**settings) -> BlockLogisticRegression:
    return BlockLogisticRegression(featuresCol="features", labelCol="label", **settings)


def rf_classifier(**settings) -> TableForestClassifier:
    chosen = {"numTrees": 25, "maxDepth": 7, "seed": SEED, **settings}
    return TableForestClassifier(featuresCol="features", labelCol="label", **chosen)


def mlp_pipeline(stages: list, inputs: int, classes: int, hidden: tuple[int, ...] = (64, 32), **settings) -> Pipeline:
    """A feed-forward network trained on the executors, on scaled inputs."""
    network = BlockPerceptronClassifier(
        featuresCol="scaled", labelCol="label", layers=[inputs, *hidden, classes], seed=SEED, **settings
    )
    return Pipeline(stages=[*stages, StandardScaler(inputCol="features", outputCol="scaled", withMean=True), network])


def train_classifier(stages: list, estimator: Estimator, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=[*stages, estimator]).fit(train)


def measure_classifier(
    make: Callable[..., Estimator], points: list[search.Point], train: DataFrame, test: DataFrame
) -> list[float]:
    """The F1 weighted by support of each point, summed on the executors."""
    scored = [make(**p).fit(train).transform(test) for p in points]
    return [metrics.classification_report(df).first()["weighted_f1"] or 0.0 for df in scored]


def classifier_search(
    stages: list, makers: dict[str, Callable[..., Estimator]], grids: dict[str, dict[str, list]], train: DataFrame, path: str
) -> tuple[DataFrame, dict[str, search.Point]]:
    """All grids on all folds by weighted F1, and the best point of each; rows are indexed once per fold."""
    units = [
        search.Unit(name, tuple(g), partial(measure_classifier, make))
        for name, make in makers.items()
        for g in search.one_each(search.grid_points(grids[name]))
    ]

    def indexed(fitted_on: DataFrame, measured_on: DataFrame) -> tuple[DataFrame, DataFrame]:
        before = Pipeline(stages=stages).fit(fitted_on)
        # Written once with its metadata: the fits read the assembled rows, not the joins.
        return tuple(stored_vectors(before.transform(df)) for df in (fitted_on, measured_on))

    results = search.search(train, units, path, indexed)
    return results, search.best_points(results, units, larger_is_better=True)


def stored_vectors(df: DataFrame) -> DataFrame:
    """(label, features), written; column metadata, which says how many classes there are, stays with them."""
    rows = df.select("label", "features")
    about = {f.name: f.metadata for f in rows.schema.fields}
    stored = materialize(rows, "vectors")
    return stored.select(*[F.col(c).alias(c, metadata=about[c]) for c in stored.columns])


def tune_classifiers(
    stages: list,
    makers: dict[str, Callable[..., Estimator]],
    grids: dict[str, dict[str, list]],
    train: DataFrame,
    path: str | None = None,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """The report of the search, and each classifier fitted on all rows with its best point."""
    results, best = classifier_search(
        stages, makers, grids, train, path or scratch_path(train.sparkSession, "search-classifiers")
    )
    before = Pipeline(stages=stages).fit(train)
    vectors = search.sized(stored_vectors(before.transform(train)))
    fits = [partial(lambda make, point: make(**point).fit(vectors), make, best[name]) for name, make in makers.items()]
    fitted = search.in_threads(train.sparkSession, fits)
    whole = {n: PipelineModel(stages=[*before.stages, m]) for n, m in zip(makers, fitted, strict=True)}
    return search.report(results), whole


def model_parameters(model: Model, names: list[str], model_type: str, coord_type: str, spark: SparkSession) -> DataFrame:
    """(feature, kind, value, model_type, coord_type, created_at): coefficients or importances."""
    if hasattr(model, "coefficients"):
        kind, weights = "coefficient", model.coefficients.toArray()
    else:
        kind, weights = "importance", model.featureImportances.toArray()
    rows = [(n, kind, float(w), model_type, coord_type) for n, w in zip(names, weights, strict=True)]
    frame = spark.createDataFrame(rows, "feature string, kind string, value double, model_type string, coord_type string")
    return frame.withColumn("created_at", F.current_timestamp())


def coordinate_parameters(models: CoordinateModels, spark: SparkSession) -> DataFrame:
    names = feature_names(models.scored)
    lon = model_parameters(models.lon, names, models.kind, "lon", spark)
    return lon.unionByName(model_parameters(models.lat, names, models.kind, "lat", spark))


def save_model_params(params: DataFrame, path: str) -> None:
    """One partition per (model_type, coord_type): a run replaces its own rows and no others."""
    (
        params.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_type", "coord_type")
        .parquet(path)
    )


def metrics_record(models: CoordinateModels, settings: dict, spark: SparkSession) -> DataFrame:
    """One row: both errors and the settings as a nested record."""
    mae = {r["coord"]: r["mae"] for r in models.metrics.collect()}
    params = {k: str(v) for k, v in settings.items()}
    row = [(models.kind, mae["lon"], mae["lat"], params)]
    schema = "model string, longitude_mae double, latitude_mae double, model_params map<string,string>"
    return spark.createDataFrame(row, schema).withColumn("created_at", F.current_timestamp())


def save_metrics(record: DataFrame, path: str) -> None:
    record.coalesce(1).write.mode("append").json(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_comparison(scores: dict[str, float], spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(scores.items()), "model string, accuracy double")


def accuracy(scored: DataFrame) -> float:
    """Share of right predictions, summed on the executors; 0 for no rows."""
    return metrics.classification_report(scored).first()["accuracy"] or 0.0


def batch_score(
    df: DataFrame,
    columns: list[str],
    predict: Callable[[np.ndarray], np.ndarray],
    out: str = "prediction",
) -> DataFrame:
    """Score with any model outside Spark ML: `predict` gets a (rows, columns) array per Arrow batch."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.asarray(predict(batch.to_numpy(dtype="float64")), dtype="float64"))

    return df.withColumn(out, scored(F.struct(*[F.col(c).cast("double").alias(c) for c in columns])))


