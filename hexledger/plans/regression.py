"""Prediction of a withdrawal cell's longitude and latitude."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession

from hexledger.operators import features, models, rows
from hexledger.session import materialize
from hexledger.sources import writers
from hexledger.sources.prepared import load_or_build

KEYS = ["customer_id", "h3_09"]
PREDICTION_COLUMNS = [
    *KEYS,
    "lon",
    "predicted_lon",
    *features.NUMERIC_FEATURES,
    "lat",
    "predicted_lat",
]


def prepared_split(
    tx: DataFrame,
    withdrawals: DataFrame,
    locations: DataFrame,
    places: DataFrame,
    path: str | None = None,
    force: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) feature rows, 80 to 20 by key, with the folds of the training rows.

    The joined rows are written once, because every later step reads them many times; with `path` they are
    stored there, and a later call reads them unless `force` is set. The feature stages are fitted once, on
    the training rows only.
    """

    def build() -> tuple[DataFrame, DataFrame]:
        data = features.training_vectors(withdrawals, rows.amount_cap(tx), locations, places)
        plain = data.withColumn("tags_features", vector_to_array("tags_features"))
        return rows.key_split(materialize(models.with_folds(plain, KEYS), "training"), KEYS)

    pair = load_or_build(tx.sparkSession, path, build, force=force) if path else build()
    train, test = (df.withColumn("tags_features", array_to_vector("tags_features")) for df in pair)
    stages = features.feature_pipeline().fit(train)
    return stages.transform(train), stages.transform(test)


def run(
    spark: SparkSession, train: DataFrame, test: DataFrame, kind: str, target: str, **settings
) -> models.CoordinateModels:
    """Train one kind of model with cross-validation and store models, metrics, parameters and predictions."""
    fitted = models.train_coordinates(train, test, kind, **settings)
    chosen = {**models.REGRESSION_SETTINGS[kind], **settings, "num_folds": models.FOLDS}
    models.save_model(fitted.lon, f"{target}/models/{kind}_lon")
    models.save_model(fitted.lat, f"{target}/models/{kind}_lat")
    models.save_metrics(models.metrics_record(fitted, chosen, spark), f"{target}/metrics")
    models.save_model_params(models.coordinate_parameters(fitted, spark), f"{target}/model_params")
    predictions = fitted.scored.select(*PREDICTION_COLUMNS).withColumnsRenamed({"lon": "true_lon", "lat": "true_lat"})
    writers.write_predictions(predictions, f"{target}/predictions/{kind}")
    return fitted
