"""Feature tables and feature stages."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    HashingTF,
    StandardScaler,
    Tokenizer,
    VectorAssembler,
    VectorSizeHint,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexledger.operators import aggregates, joins, rows
from hexledger.schemas import NUMERIC_FEATURES

# Fixed values of the published models.
TAG_BUCKETS = 25
UNKNOWN_TAGS = "Unknown"
UNKNOWN_TAGS_CLASSIFICATION = "Не известно"
CLASSIFICATION_FEATURES = ["datetime_id", "count", "sum", "avg", "min", "max", "std", "count_distinct"]


def tokenize(df: DataFrame, text: str, out: str = "tags_tokens") -> DataFrame:
    return Tokenizer(inputCol=text, outputCol=out).transform(df)


def hashing_tf(df: DataFrame, tokens: str, out: str = "tags_features", buckets: int = TAG_BUCKETS) -> DataFrame:
    return HashingTF(inputCol=tokens, outputCol=out, numFeatures=buckets).transform(df)


def cell_tag_vectors(places: DataFrame, buckets: int = TAG_BUCKETS) -> DataFrame:
    """(h3_09, tags_features): hashed term counts of all place names of a cell.

    Term counts add up, so each distinct name is hashed and the vectors are summed per cell; the
    joined text of a cell is never built.
    """
    names = places.filter("place_name IS NOT NULL").select(F.col("h3_09_center").alias("h3_09"), "place_name")
    hashed = hashing_tf(tokenize(names, "place_name"), "tags_tokens", buckets=buckets)
    return hashed.groupBy("h3_09").agg(Summarizer.sum(F.col("tags_features")).alias("tags_features"))


def with_tag_vectors(df: DataFrame, vectors: DataFrame, buckets: int = TAG_BUCKETS) -> DataFrame:
    """Attach the tag vectors; cells without places get the vector of the unknown label."""
    slot = HashingTF(inputCol="t", outputCol="v", numFeatures=buckets).indexOf(UNKNOWN_TAGS.lower())
    unknown = array_to_vector(F.array(*[F.lit(1.0 if i == slot else 0.0) for i in range(buckets)]))
    attached = joins.attach(df, vectors, "h3_09")
    return attached.withColumn("tags_features", F.coalesce("tags_features", unknown))


def training_rows(withdrawals: DataFrame, tx: DataFrame, locations: DataFrame) -> DataFrame:
    """Withdrawal pairs with customer, customer-cell and cell columns; missing numbers are 0.

    Only features are filled: a pair whose cell has no coordinates has no label and is left out.
    """
    customers = aggregates.customer_stats(tx).drop("distinct_mcc_count")
    visits = aggregates.customer_cell_stats(tx)
    data = joins.attach(withdrawals, customers, "customer_id")
    data = joins.attach(data, visits, ["customer_id", "h3_09"])
    data = joins.attach(data, locations.select("h3_09", "lat", "lon"), "h3_09")
    return rows.fill_null_numbers(rows.drop_null_rows(data, ["lat", "lon"]), NUMERIC_FEATURES)


def with_tag_key(df: DataFrame, places: DataFrame, label: str) -> DataFrame:
    """Attach the tag key of the cell, `label` where it has no names: exactly one row per row of `df`."""
    return rows.default_label(joins.attach(df, aggregates.cell_tag_keys(places), "h3_09"), "tags_key", label)


def training_set(withdrawals: DataFrame, tx: DataFrame, locations: DataFrame, places: DataFrame) -> DataFrame:
    """`training_rows` with the tag key of the cell, `Unknown` where there is none."""
    return with_tag_key(training_rows(withdrawals, tx, locations), places, UNKNOWN_TAGS)


def training_vectors(withdrawals: DataFrame, tx: DataFrame, locations: DataFrame, places: DataFrame) -> DataFrame:
    """`training_rows` with the hashed tags of the cell: the input of the regression models."""
    return with_tag_vectors(training_rows(withdrawals, tx, locations), cell_tag_vectors(places))


def classification_rows(withdrawals: DataFrame, tx: DataFrame, locations: DataFrame) -> DataFrame:
    """Transactions at withdrawal pairs with known cells; missing deviations are 0."""
    data = joins.matched(tx, (withdrawals, ["h3_09", "customer_id"]), (locations.select("h3_09"), "h3_09"))
    return rows.drop_null_rows(data.na.fill(0, subset=["std"]), CLASSIFICATION_FEATURES)


def classification_set(
    withdrawals: DataFrame, tx: DataFrame, locations: DataFrame, places: DataFrame
) -> DataFrame:
    """`classification_rows` with the tag key of the cell: the input of the classifiers.

    The classifiers only index the texts as categories, for which equal keys serve as well.
    """
    return with_tag_key(classification_rows(withdrawals, tx, locations), places, UNKNOWN_TAGS_CLASSIFICATION)


def string_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """(column, out): the index of every different value by descending frequency, ties alphabetical.

    Ranked by a distributed sort, so the values stay off the driver however many there are. Nulls have none.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg((-F.count("*")).alias("_less"))
    return rows.surrogate_key(counts, ["_less", column], out).select(column, F.col(out).cast("double").alias(out))


def index_to_string(df: DataFrame, column: str, out: str, labels: DataFrame) -> DataFrame:
    """The value of each index; `labels` (value, column) is the result of `string_index`."""
    (value,) = [c for c in labels.columns if c != column]
    return joins.attach(df, labels.withColumnRenamed(value, out), column)


def scaled_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns divided by their sample deviation, not centred, as plain columns (0 for a constant)."""
    scales = df.agg(F.struct(*[F.stddev_samp(c).alias(c) for c in columns]).alias("s"))
    scale = scales.scalar()
    return df.withColumns(
        {
            f"{c}_scaled": F.when(scale[c] > 0, F.col(c) / scale[c]).otherwise(F.lit(0.0))
            for c in columns
        }
    )


def assemble(df: DataFrame, columns: list[str], out: str = "features", invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid=invalid).transform(df)


def feature_pipeline(tag_text: str | None = None, buckets: int = TAG_BUCKETS) -> Pipeline:
    """Hashed tags followed by the scaled numeric columns, as `features`.

    With `tag_text` the tags are hashed from that column, otherwise `tags_features` is given.
    """
    if tag_text:
        tags = [
            Tokenizer(inputCol=tag_text, outputCol="tags_tokens"),
            HashingTF(inputCol="tags_tokens", outputCol="tags_features", numFeatures=buckets),
        ]
    else:
        tags = [VectorSizeHint(inputCol="tags_features", size=buckets)]
    return Pipeline(
        stages=[
            *tags,
            VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="numeric_features"),
            StandardScaler(inputCol="numeric_features", outputCol="scaled_features"),
            VectorAssembler(inputCols=["tags_features", "scaled_features"], outputCol="features"),
        ]
    )


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector slots, taken from the assembled column itself."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for g in groups for a in g), key=lambda a: a["idx"])

    def readable(name: str) -> str:
        if name.startswith("scaled_features_"):
            return NUMERIC_FEATURES[int(name.rsplit("_", 1)[1])]
        return name.replace("tags_features_", "tag_feature_")

    return [readable(a["name"]) for a in slots]
