"""Model metrics as aggregates over (label, prediction) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    error = F.col(prediction) - F.col(label)
    return df.agg(F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def class_scores(pairs: DataFrame) -> DataFrame:
    """Support, precision, recall and F1 of every class that occurs as a label; 0 where undefined."""
    per_class = (
        pairs.select(
            F.explode(
                F.array(
                    F.struct(
                        F.col("label").alias("class"),
                        F.col("n").alias("support"),
                        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"),
                        F.lit(0).cast("long").alias("predicted"),
                    ),
                    F.struct(
                        F.col("prediction").alias("class"),
                        F.lit(0).cast("long").alias("support"),
                        F.lit(0).cast("long").alias("tp"),
                        F.col("n").alias("predicted"),
                    ),
                )
            ).alias("part")
        )
        .groupBy(F.col("part.class").alias("class"))
        .agg(
            F.sum("part.support").alias("support"),
            F.sum("part.tp").alias("tp"),
            F.sum("part.predicted").alias("predicted"),
        )
        .filter("support > 0")
    )
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.col("tp") / F.col("support")
    scored = per_class.withColumn("precision", precision).withColumn("recall", recall)
    total = F.col("precision") + F.col("recall")
    f1 = F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total).otherwise(0.0)
    return scored.withColumn("f1", f1)


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, macro F1 over the classes present as labels, and F1 weighted by support."""
    scores = class_scores(confusion(df, label, prediction))
    return scores.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )
