"""The five published reports and their export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexledger.functions import tags
from hexledger.operators import aggregates
from hexledger.sources.writers import export_report

# How many rows each published report shows.
PREVIEW_ROWS = 50
TOP_LABELS = 20
TOP_CELLS = 10


def named_places(poi: DataFrame) -> DataFrame:
    """Places whose only tag is a name (the published rule), one row per name found."""
    return poi.select(
        "id",
        "h3_09",
        "h3_09_center",
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        F.explode(tags.literal_names(F.col("tags"))).alias("place_name"),
    )


def run_reports(
    tx: DataFrame, withdrawals: DataFrame, locations: DataFrame, poi: DataFrame, target: str
) -> dict[str, str]:
    """Write all reports as CSV below `target`; returns the path of each."""
    places = named_places(poi)
    rate, totals = aggregates.withdraw_rate(tx, withdrawals), aggregates.overall_totals(tx)
    reports = {
        "places": (places.drop("id"), [F.asc("h3_09_center"), F.asc("place_name"), F.asc("lat")], PREVIEW_ROWS),
        "word_frequency": (
            aggregates.word_frequency(places, tx),
            [F.desc("size_metric"), F.asc("text_label")],
            TOP_LABELS,
        ),
        "withdraw_rate": (rate, [F.asc("total_tx")], 1),
        "overall_totals": (totals, [F.asc("total_transactions")], 1),
        "cell_totals": (aggregates.cell_totals(tx, locations), [F.desc("total_sum"), F.asc("h3_09")], TOP_CELLS),
    }
    paths = {}
    for name, (df, order, limit) in reports.items():
        paths[name] = f"{target}/{name}"
        export_report(df, paths[name], order, limit)
    return paths
