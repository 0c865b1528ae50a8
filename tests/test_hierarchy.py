"""Cell paths, and the network over them next to a flat one."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hexledger.functions import cells
from hexledger.operators import hierarchy, indexers, search


def cell(base: int, digits: list[int]) -> str:
    n = (1 << 59) | (len(digits) << 52) | (base << 45)
    for r in range(1, 16):
        n |= (digits[r - 1] if r <= len(digits) else 7) << (3 * (15 - r))
    return f"{n:015x}"


def test_paths_lead_back_to_their_cells(spark):
    made = [(cell(b, [(b * k + r) % 7 for r in range(9)]),) for b in (0, 5, 17, 121) for k in range(5)]
    df = spark.createDataFrame([*made, ("8928308280fffff",), ("zz",), (None,), (cell(3, [1, 2]),)], "c string")
    rows = df.select("c", cells.cell_to_path(F.col("c"), 9).alias("p"))
    rows = rows.select("c", "p", cells.path_to_cell(F.col("p"), 9).alias("again"), cells.cell_is_valid(F.col("c")).alias("v"))
    for r in rows.collect():
        if r.c in (None, "zz", cell(3, [1, 2])) or not r.v:
            assert r.p is None and r.again is None
        else:
            assert r.again == r.c and len(r.p) == 12 and all(0 <= d <= 6 for d in r.p)
    finer = df.select(cells.path_to_cell(cells.cell_to_path(F.col("c"), 7), 7).alias("a"), cells.cell_to_parent(F.col("c"), 7).alias("b"))
    assert finer.where("a IS NOT NULL AND a <> b").count() == 0 and finer.where("a IS NOT NULL").count() >= 20


@pytest.fixture(scope="module")
def rows(spark):
    """Nine cells under three parents; the features say which, with some noise."""
    made = [
        (cell(20, [1, 2, 3, 4, 5, 6, 0, k % 3, (k // 3) % 3]), [float(k % 3), float((k // 3) % 3), float(k * 7 % 5) / 10])
        for k in range(270)
    ]
    df = spark.createDataFrame(made, "h3_09 string, f array<double>")
    return df.select("h3_09", array_to_vector("f").alias("features")).cache()


def test_as_right_as_a_flat_network(spark, rows):
    fitted = hierarchy.fit_cell_network(rows, hidden=(8,), passes=60)
    assert sorted(fitted.levels) == [10, 11] and fitted.widest_output == 7 and len(fitted.constant) == 10
    scored = fitted.transform(rows.withColumn("predicted_cell", F.lit("old")))
    assert scored.columns == ["h3_09", "features", "predicted_cell"]
    right = scored.where("h3_09 = predicted_cell").count()
    labelled = indexers.TableIndexer(inputCol="h3_09", outputCol="label").fit(rows).transform(rows)
    flat = MultilayerPerceptronClassifier(layers=[3, 8, 10], maxIter=60, seed=42).fit(search.sized(labelled))
    assert right >= flat.transform(labelled).where("label = prediction").count() - 5
    assert right > 250


def test_network_of_odd_rows(spark, rows):
    assert hierarchy.fit_cell_network(rows.withColumn("h3_09", F.lit("zz"))) is None
    one = rows.where(F.col("h3_09") == rows.first().h3_09)
    fitted = hierarchy.fit_cell_network(one.unionByName(rows.limit(3).withColumn("h3_09", F.lit(None).cast("string"))))
    assert not fitted.levels and fitted.widest_output == 0
    assert {r.predicted_cell for r in fitted.transform(rows).collect()} == {one.first().h3_09}
