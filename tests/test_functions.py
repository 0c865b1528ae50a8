from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from hexledger.functions import cells, geo, tags, values

TAG_CASES = [
    (1, "[('name', 'Bank')]"),
    (2, "[('name', 'Bank'), ('amenity', 'atm')]"),
    (3, "[('amenity', 'atm'), ('name', 'Bank')]"),
    (4, "[('highway', 'x')]"),
    (5, "[('name', \"O'Neil\")]"),
    (6, None),
    (7, "[('name', '   ')]"),
    (8, "[('name', 'A, (B)'), ('x', 'it\\'s \"so\"')]"),
    (9, "[('name', 'first'), ('name', 'second')]"),
    (10, "[]"),
]


@pytest.fixture(scope="module")
def tagged(spark):
    return spark.createDataFrame(TAG_CASES, "id int, tags string")


def test_literal_name_needs_a_single_tag(tagged):
    names = tagged.select("id", F.explode(tags.literal_names(F.col("tags"))).alias("n")).collect()
    assert [(r["id"], r["n"]) for r in names] == [(1, "bank")]


def test_tag_value_finds_any_name(tagged):
    found = {r["id"]: r["v"] for r in tagged.select("id", tags.tag_value(F.col("tags"), "name").alias("v")).collect()}
    assert found == {
        1: "bank", 2: "bank", 3: "bank", 4: None, 5: "o'neil", 6: None, 7: None, 8: "a, (b)", 9: "first", 10: None,
    }


def test_tag_map_unescapes_and_keeps_the_first_of_equal_keys(tagged):
    maps = {r["id"]: r["m"] for r in tagged.select("id", tags.tag_map(F.col("tags")).alias("m")).collect()}
    assert maps[8] == {"name": "A, (B)", "x": "it's \"so\""}
    assert maps[9] == {"name": "first"}
    assert maps[10] == {} and maps[6] is None


# Ids of real cells with their published ancestors.
REAL_CELL, REAL_PARENT = "8911aa7abd3ffff", "8811aa7abdfffff"


def _cells(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "cell string")
    c = F.col("cell")
    return df.select(
        "cell",
        cells.cell_is_valid(c).alias("valid"),
        cells.cell_resolution(c).alias("resolution"),
        cells.cell_to_parent(c, 8).alias("p8"),
        cells.cell_to_parent(c, 9).alias("p9"),
        cells.cell_to_parent(c, 10).alias("p10"),
    )


def test_real_cell(spark):
    row = _cells(spark, [REAL_CELL]).first()
    assert (row["valid"], row["resolution"], row["p8"], row["p9"], row["p10"]) == (
        True, 9, REAL_PARENT, REAL_CELL, None,
    )


def test_invalid_cells(spark):
    n = int(REAL_CELL, 16)
    bad = {
        "wrong mode": f"{n | (2 << 59):x}",
        "reserved bits": f"{n | (1 << 56):x}",
        "base cell 122": f"{(n & ~(127 << 45)) | (122 << 45):x}",
        "digit 7 inside": f"{n | (7 << 21):x}",
        "trailing digit not 7": f"{n & ~1:x}",
        "not hexadecimal": "xyz",
        "empty": "",
        "too long": "8911aa7abd3ffff0ff",
        # A pentagon (base cell 4) whose first turn is direction 1.
        "pentagon gap": f"{(1 << 59) | (1 << 52) | (4 << 45) | (1 << 42) | ((1 << 42) - 1):x}",
    }
    rows = {r["cell"]: r["valid"] for r in _cells(spark, [*bad.values(), None]).collect()}
    assert not any(rows.values())
    assert all(v is not None for v in rows.values())


def test_pentagon_with_other_direction_is_valid(spark):
    cell = f"{(1 << 59) | (1 << 52) | (4 << 45) | (2 << 42) | ((1 << 42) - 1):x}"
    assert _cells(spark, [cell]).first()["valid"]


def _utm_snyder(lat, lon, central):
    """The classical transverse Mercator power series, an independent derivation."""
    a, f, k0 = geo.WGS84_A, geo.WGS84_F, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, dl = math.radians(lat), math.radians(lon - central)
    n = a / math.sqrt(1 - e2 * math.sin(phi) ** 2)
    t, c, big_a = math.tan(phi) ** 2, ep2 * math.cos(phi) ** 2, dl * math.cos(phi)
    m = a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * phi)
        - (35 * e2**3 / 3072) * math.sin(6 * phi)
    )
    x = k0 * n * (big_a + (1 - t + c) * big_a**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * ep2) * big_a**5 / 120)
    y = k0 * (
        m
        + n
        * math.tan(phi)
        * (big_a**2 / 2 + (5 - t + 9 * c + 4 * c**2) * big_a**4 / 24
           + (61 - 58 * t + t**2 + 600 * c - 330 * ep2) * big_a**6 / 720)
    )
    return x + 500000, y


def test_utm_agrees_with_the_power_series(spark):
    places = [(55.7558, 37.6173), (55.0, 38.9), (56.3, 36.4), (0.0, 39.0), (60.0, 41.0)]
    df = spark.createDataFrame(places, "lat double, lon double")
    x, y = geo.utm(F.col("lat"), F.col("lon"))
    for row, (lat, lon) in zip(df.select(x.alias("x"), y.alias("y")).collect(), places):
        want = _utm_snyder(lat, lon, 39)
        assert row["x"] == pytest.approx(want[0], abs=0.01)
        assert row["y"] == pytest.approx(want[1], abs=0.01)


def test_mercator_and_haversine(spark):
    df = spark.createDataFrame([(0.0, 180.0, 0.0, -180.0), (0.0, 0.0, 0.0, 1.0)], "lat double, lon double, b double, c double")
    rows = df.select(
        geo.mercator_x(F.col("lon")).alias("x"),
        geo.mercator_y(F.col("lat")).alias("y"),
        geo.haversine_m(F.col("lat"), F.col("lon"), F.col("b"), F.col("c")).alias("d"),
    ).collect()
    assert rows[0]["x"] == pytest.approx(20037508.342789244)
    assert rows[0]["y"] == pytest.approx(0.0, abs=1e-6)
    assert rows[0]["d"] == pytest.approx(0.0, abs=1e-6)
    assert rows[1]["d"] == pytest.approx(math.radians(1) * geo.EARTH_RADIUS_M)


def test_default_label(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "t string")
    assert [r[0] for r in df.select(values.default_label(F.col("t"), "Unknown")).collect()] == [
        "Unknown", "Unknown", "x",
    ]


def test_tag_value_reads_the_text_once_for_keys_and_once_for_values(spark):
    rows = [("[('a', 'X'), ('b', ' '), ('a', 'Y')]",), (None,), ("no pairs",)]
    df = spark.createDataFrame(rows, "tags string")
    found = df.select(*[tags.tag_value(F.col("tags"), k).alias(k) for k in "abc"])
    assert [tuple(r) for r in found.collect()] == [("x", None, None), (None, None, None), (None, None, None)]
    plan = df.select(tags.tag_value(F.col("tags"), "a").alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 2
