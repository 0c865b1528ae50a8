from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from hexledger import session
from hexledger.sources import catalog, jdbc, prepared, readers, writers


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [(1, "a, \"b\" 'c'", 1.5), (2, None, None), (3, "line\tend", 0.1)], "id long, t string, v double"
    )


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_csv_round_trip_and_header_check(spark, frame, tmp_path):
    path = str(tmp_path / "csv")
    writers.write_csv(frame, path)
    same(readers.read_csv(spark, path, frame.schema), frame)
    renamed = frame.withColumnRenamed("t", "other").schema
    with pytest.raises(Exception, match="(?i)header|CSV"):
        readers.read_csv(spark, path, renamed).collect()


def test_delimited_text_keeps_separators(spark, frame, tmp_path):
    path = str(tmp_path / "text")
    writers.write_delimited(frame, path)
    same(spark.read.schema(frame.schema).option("escape", '"').csv(path), frame)


def test_json_keeps_null_fields(spark, frame, tmp_path):
    path = str(tmp_path / "json")
    writers.write_json_lines(frame, path)
    assert spark.read.text(path).filter(F.col("value").contains('"v":null')).count() == 1
    same(readers.read_json_lines(spark, path, frame.schema), frame)


def test_id_list_trims_and_skips_blank_lines(spark, tmp_path):
    path = tmp_path / "ids.lst"
    path.write_text("  c1 \n\nc2\n   \nc1\n")
    assert sorted(r[0] for r in readers.read_id_list(spark, str(path)).collect()) == ["c1", "c1", "c2"]
    cells = spark.createDataFrame([("c1", 1.0, 2.0)], "h3_09 string, lat double, lon double")
    rows = readers.read_id_list(spark, str(path), cells).collect()
    assert {(r["h3_09"], r["lat"]) for r in rows} == {("c1", 1.0), ("c2", None)}


def test_partitioned_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "parts")
    first = spark.createDataFrame([(1, 0, 5), (2, 1, 5)], "v int, datetime_id int, mcc_code int")
    writers.write_partitioned(first, path, ["datetime_id", "mcc_code"])
    again = spark.createDataFrame([(9, 1, 5)], "v int, datetime_id int, mcc_code int")
    writers.write_partitioned(again, path, ["datetime_id", "mcc_code"])
    stored = spark.read.orc(path)
    assert sorted((r["v"], r["datetime_id"]) for r in stored.collect()) == [(1, 0), (9, 1)]
    pruned = stored.filter("datetime_id = 0")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(datetime_id" in pruned


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") % 7).alias("x"))
    for name in ("bucketed_a", "bucketed_b"):
        writers.write_bucketed(df, name, str(tmp_path / name), "customer_id", buckets=8)
    a, b = spark.table("bucketed_a"), spark.table("bucketed_b")
    assert a.count() == 1000
    joined = a.hint("merge").join(b, "customer_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 1000


def test_storage_trial_reports_failures(spark, frame, tmp_path):
    rows = writers.storage_trial({"t": frame}, str(tmp_path / "trial")).collect()
    assert {(r["codec"], r["status"], r["rows"]) for r in rows} == {
        ("Gzip", "OK", 3), ("Snappy", "OK", 3), ("Bzip2", "FAILED", None),
    }
    assert all(r["size_mb"] > 0 and r["compression_ratio"] > 0 for r in rows if r["status"] == "OK")


def test_report_is_one_ordered_file(spark, tmp_path):
    path = str(tmp_path / "report")
    writers.export_report(spark.range(100), path, [F.desc("id")], 3)
    parts = list((tmp_path / "report").glob("*.csv"))
    assert len(parts) == 1 and parts[0].read_text().split() == ["id", "99", "98", "97"]


def test_load_or_build(spark, tmp_path):
    path = str(tmp_path / "split")
    calls = []

    def build():
        calls.append(1)
        return spark.range(8), spark.range(2)

    schema = spark.range(1).schema
    train, test = prepared.load_or_build(spark, path, build, schema)
    assert (train.count(), test.count(), len(calls)) == (8, 2, 1)
    prepared.load_or_build(spark, path, build, schema)
    assert len(calls) == 1
    prepared.load_or_build(spark, path, build, schema, force=True)
    assert len(calls) == 2
    # A rebuild takes a folder of its own; of the older ones only the last stays.
    for _ in range(3):
        prepared.load_or_build(spark, path, build, schema, force=True)
    assert len(calls) == 5 and len(list((tmp_path / "split" / "versions").iterdir())) == 2
    train, test = prepared.load_or_build(spark, path, build, schema)
    assert (train.count(), test.count(), len(calls)) == (8, 2, 5)


@pytest.mark.parametrize("stop_at", ["train", "test", "schema", "publish"])
def test_a_stopped_rebuild_leaves_the_pair_that_was_there(spark, tmp_path, monkeypatch, stop_at):
    path = str(tmp_path / "split")

    def pair(first):
        return lambda: (spark.range(first, first + 6), spark.range(first + 6, first + 8))

    def held(rows):
        return sorted(r.id for df in rows for r in df.collect())

    assert held(prepared.load_or_build(spark, path, pair(0))) == list(range(8))
    written = []

    def stop(df, target):
        if stop_at == target.rsplit("/", 1)[1]:
            raise RuntimeError("stopped")
        written.append(target)
        return whole(df, target)

    def stopped(*args, **kwargs):
        raise RuntimeError("stopped")

    whole = prepared.write_json_lines
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="stopped"):
        patch.setattr(prepared, "write_json_lines", stop)
        if stop_at == "publish":
            patch.setattr(prepared, "_publish", stopped)
        if stop_at == "schema":
            patch.setattr("pyspark.sql.readwriter.DataFrameWriter.text", stopped)
        prepared.load_or_build(spark, path, pair(100), force=True)
    assert len(written) == {"train": 0, "test": 1}.get(stop_at, 2)
    # The next call reads both halves of the first build, and a finished rebuild replaces both.
    assert held(prepared.load_or_build(spark, path, pair(200))) == list(range(8))
    assert held(prepared.load_or_build(spark, path, pair(200), force=True)) == list(range(200, 208))


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from hexledger.session import shared_dir

    class Session:
        def __init__(self, master, **conf):
            self.sparkContext = type("C", (), {"master": master})()
            self.conf = conf

    local = {"spark.sql.warehouse.dir": "file:/work/spark-warehouse"}
    assert shared_dir(Session("local[8]", **local)) == "file:/work/spark-warehouse"
    assert shared_dir(Session("yarn", **{"spark.sql.warehouse.dir": "hdfs://n/w"})) == "hdfs://n/w"
    assert shared_dir(Session("yarn", **local, **{"spark.checkpoint.dir": "s3a://b/c"})) == "s3a://b/c"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("spark://host:7077", **local))


def test_load_or_build_needs_no_schema(spark, tmp_path):
    path, calls = str(tmp_path / "split"), []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1, None)], "a short, b double"), spark.createDataFrame([], "a short, b double")

    for _ in range(2):
        train, test = prepared.load_or_build(spark, path, build)
        assert train.dtypes == [("a", "smallint"), ("b", "double")] and (train.count(), test.count()) == (1, 0)
    assert len(calls) == 1


def test_only_a_missing_codec_is_a_failed_row(spark, tmp_path):
    broken = spark.range(3).selectExpr("raise_error('no such luck') AS x")
    with pytest.raises(Exception, match="no such luck"):
        writers.storage_trial({"t": broken}, str(tmp_path / "trial"))
    empty = writers.storage_trial({"t": spark.range(0)}, str(tmp_path / "empty"), codecs=("Gzip",)).first()
    assert empty["status"] == "OK" and empty["size_mb"] > 0


def test_catalog_steps(spark, tmp_path):
    catalog.recreate_database(spark, "steps", str(tmp_path / "steps"))
    spark.range(9).write.saveAsTable("steps.numbers")
    spark.range(3).write.saveAsTable("steps.staging")
    catalog.drop_table(spark, "steps.staging")
    assert [r["tableName"] for r in catalog.list_tables(spark, "steps").collect()] == ["numbers"]
    assert "id" in [r["col_name"] for r in catalog.describe_table(spark, "steps.numbers").collect()]
    assert [r["id"] for r in catalog.preview(spark, "steps.numbers", ["id"]).collect()] == [0, 1, 2, 3, 4]
    catalog.recreate_database(spark, "steps", str(tmp_path / "steps2"))
    assert catalog.list_tables(spark, "steps").count() == 0


class _Session:
    """Just the settings that decide where intermediates are written."""

    def __init__(self, master, named):
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")
        self.conf = SimpleNamespace(get=lambda key, default: named if key == "spark.checkpoint.dir" else default)


def test_intermediates_go_to_the_shared_folder():
    assert session.shared_dir(_Session("spark://host:7077", "hdfs://shared/cp")) == "hdfs://shared/cp"
    assert session.scratch_path(_Session("local[2]", "/shared"), "x").startswith("/shared/hexledger/app-local[2]/x-")
    unset = _Session("yarn", None)
    unset.conf.get = lambda key, default=None: "hdfs://house" if key == "spark.sql.warehouse.dir" else default
    assert session.shared_dir(unset) == "hdfs://house"


def test_materialize_survives_a_second_read(spark):
    numbers = session.materialize(spark.range(5).withColumn("r", F.rand()), "numbers")
    assert tuple(map(tuple, numbers.orderBy("id").collect())) == tuple(map(tuple, numbers.orderBy("id").collect()))


class _Reader:
    """Records the options of a JDBC read; no database is opened."""

    def __init__(self):
        self.calls = []

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return (10, 99)

    def jdbc(self, url, table, **options):
        self.calls.append({"url": url, "table": table, **options})
        return "frame"


def test_jdbc_read_is_cut_by_the_key_range():
    reader = _Reader()
    assert jdbc.read_jdbc_table(reader, "jdbc:x", "tx", "pk", 16, {"user": "u"}) == "frame"
    bounds, read = reader.calls
    assert bounds["query"] == "SELECT min(pk) AS lo, max(pk) AS hi FROM tx" and bounds["user"] == "u"
    assert (read["lowerBound"], read["upperBound"], read["numPartitions"]) == (10, 100, 16)
    assert read["properties"] == {"fetchsize": "10000", "user": "u"}


def test_avro_without_its_module_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)avro"):
        readers.read_avro(spark, str(tmp_path))


def test_json_lines_are_written_compressed(spark, tmp_path):
    path = str(tmp_path / "rows")
    writers.write_json_lines(spark.range(3).selectExpr("id", "CAST(NULL AS string) AS gone"), path)
    assert [p.name for p in (tmp_path / "rows").glob("part-*") if not p.name.endswith(".json.gz")] == []
    assert sorted(map(tuple, readers.read_json_lines(spark, path, "id long, gone string").collect())) == [(i, None) for i in range(3)]
