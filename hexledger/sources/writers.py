"""Sinks and table layouts."""

from __future__ import annotations

import time

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexledger import schemas

# Codec names of each format for the three codecs of the storage trial.
TRIAL_CODECS = {
    "parquet": {"Gzip": "gzip", "Snappy": "snappy", "Bzip2": "bzip2"},
    "avro": {"Gzip": "deflate", "Snappy": "snappy", "Bzip2": "bzip2"},
    "orc": {"Gzip": "zlib", "Snappy": "snappy"},
}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Headerless delimited text; values holding the separator, quotes or line ends are quoted."""
    df.write.mode(mode).option("sep", sep).option("escape", '"').option("emptyValue", '""').csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines that keep null fields, so a re-read sees every column; names repeat on every line, so compressed."""
    df.write.mode(mode).option("ignoreNullFields", False).option("compression", "gzip").json(path)


def write_files(df: DataFrame, path: str, fmt: str, codec: str | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).format(fmt)
    if codec:
        writer = writer.option("compression", codec)
    writer.save(path)


def rewrite_orc(df: DataFrame, table: str, path: str) -> None:
    """Store a staged frame as an external ORC table."""
    df.write.mode("overwrite").format("orc").option("path", path).saveAsTable(table)


def write_partitioned(df: DataFrame, path: str, by: list[str], fmt: str = "orc", table: str | None = None) -> None:
    """Partitioned layout; only the partitions present in `df` are replaced.

    With `table` the layout is registered under that name with the declared types of the partition columns,
    which paths alone do not tell.

    The rebalance hint gathers rows of one partition value into few files, and splits a value that
    holds much of the table over several tasks.
    """
    writer = (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .format(fmt)
    )
    if table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.save(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, by: str, buckets: int = 50, sort_by: list[str] | None = None
) -> None:
    """Bucketed external table, rebalanced by bucket so that a large bucket is written by several tasks."""
    bucket = F.pmod(F.hash(by), F.lit(buckets))
    (
        df.withColumn("_bucket", bucket)
        .hint("rebalance", "_bucket")
        .drop("_bucket")
        .write.mode("overwrite")
        .format("orc")
        .option("path", path)
        .bucketBy(buckets, by)
        .sortBy(*(sort_by or [by]))
        .saveAsTable(table)
    )


def export_report(df: DataFrame, path: str, order: list[Column], limit: int) -> None:
    """The head of an ordered report as a single CSV file; only `limit` rows reach the one task."""
    write_csv(df.orderBy(*order).limit(limit).coalesce(1), path)


def write_predictions(df: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)


def stored_size_mb(spark: SparkSession, path: str) -> float:
    """Total size of the files below `path`, from the file system's own listing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return round(files.getContentSummary(folder).getLength() / 1024 / 1024, 4)


def _codec_is_missing(error: PySparkException) -> bool:
    """Whether a write failed because the format does not know the codec."""
    return "CODEC" in (error.getCondition() or "") or "codec" in str(error).split("\n", 1)[0].lower()


def storage_trial(
    tables: dict[str, DataFrame],
    base: str,
    formats: tuple[str, ...] = ("parquet",),
    codecs: tuple[str, ...] = ("Gzip", "Snappy", "Bzip2"),
) -> DataFrame:
    """Write, size and count every table in every format and codec; a codec the format lacks is a FAILED row.

    The uncompressed Parquet size of the table stands for its original size.
    """
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        plain = f"{base}/{name}_plain"
        write_files(df, plain, "parquet", "none")
        original = stored_size_mb(spark, plain)
        source = spark.read.parquet(plain)
        for fmt in formats:
            for codec in codecs:
                target = f"{base}/{name}_{fmt}_{codec}"
                began = time.perf_counter()
                try:
                    write_files(source, target, fmt, TRIAL_CODECS[fmt].get(codec, codec.lower()))
                except PySparkException as error:
                    if not _codec_is_missing(error):
                        raise
                    spent = round(time.perf_counter() - began, 3)
                    rows.append((name, fmt, codec, "FAILED", None, None, original, None, spent, None))
                    continue
                import_time = round(time.perf_counter() - began, 3)
                size = stored_size_mb(spark, target)
                began = time.perf_counter()
                count = spark.read.format(fmt).load(target).count()
                read_time = round(time.perf_counter() - began, 3)
                ratio = round(original / size, 2) if size else 0.0
                rows.append((name, fmt, codec, "OK", count, size, original, ratio, import_time, read_time))
    return spark.createDataFrame(rows, schemas.STORAGE_TRIAL)
