"""Reuse of stored train and test rows.

A pair is written to a folder of its own under `versions`, and becomes the stored pair when a numbered pointer file
names it, which is renamed into place after everything else. Readers follow the last pointer, so they see the rows
of one build whenever a rebuild stops.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hexledger.session import remove
from hexledger.sources.readers import read_json_lines
from hexledger.sources.writers import write_json_lines

# Versions that stay: the current one and the one that earlier readers may still be reading.
KEPT_VERSIONS = 2


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, path: str) -> list[str]:
    """Names of the pointer files, the oldest first: pointer-<number>-<version>."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted((n for n in names if n.startswith("pointer-")), key=lambda n: int(n.split("-")[1]))


def _version(pointer: str) -> str:
    return pointer.split("-", 2)[2]


def _publish(spark: SparkSession, path: str, version: str) -> None:
    """Name `version` as the stored one, in one step; of two writers one fails and its pair stays unnamed."""
    before = _pointers(spark, path)
    number = int(before[-1].split("-")[1]) + 1 if before else 1
    _, files = _folder(spark, path)
    child = spark._jvm.org.apache.hadoop.fs.Path
    unnamed = child(f"{path}/unnamed-{version}")
    files.create(unnamed, False).close()
    if not files.rename(unnamed, child(f"{path}/pointer-{number}-{version}")):
        raise OSError(f"could not publish version {version} of {path}")
    for old in before[: len(before) + 1 - KEPT_VERSIONS]:
        remove(spark, f"{path}/versions/{_version(old)}")
        remove(spark, f"{path}/{old}")


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a pair was published under `path`."""
    return bool(_pointers(spark, path))


def load_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], tuple[DataFrame, DataFrame]],
    schema: StructType | None = None,
    force: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The stored (train, test) pair, or the pair from `build()`, stored first.

    Only the lack of a published pair, or `force`, leads to a rebuild; a failing read is an error. The schema is
    stored beside the rows, so a later call needs none. Both ways return frames that read the stored rows, so
    everything after sees the same split. A rebuild that stops leaves the pair that was there.
    """
    if force or not is_complete(spark, path):
        version = uuid.uuid4().hex
        home = f"{path}/versions/{version}"
        train, test = build()
        for name, df in (("train", train), ("test", test)):
            write_json_lines(df, f"{home}/{name}")
        described = spark.createDataFrame([(train.schema.json(),)], "schema string")
        described.coalesce(1).write.text(f"{home}/schema")
        _publish(spark, path, version)
    home = f"{path}/versions/{_version(_pointers(spark, path)[-1])}"
    if schema is None:
        schema = StructType.fromJson(json.loads(spark.read.text(f"{home}/schema", wholetext=True).first()[0]))
    return tuple(read_json_lines(spark, f"{home}/{name}", schema) for name in ("train", "test"))
