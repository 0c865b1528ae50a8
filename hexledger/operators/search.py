"""Searches over grids with k folds, in parallel, whose results are stored as they come and survive a stop.

A unit is one fit; it measures one grid point, or several if one fit holds the others (`by_prefix`). Each
finished unit stores its metrics in a folder of its own under the search's path, and a later call fits only what
is missing. Units run side by side in threads. Every thread gets its own copy of the session's local properties:
`CrossValidator` wraps all its tasks with one copy, so one thread's execution id is set and cleared under
another's query, which is why its parallel fits failed now and then.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

# Fixed value: the published number of fits side by side. Fits of few tasks go on in more threads, up to a bound.
PARALLELISM = 4
MOST_THREADS = 16
# Rows that one task of a fit should have at least; smaller sets are read by fewer tasks.
ROWS_PER_TASK = 20_000
# Of fits that add up little per row (trees, linear models) a task takes more: starting one costs more than it does.
LIGHT_ROWS = 200_000

RESULT = "target string, fold int, settings string, metric double"

Point = dict[str, object]
# Fits on the first frame and returns the metric of each point on the second.
Measure = Callable[[list[Point], DataFrame, DataFrame], list[float]]


@dataclass(frozen=True)
class Unit:
    """Grid points that one fit measures; `target` tells searches over the same grid apart."""

    target: str
    points: tuple[Point, ...]
    measure: Measure

    def rows(self, fold: int) -> list[tuple[str, int, str]]:
        return [(self.target, fold, named(p)) for p in self.points]


def grid_points(grid: dict[str, list]) -> list[Point]:
    """All combinations; an empty grid has one point without settings."""
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def named(point: Point) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(point.items()))


def one_each(points: list[Point]) -> list[list[Point]]:
    return [[p] for p in points]


def by_prefix(points: list[Point], length: str = "maxIter") -> list[list[Point]]:
    """Points that differ only in the number of boosting rounds: the longest fit holds the shorter ones.

    Rounds follow each other and draw their seeds in order, so the first rounds of a long fit are the short fit.
    """
    groups: dict[str, list[Point]] = {}
    for point in points:
        groups.setdefault(named({k: v for k, v in point.items() if k != length}), []).append(point)
    return [sorted(g, key=lambda p: p.get(length, 0)) for g in groups.values()]


def sized(df: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """`df` read by at most as many tasks as its rows are worth; every step of a fit runs that many tasks."""
    return df.coalesce(max(1, math.ceil(df.count() / rows)))


def in_threads(session: SparkSession, tasks: list[Callable[[], object]], parallelism: int = PARALLELISM) -> list:
    """Results in order; every task ends before the first error is raised, so that what it stored stays."""

    def caught(task: Callable[[], object]):
        try:
            return task(), None
        except Exception as error:  # noqa: BLE001  raised below
            return None, error

    wrapped = [inheritable_thread_target(session)(partial(caught, task)) for task in tasks]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        results = pool.map(lambda task: task(), wrapped, chunksize=1)
    for _, error in results:
        if error is not None:
            raise error
    return [result for result, _ in results]


def stored_results(spark: SparkSession, path: str) -> DataFrame:
    """(target, fold, settings, metric) of all finished units under `path`; empty before the first one."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).option("recursiveFileLookup", "true").json(path)


def search(
    train: DataFrame,
    units: list[Unit],
    path: str,
    prepare: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] | None = None,
    parallelism: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Measure every unit on every fold of `train` (column `fold`); returns `stored_results`.

    `prepare` turns a fold's (train, validation) rows into what the fits read, once for all units of the fold.
    The path belongs to one search over one set of rows: what is stored there is not measured again.
    Without `parallelism` there are as many fits at once as fill the session's cores.
    """
    spark, widest = train.sparkSession, 1
    done = {(r.target, r.fold, r.settings) for r in stored_results(spark, path).collect()}
    folds = sorted(r.fold for r in train.select("fold").distinct().collect())
    tasks = []
    for fold in folds:
        todo = [u for u in units if not done.issuperset(u.rows(fold))]
        if not todo:
            continue
        pair = train.where(F.col("fold") != fold), train.where(F.col("fold") == fold)
        fitted_on, measured_on = (sized(df, rows_per_task) for df in (prepare(*pair) if prepare else pair))
        widest = max(widest, math.ceil(fitted_on.count() / rows_per_task))

        def run(unit: Unit, fold: int = fold, a: DataFrame = fitted_on, b: DataFrame = measured_on) -> None:
            metrics = unit.measure(list(unit.points), a, b)
            rows = [(*key, float(m)) for key, m in zip(unit.rows(fold), metrics, strict=True)]
            name = hashlib.md5(repr(unit.rows(fold)).encode(), usedforsecurity=False).hexdigest()
            spark.createDataFrame(rows, RESULT).coalesce(1).write.mode("overwrite").json(f"{path}/unit-{name}")

        tasks += [partial(run, unit) for unit in todo]
    fill = min(MOST_THREADS, max(PARALLELISM, spark.sparkContext.defaultParallelism // widest))
    in_threads(spark, tasks, parallelism or fill)
    return stored_results(spark, path)


def report(results: DataFrame) -> DataFrame:
    """(target, settings, folds, avg_metric): the mean over the folds of each grid point."""
    return results.groupBy("target", "settings").agg(
        F.countDistinct("fold").cast("int").alias("folds"), F.avg("metric").alias("avg_metric")
    )


def best_points(results: DataFrame, units: list[Unit], larger_is_better: bool) -> dict[str, Point]:
    """The best point of each target by its mean metric; of equal ones the first of the grid."""
    sign = -1 if larger_is_better else 1
    means = {(r.target, r.settings): sign * r.avg_metric for r in report(results).collect()}
    best: dict[str, Point] = {}
    for unit in units:
        for point in unit.points:
            held = best.get(unit.target)
            if held is None or means[unit.target, named(point)] < means[unit.target, named(held)]:
                best[unit.target] = point
    return best
