"""Hard negatives by BOND: branch and bound on vectors stored dimension by dimension.

Rows are packed once into blocks of at most `BLOCK_ROWS`, columns first and ordered by label, and written. An
anchor reads a block's dimensions in the descending magnitude of its own entries. After each few dimensions the
smallest and greatest values of the remaining columns bound what every candidate can still gain or lose, and
candidates that can no longer enter a list are struck from the bitmap. Survivors end with exact scores.

The first search finds each anchor's positives, and with them its windows of scores; the second finds the best
different-label rows inside each window. Anchors are dealt into passes of a bounded size, which are broadcast one
after the other: no row is shuffled or copied per anchor. A task keeps the lists of the anchors of its pass over all
its blocks, and only these lists are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexledger.llm.frames import bound_batches
from hexledger.llm.vectors import common_length, matrix
from hexledger.session import materialize, scratch_path

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
# A negative's score is between these percentages of the positive's.
LOW_PERCENT, HIGH_PERCENT = 30, 90
BLOCK_ROWS = 4096
# Anchors, and bytes of their vectors, that are sent to the blocks at once.
PASS_ANCHORS, PASS_BYTES = 16_384, 32 << 20
# Entries are held at plus and minus this number; with up to 256 dimensions 90 times a score then fits into 64 bits.
LARGEST = float(1 << 16)
# Multiplications that one task of a search should do.
TASK_WORK = 2e11

_NONE = -np.iinfo(np.int64).max
_BLOCKS = "block string, ids binary, labels binary, columns binary"
_ANCHORS = "block string, place int, anchor_id long, label long, entries binary"


def blocks_of(vectors: DataFrame, column: str, length: int) -> DataFrame:
    """Rows that take part, packed; `vectors` has vec_id and label (long)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            ids, labels, entries = (np.concatenate([h[k] for h in held]) for k in range(3))
            order = np.argsort(labels, kind="stable")
            packed = [x.tobytes() for x in (ids[order], labels[order], np.ascontiguousarray(entries[order].T))]
            columns = [pa.array([f"{part}-{number}"]), *(pa.array([p], pa.binary()) for p in packed)]
            return pa.RecordBatch.from_arrays(columns, ["block", "ids", "labels", "columns"])

        for batch in batches:
            rows, entries = matrix(batch.column("vector"), length)
            if not len(rows):
                continue
            known = batch.take(pa.array(rows))
            whole = np.floor(SCALE * np.clip(entries, -LARGEST, LARGEST)).astype(np.int32)
            held.append((known.column("vec_id").to_numpy(), known.column("label").to_numpy(), whole))
            size += len(rows)
            if size >= BLOCK_ROWS:
                yield block()
                number, held, size = number + 1, [], 0
        if held:
            yield block()

    taking = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    taking = taking.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col(column).alias("vector"))
    return taking.mapInArrow(pack, _BLOCKS)


class Block:
    def __init__(self, row: dict, length: int) -> None:
        self.name = row["block"]
        self.ids, self.labels = (np.frombuffer(row[c], dtype=np.int64) for c in ("ids", "labels"))
        whole = np.frombuffer(row["columns"], dtype=np.int32).reshape(length, -1)
        self.low, self.high = whole.min(axis=1).astype(np.int64), whole.max(axis=1).astype(np.int64)
        self.most = np.maximum(np.abs(self.low), np.abs(self.high))
        self.whole, self.forms = whole, {}

    def columns(self, entries: np.ndarray) -> np.ndarray:
        """The columns in the smallest type in which all partial scores of the anchor are exact."""
        most = int(np.abs(entries).astype(object) @ self.most.astype(object))
        form = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        if form not in self.forms:
            self.forms[form] = self.whole.astype(form)
        return self.forms[form]

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, side="right"))

    def scan(
        self, entries: np.ndarray, alive: np.ndarray, strike: Callable[[np.ndarray, int, int], np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the candidates that `strike` leaves, of those in the bitmap `alive`.

        `strike(partial, lost, won)` marks the candidates to keep, given what the rest can take away and add.
        """
        columns = self.columns(entries)
        order = np.argsort(-np.abs(entries), kind="stable")
        gains = entries[order] * self.low[order], entries[order] * self.high[order]
        lost = np.append(np.cumsum(np.minimum(*gains)[::-1])[::-1], 0)
        won = np.append(np.cumsum(np.maximum(*gains)[::-1])[::-1], 0)
        values = entries.astype(columns.dtype)[order]
        at = np.flatnonzero(alive)
        sums = np.zeros(len(at), dtype=columns.dtype)
        step, done = max(len(order) // 8, 1), 0
        while done < len(order) and len(at):
            upto = len(order) if len(order) - done < 2 * step else done + (4 * step if not done else step)
            read = columns[order[done:upto]]
            sums += values[done:upto] @ (read if len(at) == read.shape[1] else read[:, at])
            done = upto
            keep = strike(sums, int(lost[done]), int(won[done]))
            if np.count_nonzero(keep) < 0.9 * len(at):
                at, sums = at[keep], sums[keep]
        return at, sums.astype(np.int64)


class Best:
    """The first `size` (score, id) of some lists: greater scores first, of equal ones the smaller id."""

    def __init__(self, lists: int, size: int) -> None:
        self.scores = np.full((lists, size), _NONE)
        self.ids = np.zeros((lists, size), dtype=np.int64)

    def least(self, k: int) -> int:
        """What a score must reach to enter list `k`."""
        return int(self.scores[k, -1])

    def add(self, k: int, scores: np.ndarray, ids: np.ndarray) -> None:
        size = self.scores.shape[1]
        keep = scores >= self.least(k)
        scores, ids = np.append(scores[keep], self.scores[k]), np.append(ids[keep], self.ids[k])
        first = np.lexsort((ids, -scores))[:size]
        self.scores[k], self.ids[k] = scores[first], ids[first]


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k]


def find_positives(block: Block, entries: np.ndarray, label: int, own: int | None, best: Best, k: int) -> None:
    first, last = block.of_label(label)
    alive = np.zeros(len(block.ids), dtype=bool)
    alive[first:last] = True
    if own is not None:
        alive[own] = False

    def strike(partial: np.ndarray, lost: int, won: int) -> np.ndarray:
        least = best.least(k)
        if len(partial) >= POSITIVES:
            least = max(least, int(_kth(partial, POSITIVES)) + lost)
        return partial >= least - won

    at, scores = block.scan(entries, alive, strike)
    best.add(k, scores, block.ids[at])


def find_negatives(block: Block, entries: np.ndarray, label: int, windows: np.ndarray, best: Best, k: int) -> None:
    """`windows`: the lowest and highest score for each list from `k` on."""
    first, last = block.of_label(label)
    alive = np.ones(len(block.ids), dtype=bool)
    alive[first:last] = False

    def strike(partial: np.ndarray, lost: int, won: int) -> np.ndarray:
        keep = np.zeros(len(partial), dtype=bool)
        for w, (low, high) in enumerate(windows.tolist()):
            least = max(low, best.least(k + w))
            if high - low > won - lost:  # some candidates may lie wholly inside by now
                sure = partial[(partial >= low - lost) & (partial <= high - won)]
                if len(sure) >= NEGATIVES:
                    least = max(least, int(_kth(sure, NEGATIVES)) + lost)
            keep |= (partial >= least - won) & (partial <= high - lost)
        return keep

    at, scores = block.scan(entries, alive, strike)
    for w, (low, high) in enumerate(windows.tolist()):
        inside = (scores >= low) & (scores <= high)
        best.add(k + w, scores[inside], block.ids[at[inside]])


def _anchors_of(blocks: DataFrame, length: int) -> DataFrame:
    """One row per anchor; (block, place) names it, also where ids repeat."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, length)
                at = np.flatnonzero(block.ids % ANCHOR_EVERY == 0)
                columns = [pa.array([block.name] * len(at), pa.string()), pa.array(at.astype(np.int32))]
                columns += [pa.array(block.ids[at]), pa.array(block.labels[at])]
                packed = [np.ascontiguousarray(block.whole[:, p]).tobytes() for p in at]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(packed, pa.binary())], ["block", "place", "anchor_id", "label", "entries"]
                )

    return blocks.mapInArrow(take, _ANCHORS)


def _search(blocks: DataFrame, anchors: DataFrame, passes: int, length: int, tasks: int, name: str) -> DataFrame:
    """(block, place, nth, score, id) of the best rows that each task found; `anchors` with windows: negatives."""
    spark = blocks.sparkSession
    schema = "block string, place int, nth int, score long, id long"
    windowed = "windows" in anchors.columns
    path, fields = scratch_path(spark, name), [*anchors.columns]

    def look(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
        given = best = None
        each = POSITIVES if windowed else 1
        for batch in batches:
            for row in batch.to_pylist():
                if given is None:
                    unpack = lambda packed: np.frombuffer(packed, dtype=np.int32).astype(np.int64)
                    given = [a | {"entries": unpack(a["entries"])} for a in sent.value]
                    best = Best(len(given) * each, NEGATIVES if windowed else POSITIVES)
                block = Block(row, length)
                for k, anchor in enumerate(given):
                    entries, label = anchor["entries"], anchor["label"]
                    if windowed:
                        windows = np.array(anchor["windows"], dtype=np.int64).reshape(-1, 2)
                        find_negatives(block, entries, label, windows, best, k * each)
                    else:
                        own = anchor["place"] if anchor["block"] == block.name else None
                        find_positives(block, entries, label, own, best, k)
        if given is None:
            return
        lists, places = np.nonzero(best.scores != _NONE)
        for start in range(0, len(lists), 50_000):
            some = lists[start : start + 50_000]
            where = some, places[start : start + 50_000]
            columns = [
                pa.array([given[k]["block"] for k in (some // each).tolist()], pa.string()),
                pa.array([given[k]["place"] for k in (some // each).tolist()], pa.int32()),
                pa.array((some % each + 1).astype(np.int32)),
                pa.array(best.scores[where]),
                pa.array(best.ids[where]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "place", "nth", "score", "id"])

    dealt = anchors.withColumn("pass", F.pmod(F.xxhash64("block", "place"), F.lit(passes)).cast("int"))
    dealt = materialize(dealt, f"{name}-passes")
    spread = blocks.repartition(tasks)
    for number in range(passes):
        # One pass at a time, bounded by PASS_ANCHORS and PASS_BYTES.
        anchors_of_pass = dealt.where(F.col("pass") == number).select(*fields).collect()
        sent = spark.sparkContext.broadcast([row.asDict() for row in anchors_of_pass])
        spread.mapInArrow(partial(look, sent=sent), schema).write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(schema).parquet(path)


def _ranked(found: DataFrame, keys: list[str], first: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)


def mine(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Hard negatives: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows take part if vec_id, label and vector are not null, all entries are finite numbers, and the vector is as
    long as most. Each row counts by itself, also where ids or whole rows repeat, so an id may be its own anchor's
    positive only if it stands in another row; equal (score, id) are told apart by nothing and all count. Anchors
    are the rows whose id is divisible by `ANCHOR_EVERY`. Entries beyond `LARGEST` are held there. Windows around
    negative scores are empty. Other columns are not read; without vectors the result is empty.
    """
    spark: SparkSession = vectors.sparkSession
    bound_batches(spark)
    keys = ["block", "place"]
    length = common_length(vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()), column)
    blocks = materialize(blocks_of(vectors, column, length), "vector-blocks") if length else None
    if blocks is None:
        return spark.createDataFrame(
            [],
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
        )
    anchors = materialize(_anchors_of(blocks, length), "anchors")
    n_anchors, n_blocks = anchors.count(), blocks.count()
    # Twice the passes that the bounds need: the hash deals anchors evenly, but not exactly.
    full = max(n_anchors / PASS_ANCHORS, n_anchors * length * 4 / PASS_BYTES)
    passes = 1 if full <= 1 else int(2 * full) + 1
    work = float(n_blocks) * BLOCK_ROWS * n_anchors / passes * length
    tasks = max(1, min(n_blocks, max(2 * spark.sparkContext.defaultParallelism, int(work / TASK_WORK))))

    found = _search(blocks, anchors, passes, length, tasks, "positives")
    positives = materialize(
        _ranked(found, keys, POSITIVES).select(
            *keys, F.col("rank").alias("nth"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id")
        ),
        "positives",
    )
    # The least and greatest whole scores inside: 30 * p <= 100 * s <= 90 * p, by whole-number division.
    low, high = F.col("positive_score") * LOW_PERCENT, F.col("positive_score") * HIGH_PERCENT
    ends = low + F.pmod(-low, F.lit(100)), high - F.pmod(high, F.lit(100))
    whole = [F.call_function("div", x, F.lit(100)) for x in ends]
    window = F.struct("nth", F.array(*whole).alias("ends"))
    windows = positives.groupBy(*keys).agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(window)), lambda w: w["ends"])).alias("windows")
    )
    found = _search(blocks, anchors.join(windows, keys), passes, length, tasks, "negatives")
    named = positives.join(anchors.select(*keys, "anchor_id"), keys)
    return (
        _ranked(found, [*keys, "nth"], NEGATIVES)
        .join(named, [*keys, "nth"])
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
