"""Removal of repeated byte strings across documents, by prefix-free parsing.

A rolling hash over `TRIGGER` bytes sets triggers: in each string of `WIDTH` bytes the smallest hash is one,
so every string has a trigger of its own that only its content decides. The strings that share a trigger
overlap in one phrase, and each string lies in exactly one phrase, at the place its trigger gives it. Phrases
overlap by `WIDTH` - 1 bytes, so a suffix of the corpus is told from others up to `WIDTH` bytes by the suffix of
its phrase alone. The order of the parse ranks suffixes only among those with equal phrase suffixes; of these the
first and the last document are all that is asked for. So the dictionary is sorted by its suffixes, the parse is
kept as the list of phrase ids of each chunk, by id, with the documents they stand in, and both together give
the classes of equal strings of the corpus and the smallest document of each.

1. Documents are packed into chunks, which are dealt once to evenly filled buckets of a table: each pass over them keeps
   all cores busy however few tasks read the input, and later joins do not move the texts.
2. Triggers of each chunk go to tasks by their hash; those that occur in one document only drop out.
3. The parse: the different phrases of a chunk as 64-bit ids, with first and last document, are stored by bucket.
4. The dictionary: the content of each different phrase of the corpus is sent once, by the smallest chunk that has
   it. In a bucket its suffixes are sorted, and each class of `WIDTH` equal bytes gives its smallest document.
5. The parse takes these back to the chunks, which mark and cut the strings of documents that are not the smallest.

A trigger that very many chunks share is dealt on by its whole strings instead, so none is a hot key. Different
phrases are taken for one if both their 64-bit ids and their buckets collide.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexledger.llm.frames import bound_batches
from hexledger.llm.text_arrays import Texts, mix
from hexledger.session import materialize, scratch_path

WIDTH = 50
TRIGGER = 24
CHUNK_BYTES = 1 << 21
# Text whose triggers one task compares.
BUCKET_BYTES = 1 << 24
# A trigger in so many chunks is dealt on by whole strings.
HEAVY_CHUNKS = 1 << 13

_REACH = WIDTH - TRIGGER + 1  # triggers that a string can have
_SEGMENT = 1 << 15  # places whose hashes are compared together: they stay in a core's cache
_PLACE = np.uint64((1 << 22) - 1)
# Where the eight-byte pieces begin that together are a string; the last two overlap.
_PIECES = (*range(0, WIDTH - 7, 8), WIDTH - 8)
_PACKED = "chunk long, orders array<long>, hashes array<long>, cuts array<long>, data binary"


@dataclass
class Phrases:
    """The phrases of one chunk: strings that start in [low, high] share the trigger at `at`."""

    low: np.ndarray
    high: np.ndarray
    at: np.ndarray
    document: np.ndarray
    trigger: np.ndarray  # hash of the trigger

    def take(self, chosen: np.ndarray) -> Phrases:
        return Phrases(*(getattr(self, n)[chosen] for n in ("low", "high", "at", "document", "trigger")))


def phrases(texts: Texts, prefix: np.ndarray) -> Phrases:
    n = len(texts.data) - WIDTH + 1
    if n <= 0:
        empty = np.zeros(0, dtype=np.int64)
        return Phrases(empty, empty, empty, empty, empty.astype(np.uint64))
    hashes = texts.window_hash(prefix, TRIGGER)
    at = np.empty(n, dtype=np.int32)
    places = np.arange(_SEGMENT + _REACH, dtype=np.uint64)
    for first in range(0, n, _SEGMENT):
        count = min(_SEGMENT, n - first)
        # The hash above, the place below: the minimum is the smallest hash, the leftmost of equals.
        packed = hashes[first : first + count + _REACH - 1] & ~_PLACE
        packed |= places[: len(packed)]
        width = 1
        while 2 * width <= _REACH:
            packed = np.minimum(packed[:-width], packed[width:])
            width *= 2
        if width < _REACH:
            packed = np.minimum(packed[: width - _REACH], packed[_REACH - width :])
        packed &= _PLACE
        at[first : first + count] = packed
        at[first : first + count] += first
    # The last places of a document begin no string of its own.
    begins, ends = texts.offsets[:-1], texts.offsets[1:]
    edges = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edges, np.minimum(np.maximum(ends - WIDTH + 1, begins), n), 1)
    np.add.at(edges, np.minimum(ends, n), -1)
    inside = np.cumsum(edges[:-1]) == 0
    new, closed = inside.copy(), inside.copy()
    other = at[1:] != at[:-1]
    new[1:] &= other | ~inside[:-1]
    closed[:-1] &= other | ~inside[1:]
    low, high = np.flatnonzero(new), np.flatnonzero(closed)
    found = at[low].astype(np.int64)
    return Phrases(low, high, found, texts.document_of(low), mix(hashes[found]))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _keys(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint32)


def _texts(row: dict) -> Texts:
    return Texts(np.frombuffer(row["data"], dtype=np.uint8), np.array(row["cuts"], dtype=np.int64))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("chunk", pa.int64()),
            ("orders", pa.list_(pa.int64())),
            ("hashes", pa.list_(pa.int64())),
            ("cuts", pa.list_(pa.int64())),
            ("data", pa.binary()),
        ]
    )
    chunk = TaskContext.get().partitionId() << 32
    orders, hashes, data, size = [], [], [], 0

    def full() -> pa.RecordBatch:
        cuts = np.concatenate(([0], np.cumsum([len(d) for d in data]))).tolist()
        row = {"chunk": chunk, "orders": orders, "hashes": hashes, "cuts": cuts, "data": b"".join(data)}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            text = (row["text"] or "").encode()
            if data and size + len(text) > CHUNK_BYTES:
                yield full()
                chunk, orders, hashes, data, size = chunk + 1, [], [], [], 0
            orders.append(row["order"])
            hashes.append(row["text_hash"])
            data.append(text)
            size += len(text)
    if data:
        yield full()


def _trigger_rows(buckets: int):
    """Step 2, in the chunks: the different triggers by bucket, and whether two documents share one."""
    schema = _schema(bucket=pa.int32(), chunk=pa.int64(), keys=pa.binary(), shared=pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = _texts(row)
                rows = []
                for bucket, keys, documents, _ in _by_bucket(phrases(texts, texts.prefix()), buckets):
                    shared = documents[1] != documents[0]
                    rows.append((bucket, row["chunk"], keys.tobytes(), np.packbits(shared).tobytes()))
                yield _batch(rows, schema)

    return run


def _by_bucket(found: Phrases, buckets: int):
    """(bucket, its different keys in order, first and last document of each, index of each phrase's key)."""
    bucket, key = _bucket(found.trigger, buckets), _keys(found.trigger)
    order = np.lexsort((found.document, key, bucket))
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, edges) if len(order) else []:
        keys, first, inverse = np.unique(key[part], return_index=True, return_inverse=True)
        last = np.append(first[1:], len(part)) - 1
        documents = (found.document[part][first], found.document[part][last])
        yield int(bucket[part[0]]), keys, documents, (part, inverse)


def _shared_triggers(table: pa.Table) -> pa.Table:
    """Step 2, by bucket: for each chunk the status of its keys: 0 alone, 1 shared, 2 shared by very many."""
    keys = [np.frombuffer(k, dtype=np.uint32) for k in table["keys"].to_pylist()]
    shared = [
        np.unpackbits(np.frombuffer(s, dtype=np.uint8), count=len(k)).astype(bool)
        for k, s in zip(keys, table["shared"].to_pylist(), strict=True)
    ]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    new = np.ones(len(every), dtype=bool)
    new[1:] = every[order[1:]] != every[order[:-1]]
    first = np.flatnonzero(new)
    chunks = np.diff(np.append(first, len(every)))
    within = np.logical_or.reduceat(np.concatenate(shared)[order], first)
    status = np.where(chunks >= HEAVY_CHUNKS, 2, ((chunks > 1) | within).astype(int)).astype(np.uint8)
    of_each = np.empty(len(every), dtype=np.uint8)
    of_each[order] = np.repeat(status, chunks)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    bucket = table["bucket"][0].as_py()
    return pa.table(
        {
            "chunk": table["chunk"],
            "bucket": pa.array([bucket] * len(keys), pa.int32()),
            "status": pa.array([s.tobytes() for s in np.split(of_each, cuts)], pa.binary()),
        }
    )


@dataclass
class Contents:
    """The different contents of a chunk's shared phrases, in the order of their buckets and ids."""

    bucket: np.ndarray
    ident: np.ndarray
    start: np.ndarray  # an occurrence in the chunk
    size: np.ndarray
    found: Phrases
    of_phrase: np.ndarray  # the content of each phrase of `found`

    def by_bucket(self) -> Iterator[tuple[int, int]]:
        """Begin and end of each bucket's contents."""
        if len(self.bucket):
            edges = np.flatnonzero(np.diff(self.bucket)) + 1
            yield from zip([0, *edges.tolist()], [*edges.tolist(), len(self.bucket)], strict=True)


def contents(texts: Texts, prefix: np.ndarray, status: dict[int, np.ndarray], buckets: int) -> Contents:
    """Phrases of shared triggers; those of a very common one as the single strings that they are made of."""
    found = phrases(texts, prefix)
    state = np.zeros(len(found.low), dtype=np.uint8)
    for bucket, _, _, (part, inverse) in _by_bucket(found, buckets):
        if bucket in status:
            state[part] = status[bucket][inverse]
    heavy = found.take(state == 2)
    count = heavy.high - heavy.low + 1
    owner = np.repeat(np.arange(len(count)), count)
    single = heavy.take(owner)
    single.low = single.low + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    single.high = single.low
    light = found.take(state == 1)
    both = Phrases(
        *(
            np.concatenate((getattr(light, n), getattr(single, n)))
            for n in ("low", "high", "at", "document", "trigger")
        )
    )
    content = texts.segment_hash(prefix, both.low, both.high + WIDTH)
    dealt = np.concatenate((light.trigger, mix(content[len(light.low) :])))
    bucket = _bucket(dealt, buckets)
    order = np.lexsort((content, bucket))
    both, content, bucket = both.take(order), content[order], bucket[order]
    new = np.ones(len(content), dtype=bool)
    new[1:] = (content[1:] != content[:-1]) | (bucket[1:] != bucket[:-1])
    first = np.flatnonzero(new)
    size = (both.high - both.low + WIDTH)[first]
    return Contents(bucket[first], content[first], both.low[first], size, both, np.cumsum(new) - 1)


def _narrow(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _widen(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"u{len(data) // n}").astype(np.uint64)


def _pack_documents(least: np.ndarray, most: np.ndarray) -> tuple[int, bytes, bytes]:
    """First and last documents as a base, distances from it, and distances of the last from the first."""
    base = least.min()
    distance = least.view(np.uint64) - base.view(np.uint64)
    return int(base), _narrow(distance), _narrow(most.view(np.uint64) - least.view(np.uint64))


def _unpack_documents(row: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    least = _widen(row["least"], n) + np.array([row["base"]], dtype=np.int64).view(np.uint64)
    return least.view(np.int64), (least + _widen(row["span"], n)).view(np.int64)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _schema(**types: pa.DataType) -> pa.Schema:
    return pa.schema(list(types.items()))


_DOCUMENTS = {"base": pa.int64(), "least": pa.binary(), "span": pa.binary()}
_PARSE = "bucket int, chunk long, idents binary, base long, least binary, span binary"
_WANTED = "chunk long, bucket int, places binary, base long, least binary, span binary"
_CONTENT = "bucket int, idents binary, sizes binary, data binary, base long, least binary, span binary"
_SMALLEST = "bucket int, idents binary, document binary, mask binary"
_SMALLER = "chunk long, bucket int, content binary, document binary, mask binary"


def _parse_rows(buckets: int):
    """Step 3, in the chunks: the ids of their phrases by bucket, each with its first and last document."""
    schema = _schema(bucket=pa.int32(), chunk=pa.int64(), idents=pa.binary(), **_DOCUMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = _texts(row)
                own = contents(texts, texts.prefix(), _status(row["status"]), buckets)
                orders = np.array(row["orders"], dtype=np.int64)[own.found.document]
                n = len(own.size)
                least, most = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
                np.minimum.at(least, own.of_phrase, orders)
                np.maximum.at(most, own.of_phrase, orders)
                rows = [
                    (int(own.bucket[a]), row["chunk"], own.ident[a:b].tobytes())
                    + _pack_documents(least[a:b], most[a:b])
                    for a, b in own.by_bucket()
                ]
                yield _batch(rows, schema)

    return run


def _status(entries: list | None) -> dict[int, np.ndarray]:
    return {e["bucket"]: np.frombuffer(e["status"], dtype=np.uint8) for e in entries or []}


def _wanted(table: pa.Table) -> pa.Table:
    """Step 4, by bucket: which contents the smallest chunk that has them is to send, and their documents."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    idents = [np.frombuffer(r["idents"], dtype=np.uint64) for r in rows]
    documents = [_unpack_documents(r, len(i)) for r, i in zip(rows, idents, strict=True)]
    every = np.concatenate(idents)
    order = np.argsort(every, kind="stable")
    new = np.ones(len(every), dtype=bool)
    new[1:] = every[order[1:]] != every[order[:-1]]
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(np.concatenate([d[0] for d in documents])[order], first)
    most = np.maximum.reduceat(np.concatenate([d[1] for d in documents])[order], first)
    turn = np.argsort(order[first])
    place, least, most = order[first][turn], least[turn], most[turn]
    bounds = np.cumsum([0] + [len(i) for i in idents])
    cuts = np.searchsorted(place, bounds)
    out = [
        (r["chunk"], r["bucket"], (place[a:b] - bounds[k]).astype(np.uint32).tobytes())
        + _pack_documents(least[a:b], most[a:b])
        for k, (r, a, b) in enumerate(zip(rows, cuts[:-1], cuts[1:], strict=True))
        if b > a
    ]
    schema = _schema(chunk=pa.int64(), bucket=pa.int32(), places=pa.binary(), **_DOCUMENTS)
    return pa.Table.from_batches([_batch(out, schema)])


def _content_rows(buckets: int):
    """Step 4, in the chunks: the contents that this chunk sends for the corpus."""
    schema = _schema(
        bucket=pa.int32(), idents=pa.binary(), sizes=pa.binary(), data=pa.binary(), **_DOCUMENTS
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = _texts(row)
                own = contents(texts, texts.prefix(), _status(row["status"]), buckets)
                rows = []
                for entry in row["wanted"]:
                    chosen = np.frombuffer(entry["places"], dtype=np.uint32).astype(np.int64)
                    chosen += np.searchsorted(own.bucket, entry["bucket"])
                    size = own.size[chosen]
                    ends = np.cumsum(size)
                    at = np.repeat(own.start[chosen] - (ends - size), size) + np.arange(ends[-1])
                    rows.append(
                        (
                            entry["bucket"],
                            own.ident[chosen].tobytes(),
                            size.astype(np.uint8).tobytes(),
                            texts.data[at].tobytes(),
                            entry["base"],
                            entry["least"],
                            entry["span"],
                        )
                    )
                yield _batch(rows, schema)

    return run


def suffix_order(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that begin at `start` in the order of their first `WIDTH` bytes, and flags of each new string."""
    pieces = np.ndarray(len(data) - 7, dtype=">u8", buffer=data, strides=(1,))
    order = np.argsort(pieces[start].astype(np.uint64))
    new = np.ones(len(start), dtype=bool)
    first = pieces[start[order]]
    new[1:] = first[1:] != first[:-1]
    for k in _PIECES[1:]:
        # Only those that are not told apart yet.
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        rank, own = np.cumsum(new[at]), order[at]
        piece = pieces[start[own] + k].astype(np.uint64)
        turn = np.argsort(piece)
        turn = turn[np.argsort(rank[turn], kind="stable")]
        order[at], piece = own[turn], piece[turn]
        new[at[1:]] |= piece[1:] != piece[:-1]
    return order, new


def _smallest_documents(table: pa.Table) -> pa.Table:
    """Step 4, by bucket: (content, document, mask) for strings that start in a smaller document than the last."""
    rows = table.to_pylist()
    idents = np.concatenate([np.frombuffer(r["idents"], dtype=np.uint64) for r in rows])
    documents = [_unpack_documents(r, len(r["sizes"])) for r in rows]
    least, most = (np.concatenate([d[k] for d in documents]) for k in (0, 1))
    size = np.concatenate([np.frombuffer(r["sizes"], dtype=np.uint8) for r in rows]).astype(np.int64)
    data = np.frombuffer(b"".join(r["data"] for r in rows), dtype=np.uint8)
    count = size - WIDTH + 1
    content = np.repeat(np.arange(len(size)), count)
    offset = np.arange(len(content)) - np.repeat(np.cumsum(count) - count, count)
    order, new = suffix_order(data, (np.cumsum(size) - size)[content] + offset)
    edges = np.flatnonzero(new)
    lowest = np.minimum.reduceat(least[content[order]], edges)
    lowest = np.repeat(lowest, np.diff(np.append(edges, len(order))))
    hit = lowest < most[content[order]]
    chosen, lowest = order[hit], lowest[hit]
    # One entry for each content and smallest document, with the offsets as bits.
    content, offset = content[chosen], offset[chosen]
    turn = np.lexsort((lowest, idents[content]))
    content, offset, lowest = content[turn], offset[turn], lowest[turn]
    new = np.ones(len(content), dtype=bool)
    new[1:] = (content[1:] != content[:-1]) | (lowest[1:] != lowest[:-1])
    first = np.flatnonzero(new)
    bits = np.left_shift(np.uint32(1), offset.astype(np.uint32))
    masks = np.bitwise_or.reduceat(bits, first) if len(first) else bits
    out = (rows[0]["bucket"], idents[content[first]].tobytes(), lowest[first].tobytes(), masks.tobytes())
    schema = _schema(bucket=pa.int32(), idents=pa.binary(), document=pa.binary(), mask=pa.binary())
    return pa.Table.from_batches([_batch([out], schema)])


def _back_to_chunks(parse: pa.Table, smallest: pa.Table) -> pa.Table:
    """Step 5, by bucket: the entries of each chunk's contents that have a document above the smallest."""
    schema = _schema(
        chunk=pa.int64(), bucket=pa.int32(), content=pa.binary(), document=pa.binary(), mask=pa.binary()
    )
    out = []
    for entries in smallest.to_pylist():  # one row
        known = np.frombuffer(entries["idents"], dtype=np.uint64)
        document = np.frombuffer(entries["document"], dtype=np.int64)
        mask = np.frombuffer(entries["mask"], dtype=np.uint32)
        for batch in parse.to_batches():
            for row in batch.to_pylist():
                idents = np.frombuffer(row["idents"], dtype=np.uint64)
                _, most = _unpack_documents(row, len(idents))
                begin = np.searchsorted(known, idents, side="left")
                n = np.searchsorted(known, idents, side="right") - begin
                content = np.repeat(np.arange(len(idents)), n)
                at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(len(content))
                hit = document[at] < most[content]
                content, at = content[hit].astype(np.uint32), at[hit]
                if len(at):
                    values = (content.tobytes(), document[at].tobytes(), mask[at].tobytes())
                    out.append((row["chunk"], row["bucket"], *values))
    return pa.Table.from_batches([_batch(out, schema)])


def _cut(buckets: int, with_text: bool):
    """Step 4: what is removed from each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = _texts(row)
                orders = np.array(row["orders"], dtype=np.int64)
                own = contents(texts, texts.prefix(), _status(row["status"]), buckets)
                marks = np.zeros(len(texts.data) + 1, dtype=np.int32)
                by_content = np.argsort(own.of_phrase, kind="stable")
                counts = np.bincount(own.of_phrase, minlength=len(own.size))
                ends = np.cumsum(counts)
                for entry in row["smaller"] or []:
                    base = np.searchsorted(own.bucket, entry["bucket"])
                    content = np.frombuffer(entry["content"], dtype=np.uint32).astype(np.int64) + base
                    document = np.frombuffer(entry["document"], dtype=np.int64)
                    mask = np.frombuffer(entry["mask"], dtype=np.uint32)
                    # Every phrase with one of these contents.
                    n = counts[content]
                    turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    phrase = by_content[np.repeat(ends[content] - n, n) + turn]
                    mask = np.repeat(mask, n)
                    later = orders[own.found.document[phrase]] > np.repeat(document, n)
                    low, mask = own.found.low[phrase[later]], mask[later]
                    for k in range(_REACH):
                        at = low[(mask >> np.uint32(k)) & np.uint32(1) > 0] + k
                        np.add.at(marks, at, 1)
                        np.add.at(marks, at + WIDTH, -1)
                removed = np.cumsum(marks[:-1]) > 0
                opens = removed.copy()
                opens[1:] &= ~removed[:-1]
                edges = texts.offsets[:-1][texts.offsets[:-1] < len(removed)]
                opens[edges] = removed[edges]
                n = len(texts)
                cuts, data = texts.offsets, texts.data
                kept, spans = [], []
                run_starts = np.flatnonzero(opens)
                closes = removed.copy()
                closes[:-1] &= ~removed[1:] | opens[1:]
                run_ends = np.flatnonzero(closes) + 1
                owner = texts.document_of(run_starts)
                n_spans = np.bincount(owner, minlength=n)
                upto = np.cumsum(n_spans)
                for d in range(n):
                    own_data, gone = data[cuts[d] : cuts[d + 1]], removed[cuts[d] : cuts[d + 1]]
                    kept.append(own_data[~gone].tobytes())
                    if with_text:
                        k = slice(upto[d] - n_spans[d], upto[d])
                        spans.append(
                            [
                                {"start": int(s), "bytes": int(b)}
                                for s, b in zip(run_starts[k] - cuts[d], run_ends[k] - run_starts[k], strict=True)
                            ]
                        )
                columns = {
                    "order": pa.array(orders),
                    "text_hash": pa.array(row["hashes"], pa.int64()),
                    "n_bytes": pa.array(np.diff(cuts)),
                    "n_removed": pa.array(texts.per_document(removed)),
                    "n_spans": pa.array(n_spans),
                    "kept": pa.array(kept, pa.binary()),
                }
                if with_text:
                    kind = pa.list_(pa.struct([("start", pa.int64()), ("bytes", pa.int64())]))
                    columns["spans"] = pa.array(spans, kind)
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _stored(frame: DataFrame, column: str, buckets: int, purpose: str) -> DataFrame:
    """`frame` as a table whose rows lie in buckets by `column`, as they come."""
    spark = frame.sparkSession
    name = f"llm_{purpose}_{uuid.uuid4().hex}"
    writer = frame.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, purpose))
    writer.bucketBy(buckets, column).saveAsTable(name)
    atexit.register(_forget, spark, name)
    return spark.table(name)


def _corpus(documents: DataFrame) -> tuple[DataFrame, int]:
    """The chunks, dealt to buckets one by one: a task of the scan may hold very many; and the bytes of all texts."""
    # Null ids come before all others.
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = documents.select(order.alias("order"), F.xxhash64("text").alias("text_hash"), "text")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tables = _tables(total)
    return _stored(rows.mapInArrow(_pack, _PACKED).repartition(tables, "chunk"), "chunk", tables, "corpus"), total


def _tables(total: int) -> int:
    """Buckets of a stored table: about so many tasks read it side by side."""
    return min(max(total // (4 * CHUNK_BYTES), 1), 50_000)


def _forget(spark, name: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before the process
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _of_chunks(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """One row per chunk with the list of its rows."""
    return rows.groupBy("chunk").agg(F.collect_list(F.struct(*columns)).alias(name))


def remove_repeats(documents: DataFrame, spans: bool = True) -> DataFrame:
    """doc_id, text_hash, n_bytes, n_removed, n_spans, kept (binary) and, if asked, spans of each document.

    A byte is removed if a string of `WIDTH` bytes over it also starts in a document with a smaller doc_id;
    `spans` are the maximal removed runs (start, bytes). `kept` are the bytes left, which need not be UTF-8.
    One row per row: repeated rows and rows that share an id do not remove from each other. Null ids are
    smaller than all others, and come back as null. A null text is empty; texts under `WIDTH` bytes stay.
    Other columns are not looked at.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    corpus, total = _corpus(documents)
    buckets = total // BUCKET_BYTES + 1
    triggers = corpus.mapInArrow(
        _trigger_rows(buckets), "bucket int, chunk long, keys binary, shared binary"
    )
    shared = triggers.groupBy("bucket").applyInArrow(
        _shared_triggers, "chunk long, bucket int, status binary"
    )
    status = materialize(_of_chunks(shared, "status", "bucket", "status"), "trigger-status")
    known = corpus.join(status.hint("shuffle_hash"), "chunk")
    tables = min(buckets, _tables(total))
    parse = _stored(
        known.mapInArrow(_parse_rows(buckets), _PARSE).repartition(tables, "bucket"), "bucket", tables, "parse"
    )
    wanted = _of_chunks(
        parse.groupBy("bucket").applyInArrow(_wanted, _WANTED), "wanted", "bucket", "places", "base", "least", "span"
    )
    dictionary = known.join(wanted.hint("shuffle_hash"), "chunk").mapInArrow(_content_rows(buckets), _CONTENT)
    smallest = dictionary.groupBy("bucket").applyInArrow(_smallest_documents, _SMALLEST)
    found = parse.groupBy("bucket").cogroup(smallest.groupBy("bucket")).applyInArrow(_back_to_chunks, _SMALLER)
    smaller = materialize(
        _of_chunks(found, "smaller", "bucket", "content", "document", "mask"), "smaller-documents"
    )
    rows = "order long, text_hash long, n_bytes long, n_removed long, n_spans long, kept binary"
    if spans:
        rows += ", spans array<struct<start: long, bytes: long>>"
    out = (
        corpus.join(status.hint("shuffle_hash"), "chunk", "left")
        .join(smaller.hint("shuffle_hash"), "chunk", "left")
        .mapInArrow(_cut(buckets, spans), rows)
    )
    doc_id = F.when(F.col("order") != -(1 << 63), F.col("order"))
    return out.withColumn("doc_id", doc_id).drop("order")
