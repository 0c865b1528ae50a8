"""MinHash near-deduplication with sequential Bayesian verification.

Documents with equal shingle sets form one node. Nodes that agree in a band of their MinHash signatures share
a bucket. Candidate pairs are compared signature batch by signature batch and dropped as soon as the
posterior probability that their similarity reaches the threshold is under `MISS`; survivors are verified on
their full shingle sets. Links build connected components.

No bucket is expanded into all its pairs. First each node is compared with one pivot of each of its buckets
and verified against the likeliest, so a bucket of near copies costs a row a member. Only buckets that still
hold several components afterwards are searched, in blocks over many tasks. A block looks at pairs across
components, each in the first band its nodes share, and returns only links that join two components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexledger.llm.frames import bound_batches, counted, fresh, same
from hexledger.llm.text_arrays import Texts, mix, signed, slices, word_ngrams
from hexledger.session import materialize

SHINGLE = 5
# Links have 100 * intersection >= PERCENT * union. At 85 % two nodes miss all bands with a chance of 1e-6.
PERCENT = 85
BANDS, ROWS = 24, 5
# Hashes compared at a time, and the chance at which a candidate is given up.
BATCH = 24
MISS = 1e-6
# Members of a bucket, and their shingles, that a block has; larger buckets are cut into such blocks.
BLOCK = 512
BLOCK_SHINGLES = 500_000
# Members that are verified against one copy of a pivot's text.
MEMBERS = 256
BROADCAST_NODES = 200_000

_HASHES = BANDS * ROWS
_A = mix(np.arange(1, _HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(1, _HASHES + 1, dtype=np.uint64) + np.uint64(1 << 32))


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each document, by document and value, and how many each document has.

    Words are runs of bytes without ASCII white space, A-Z in lower case. A document of fewer than `SHINGLE`
    words has all of them as its one shingle; one without words has none.
    """
    data = texts.data.copy()
    data[(data >= 0x41) & (data <= 0x5A)] += 32
    texts = Texts(data, texts.offsets)
    starts, ends = texts.words()
    words, document = texts.segment_hash(texts.prefix(), starts, ends), texts.document_of(starts)
    values, first = word_ngrams(words, document, SHINGLE)
    owners = document[first]
    n_words = np.bincount(document, minlength=len(texts))
    for n in range(1, SHINGLE):
        grams, at = word_ngrams(words, document, n)
        short = n_words[document[at]] == n
        values = np.concatenate((values, mix(grams[short] + np.uint64(n))))
        owners = np.concatenate((owners, document[at][short]))
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    return values[new], np.bincount(owners[new], minlength=len(texts))


def _node_ids(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number for each set (0 for the empty one)."""
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(values + np.uint64(7)))))
        ends = np.cumsum(sizes)
        return np.where(sizes > 0, mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)), 0).astype(np.uint64)


def _signatures(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(documents, hashes) of 32-bit minima; 0 for empty sets."""
    out = np.zeros((len(sizes), _HASHES), dtype=np.uint32)
    filled = np.flatnonzero(sizes > 0)
    if len(filled):
        starts = (np.cumsum(sizes) - sizes)[filled]
        with np.errstate(over="ignore"):
            for k in range(_HASHES):
                hashed = ((values * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32)
                out[filled, k] = np.minimum.reduceat(hashed, starts)
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch):
            values, sizes = shingle_sets(texts)
            signatures = _signatures(values, sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_hash"),
                    pa.array(sizes),
                    pa.array(signed(_node_ids(values, sizes))),
                    pa.array([row.tobytes() for row in signatures], pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "node", "signature"],
            )


def _keys(signatures: np.ndarray) -> np.ndarray:
    """(documents, bands) of bucket names."""
    wide = signatures.astype(np.uint64)
    keys = np.empty((len(wide), BANDS), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            key = np.full(len(wide), band + 1, dtype=np.uint64)
            for k in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, band * ROWS + k])
            keys[:, band] = key
    return signed(keys)


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _keys(_matrix(batch.column("signature")))
        own = [np.repeat(batch.column(c).to_numpy(), BANDS) for c in ("node", "n_shingles")]
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *map(pa.array, own)], names=["key", "node", "n_shingles"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, _HASHES)


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """For 0, BATCH, 2 * BATCH, ... hashes: the fewest equal ones with which a pair is not given up.

    The prior of the similarity is uniform, so after m of n equal hashes it is Beta(m + 1, n - m + 1).
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    above = s >= percent / 100
    out = [0]
    for n in range(BATCH, _HASHES + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(s) + (n - m) * np.log(1 - s)
            density = np.exp(log - log.max())
            if density[above].sum() / density.sum() >= miss:
                out.append(m)
                break
    return out


def _survivors(left: np.ndarray, right: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `left` and `right` (or of one `left` row and `right`) that stay, and their equal hashes."""
    alive = np.arange(len(right))
    matches = np.zeros(len(right), dtype=np.int64)
    for k, fewest in enumerate(least[1:]):
        at = slice(k * BATCH, (k + 1) * BATCH)
        own = left[at] if left.ndim == 1 else left[alive, at]
        matches = matches + (own == right[alive, at]).sum(axis=1)
        stay = matches >= fewest
        alive, matches = alive[stay], matches[stay]
        if not len(alive):
            break
    return alive, matches


def _prune_pairs(least: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive, matches = _survivors(_matrix(batch.column("sx")), _matrix(batch.column("sy")), least)
            yield pa.RecordBatch.from_arrays(
                [batch.column("x").take(pa.array(alive)), batch.column("y").take(pa.array(alive)), pa.array(matches)],
                names=["x", "y", "matches"],
            )

    return run


def _search_block(least: list[int], percent: int):
    """Links that join components, between the two blocks of one bucket (or inside one)."""

    def run(table: pa.Table) -> pa.Table:
        low, high, key = (table[c][0].as_py() for c in ("low", "high", "key"))
        table = table.sort_by("node")
        block, node, label = (table[c].to_numpy() for c in ("block", "node", "label"))
        signature = _matrix(table["signature"].combine_chunks())
        band = int(np.flatnonzero(_keys(signature[:1])[0] == key)[0])
        sets, sizes = [], []
        for batch in table.select(["text"]).to_batches():
            for _, texts in slices(batch):
                for found, into in zip(shingle_sets(texts), (sets, sizes), strict=True):
                    into.append(found)
        sizes = np.concatenate(sizes)
        _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(sizes)
        mark = np.zeros(shingle.max(initial=0) + 1, dtype=bool)
        _, home = np.unique(label, return_inverse=True)
        xs, ys = [], []
        right = np.flatnonzero(block == high)
        for i in np.flatnonzero(block == low):
            others = right[home[right] != home[i]]
            if low == high:
                others = others[others > i]
            # A pair is looked at in the first band that its nodes share.
            earlier = signature[others, : band * ROWS] == signature[i, : band * ROWS]
            others = others[~earlier.reshape(len(others), band, ROWS).all(axis=2).any(axis=1)]
            alive, matches = _survivors(signature[i], signature[others], least)
            own = shingle[ends[i] - sizes[i] : ends[i]]
            mark[own] = True
            for j in others[alive[np.argsort(-matches, kind="stable")]]:
                if home[j] == home[i]:
                    continue
                shared = int(mark[shingle[ends[j] - sizes[j] : ends[j]]].sum())
                if 100 * shared >= percent * (sizes[i] + sizes[j] - shared):
                    xs.append(node[i])
                    ys.append(node[j])
                    home[home == home[j]] = home[i]
            mark[own] = False
        return pa.table({"x": pa.array(xs, pa.int64()), "y": pa.array(ys, pa.int64())})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of (a, b) edges: the smallest node of the component.

    Large-star and small-star rounds until every node points at its smallest; each round is written.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(lowest.select("a", F.col("m").alias("b")).unionByName(down).distinct(), "small-star")
        # Done when no node points at two, and none is pointed at that points on.
        pointing = edges.groupBy("a").agg(F.count("*").alias("n"))
        open_ = edges.select(F.col("b").alias("a")).distinct().join(pointing, "a", "left_semi")
        if pointing.where("n > 1").isEmpty() and open_.isEmpty():
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def _labelled(frame: DataFrame, column: str, labels: DataFrame, name: str) -> DataFrame:
    own = labels.select(F.col("node").alias(column), F.col("label").alias("_label"))
    return frame.join(own, column, "left").withColumn(name, F.coalesce("_label", column)).drop("_label")


def verify(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (x, y) of `pairs` whose full shingle sets are similar enough. `texts`: (node, text).

    The text of a y goes once to each `MEMBERS` of its x, which are spread by a salt.
    """
    spread = pairs.groupBy("y").agg((F.count("*") / MEMBERS).cast("long").alias("more"))
    salted = pairs.join(spread, "y").select(
        "x", "y", F.pmod(F.xxhash64("x"), F.col("more") + 1).alias("salt")
    )
    named = lambda column: texts.select(F.col("node").alias(column), "text")
    heads = salted.select("y", "salt").distinct().join(named("y"), "y").withColumn("x", F.lit(None).cast("long"))
    rows = heads.unionByName(salted.join(named("x"), "x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_set = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for part, own in slices(batch):
                values, sizes = shingle_sets(own)
                ends = np.cumsum(sizes)
                xs, ys = [], []
                for k, (x, y) in enumerate(zip(part["x"].to_pylist(), part["y"].to_pylist(), strict=True)):
                    mine = values[ends[k] - sizes[k] : ends[k]]
                    if x is None:
                        head, head_set = y, mine
                        continue
                    assert head == y
                    shared = len(np.intersect1d(head_set, mine, assume_unique=True))
                    if 100 * shared >= percent * (len(head_set) + len(mine) - shared):
                        xs.append(x)
                        ys.append(y)
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], names=["x", "y"])

    ordered = rows.repartition("y", "salt").sortWithinPartitions("y", "salt", F.col("x").asc_nulls_first())
    return ordered.select("x", "y", "text").mapInArrow(run, "x long, y long")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after the (x, y) `links` have joined components."""
    edges = _labelled(_labelled(links, "x", labels, "a"), "y", labels, "b").select("a", "b")
    merged = components(edges)
    moved = _labelled(labels.withColumnRenamed("label", "old"), "old", merged, "label").select("node", "label")
    fresh = merged.join(labels.select("node"), "node", "left_anti")
    return materialize(moved.unionByName(fresh), "labels")


def components_of(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, label, n_shingles, component_id and kept: one row per row of `documents`.

    `label` names the component (null without words), also where ids are not unique.

    component_id is the smallest doc_id among the documents that links reach, kept whether that is the
    document's own. Rows with equal shingle sets are linked, so are repeated rows; rows that share an id but
    not the set are documents of their own. Documents without words, empty or null, are linked with nothing.
    Null ids are never the smallest unless a component has no other; a row with a null id is kept only then.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    least = least_matches(percent)
    features = materialize(
        documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
            _features, f"{_id_field(documents)}, text_hash long, n_shingles long, node long, signature binary"
        ),
        "minhash",
    )
    nodes = materialize(
        features.where("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.min("n_shingles").alias("n_shingles"),
            F.min("signature").alias("signature"),
        ),
        "nodes",
    )
    bands = materialize(
        nodes.select("node", "n_shingles", "signature").mapInArrow(_band_keys, "key long, node long, n_shingles long"),
        "bands",
    )
    buckets = (
        bands.groupBy("key")
        .agg(
            F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"), F.min("node").alias("pivot")
        )
        .where("members > 1")
    )
    buckets = materialize(buckets, "buckets")
    members = materialize(bands.select("key", "node").join(buckets, "key"), "members")

    in_buckets = members.select("node").distinct().join(nodes, "node")
    texts = materialize(_texts_of(documents, in_buckets), "bucket-texts")
    signature = texts.select("node", "signature")
    star = members.where("node <> pivot").select(F.col("node").alias("x"), F.col("pivot").alias("y")).distinct()
    star = star.join(signature.toDF("x", "sx"), "x").join(signature.toDF("y", "sy"), "y")
    pruned = star.mapInArrow(_prune_pairs(least), "x long, y long, matches long")
    likeliest = pruned.groupBy("x").agg(F.max(F.struct("matches", "y")).alias("best")).select("x", "best.y")
    likeliest = materialize(likeliest, "star-pairs")
    links = materialize(verify(likeliest, texts, percent), "star-links")
    labels = _merged(spark.createDataFrame([], "node long, label long"), links)

    placed = materialize(_labelled(members, "node", labels, "label"), "placed")
    mixed = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    blocks = F.greatest(F.col("members") / BLOCK, F.col("shingles") / BLOCK_SHINGLES).cast("int") + 1
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    searched = (
        placed.join(mixed.select("key"), "key")
        .select("key", "node", "label", block.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .join(texts, "node")
        .groupBy("key", "low", "high")
        .applyInArrow(_search_block(least, percent), "x long, y long")
    )
    labels = _merged(labels, materialize(searched, "cross-links"))

    labelled = _labelled(nodes.select("node", "first_doc"), "node", labels, "label")
    smallest = labelled.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    homes = labelled.join(smallest, "label").select("node", "label", "component_id")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        features.select("doc_id", "text_hash", "n_shingles", "node")
        .join(homes, "node", "left")
        .drop("node")
        .withColumn("component_id", own)
        .withColumn("kept", same(F.col("doc_id"), F.col("component_id")))
    )


def _id_field(documents: DataFrame) -> str:
    return f"doc_id {documents.schema['doc_id'].dataType.simpleString()}"


def _texts_of(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, signature, text): one text of each node. Rows that share the id but not the set are told apart by the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                own = signed(_node_ids(*shingle_sets(texts))) == part["node"].to_numpy()
                yield part.filter(pa.array(own))

    wanted = materialize(nodes.select("node", "signature", F.col("first_doc").alias("wanted")), "bucket-nodes")
    joined = documents.select("doc_id", "text").join(
        counted(wanted, wanted.count(), BROADCAST_NODES), same(F.col("doc_id"), F.col("wanted"))
    )
    found = joined.select("node", "signature", "text").mapInArrow(run, "node long, signature binary, text string")
    return found.dropDuplicates(["node"])


def near_dedup(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`documents` with one row of each component: the kept document, in the order of its texts' hashes.

    Rows without words all stay. Columns are those of `documents`.
    """
    judged = materialize(components_of(documents, percent), "judged")
    linked = judged.where("label IS NOT NULL")
    first = linked.where("kept").groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    other = linked.join(first, "label", "left").where(~same(F.struct("doc_id", "text_hash"), F.col("first")))
    gone = materialize(other.select("doc_id", "text_hash").distinct(), "near-copies")
    repeated = materialize(
        linked.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeats"
    )

    own = fresh("_hash", documents)

    def key(left: DataFrame, right: DataFrame):
        on = same(left["doc_id"], right["doc_id"])
        return on & (left[own] == right["text_hash"])

    rows = documents.withColumn(own, F.xxhash64("text"))
    gone_side = counted(gone, gone.count(), BROADCAST_NODES)
    rest = rows.join(gone_side, key(rows, gone_side), "left_anti")
    n_repeated = repeated.count()
    if not n_repeated:
        return rest.drop(own)
    side = counted(repeated, n_repeated, BROADCAST_NODES)
    once = rest.join(side, key(rest, side), "left_anti")
    again = rest.join(side, key(rest, side), "left_semi").dropDuplicates(["doc_id", own])
    return once.unionByName(again).drop(own)
