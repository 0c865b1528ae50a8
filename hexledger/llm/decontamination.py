"""Benchmark decontamination by a prefix-filtered set join, in DataFrame expressions only.

Every benchmark item is cut into windows of `WINDOW` consecutive words (an item of fewer words is one window).
The words of all windows are ordered by how rare they are in the documents. A document that holds a window
holds its rarest word, the one prefix token that exact containment makes necessary; so only occurrences of
prefix tokens are joined. The token's place in the window bounds where the window can lie and the document's
length must hold it; what is left is verified word by word over the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexledger.llm.frames import counted, same
from hexledger.session import materialize

WINDOW = 10
# Rows of prefix tokens (or of the benchmark's words) that are broadcast at most; more are joined by shuffling.
BROADCAST_WINDOWS = 500_000

# Between words: ASCII characters that are neither letters nor digits.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text in their own case; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(win, size, tokens) for the different windows, and (win, item_id) for the items that have them.

    Items without words have no windows. An item without an id marks words, but is not listed.
    """
    items = benchmark.select("item_id", words(lower_ascii(F.col("text"))).alias("w")).where("size(w) > 0")
    cut = items.select(
        "item_id", "w", F.explode(F.expr(f"sequence(0, greatest(size(w) - {window}, 0))")).alias("at")
    ).select("item_id", F.expr(f"slice(w, at + 1, {window})").alias("tokens"))
    named = materialize(cut.withColumn("win", F.array_join("tokens", " ")), "windows")
    distinct = named.groupBy("win").agg(F.first("tokens").alias("tokens")).withColumn("size", F.size("tokens"))
    return distinct, named.select("win", "item_id").where("item_id IS NOT NULL").distinct()


def _occurrences(documents: DataFrame, *keep: str) -> DataFrame:
    """One row per word of a document: its place `at` and the word, in lower case by all of Unicode's rules.

    Equal words in A-Z lower case are equal in that case too, so joins on it lose nothing.
    """
    return documents.select(*keep, F.posexplode("w").alias("at", "word")).withColumn(
        "token", F.lower("word")
    )


def prefix_tokens(documents: DataFrame, distinct: DataFrame) -> DataFrame:
    """(token, win, size, place): the rarest word of each window and its first place in it.

    `documents` has w. Rarity is the number of occurrences in all documents; ties go by the word itself.
    """
    places = materialize(
        distinct.select("win", "size", F.posexplode("tokens").alias("place", "word"))
        .withColumn("token", F.lower("word"))
        .drop("word"),
        "window-words",
    )
    vocabulary = materialize(places.select("token").distinct(), "window-vocabulary")
    occurring = _occurrences(documents).join(
        counted(vocabulary, vocabulary.count(), BROADCAST_WINDOWS), "token", "left_semi"
    )
    counts = occurring.groupBy("token").agg(F.count("*").alias("rows"))
    rarest = places.join(counts, "token", "left").groupBy("win", "size").agg(
        F.min(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "token", "place")).alias("best")
    )
    # A window with a word that no document has can't occur.
    return rarest.where("best.rows > 0").select("best.token", "win", "size", "best.place")


def hits(documents: DataFrame, distinct: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, first, size, win): every occurrence of a window in a document.

    `documents` has doc_id, text_hash and w.
    """
    prefix = materialize(prefix_tokens(documents, distinct), "prefix-tokens")
    around = window - 1
    # The words around the token, so that a candidate can be verified wherever the join is done.
    candidates = _occurrences(documents, "doc_id", "text_hash", "w").select(
        "doc_id",
        "text_hash",
        "at",
        "token",
        F.expr(f"slice(w, greatest(at - {around}, 0) + 1, least(at, {around}) + {window})").alias("near"),
    )
    joined = candidates.join(counted(prefix, prefix.count(), BROADCAST_WINDOWS), "token")
    # Positional bound: the window begins `place` words before the token. Length bound: it ends in the text.
    in_near = f"least(at, {around}) - place"
    fits = joined.where(f"at >= place AND {in_near} + size <= size(near)")
    found = lower_ascii(F.array_join(F.expr(f"slice(near, {in_near} + 1, size)"), " "))
    return fits.where(found == F.col("win")).select(
        "doc_id", "text_hash", (F.col("at") - F.col("place")).alias("first"), "size", "win"
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    One row per row of `documents`; rows with the same id and text are judged once and repeated, null ids
    are an id. A null or empty text has no words and no hits. An empty benchmark hits nothing. A word inside
    several windows counts once. Other columns of `documents` are not looked at.
    """
    base = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    distinct, items = windows(benchmark, window)
    found = materialize(hits(base, distinct, window).distinct(), "window-hits")
    covered = (
        found.select("doc_id", "text_hash", F.explode(F.expr("sequence(first, first + size - 1)")).alias("at"))
        .distinct()
        .groupBy("doc_id", "text_hash")
        .agg(F.count("*").alias("n_hit"))
    )
    listed = (
        found.select("doc_id", "text_hash", "win")
        .distinct()
        .join(items, "win")
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    )
    keys = ["doc_id", "text_hash"]
    marked = covered.join(listed.withColumnsRenamed({k: f"l_{k}" for k in keys}), _keys("", "l_"), "left").select(
        *(F.col(k).alias(f"m_{k}") for k in keys), "n_hit", "ids"
    )
    every = base.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"))
    n_hit, ids = F.coalesce("n_hit", F.lit(0)), F.coalesce("ids", F.array().cast("array<string>"))
    return every.join(marked, _keys("", "m_"), "left").select(
        "doc_id",
        "text_hash",
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _keys(left: str, right: str) -> Column:
    doc = same(F.col(f"{left}doc_id"), F.col(f"{right}doc_id"))
    return doc & (F.col(f"{left}text_hash") == F.col(f"{right}text_hash"))
