"""Line deduplication: later copies of repeated line runs are deleted. DataFrame expressions only.

The corpus is one sequence of line ids in the order (doc_id, line); runs do not cross documents. Distributed
prefix doubling ranks the suffixes of this sequence: the rank of a suffix by its first 2n lines follows from
its ranks by n lines and the rank of the suffix n lines on. Suffixes that are alone in their rank can't start
a repeated run and drop out at once, so after the first round only repeated lines are left. Suffixes with
equal first lines form an interval of the suffix array with that longest common prefix; the first of them in
corpus order is the original, the others start later copies.

A repeated run is deleted where it is not the first of its interval and has at least `MIN_WORDS` words. The
lines of all such runs, up to the maximal ones, are those of the runs that are minimal from the left (from a
line on, as few lines as have that many words) or from the right (up to a line), so these are looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexledger.llm.frames import counted, fresh, same
from hexledger.operators.rows import surrogate_key
from hexledger.session import materialize

MIN_WORDS = 10
# Documents with deleted lines that are broadcast at most; more are joined by shuffling.
BROADCAST_DOCUMENTS = 200_000

_DOC = ["doc_id", "text_hash"]


def document_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line, id, words): every line of every document."""
    hashed = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").where("text IS NOT NULL")
    lines = hashed.select(*_DOC, F.posexplode(F.split("text", "\n")).alias("line", "content"))
    words = F.size(F.array_remove(F.split("content", r"[\x20\x09-\x0D]+"), ""))
    return lines.select(*_DOC, "line", F.xxhash64("content").alias("id"), words.alias("words"))


def _ranked(keys: DataFrame, name: str, *order: str) -> DataFrame:
    """The different keys that occur more than once, with their rank in sorted order as `name`."""
    repeated = keys.groupBy(*order).agg(F.count("*").alias("rows")).where("rows > 1").drop("rows")
    return surrogate_key(repeated, list(order), name)


def repeated_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line, words, rank) of the lines that occur more than once in the corpus."""
    # Rows that repeat a document are the same document.
    stored = materialize(document_lines(documents.select("doc_id", "text")).distinct(), "lines")
    ranks = _ranked(stored.select("id"), "rank", "id")
    return materialize(stored.join(ranks, "id").select(*_DOC, "line", "words", "rank"), "repeated-lines")


def doubled(ranks: DataFrame, length: int) -> DataFrame:
    """Ranks by 2 * length lines from ranks by `length` lines, of the suffixes that are not alone."""
    later = ranks.select(*_DOC, (F.col("line") - length).alias("line"), F.col("rank").alias("next_rank"))
    pairs = materialize(_join(ranks.select(*_DOC, "line", "rank"), later), f"pairs-{length}")
    named = _ranked(pairs.select("rank", "next_rank"), "name", "rank", "next_rank")
    return materialize(
        pairs.join(named, ["rank", "next_rank"]).select(*_DOC, "line", F.col("name").alias("rank")),
        f"ranks-{2 * length}",
    )


def _join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on document and line; null ids are an id."""
    other = right.withColumnsRenamed({"doc_id": "r_doc", "text_hash": "r_hash", "line": "r_line"})
    on = same(F.col("doc_id"), F.col("r_doc")) & (F.col("text_hash") == F.col("r_hash"))
    return left.join(other, on & (F.col("line") == F.col("r_line")), how).drop("r_doc", "r_hash", "r_line")


def minimal_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_hash, line, length): runs of repeated lines that are minimal from the left or right."""
    doc = Window.partitionBy(*_DOC).orderBy("line")
    # Unbroken stretches of repeated lines, with the words up to each line.
    stretch = [*_DOC, "stretch"]
    placed = lines.withColumn("stretch", F.col("line") - F.row_number().over(doc))
    upto = F.sum("words").over(Window.partitionBy(*stretch).orderBy("line"))
    placed = placed.select(*stretch, "line", upto.alias("upto"), (upto - F.col("words")).alias("before"))

    def nearest(point: str, query: Column, query_first: bool) -> DataFrame:
        """Each line with the nearest line whose `point` is not under (or not over) its `query`."""
        points = placed.select(*stretch, "line", F.col(point).alias("value"), F.lit(1).alias("kind"))
        asked = placed.select(
            *stretch, "line", query.alias("value"), F.lit(0 if query_first else 2).alias("kind")
        )
        order = Window.partitionBy(*stretch).orderBy("value", "kind", "line")
        at = F.when(F.col("kind") == 1, F.col("line"))
        if query_first:
            found = F.first(at, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
        else:
            found = F.last(at, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
        return points.unionByName(asked).withColumn("found", found).where("kind <> 1 AND found IS NOT NULL")

    left = nearest("upto", F.col("before") + min_words, True)
    right = nearest("before", F.col("upto") - min_words, False)
    length = (F.col("found") - F.col("line") + 1).alias("length")
    return (
        left.select(*_DOC, "line", length)
        .unionByName(
            right.select(*_DOC, F.col("found").alias("line"), (F.col("line") - F.col("found") + 1).alias("length"))
        )
        .distinct()
    )


def later_copies(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, line, length): the looked-up runs that start earlier in the corpus too."""
    runs = materialize(minimal_runs(lines, min_words), "minimal-runs")
    longest = runs.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]
    ranks, length, found = lines, 1, None
    while length <= longest:
        # Runs of length to 2 * length - 1 lines: two blocks of `length` lines cover them.
        own = runs.where((F.col("length") >= length) & (F.col("length") < 2 * length))
        first = _join(own, ranks.select(*_DOC, "line", F.col("rank").alias("first_rank")))
        ends = first.withColumn("line", F.col("line") + F.col("length") - length)
        both = _join(ends, ranks.select(*_DOC, "line", F.col("rank").alias("last_rank")))
        both = both.withColumn("line", F.col("line") - F.col("length") + length)
        found = both if found is None else found.unionByName(both)
        if 2 * length <= longest:
            ranks = doubled(ranks, length)
        length *= 2
    if found is None:
        return runs.limit(0)
    stored = materialize(found, "ranked-runs")
    interval = ["length", "first_rank", "last_rank"]
    origin = (
        stored.groupBy(*interval)
        .agg(F.count("*").alias("rows"), F.min(F.struct(*_DOC, "line")).alias("origin"))
        .where("rows > 1")
        .drop("rows")
    )
    # Written, so that the join below deals both sides anew and a frequent run can be split over tasks.
    return (
        stored.join(materialize(origin, "origins"), interval)
        .where(~same(F.struct(*_DOC, "line"), F.col("origin")))
        .select(*_DOC, "line", "length")
    )


def deleted_runs(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, runs): the maximal stretches of deleted lines of each document, as (from, to)."""
    copies = later_copies(repeated_lines(documents), min_words)
    gone = copies.select(*_DOC, F.explode(F.expr("sequence(line, line + length - 1)")).alias("line")).distinct()
    doc = Window.partitionBy(*_DOC).orderBy("line")
    return (
        gone.withColumn("stretch", F.col("line") - F.row_number().over(doc))
        .groupBy(*_DOC, "stretch")
        .agg(F.min("line").alias("from"), F.max("line").alias("to"))
        .groupBy(*_DOC)
        .agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("runs"))
    )


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`documents` with the remaining text, n_lines, n_removed (lines) and n_runs (maximal deleted stretches).

    One row per row. Rows that repeat a document (same id, same text) are that document and get the same
    result; rows that share an id but not the text are ordered by a hash of the text; null ids come first.
    A null text stays null and has no lines; an empty one has one line without words. Lines without words are
    deleted only inside a run. Columns that clash with the new names are replaced.
    """
    new = ["n_lines", "n_removed", "n_runs"]
    rows = documents.drop(*new)
    doc, text_hash, gone = (fresh(c, rows) for c in ("_doc", "_hash", "_runs"))
    runs = materialize(deleted_runs(documents, min_words), "deleted-runs").withColumnsRenamed(
        {"doc_id": doc, "text_hash": text_hash, "runs": gone}
    )
    on = same(F.col("doc_id"), F.col(doc)) & (F.xxhash64("text") == F.col(text_hash))
    joined = rows.join(counted(runs, runs.count(), BROADCAST_DOCUMENTS), on, "left")
    lines = F.split("text", "\n")
    # The stretches between the deleted ones.
    kept = F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform(gone, lambda r: r["to"] + 1)),
        F.concat(F.transform(gone, lambda r: r["from"]), F.array(F.size(lines))),
        lambda first, after: F.struct(first.alias("first"), after.alias("after")),
    )
    kept = F.filter(kept, lambda k: k["first"] < k["after"])
    rest = F.array_join(F.flatten(F.transform(kept, lambda k: F.slice(lines, k["first"] + 1, k["after"] - k["first"]))), "\n")
    removed = F.aggregate(gone, F.lit(0), lambda n, r: n + r["to"] - r["from"] + 1)
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(rest)
    return joined.select(
        *(text.alias("text") if c == "text" else F.col(c) for c in rows.columns),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.coalesce(removed, F.lit(0)).alias("n_removed"),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias("n_runs"),
    )
