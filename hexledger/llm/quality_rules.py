"""Quality rules: base counts, and a likelihood ratio of byte n-grams.

Two multinomials over all different grams of `GRAM_BYTES` bytes are counted over whole corpora: one over the trusted
target documents, one over all documents. A document's score is the mean over its grams of
log(target probability / raw probability); documents under a fixed threshold are rejected. Junk is rare in
the target and common in the raw corpus, so its grams score far below zero, while clean text stays close to it.
Byte grams, unlike grams of words, are dense even in a small target, so a clean document does not fail for
words that the target happens to lack. The counts are a table of as many rows as there are different grams; its
ratios are broadcast up to a counted size, beyond it they are joined to the grams of each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexledger.llm.frames import bound_batches, counted, fresh
from hexledger.llm.text_arrays import WHITE, Texts, mix, slices, word_ngrams
from hexledger.session import materialize

# A mean ratio is rounded to so many digits, so that the order of a sum decides no verdict.
DIGITS = 9
# The log ratios are broadcast up to this many different grams (12 bytes each); more are joined by shuffling.
BROADCAST_GRAMS = 1 << 22
# A task hands its counts on when it holds this many rows of them.
PENDING_GRAMS = 1 << 19
# Added to every count, as a share of the mean count of a gram.
SMOOTHING = 1.0
# A gram is an int.
GRAM_BYTES = 4
# Mean log ratio under which a document is rejected.
THRESHOLD = -0.35
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """All grams of the documents, and how many each document has."""
    n = max(len(texts.data) - GRAM_BYTES + 1, 0)
    whole = np.zeros(len(texts.data), dtype=bool)
    whole[:n] = True
    for k in range(1, GRAM_BYTES):  # grams that would reach into the next document
        ends = texts.offsets[1:] - k
        whole[ends[(ends >= texts.offsets[:-1]) & (ends >= 0)]] = False
    grams = np.zeros(n, dtype=np.uint32)
    for k in range(GRAM_BYTES):
        grams <<= np.uint32(8)
        grams |= texts.data[k : n + k]
    return grams[whole[:n]], texts.per_document(whole)


def _added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), dtype=bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        grams = (keys >> np.uint64(1)).astype(np.uint32).view(np.int32)
        target = np.where(keys & np.uint64(1), counts, 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(grams), pa.array(counts), pa.array(target)], names=["gram", "raw", "target"]
        )

    pending, held = [], 0
    for batch in batches:
        for part, texts in slices(batch):
            grams, n = _grams(texts)
            trusted = part.column("trusted").to_numpy(zero_copy_only=False).astype(np.uint64)
            # Grams of trusted and of other documents are counted apart.
            keys = grams.astype(np.uint64) << np.uint64(1) | np.repeat(trusted, n)
            pending.append(np.unique(keys, return_counts=True))
            held += len(pending[-1][0])
            if held > PENDING_GRAMS:
                pending = [_added_up(*map(np.concatenate, zip(*pending, strict=True)))]
                held = len(pending[0][0])
                if held > PENDING_GRAMS // 2:
                    yield rows(*pending[0])
                    pending, held = [], 0
    if pending:
        yield rows(*_added_up(*map(np.concatenate, zip(*pending, strict=True))))


def gram_counts(documents: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """(gram, raw, target): how often each gram occurs in all and in trusted documents.

    `trusted_ids` has one column doc_id; repeated and null ids count once and not at all. Each task adds up
    many texts before it emits a gram's count, so a frequent gram is no hot key.
    """
    bound_batches(documents.sparkSession)
    ids = materialize(trusted_ids.select("doc_id").where("doc_id IS NOT NULL").distinct(), "trusted-ids")
    flagged = documents.select("doc_id", "text").join(
        counted(ids.withColumn("trusted", F.lit(True)), ids.count()), "doc_id", "left"
    )
    return (
        flagged.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
        .mapInArrow(_count_grams, "gram int, raw long, target long")
        .groupBy("gram")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )


def gram_ratios(counts: DataFrame) -> DataFrame:
    """(gram, ratio): log(target probability / raw probability).

    Without any trusted text there are no rows: nothing is known, so nothing is rejected.
    """
    totals = counts.agg(F.count("*").alias("n"), F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    if not totals["target"]:
        return counts.where("false").select("gram", F.lit(0.0).alias("ratio"))
    # The same share of pseudo-counts, spread as the raw corpus is.
    weight = SMOOTHING * totals["n"]
    prior = (F.col("raw") + 1) / F.lit(float(totals["raw"] + totals["n"]))

    def probability(of: str) -> Column:
        return (F.col(of) + F.lit(weight) * prior) / F.lit(totals[of] + weight)

    return counts.select("gram", (F.log(probability("target")) - F.log(probability("raw"))).alias("ratio"))


def _to_driver(ratios: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = ratios.toArrow()
    grams = table.column("gram").to_numpy().astype(np.int32).view(np.uint32)
    order = np.argsort(grams)
    return grams[order], table.column("ratio").to_numpy()[order]


def log_ratios(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The grams of `gram_ratios` in order, and their ratios, for tables of at most `BROADCAST_GRAMS` rows."""
    return _to_driver(gram_ratios(counts))


def _ratios_of(grams: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ratio of each gram; one that is not in the table has 0."""
    known, ratios = table
    if not len(known):
        return np.zeros(len(grams))
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    return np.where(known[at] == grams, ratios[at], 0.0)


def _base(texts: Texts) -> dict[str, np.ndarray]:
    n = len(texts)
    prefix = texts.prefix()
    starts, ends = texts.words()
    words, document = texts.segment_hash(prefix, starts, ends), texts.document_of(starts)
    n_words = np.bincount(document, minlength=n)
    ink = ~WHITE[texts.data]
    starts, ends = texts.lines()
    inked = np.concatenate(([0], np.cumsum(ink)))
    has_word = inked[ends] > inked[starts]
    starts, ends = starts[has_word], ends[has_word]
    line_document = texts.document_of(starts)
    lines = mix(texts.segment_hash(prefix, starts, ends) + mix(line_document.astype(np.uint64)))
    order = np.argsort(lines, kind="stable")
    again = np.zeros(len(lines), dtype=bool)
    again[order[1:]] = lines[order[1:]] == lines[order[:-1]]

    triples, first = word_ngrams(words, document, 3)
    triples = mix(triples + mix(document[first].astype(np.uint64)))
    order = np.argsort(triples)
    equal = triples[order[1:]] == triples[order[:-1]]
    twice = np.zeros(len(triples), dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    repeated = np.zeros(len(words), dtype=bool)
    for k in range(3):
        repeated[first[twice] + k] = True
    return {
        "n_words": n_words,
        "word_chars": texts.per_document(ink & ((texts.data & 0xC0) != 0x80)),
        "n_symbols": texts.per_document(_SYMBOL[texts.data]),
        "n_dup_lines": np.bincount(line_document[again], minlength=n),
        "n_repeat_words": np.bincount(document[repeated], minlength=n),
    }


def judge(
    documents: DataFrame, ratios: tuple[np.ndarray, np.ndarray] | DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """`documents` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept.

    `ratios` is what `log_ratios` gives, or the table of `gram_ratios`, which is then joined. One row per row of
    `documents`, repeated or not. A null text has no words; a text without words fails the base rules and has
    llr 0. Columns of the input that clash with the new names are replaced.
    """
    if isinstance(ratios, DataFrame):
        return _judge_by_join(documents, ratios, threshold)
    spark = documents.sparkSession
    bound_batches(spark)
    table = spark.sparkContext.broadcast(ratios)
    new = {
        "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
        "n_repeat_words": "long", "base_failed": "boolean", "llr": "double", "kept": "boolean",
    }
    rest = documents.drop(*new)
    kept_fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                base = _base(texts)
                grams, n = _grams(texts)
                owner = np.repeat(np.arange(len(texts)), n)
                sums = np.bincount(owner, weights=_ratios_of(grams, table.value), minlength=len(texts))
                llr = np.round(np.where(n > 0, sums / np.maximum(n, 1), 0.0), DIGITS)
                failed = (base["n_words"] < MIN_WORDS) | (
                    100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"]
                )
                columns = [base[c] for c in list(new)[:5]] + [failed, llr, ~failed & (llr >= threshold)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *map(pa.array, columns)], names=[*part.schema.names, *new]
                )

    return rest.mapInArrow(run, ", ".join([*kept_fields, *(f"{k} {v}" for k, v in new.items())]))


def _text_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch):
            grams, n = _grams(texts)
            owner = np.repeat(np.arange(len(texts), dtype=np.uint64), n)
            keys, counts = np.unique(owner << np.uint64(32) | grams, return_counts=True)
            texts_of = part.column("_text_key").take(pa.array((keys >> np.uint64(32)).astype(np.int64)))
            grams = pa.array(keys.astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays([texts_of, grams, pa.array(counts)], names=["_text_key", "gram", "n"])


def _judge_by_join(documents: DataFrame, ratios: DataFrame, threshold: float) -> DataFrame:
    """The same with a table of any size: a row per text and different gram meets the gram's ratio."""
    key = F.expr("substr(unhex(sha2(coalesce(text, ''), 256)), 1, 16)")
    nothing = np.zeros(0, dtype=np.uint32), np.zeros(0)
    based = judge(documents, nothing, threshold)
    # Rows of equal texts have the same grams, so that repeats do not change the mean.
    llrs = (
        documents.select("text", key.alias("_text_key"))
        .mapInArrow(_text_grams, "_text_key binary, gram int, n long")
        .join(ratios, "gram", "left")
        .groupBy("_text_key")
        .agg((F.sum(F.col("n") * F.coalesce("ratio", F.lit(0.0))) / F.sum("n")).alias("_llr"))
    )
    own_key, own_llr = fresh("_text_key", based), fresh("_llr", based)
    llrs = llrs.withColumnsRenamed({"_text_key": own_key, "_llr": own_llr})
    joined = based.withColumn(own_key, key).join(llrs, own_key, "left")
    return (
        joined.withColumn("llr", F.round(F.coalesce(own_llr, F.lit(0.0)), DIGITS))
        .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
        .select(*(f"`{c}`" for c in based.columns))
    )


def quality_rules(documents: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Count both multinomials over `documents`, then judge every document by them."""
    counts = materialize(gram_counts(documents, trusted_ids), "gram-counts")
    ratios = gram_ratios(counts)
    small = ratios.count() <= BROADCAST_GRAMS
    return judge(documents, _to_driver(ratios) if small else ratios, threshold)


def trusted(labels: DataFrame) -> DataFrame:
    """The documents labelled good and not toxic; null labels trust nothing."""
    return labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")
