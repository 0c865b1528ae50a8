"""Token counts by a digest cache: only texts whose content was never counted with this tokenizer are encoded.

The cache is a folder of Parquet rows (tokenizer, digest, n_tokens). `tokenizer` is a digest of the vocabulary
file, the library's version and the way content is normalised; `digest` is that of the normalised content. A run
finds the different digests of its documents, joins them to the cache, encodes one text of each digest that is
missing, appends the counts to the cache in one commit, and joins the counts to the documents. Only digests and
the texts of misses are shuffled.

Content is normalised only in ways that cannot change a count. A tokenizer that turns white space into one space
and drops it gives the same tokens whatever ASCII white space separates the words, and a pure ASCII text without
the opening of a special token may be lower-cased if the tokenizer does that anyway. Other tokenizers see the
content as it is. For the same reason a worker of a white-space tokenizer counts each different word once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexledger.llm.frames import bound_batches, counted, fresh
from hexledger.llm.text_arrays import slices
from hexledger.session import materialize, scratch_path

LIMIT = 2048
# What a worker's remembered words may hold of memory; it forgets all when there are more.
REMEMBERED_BYTES = 96 << 20
# What Python holds for a remembered word beside its own bytes: the object, its count and its share of the table.
WORD_BYTES = 160
# Texts or words handed to the library at once.
ENCODED_BYTES = 1 << 18

_CACHE = "tokenizer string, digest binary, n_tokens long"
_WHITE = r"[ \t\n\x0B\f\r]+"


class Rules:
    """What a tokenizer file allows: whether white space only separates words, and whether case is dropped."""

    def __init__(self, name: str, content: bytes) -> None:
        self.pieces = name.endswith(".model")
        spec = {} if self.pieces else json.loads(content)
        normal = spec.get("normalizer") or {}
        steps = normal.get("normalizers", [normal])
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        # The tokenizer's own step that makes one space of white space.
        spaced = any(s.get("type") == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " " for s in steps)
        dropped = split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"]
        plain = all("<|" in t["content"] and " " not in t["content"] for t in spec.get("added_tokens", []))
        self.words = bool(spaced and dropped and plain)
        self.lower = self.words and any(s.get("type") == "Lowercase" for s in steps)

    def normalised(self, text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        if not self.words:
            return text
        spaced = F.trim(F.regexp_replace(text, _WHITE, " "))
        if not self.lower:
            return spaced
        plain = (F.octet_length(text) == F.char_length(text)) & ~F.contains(text, F.lit("<|"))
        return F.when(plain, F.lower(spaced)).otherwise(spaced)


class Counter:
    """The tokenizer of one worker, in a dict that the worker keeps between tasks."""

    def __init__(self, state: dict) -> None:
        if "encode" not in state:
            if state["pieces"]:
                from sentencepiece import SentencePieceProcessor

                processor = SentencePieceProcessor(model_proto=state["content"])
                state["encode"] = lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]
            else:
                import os

                from tokenizers import Tokenizer

                os.environ["TOKENIZERS_PARALLELISM"] = "false"
                tokenizer = Tokenizer.from_str(state["content"].decode())
                tokenizer.no_truncation()
                tokenizer.no_padding()
                state["encode"] = lambda texts: [
                    len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)
                ]
            state.update(known={}, held=0)
        self.state = state

    def counts(self, texts: list[bytes]) -> list[int]:
        if not self.state["words"]:
            return self.encoded(texts)
        words = [t.split() for t in texts]  # bytes split at ASCII white space only
        known = self.state["known"]
        new = {w for each in words for w in each if w not in known}
        self.state["held"] += self.memory(new)
        if self.state["held"] > REMEMBERED_BYTES:
            known.clear()
            new = {w for each in words for w in each}
            self.state["held"] = self.memory(new)
        new = list(new)
        known.update(zip(new, self.encoded(new), strict=True))
        return [sum(map(known.__getitem__, each)) for each in words]

    @staticmethod
    def memory(words: set[bytes]) -> int:
        return sum(map(len, words)) + WORD_BYTES * len(words)

    def encoded(self, texts: list[bytes]) -> list[int]:
        out, batch, size = [], [], 0
        for text in texts:
            if batch and size + len(text) > ENCODED_BYTES:
                out += self.state["encode"](batch)
                batch, size = [], 0
            batch.append(text.decode())
            size += len(text)
        return out + (self.state["encode"](batch) if batch else [])


def tokenizer_digest(path: str, content: bytes) -> str:
    """Names the counts: the file, the library that reads it, and the way of normalising."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    rules = Rules(path, content)
    said = f"{library} {version(library)} words={rules.words} lower={rules.lower}"
    return hashlib.sha256(content + said.encode()).hexdigest()


def _stored(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of the cache for one tokenizer; repeated appends of a digest count once."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    rows = spark.read.schema(_CACHE).parquet(cache).where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(documents: DataFrame, tokenizer_path: str, cache: str | None = None) -> DataFrame:
    """`documents` with `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `LIMIT` tokens).

    One row per row of `documents`, repeated or not, whatever its id. Null and empty texts have no bytes and no
    tokens. Special strings inside a text count as the library takes them by default. Columns of the input with
    one of the three names are replaced, all others stay. `cache` is a folder that Spark can write, kept between
    runs and appended to in one commit; without one, counts are kept for this call only.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    cache = cache or scratch_path(spark, "token-cache")
    with open(tokenizer_path, "rb") as file:
        content = file.read()
    rules, tokenizer = Rules(tokenizer_path, content), tokenizer_digest(tokenizer_path, content)
    # The vocabulary file: a few MB.
    state = spark.sparkContext.broadcast({"content": content, "pieces": rules.pieces, "words": rules.words})

    rest = documents.drop("n_bytes", "n_tokens", "over_limit")
    key = fresh("digest", rest)
    normal = rules.normalised(F.col("text"))
    digest = F.unhex(F.sha2(normal.cast("binary"), 256))
    wanted = materialize(rest.select(digest.alias("digest")).distinct(), "token-digests")
    n_wanted = wanted.count()

    def of_this_run() -> DataFrame:
        return _stored(spark, cache, tokenizer).join(counted(wanted, n_wanted), "digest", "left_semi")

    missing = materialize(wanted.join(of_this_run(), "digest", "left_anti"), "token-misses")
    n_missing = missing.count()
    texts = rest.select(digest.alias("digest"), normal.alias("text"))
    one_each = texts.join(counted(missing, n_missing), "digest", "left_semi").dropDuplicates(["digest"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(state.value)
        for batch in batches:
            for part, of in slices(batch):
                data, cuts = of.data.tobytes(), of.offsets.tolist()
                n = counter.counts([data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), pa.array(np.array(n, dtype=np.int64))], ["digest", "n_tokens"]
                )

    if n_missing:
        one_each.mapInArrow(count, "digest binary, n_tokens long").select(
            F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens"
        ).write.mode("append").partitionBy("tokenizer").parquet(cache)
    counts = of_this_run().withColumnRenamed("digest", key)
    return (
        rest.withColumn(key, digest)
        .withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
        .join(counted(counts, n_wanted), key, "left")
        .drop(key)
        .withColumn("over_limit", F.col("n_tokens") > LIMIT)
    )
