"""Token counts against the libraries, and what the cache saves."""

from __future__ import annotations

import os
import random
import sys

import public_tokenizers
import pytest
from cases import documents, prose, texts

from hexledger.llm import token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")


def library_count(path: str, text: str) -> int:
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        return len(SentencePieceProcessor(model_file=path).encode(text))
    from tokenizers import Tokenizer

    return len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


def odd_texts() -> list[str]:
    """Where folding of white space or case could change a count."""
    marks = ["J̌", "H̱", "İ", "É", "İ", "ΣΑΣ", "KK", "한가"]
    special = ["<|endoftext|>", "<|ENDOFTEXT|>", "a<|endoftext|>b", "<| endoftext|>", "<|startoftext|><|endoftext|>"]
    spaces = ["\x1c", "\x85", "\xa0", " ", "​", "\t\n\x0b\x0c\r ", " ́", "\ńx"]
    dice, parts = random.Random(4), ["It's", "DON'T", "x1y22", "!!", "\U0001f600", "Stra\xdfe", *marks, *special, *spaces]
    return [*parts, *("".join(dice.choice(parts + [" ", "  "]) for _ in range(12)) for _ in range(150))]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_are_those_of_the_library(spark, name):
    path = public_tokenizers.path(name)
    rows = texts() + [(1000 + k, t) for k, t in enumerate(odd_texts())]
    rows += [(5000, "word " * 3000), (5001, "ab" * 40_000), (5002, prose(30, 100).replace(" ", "\n\n")), (5003, prose(30, 100).upper())]
    got = token_counts.count_tokens(documents(spark, rows), path).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), library_count(path, text)), text[:80]
        assert r.over_limit == (r.n_tokens > 2048) and r.score == "own" and r.text_hash == "h"
    assert token_counts.count_tokens(documents(spark, []), path).count() == 0


def test_only_distinct_misses_are_encoded_and_appended(spark, tmp_path):
    cache = str(tmp_path / "cache")

    def files() -> set[str]:
        return {os.path.join(d, f) for d, _, names in os.walk(cache) for f in names if f.endswith(".parquet")}

    def stored():
        return spark.read.parquet(cache).collect()

    first = [(1, "one two"), (2, "ONE \n two "), (3, "three"), (4, None), (5, ""), (6, " \t")]
    counts = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(documents(spark, first), WORDS, cache).collect()}
    assert counts == {1: 2, 2: 2, 3: 1, 4: 0, 5: 0, 6: 0}
    assert len(stored()) == 3  # of equal normalised content one; the empty content is one too
    before = files()
    # Stored counts are used: a cache that says something else is believed.
    again = token_counts.count_tokens(documents(spark, first), WORDS, cache)
    assert {r.doc_id: r.n_tokens for r in again.collect()} == counts
    assert files() == before
    more = [*first, (7, "four five six"), (8, "four five six")]
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(documents(spark, more), WORDS, cache).collect()}[8] == 3
    assert len(stored()) == 4 and before < files()
    # Another tokenizer has its own counts; the first one's stay.
    other = public_tokenizers.path("byte_bpe_50k.json")
    token_counts.count_tokens(documents(spark, first), other, cache).collect()
    assert len({r.tokenizer for r in stored()}) == 2
    # A digest that was appended twice still gives one row per document.
    spark.createDataFrame(stored()).write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert token_counts.count_tokens(documents(spark, more), WORDS, cache).count() == len(more)


def test_large_sides_are_joined_by_shuffling(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "counted", lambda small, rows: small)
    rows = texts() * 3
    got = token_counts.count_tokens(documents(spark, rows), WORDS).collect()
    assert len(got) == len(rows)
    assert all(r.n_tokens == library_count(WORDS, r.text or "") for r in got[:20])


def test_remembered_words_are_forgotten_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED_BYTES", 60)
    with open(WORDS, "rb") as file:
        counter = token_counts.Counter({"content": file.read(), "pieces": False, "words": True})
    for k in range(30):
        text = prose(k, 30)
        assert counter.counts([text.encode(), b""]) == [library_count(WORDS, text), 0]
        assert sum(map(len, counter.state["known"])) <= max(60, len(text))


def test_short_words_are_counted_with_what_python_holds_for_them(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED_BYTES", 1 << 20)
    with open(WORDS, "rb") as file:
        counter = token_counts.Counter({"content": file.read(), "pieces": False, "words": True})
    for k in range(20):
        text = " ".join(f"{n:x}" for n in range(1000 * k, 1000 * (k + 1)))
        assert counter.counts([text.encode()]) == [library_count(WORDS, text)]
        known = counter.state["known"]
        assert sys.getsizeof(known) + sum(map(sys.getsizeof, known)) <= 1 << 20
