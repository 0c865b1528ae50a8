"""The operators on documents against plain Python, on awkward rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from cases import documents, prose, texts

from hexledger.llm import (
    bpe,
    decontamination,
    line_dedup,
    near_dedup,
    quality_classifier,
    quality_rules,
    sharding,
    suffix_dedup,
)

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def white_words(text: str | None) -> list[str]:
    return [w for w in SPACE.split(text or "") if w]


def ascii_lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


# Quality rules


def base_counts(text: str | None) -> tuple:
    text = text or ""
    words = white_words(text)
    lines = [line for line in text.split("\n") if white_words(line)]
    triples = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(triples)
    repeated = {k + j for k, t in enumerate(triples) if often[t] > 1 for j in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
        len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    )


def test_base_counts_and_verdicts(spark, docs, empty):
    trusted = spark.createDataFrame([(1,), (9,), (9,), (None,), (16,), (99,)], "doc_id long")
    rows = quality_rules.quality_rules(docs, trusted).collect()
    assert len(rows) == len(texts())
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == base_counts(r.text)
        assert r.kept == (not r.base_failed and r.llr >= quality_rules.THRESHOLD)
        assert isinstance(r.kept, bool) and r.score == "own"  # `kept` is replaced, other columns stay
    assert quality_rules.quality_rules(empty, trusted).count() == 0


def test_ratio_is_that_of_the_counted_grams(spark, docs):
    import numpy as np

    trusted = spark.createDataFrame([(1,), (9,), (16,)], "doc_id long")
    counts = quality_rules.gram_counts(docs, trusted).collect()
    n = quality_rules.GRAM_BYTES
    grams = [max(len((t or "").encode()) - n + 1, 0) for _, t in texts()]
    assert sum(r.raw for r in counts) == sum(grams)
    assert sum(r.target for r in counts) == sum(g for g, (i, _) in zip(grams, texts(), strict=True) if i in (1, 9, 16))
    none = quality_rules.log_ratios(quality_rules.gram_counts(docs, trusted.limit(0)))
    assert not np.any(none)


def test_junk_is_rejected_and_clean_text_kept(spark):
    clean = [(k, prose(100 + k, 150)) for k in range(60)]
    junk = [(100 + k, " ".join(w.upper() + "!!" for w in prose(500 + k, 150).split())) for k in range(20)]
    trusted = spark.createDataFrame([(k,) for k in range(30)], "doc_id long")
    rows = quality_rules.quality_rules(documents(spark, clean + junk), trusted).collect()
    assert {r.doc_id for r in rows if r.kept} == {k for k, _ in clean}


@pytest.mark.parametrize("vocabulary", [5_000, 110_000])
def test_junk_is_rejected_however_many_grams_the_corpus_has(spark, vocabulary):
    import numpy as np

    dice = np.random.default_rng(7)
    # Words of four characters of three bytes; each is used eight times. At the larger size 788,420 different grams.
    words = ["".join(map(chr, w)) for w in dice.integers(0x4E00, 0x9FA5, (vocabulary, 4))]
    used = [words[k] for _ in range(8) for k in dice.permutation(vocabulary)]
    clean = [(k, " ".join(used[k * 400 : k * 400 + 400])) for k in range(len(used) // 400)]
    junk = [
        (10_000 + k, " ".join("".join(map(chr, w)) for w in dice.integers(0x21, 0x7F, (150, 6)))) for k in range(10)
    ]
    trusted = spark.createDataFrame([(k,) for k, _ in clean[::2]], "doc_id long")
    rows = documents(spark, clean + junk)
    if vocabulary > 100_000:
        assert quality_rules.gram_counts(rows, trusted).count() == 788_420
    kept = {r.doc_id for r in quality_rules.quality_rules(rows, trusted).where("kept").select("doc_id").collect()}
    assert kept == {k for k, _ in clean}


def test_joined_ratios_score_as_broadcast_ones(spark, docs, monkeypatch):
    trusted = spark.createDataFrame([(1,), (9,), (16,)], "doc_id long")

    def rows():
        found = quality_rules.quality_rules(docs, trusted).drop("score").collect()
        return sorted((str(r.doc_id), str(r.text), r.n_words, r.base_failed, r.kept, round(r.llr, 9)) for r in found)

    sent = rows()
    assert len(sent) == len(texts()) and any(r[-1] for r in sent)
    monkeypatch.setattr(quality_rules, "BROADCAST_GRAMS", 10)
    monkeypatch.setattr(quality_rules, "PENDING_GRAMS", 10)
    assert rows() == sent


# Quality classifier


def test_scores_all_rows_and_learns(spark, docs, empty):
    clean = [(k, prose(k, 120)) for k in range(150)]
    junk = [(200 + k, " ".join(w + "%%%" for w in prose(900 + k, 120).split())) for k in range(60)]
    labels = spark.createDataFrame(
        [(k, 1, 0) for k, _ in clean] + [(k, 0, 1) for k, _ in junk] + [(None, 1, 0), (3, None, 0), (3, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    rows = documents(spark, clean + junk)
    weights = quality_classifier.train(rows, labels)
    scored = quality_classifier.score(rows, weights).collect()
    wrong = [r for r in scored if (r.predicted == 1) != (r.doc_id < 200)]
    assert len(wrong) <= 0.02 * len(scored)
    every = quality_classifier.score(docs, weights).collect()
    assert len(every) == len(texts()) and all(0 <= r.score <= 1 for r in every)
    wordless = {r.score for r in every if not white_words(r.text)}
    assert len(wordless) == 1
    assert quality_classifier.score(empty, weights).count() == 0
    untaught = quality_classifier.train(rows, labels.limit(0))
    assert {r.score for r in quality_classifier.score(docs, untaught).collect()} == {0.5}


def test_held_out_rows_are_not_learnt_from(spark):
    from zlib import crc32

    from pyspark.sql import functions as F

    rows = spark.range(500).select(F.col("id"), quality_classifier.held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    labels = spark.createDataFrame([(k, 1) for k in range(100)], "doc_id long, quality int")
    used = quality_classifier.training_rows(documents(spark, [(k, "a b") for k in range(100)]), labels)
    assert {r.doc_id for r in used.collect()} == {k for k in range(100) if crc32(str(k).encode()) % 4 != 2}


# Suffix-array dedup


def removed_bytes(rows):
    """Rows with None as the smallest id; strings are judged on the input."""
    order = lambda i: -1 if i is None else i
    first: dict[bytes, int] = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, d in data:
        for k in range(len(d) - 49):
            s = d[k : k + 50]
            first[s] = min(first.get(s, order(i)), order(i))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - 49):
            if first[d[k : k + 50]] < order(i):
                gone[k : k + 50] = b"\1" * 50
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((i, len(d), sum(gone), kept, tuple((a, b - a) for a, b in spans)))
    return out


@pytest.mark.parametrize("heavy, chunk, bucket", [(256, 1 << 21, 1 << 25), (2, 4000, 20000)])
def test_repeats_are_removed(docs, empty, monkeypatch, heavy, chunk, bucket):
    monkeypatch.setattr(suffix_dedup, "HEAVY_CHUNKS", heavy)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket)
    rows = suffix_dedup.remove_repeats(docs).collect()
    got = Counter(
        (r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept), tuple((s["start"], s["bytes"]) for s in r.spans)) for r in rows
    )
    assert got == Counter(removed_bytes(texts()))
    assert all(r.n_spans == len(r.spans) for r in rows)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_one_string_in_every_chunk_is_sent_once(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 200)
    shared = prose(77, 20)
    rows = [(k, prose(1000 + k, 20) + shared + prose(2000 + k, 5)) for k in range(60)]
    got = suffix_dedup.remove_repeats(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed) for r in got) == Counter(r[:3] for r in removed_bytes(rows))
    # The same id in many chunks: the smallest chunk sends it, with the documents of all.
    import numpy as np
    import pyarrow as pa

    ids = np.array([5, 9], dtype=np.uint64).tobytes()
    least, most = np.array([40, 50]), np.array([40, 60])
    parse = []
    for k in range(100):
        base, low, span = suffix_dedup._pack_documents(least + k, most + k)
        parse.append((3, 0, 100 - k, ids, base, low, span))
    names = ["bucket", "part", "chunk", "idents", "base", "least", "span"]
    table = pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in parse])
    out = suffix_dedup._wanted(table).to_pylist()
    assert [r["chunk"] for r in out] == [1]
    low, high = suffix_dedup._unpack_documents(out[0], 2)
    assert low.tolist() == [40, 50] and high.tolist() == [139, 159]


def test_chunks_of_one_scan_task_are_dealt_to_many(spark, monkeypatch):
    from pyspark.sql.functions import input_file_name

    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 400)
    rows = documents(spark, [(k, prose(3000 + k, 20)) for k in range(500)]).coalesce(1)
    corpus, total = suffix_dedup._corpus(rows)
    held = [r["count"] for r in corpus.groupBy(input_file_name()).count().collect()]
    assert len(held) > 0.6 * (total // 1600) > 8 and max(held) < sum(held) / 5


def test_documents_survive_packing():
    import numpy as np

    least = np.array([-(2**63), -5, 0, 7, 2**40])
    most = np.array([2**62, -5, 1, 300, 2**40])
    base, low, span = suffix_dedup._pack_documents(least, most)
    got = suffix_dedup._unpack_documents({"base": base, "least": low, "span": span}, 5)
    assert got[0].tolist() == least.tolist() and got[1].tolist() == most.tolist()


def test_suffixes_come_in_the_order_of_their_strings():
    import numpy as np

    dice = np.random.default_rng(4)
    data = np.concatenate((dice.integers(0, 2, 500), [255, 0] * 40, dice.integers(0, 256, 200), [7] * 90)).astype(np.uint8)
    start = dice.permutation(len(data) - 49)
    order, new = suffix_dedup.suffix_order(data, start)
    strings = [data[s : s + 50].tobytes() for s in start[order]]
    assert strings == sorted(strings)
    assert new.tolist() == [k == 0 or strings[k] != strings[k - 1] for k in range(len(strings))]
    assert all(len(x) == 0 for x in suffix_dedup.suffix_order(data, start[:0]))


# Sharding


def test_shards_keep_the_law(spark, docs, empty):
    rows = sharding.shard(docs, shards=4).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16) for i, t in texts()
    )
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard(empty).count() == 0
    many = documents(spark, [(k, prose(k, 5 + k % 40)) for k in range(3000)] + [(9000 + k, "same") for k in range(500)])
    rows = sharding.shard(many, shards=10).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert set(sizes) == set(range(10)) and max(sizes.values()) - min(sizes.values()) < 600
    homes = {}
    for r in rows:
        homes.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_best_fit_takes_the_tightest_bin():
    import random

    dice = random.Random(3)
    sizes = sorted((dice.randint(1, 100) for _ in range(400)), reverse=True)
    bins, homes = [], []
    for size in sizes:
        fits = [(b, k) for k, b in enumerate(bins) if b >= size]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append(100)
        bins[k] -= size
        homes.append(k)
    assert list(sharding.pack(sizes, 100)) == homes


def test_slots_are_gapless_over_many_lanes(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS shard", "id % 7 AS doc_id")
    got = sharding.slots(rows, numbered_rows=50).collect()
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


# Decontamination


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def test_decontamination(spark, docs, empty):
    long_item = " ".join(prose(8, 5000).split()[100:130])
    items = [
        (1, long_item), (2, long_item.upper()), (2, "ñandú; 漢字"), (3, None), (4, ""), (None, "One two"),
        (5, "the " * 12), (6, "nothing like this exists"), (7, prose(2, 200)), (10, "Three"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.decontaminate(docs, benchmark).collect()
    want = Counter()
    for i, t in texts():
        w, hit, ids = item_words(t), set(), set()
        for item, text in items:
            v = item_words(text)
            for k in range(max(len(v) - 10, 0) + 1 if v else 0):
                window = v[k : k + 10]
                for a in range(len(w) - len(window) + 1):
                    if w[a : a + len(window)] == window:
                        hit |= set(range(a, a + len(window)))
                        ids |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        want[(i, len(w), len(hit), len(ids), digest, bool(hit))] += 1
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)
    assert got == want and any(k[5] for k in want)
    assert decontamination.decontaminate(empty, benchmark).count() == 0
    clean = decontamination.decontaminate(docs, benchmark.limit(0)).collect()
    assert len(clean) == len(texts()) and not any(r.contaminated for r in clean)


def test_decontamination_without_broadcast(docs, spark, monkeypatch):
    benchmark = spark.createDataFrame([(1, prose(2, 200)), (2, "three")], "item_id long, text string")
    with_it = Counter(decontamination.decontaminate(docs, benchmark).collect())
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert Counter(decontamination.decontaminate(docs, benchmark).collect()) == with_it
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# BPE


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def test_round_trip_equals_the_library(spark, docs, empty, tokenizer):
    path, library = tokenizer
    odd = ["<|endoftext|>end", "it's he'll ''s", "İstanbul ΑΣ", "e\u0301 \u00a0x\u0085y", "x\u001cy", "0123456789"]
    frame = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(100 + k, t) for k, t in enumerate(odd)], "doc_id long, text string")
    )
    rows = bpe.decode(bpe.encode(frame, path), path).collect()
    assert len(rows) == len(texts()) + len(odd)
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert bpe.unpack(r.ids) == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(empty, path).count() == 0


def test_long_runs_join_their_halves(spark, tokenizer, monkeypatch):
    import random

    path, library = tokenizer
    monkeypatch.setattr(bpe, "LEAF_BYTES", 32)
    dice = random.Random(5)
    runs = ["".join(dice.choice(["th", "an", "é", "z", "ing", "漢", "q"]) for _ in range(300)) for _ in range(20)]
    runs += ["ab" * 500, "!?" * 300 + "'s", "a" * 1000, "x" * 33]
    frame = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string")
    for r in bpe.encode(frame, path).collect():
        assert bpe.unpack(r.ids) == library.encode(r.text, add_special_tokens=False).ids


def test_spread_runs_equal_the_library(spark, tokenizer, monkeypatch):
    path, library = tokenizer
    monkeypatch.setattr(bpe, "SPREAD_BYTES", 2000)
    texts_ = ["word " + "thequickbrown" * 400 + " and, " + "!?" * 1500 + " end", "tha" * 1000, "tha" * 1000, "short"]
    frame = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    rows = bpe.encode(frame, path).collect()
    assert len(rows) == 4
    for r in rows:
        assert bpe.unpack(r.ids) == library.encode(r.text, add_special_tokens=False).ids


def test_ids_decoded_in_one_pass_and_all_columns_stay(spark, docs, tokenizer, monkeypatch):
    path, library = tokenizer
    monkeypatch.setattr(bpe, "SPREAD_BYTES", 2000)
    rows = bpe.encode(docs, path, decoded=True).collect()
    assert len(rows) == len(texts()) and max(len(t or "") for _, t in texts()) > 3000
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert bpe.unpack(r.ids) == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)
        assert (r.key, r._hash, r._runs, r._doc, r.digest) == ("k", 8, 9, 10, "d")


def test_remembered_runs_are_bounded_by_their_bytes(tokenizer, monkeypatch):
    path, library = tokenizer
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 500)
    with open(path, encoding="utf-8") as file:
        codec = bpe.Codec({"json": file.read()})
    for k in range(20):
        text = prose(k, 30)
        runs = codec.runs(text)
        known = codec.run_ids(set(runs))
        assert b"".join(known[r] for r in runs) == bytes(
            b for i in library.encode(text, add_special_tokens=False).ids for b in i.to_bytes(4, "little")
        )
        assert 5 * sum(map(len, known)) <= max(500, 5 * sum(map(len, set(runs))))


@pytest.mark.parametrize("bound", [None, 0])
def test_helper_columns_do_not_touch_those_of_the_input(spark, docs, monkeypatch, bound):
    """Columns that are called as an operator's own helpers keep their values."""
    if bound is not None:
        monkeypatch.setattr(quality_rules, "BROADCAST_GRAMS", bound)
    trusted = spark.createDataFrame([(1,), (9,), (16,)], "doc_id long")
    made = [quality_rules.quality_rules(docs, trusted)]
    made += [line_dedup.dedup_lines(docs), near_dedup.near_dedup(docs)] if bound is None else []
    for df in made:
        kept = {tuple(r) for r in df.select("key", "_hash", "_runs", "_doc", "_text_key", "_llr", "digest").collect()}
        assert kept == {("k", 8, 9, 10, "t", 1.5, "d")}


# Near-dedup


def shingles(text):
    words = white_words(ascii_lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 5, 0) + 1))


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        own = i if not sets[k] else min(ids, default=None)
        out.append((i, len(sets[k]), own, i == own))
    return Counter(out)


def chain(n, step):
    """Texts of which each is like the next, but the ends are not."""
    words = prose(77, 120).split()
    out = []
    for k in range(n):
        out.append((1000 + (k * 7) % n, " ".join(words)))
        words[(k * step) % 100] = f"new{k}"
    return out


@pytest.mark.parametrize("block", [8, 512])
def test_near_copies_are_grouped(spark, docs, empty, monkeypatch, block):
    got = near_dedup.components_of(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute_components(texts())
    assert near_dedup.components_of(empty).count() == 0
    rows = chain(40, 9) + [(2000 + k, prose(300 + k % 3, 100) + " tail" * (k % 2)) for k in range(40)]
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "MEMBERS", 4)
    got = near_dedup.components_of(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute_components(rows)


def test_one_document_of_each_group_stays(docs):
    left = near_dedup.near_dedup(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    ids = Counter(r.doc_id for r in rows)
    assert ids[2] == ids[3] == ids[8] == 0 and ids[1] == ids[7] == ids[9] == 1
    assert ids[4] == ids[5] == ids[6] == 1 and ids[10] == 2


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(50, 60), (60, 50), (70, 70)], "a long, b long")
    got = {r.node: r.label for r in near_dedup.components(edges).collect()}
    assert got == {**{k: 0 for k in range(31)}, 50: 50, 60: 50}


def test_pruning_keeps_what_may_be_similar():
    least = near_dedup.least_matches()
    assert least[0] == 0 and all(0 < m < 0.85 * 24 * (k + 1) for k, m in enumerate(least[1:]))


# Line dedup


def deleted_lines(rows, min_words=10):
    """The definition itself: any run with enough words that also starts earlier, per different document."""
    seqs = [(i, (t.split("\n") if t is not None else [])) for i, t in rows]
    words = [[len(white_words(x)) for x in lines] for _, lines in seqs]
    gone = [set() for _ in seqs]
    for d, (_, lines) in enumerate(seqs):
        for s in range(len(lines)):
            best = 0
            for e, (_, earlier) in enumerate(seqs[: d + 1]):
                for o in range(len(earlier) if e < d else s):
                    n = 0
                    while s + n < len(lines) and o + n < len(earlier) and lines[s + n] == earlier[o + n]:
                        n += 1
                    best = max(best, n)
            if sum(words[d][s : s + best]) >= min_words:
                gone[d] |= set(range(s, s + best))
    return gone


def test_line_runs_are_deleted(spark, docs, empty):
    rows = [r for r in texts() if r[0] not in (None, 9, 10, 16)]
    rows += [(30, "a b c\n\nd e f\ng h i j"), (31, "x\na b c\n\nd e f\ng h i j\ny"), (32, "a b c\n\nd e f"), (33, "\n\n")]
    want = deleted_lines(rows)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    for (i, t), gone in zip(rows, want, strict=True):
        lines = t.split("\n") if t is not None else []
        left = None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
        assert (got[i].text, got[i].n_lines, got[i].n_removed) == (left, len(lines), len(gone))
        assert got[i].runs == 6 and got[i].text_hash == "h"
    every = line_dedup.dedup_lines(docs).collect()
    assert len(every) == len(texts())
    assert len({(r.text, r.n_removed) for r in every if r.doc_id == 9}) == 1  # repeated rows stay equal
    assert line_dedup.dedup_lines(empty).count() == 0
