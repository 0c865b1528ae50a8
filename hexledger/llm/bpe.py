"""BPE encoding and decoding with a public tokenizer file, long unsplit text by tree concatenation.

A text is split into runs as the tokenizer does it, and each run is merged on its own; a worker remembers the
runs it has met. The merges of all new runs of a slice go on at once, one merge of each run a round. A run
longer than `LEAF_BYTES` is cut into halves again and again; the leaves are encoded side by side, and two
neighbours are joined by encoding a window around the join anew, growing it until it starts and ends with
tokens on which both sides agree. A sequence whose neighbouring tokens are all merged as they would be on
their own is the encoding of the whole, so the join is exact. Runs over `SPREAD_BYTES` spread their leaves
over tasks first.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexledger.llm.frames import bound_batches, fresh
from hexledger.llm.text_arrays import mix, slices

# Runs of more bytes are encoded by halves.
LEAF_BYTES = 64
# Documents with an unsplit run of more bytes have its leaves encoded by several tasks.
SPREAD_BYTES = 1 << 16
# Bytes of the runs, and of their ids, that a worker remembers; it forgets all when there are more.
REMEMBERED_BYTES = 16 << 20

WORD_END = "</w>"

_NEVER = np.iinfo(np.int32).max
_TABLE_BITS = 18


def _byte_names() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the other bytes in order from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Merges:
    """The vocabulary and the merge rules of a tokenizer file, as arrays."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        names = dict(zip(vocab.values(), vocab.keys(), strict=True))
        names |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        # Bytes of a token: each character of its name is a byte.
        self.sizes = np.array([len(n.removesuffix(end)) if end else len(n) for n in self.names])
        self.inner = np.array([vocab[c] for c in _byte_names()], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in _byte_names()], dtype=np.int64)
        pairs = np.array([(vocab[a], vocab[b]) for a, b in rules], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in rules], dtype=np.int64)
        # A hash table with open places; `reach` is the longest way from a pair's place to where it stands.
        self.keys = np.full((1 << _TABLE_BITS) + 64, -1, dtype=np.int64)
        self.ranks = np.full(len(self.keys), _NEVER, dtype=np.int32)
        self.reach = 0
        keys = (pairs[:, 0] << 20) | pairs[:, 1]
        for rank, (key, at) in enumerate(zip(keys.tolist(), self._place(keys).tolist(), strict=True)):
            step = 0
            while self.keys[at + step] >= 0:
                step += 1
            self.keys[at + step], self.ranks[at + step] = key, rank
            self.reach = max(self.reach, step)

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 20) | right
        at = self._place(keys)
        out = np.where(self.keys[at] == keys, self.ranks[at], _NEVER)
        for step in range(1, self.reach + 1):
            open_ = np.flatnonzero((out == _NEVER) & (self.keys[at + step - 1] >= 0))
            if not len(open_):
                break
            hit = open_[self.keys[at[open_] + step] == keys[open_]]
            out[hit] = self.ranks[at[hit] + step]
        return out

    def encode(self, runs: list[bytes], ended: bool | list[bool] = True) -> list[np.ndarray]:
        """The ids of each run; a run that is not `ended` goes on, so its last byte gets no word end."""
        if not runs:
            return []
        sizes = np.array([len(r) for r in runs], dtype=np.int64)
        data = np.frombuffer(b"".join(runs), dtype=np.uint8)
        symbols = self.inner[data]
        tails = np.cumsum(sizes) - 1
        closed = (sizes > 0) & np.broadcast_to(np.asarray(ended), sizes.shape)
        symbols[tails[closed]] = self.last[data[tails[closed]]]
        owner = np.repeat(np.arange(len(runs)), sizes)
        done_symbols, done_owner = [], []
        rank = np.full(len(symbols), _NEVER, dtype=np.int32)
        inside = owner[:-1] == owner[1:]
        rank[:-1][inside] = self.rank(symbols[:-1][inside], symbols[1:][inside])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(owner)))
            at_best = np.repeat(best, lengths)
            over = at_best == _NEVER
            if over.any():
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
                symbols, owner, rank, at_best = symbols[~over], owner[~over], rank[~over], at_best[~over]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == at_best)
            at = at[np.concatenate(([True], owner[at][1:] != owner[at][:-1]))]  # the leftmost of each run
            symbols[at] = self.made[rank[at]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))  # places after one symbol of each earlier run has gone
            symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
            for left in (at - 1, at):
                ok = (left >= 0) & (left + 1 < len(symbols))
                left = np.concatenate((left[ok], left[~ok & (left >= 0)]))
                right = np.minimum(left + 1, len(symbols) - 1)
                pair = (owner[left] == owner[right]) & (left != right)
                fresh = np.full(len(left), _NEVER, dtype=np.int32)
                fresh[pair] = self.rank(symbols[left[pair]], symbols[right[pair]])
                own = np.isin(left, at) | pair
                rank[left[own]] = fresh[own]
        owners = np.concatenate(done_owner) if done_owner else np.zeros(0, dtype=np.int64)
        values = np.concatenate(done_symbols) if done_symbols else np.zeros(0, dtype=np.int64)
        order = np.argsort(owners, kind="stable")
        cuts = np.cumsum(np.bincount(owners, minlength=len(runs)))[:-1]
        return np.split(values[order].astype("<u4"), cuts)


def _plain_pattern() -> tuple[re.Pattern, re.Pattern]:
    """Finds the runs of a text of plain characters (code points under 384, one of them apart), and finds a
    character that is not plain. The form of the split is the tokenizer's: contractions, letters, one digit,
    other signs."""
    plain = [c for c in map(chr, range(0x180)) if c != "\u0130"]
    of = lambda kind: "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == kind)
    white = "\\t-\\r \\x85\\xa0"
    runs = f"'s|'t|'re|'ve|'m|'ll|'d|[{of('L')}]+|[{of('N')}]|[^{white}{of('L')}{of('N')}]+"
    return re.compile(runs), re.compile("[^\x00-\u012f\u0131-\u017f]")


class Codec:
    """The tokenizer of one worker, built from a dict that the worker keeps between tasks."""

    def __init__(self, state: dict) -> None:
        if "merges" not in state:
            spec = json.loads(state["json"])
            state.update(merges=Merges(spec), known={}, held=0, plain_tokens=spec["decoder"] is None)
            state["added"] = {t["content"]: t["id"] for t in spec["added_tokens"]}
            state["pattern"], state["unusual"] = _plain_pattern()
        self.state = state
        self.merges = state["merges"]

    def tokenizer(self):
        if "tokenizer" not in self.state:
            from tokenizers import Tokenizer

            self.state["tokenizer"] = Tokenizer.from_str(self.state["json"])
        return self.state["tokenizer"]

    def runs(self, text: str) -> list[str]:
        """The parts of a text that are merged independently, in order, special tokens among them."""
        if not self.state["unusual"].search(text) and not any(a in text for a in self.state["added"]):
            return self.state["pattern"].findall(text.lower())
        # Rare characters: normalised and split by the tokenizer's own rules.
        tokenizer, out = self.tokenizer(), []
        for part in re.split("(" + "|".join(map(re.escape, self.state["added"])) + ")", text):
            if part in self.state["added"]:
                out.append(part)
            elif part:
                normal = tokenizer.normalizer.normalize_str(part)
                out += [normal[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def run_ids(self, runs: set[str]) -> dict[str, bytes]:
        """Packed ids of at least the given runs."""
        known = self.state["known"]
        new = runs.difference(known)
        # A run has at most one id of four bytes for each of its bytes.
        self.state["held"] += 5 * sum(map(len, new))
        if self.state["held"] > REMEMBERED_BYTES:
            known.clear()
            new = set(runs)
            self.state["held"] = 5 * sum(map(len, new))
        for content, number in self.state["added"].items():
            if content in new:
                known[content] = np.array([number], dtype="<u4").tobytes()
                new.discard(content)
        short, long = [], []
        for run in new:
            (short if len(run) <= LEAF_BYTES // 4 or len(run.encode()) <= LEAF_BYTES else long).append(run)
        for run, ids in zip(short, self.merges.encode([r.encode() for r in short]), strict=True):
            known[run] = ids.tobytes()
        for run in long:
            leaves = [leaf.encode() for leaf in halves(run)]
            ids = self.merges.encode(leaves, [False] * (len(leaves) - 1) + [True])
            known[run] = self.joined(leaves, ids).tobytes()
        return known

    def joined(self, texts: list[bytes], ids: list[np.ndarray]) -> np.ndarray:
        """The ids of the run of which `texts` are the leaves. All joins of one level go on together."""
        while len(ids) > 1:
            made: dict[int, np.ndarray] = {}
            pending, width = list(range(0, len(ids) - 1, 2)), 4
            while pending:
                windows = [self.window(texts[i], ids[i], texts[i + 1], ids[i + 1], width) for i in pending]
                # A window ends the run only if the run's last leaf is wholly inside.
                ended = [
                    i + 2 == len(ids) and width >= len(ids[i + 1]) for i in pending
                ]
                again = []
                for i, new in zip(pending, self.merges.encode(windows, ended), strict=True):
                    left, right = ids[i], ids[i + 1]
                    a, b = max(len(left) - width, 0), min(width, len(right))
                    if (a == 0 or new[0] == left[a]) and (b == len(right) or new[-1] == right[b - 1]):
                        made[i] = np.concatenate((left[:a], new, right[b:]))
                    else:
                        again.append(i)
                pending, width = again, width * 2
            ids = [made[i] for i in sorted(made)] + ids[len(ids) - len(ids) % 2 :]
            texts = [texts[i] + texts[i + 1] for i in range(0, len(texts) - 1, 2)] + texts[len(texts) - len(texts) % 2 :]
        return ids[0] if ids else np.zeros(0, dtype="<u4")

    def decoded(self, ids: list[bytes | None]) -> pa.Array:
        """The texts of packed ids."""
        if not self.state["plain_tokens"]:
            raise ValueError("only tokenizers without a decoder, whose text is their tokens, are known here")
        name = self.merges.names.__getitem__
        return pa.array([" ".join(map(name, np.frombuffer(x or b"", dtype="<u4").tolist())) for x in ids], pa.string())

    def window(
        self, left: bytes, left_ids: np.ndarray, right: bytes, right_ids: np.ndarray, width: int
    ) -> bytes:
        """The bytes of the last tokens on the left and the first ones on the right of a join."""
        sizes = self.merges.sizes
        before = int(sizes[left_ids[max(len(left_ids) - width, 0) :]].sum())
        return left[len(left) - before :] + right[: int(sizes[right_ids[:width]].sum())]


def halves(run: str) -> list[str]:
    """The run cut into halves until each has at most `LEAF_BYTES` bytes (or is one character)."""
    if len(run) < 2 or len(run.encode()) <= LEAF_BYTES:
        return [run]
    middle = len(run) // 2
    return halves(run[:middle]) + halves(run[middle:])


_LONG_RUN = r"[^ \t\n\x0B\f\r]{%d}"


def _packed(ids: list[bytes]) -> pa.Array:
    return pa.array(ids, type=pa.binary())


def encode(documents: DataFrame, tokenizer_path: str, decoded: bool = False) -> DataFrame:
    """`documents` with `ids`: the token ids of the whole text, packed as little-endian 32-bit numbers.

    One row per row of `documents`, repeated or not. Null and empty texts have no ids. Strings of special
    tokens in a text become those tokens, as the tokenizer does it. A column `ids` of the input is replaced.
    With `decoded` the ids are decoded by the same worker, as `decode` does it, into a column of that name.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        state = spark.sparkContext.broadcast({"json": file.read()})  # the vocabulary file: a few MB
    new = ["ids", "decoded"] if decoded else ["ids"]
    rest = documents.drop(*new)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    fields += ", ids binary, decoded string" if decoded else ", ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(state.value)
        for batch in batches:
            for part, texts in slices(batch):
                data, cuts = texts.data.tobytes(), texts.offsets.tolist()
                runs = [codec.runs(data[a:b].decode()) for a, b in zip(cuts, cuts[1:], strict=False)]
                known = codec.run_ids({r for each in runs for r in each})
                ids = [b"".join(map(known.__getitem__, each)) for each in runs]
                made = [_packed(ids), codec.decoded(ids)] if decoded else [_packed(ids)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *new])

    long = F.coalesce(
        (F.octet_length("text") > SPREAD_BYTES) & F.col("text").rlike(_LONG_RUN % SPREAD_BYTES), F.lit(False)
    )
    short_rows = rest.where(~long).mapInArrow(run, fields)
    long_rows = _encode_spread(rest.where(long), state)
    return short_rows.unionByName(decode(long_rows, tokenizer_path) if decoded else long_rows)


def _encode_spread(documents: DataFrame, state) -> DataFrame:
    """`encode` for documents with very long unsplit runs: their leaves are rows of their own."""
    parts = "key string, seq int, leaf boolean, ended boolean, part string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(state.value)
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows = []
                for run in codec.runs(text):
                    leaves = halves(run) if len(run) > SPREAD_BYTES // 4 else [run]
                    rows += [(len(leaves) > 1, k == len(leaves) - 1, leaf) for k, leaf in enumerate(leaves)]
                n = len(rows)
                columns = [pa.array([key] * n, pa.string()), pa.array(range(n), pa.int32())]
                columns += [
                    pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.bool_(), pa.bool_(), pa.string()))
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "seq", "leaf", "ended", "part"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(state.value)
        for batch in batches:
            runs = batch.column("part").to_pylist()
            leaf = batch.column("leaf").to_pylist()
            own = codec.run_ids({r for r, spread in zip(runs, leaf, strict=True) if not spread})
            spread = iter(
                codec.merges.encode(
                    [r.encode() for r, s in zip(runs, leaf, strict=True) if s],
                    [e for e, s in zip(batch.column("ended").to_pylist(), leaf, strict=True) if s],
                )
            )
            ids = [next(spread).tobytes() if s else own[r] for r, s in zip(runs, leaf, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, _packed(ids)], [*batch.schema.names, "ids"])

    def join_all(table: pa.Table) -> pa.Table:
        codec = Codec(state.value)
        out, texts, ids = [], [], []
        for row in table.sort_by("seq").to_pylist():
            if not row["leaf"]:
                out.append(row["ids"])
                continue
            texts.append(row["part"].encode())
            ids.append(np.frombuffer(row["ids"], dtype="<u4"))
            if row["ended"]:
                out.append(codec.joined(texts, ids).tobytes())
                texts, ids = [], []
        return pa.table({"key": pa.array([table["key"][0].as_py()], pa.string()), "ids": _packed([b"".join(out)])})

    own = fresh("key", documents)
    keyed = documents.withColumn(own, F.sha2(F.col("text").cast("binary"), 256))
    encoded = (
        keyed.select(F.col(own).alias("key"), "text")
        .dropDuplicates(["key"])
        .mapInArrow(cut, parts)
        .repartition(F.col("key"), F.col("seq"))
        .mapInArrow(each, f"{parts}, ids binary")
        .groupBy("key")
        .applyInArrow(join_all, "key string, ids binary")
    )
    return keyed.join(encoded.withColumnRenamed("key", own), own).drop(own)


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """`encoded` with `decoded`: the tokenizer's text for packed `ids`; no ids give an empty text."""
    spark = encoded.sparkSession
    bound_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        state = spark.sparkContext.broadcast({"json": file.read()})
    rest = encoded.drop("decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(state.value)
        for batch in batches:
            texts = codec.decoded(batch.column("ids").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "decoded"])

    return rest.mapInArrow(run, f"{fields}, decoded string")


def unpack(ids: bytes) -> list[int]:
    return np.frombuffer(ids, dtype="<u4").tolist()
