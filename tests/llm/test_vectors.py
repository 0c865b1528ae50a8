"""Whitening and hard negatives against plain numpy and Python, on awkward vectors."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from hexledger.llm import hard_negatives, whitening
from hexledger.llm.vectors import common_length

SCHEMA = (
    "vec_id long, embedding array<float>, label int, block string, place int, columns string, rank int, "
    "whitened string, n long, pass int"
)
DIMENSIONS = 12


def vectors(seed: int = 3, n: int = 420):
    dice = np.random.default_rng(seed)
    centres = dice.normal(0, 0.4, (4, DIMENSIONS))
    labels = dice.integers(0, 4, n)
    made = (centres[labels] + dice.normal(0, 0.3, (n, DIMENSIONS))).astype(np.float32)
    rows = [(k, [float(x) for x in v], int(c)) for k, (v, c) in enumerate(zip(made, labels, strict=True))]
    same = rows[100][1]
    rows += [(1000 + k, same, 2) for k in range(40)]  # equal vectors: ties
    rows += [rows[100], rows[7], rows[7]]  # repeated rows, an anchor among them
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.5] * (DIMENSIONS - 1), 1), (2003, [0.5] * 5 + [None] * 7, 1)]
    rows += [(2004, [0.5] * 11 + [float("nan")], 1), (2100, [0.5] * 11 + [float("inf")], 1), (2006, same, None)]
    rows += [(None, same, 1), (2200, [0.0] * DIMENSIONS, 3), (2201, [-3.0] * DIMENSIONS, -5), (2300, same, 9)]
    return rows


def frame(spark, rows, parts: int = 3):
    return spark.createDataFrame([(*r, "b", 1, "c", 2, "w", 3, 4) for r in rows], SCHEMA).repartition(parts)


def plain(rows, length: int = DIMENSIONS):
    return [
        r
        for r in rows
        if r[1] is not None and len(r[1]) == length and all(x is not None and math.isfinite(x) for x in r[1])
    ]


# Whitening


@pytest.mark.parametrize("kind", ["random", "equal", "clustered", "poor", "one", "zero", "wide"])
def test_eigenvectors(kind):
    dice = np.random.default_rng(5)
    basis, _ = np.linalg.qr(dice.normal(size=(40, 40)))
    values = {
        "random": np.sort(dice.random(40))[::-1] * 50,
        "equal": np.full(40, 3.0),
        "clustered": np.repeat([9.0, 9.0 + 1e-9, 4.0, 0.0], 10),
        "poor": np.append(np.arange(15.0, 0, -1), np.zeros(25)),
        "one": np.array([2.5]),
        "zero": np.zeros(40),
        "wide": 10.0 ** -np.arange(40.0),
    }[kind]
    basis = basis[: len(values), : len(values)] if kind != "one" else np.eye(1)
    a = basis * values @ basis.T
    a = (a + a.T) / 2
    got, vectors_of = whitening.eigen(a)
    scale = max(np.abs(values).max(), 1e-300)
    assert np.allclose(got, np.linalg.eigvalsh(a)[::-1], rtol=0, atol=1e-13 * scale)
    assert np.allclose(vectors_of.T @ vectors_of, np.eye(len(a)), atol=1e-13)
    assert np.allclose(a @ vectors_of, vectors_of * got, atol=2e-13 * scale)


def test_whitening_is_that_of_numpy(spark):
    rows = vectors()
    table = frame(spark, rows)
    fitted = whitening.fit(table, components=8)
    used = plain(rows)
    x = np.floor(64 * np.array([r[1] for r in used], dtype=np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    assert (fitted.n, fitted.length) == (n, DIMENSIONS)
    centred = (n * x - total) / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1], components[:, ::-1][:, :8]
    assert np.allclose(fitted.explained, values[:8] / values.sum(), rtol=1e-12)
    want = centred @ components / np.sqrt(values[:8])
    got = whitening.whiten(table, fitted).collect()
    assert Counter(r.vec_id for r in got) == Counter(r[0] for r in used)
    signs = np.sign((fitted.vectors * components).sum(axis=0))
    by_vector = {tuple(r[1]): (w, d) for r, w, d in zip(used, want, ((n * x - total) ** 2).sum(axis=1), strict=True)}
    for r in got:
        w, deviation = by_vector[tuple(r.embedding)]
        assert np.allclose(r.whitened, w * signs, atol=1e-9)
        assert r.deviation == deviation and r.rank == 2 and r.n == 3
    made = np.array([r.whitened for r in got])
    error = np.abs(np.cov(made.T, bias=True) - np.eye(8)).max()
    assert error < 1e-11 and fitted.identity_error < 1e-11


def test_whitening_of_odd_tables(spark):
    assert whitening.fit(frame(spark, [], 1)) is None
    assert whitening.whiten(frame(spark, [], 1), None).count() == 0
    assert whitening.fit(frame(spark, [(1, None, 1), (2, [], 1)])) is None
    # Two vectors span one dimension: the other components have no variance.
    table = frame(spark, [(1, [1.0, 2.0, 3.0], 1), (2, [2.0, 0.0, 3.0], 1)])
    fitted = whitening.fit(table)
    rows = {r.vec_id: r.whitened for r in whitening.whiten(table, fitted).collect()}
    assert sorted(x[0] for x in rows.values()) == pytest.approx([-1, 1])
    assert all(x[1:] == [0.0, 0.0] for x in rows.values()) and fitted.identity_error < 1e-12
    # One far value: held at the bound; what does not fit into 64 bits is null.
    table = frame(spark, [(k, [float(k), 1e30 if k == 3 else 0.5], 1) for k in range(40)])
    got = whitening.whiten(table, whitening.fit(table)).collect()
    assert len(got) == 40 and all(r.deviation is None or r.deviation >= 0 for r in got)


def test_common_length(spark):
    assert common_length(frame(spark, vectors()), "embedding") == DIMENSIONS
    assert common_length(frame(spark, [(1, [1.0], 1), (2, [1.0, 2.0], 1)]), "embedding") == 2


# Hard negatives


def brute_negatives(rows):
    rows = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in plain(rows) if i is not None and c is not None]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for k, (anchor, v, label) in enumerate(rows):
        if anchor % 100:
            continue
        scored = [(-score(v, w), i, c) for j, (i, w, c) in enumerate(rows) if j != k]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            inside = sorted(s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)[:10]
            out += [(anchor, positive, r, i, -p, -s) for r, (s, i, _) in enumerate(inside, 1)]
    return Counter(out)


@pytest.mark.parametrize(("block_rows", "pass_anchors", "parts"), [(4096, 16_384, 3), (7, 2, 5), (64, 3, 1)])
def test_hard_negatives_are_those_of_all_pairs(spark, monkeypatch, block_rows, pass_anchors, parts):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(hard_negatives, "PASS_ANCHORS", pass_anchors)
    rows = vectors()
    got = Counter(map(tuple, hard_negatives.mine(frame(spark, rows, parts)).collect()))
    want = brute_negatives(rows)
    assert len(want) > 100 and got == want


def test_hard_negatives_of_large_entries_and_odd_tables(spark):
    known = [r for r in plain(vectors(9, 150)) if r[0] is not None and r[2] is not None]
    for scale in (3000, 20_000):  # scores beyond 2**24 and beyond 2**53
        rows = [(k, [float(np.float32(min(max(x * scale, -6e4), 6e4))) for x in v], c) for k, v, c in known]
        assert Counter(map(tuple, hard_negatives.mine(frame(spark, rows)).collect())) == brute_negatives(rows)
    assert hard_negatives.mine(frame(spark, [], 1)).count() == 0
    assert hard_negatives.mine(frame(spark, [(100, [1.0, 2.0], 1), (2, None, 1), (None, [1.0, 1.0], 1)])).count() == 0


def test_most_candidates_are_struck_before_the_last_dimensions():
    """What the method is for: with an outstanding positive, few candidates are read to the end."""
    dice = np.random.default_rng(1)
    n, d = 4000, 64
    entries = (dice.normal(size=d) * np.linspace(4, 0.05, d) * 30).astype(np.int64)
    whole = dice.integers(-100, 100, (n, d)).astype(np.int32)
    whole[:6] = np.sign(entries) * 100
    packed = {"block": "b", "ids": np.arange(n), "labels": np.zeros(n, dtype=np.int64)}
    packed["columns"] = np.ascontiguousarray(whole.T).tobytes()
    block = hard_negatives.Block({k: v if isinstance(v, (str, bytes)) else v.tobytes() for k, v in packed.items()}, d)
    seen = []
    strike_of = block.scan

    def scan(entries, alive, strike):
        def counting(partial, lost, won):
            keep = strike(partial, lost, won)
            seen.append(int(keep.sum()))
            return keep

        return strike_of(entries, alive, counting)

    block.scan = scan
    best = hard_negatives.Best(1, 5)
    hard_negatives.find_positives(block, entries, 0, 0, best, 0)
    assert best.ids[0].tolist() == [1, 2, 3, 4, 5]
    assert seen[0] < n / 2 and seen[-1] == 5
