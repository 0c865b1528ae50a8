"""Small documents with everything that is awkward: nulls, empties, repeats, copies, long and odd texts."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, kept int, node string, "
    "chunk int, rows int, label string, size double, runs int, text_hash string, "
    "key string, _hash long, _runs int, _doc long, _text_key string, _llr double, digest string"
)


def prose(seed: int, n: int, words: int = 400) -> str:
    dice = random.Random(seed)
    out = []
    for k in range(n):
        word = "".join(dice.choice("aeioustrn") for _ in range(dice.randint(2, 7))) if dice.random() < 0.7 else "the"
        out.append(word.capitalize() if dice.random() < 0.1 else word)
        if dice.random() < 0.08:
            out[-1] += "."
        if k % 12 == 11:
            out[-1] += "\n"
    return " ".join(out).replace("\n ", "\n")


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    edited = base.split(" ")
    edited[60] = "CHANGED"
    rows = [
        (1, base),
        (2, base),
        (3, " ".join(edited)),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "one two three"),
        (8, "One TWO three"),
        (9, prose(2, 200)),
        (9, prose(2, 200)),  # a repeated row
        (10, prose(3, 90)),
        (10, prose(4, 90)),  # an id used twice
        (None, prose(5, 80)),
        (None, None),
        (11, prose(5, 80)),
        (12, "spam " * 300),
        (13, "!!! ### " * 100),
        (14, "Éàß ñandú 漢字 \U0001f600 " * 30 + prose(6, 60)),
        (15, prose(7, 100) + "\n" + base),
        (16, prose(8, 5000)),
        (17, "x" * 3000),
        (18, prose(9, 60) + "\n" + prose(8, 60)),
        (19, "a\n" * 200),
        (20, "short line here\n" * 50 + prose(10, 70)),
    ]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    extra = ("en", "src", 1, "own", 7, "n", 3, 4, "l", 0.5, 6, "h", "k", 8, 9, 10, "t", 1.5, "d")
    return spark.createDataFrame([(i, t, *extra) for i, t in rows], SCHEMA).repartition(3)
