"""Hexagonal cell ids as 64-bit integers: resolution, parent and validity.

An id packs, from the high end: a zero bit, 4 mode bits, 3 reserved bits, 4 resolution bits,
7 base-cell bits and fifteen 3-bit digits; digits below the id's resolution hold 7.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the id format.
MAX_RESOLUTION = 15
RESOLUTION_SHIFT = 52
BASE_CELL_SHIFT = 45
MODE_SHIFT = 59
RESERVED_SHIFT = 56
CELL_MODE = 1
BASE_CELLS = 122
PENTAGON_BASE_CELLS = [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _bits(n: Column, shift: int, mask: int) -> Column:
    return F.shiftrightunsigned(n, shift).bitwiseAND(_long(mask))


def cell_to_long(cell: Column) -> Column:
    """The id as an integer; null for text that is not 15 or 16 hex characters."""
    return F.when(cell.rlike("^[0-9a-fA-F]{15}$|^0[0-9a-fA-F]{15}$"), F.conv(cell, 16, 10).cast("long"))


def long_to_cell(n: Column) -> Column:
    return F.lower(F.hex(n))


def cell_resolution(cell: Column) -> Column:
    return _bits(cell_to_long(cell), RESOLUTION_SHIFT, 15).cast("int")


def cell_to_parent(cell: Column, resolution: int) -> Column:
    """The ancestor at `resolution`; null when the id is already coarser than that."""
    n = cell_to_long(cell)
    unused = (1 << (3 * (MAX_RESOLUTION - resolution))) - 1
    moved = (
        n.bitwiseAND(_long(~(15 << RESOLUTION_SHIFT)))
        .bitwiseOR(_long(resolution << RESOLUTION_SHIFT))
        .bitwiseOR(_long(unused))
    )
    return F.when(_bits(n, RESOLUTION_SHIFT, 15) >= resolution, long_to_cell(moved))


# A base cell number as digits of 7, before the digits of the resolutions.
BASE_DIGITS = 3


def cell_to_path(cell: Column, resolution: int) -> Column:
    """Digits 0 to 6 that lead to the ancestor at `resolution`: three for the base cell, then one per level.

    Null for text that is not a valid id of that resolution or a finer one.
    """
    n = cell_to_long(cell)
    base = _bits(n, BASE_CELL_SHIFT, 127)
    head = [F.floor(base / 49), F.floor(base / 7) % 7, base % 7]
    steps = [_bits(n, 3 * (MAX_RESOLUTION - r), 7) for r in range(1, resolution + 1)]
    known = cell_is_valid(cell) & (_bits(n, RESOLUTION_SHIFT, 15) >= resolution)
    return F.when(known, F.array(*[d.cast("int") for d in (*head, *steps)]))


def path_to_cell(path: Column, resolution: int) -> Column:
    """The id at the end of a path of `cell_to_path`."""
    base = path[0] * 49 + path[1] * 7 + path[2]
    unused = (1 << (3 * (MAX_RESOLUTION - resolution))) - 1
    n = _long((CELL_MODE << MODE_SHIFT) | (resolution << RESOLUTION_SHIFT) | unused)
    n = n.bitwiseOR(F.shiftleft(base.cast("long"), BASE_CELL_SHIFT))
    for r in range(1, resolution + 1):
        n = n.bitwiseOR(F.shiftleft(path[BASE_DIGITS + r - 1].cast("long"), 3 * (MAX_RESOLUTION - r)))
    return long_to_cell(n)


def cell_is_valid(cell: Column) -> Column:
    """True only for a well-formed cell id; false (never null) for anything else."""
    n = cell_to_long(cell)
    resolution = _bits(n, RESOLUTION_SHIFT, 15)
    base = _bits(n, BASE_CELL_SHIFT, 127)
    digits = [_bits(n, 3 * (MAX_RESOLUTION - r), 7) for r in range(1, MAX_RESOLUTION + 1)]
    shape = reduce(
        lambda a, b: a & b,
        [F.when(resolution >= r, d != 7).otherwise(d == 7) for r, d in enumerate(digits, start=1)],
    )
    # A pentagon has no children in direction 1: its first used digit that is not 0 cannot be 1.
    first_turn = F.coalesce(*[F.when((resolution >= r) & (d != 0), d) for r, d in enumerate(digits, start=1)])
    pentagon_ok = ~(base.isin(PENTAGON_BASE_CELLS) & F.coalesce(first_turn == 1, F.lit(False)))
    return F.coalesce(
        (_bits(n, MODE_SHIFT, 31) == CELL_MODE)
        & (_bits(n, RESERVED_SHIFT, 7) == 0)
        & (base < BASE_CELLS)
        & shape
        & pentagon_ok,
        F.lit(False),
    )
