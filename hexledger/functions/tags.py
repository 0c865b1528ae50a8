"""Tag text of the form `[('key', 'value'), ...]`: the published name rule and a full parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: the separator between two single-quoted pairs, a single-quoted name pair, and
# one pair of quoted strings with backslash escapes in either quote style.
PAIR_SEPARATOR = r"'\),\s*\('"
NAME_PAIR = r"^\('name',\s*'(.*?)'\)?$"
_QUOTED = r"""('[^'\\]*(?:\\.[^'\\]*)*'|"[^"\\]*(?:\\.[^"\\]*)*")"""
ANY_PAIR = rf"\({_QUOTED},\s*{_QUOTED}\)"


def tag_pieces(tags: Column) -> Column:
    """The list text without its brackets, cut between single-quoted pairs."""
    inner = F.substring(tags, F.lit(2), F.greatest(F.length(tags) - 2, F.lit(0)))
    return F.split(inner, PAIR_SEPARATOR)


def literal_names(tags: Column) -> Column:
    """Array of names by the published rule.

    Cutting consumes the quotes at the cut, so a name is found only where its pair kept both of
    them, that is where `name` is the only tag. Use `tag_value` for the name of any element.
    """
    names = F.transform(tag_pieces(tags), lambda p: F.lower(F.trim(F.regexp_extract(p, NAME_PAIR, 1))))
    return F.filter(names, lambda n: n != "")


def _unquote(quoted: Column) -> Column:
    body = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    return F.regexp_replace(body, r"\\(.)", "$1")


def tag_keys(tags: Column) -> Column:
    return F.transform(F.regexp_extract_all(tags, F.lit(ANY_PAIR), F.lit(1)), _unquote)


def tag_values(tags: Column) -> Column:
    return F.transform(F.regexp_extract_all(tags, F.lit(ANY_PAIR), F.lit(2)), _unquote)


def tag_map(tags: Column) -> Column:
    """All pairs as a map; the first pair wins where a key repeats."""
    keys, values = tag_keys(tags), tag_values(tags)
    return F.map_from_entries(
        F.transform(
            F.array_distinct(keys),
            lambda k: F.struct(k, F.element_at(values, F.array_position(keys, k).cast("int"))),
        )
    )


def tag_value(tags: Column, key: str) -> Column:
    """The trimmed lower-case value of `key`; null when the element does not have it."""
    at = F.nullif(F.array_position(tag_keys(tags), key), F.lit(0)).cast("int")
    return F.nullif(F.lower(F.trim(F.try_element_at(tag_values(tags), at))), F.lit(""))
