"""Small text and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(c: Column) -> Column:
    return F.lower(F.trim(c))


def default_label(c: Column, label: str) -> Column:
    """`label` for null and for the empty string."""
    return F.when(c.isNull() | (c == ""), F.lit(label)).otherwise(c)


def tokens(c: Column) -> Column:
    """Split at single spaces."""
    return F.split(c, " ")


def key_share(*keys: Column) -> Column:
    """0..99 from the md5 of the key: the same row lands in the same share on every run."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100
