"""Column expressions on text shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, everything else as it is. Pure ASCII text takes the quick built-in way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower()))


def text_key(text: Column) -> Column:
    """16-byte key of a text (null: of the empty text): equal texts share it, whatever their doc_id."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def free_name(name: str, df: DataFrame) -> str:
    """``name``, with underscores added until ``df`` has no such column, for a column beside the caller's own."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def sized(df: DataFrame, most: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, counted; otherwise left to a shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
