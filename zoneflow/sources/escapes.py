"""Backslash escapes of text lines, both ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# second character of the escape -> character it stands for
LINE = {"n": "\n", "r": "\r", "t": "\t"}
QUOTED = {**LINE, '"': '"'}


def escape(c: Column, codes: dict[str, str]) -> Column:
    """Backslashes first, so that none made by a later step is doubled."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for code, char in codes.items():
        out = F.replace(out, F.lit(char), F.lit("\\" + code))
    return out


def unescape(c: Column, codes: dict[str, str]) -> Column:
    """The inverse: in escaped text the leftmost double backslash is always an
    escaped backslash, so the pieces between them hold only the other escapes."""

    def decode(piece: Column) -> Column:
        for code, char in codes.items():
            piece = F.replace(piece, F.lit("\\" + code), F.lit(char))
        return piece

    # most texts hold no escape
    return F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(F.split(c, r"\\\\", -1), decode), "\\")).otherwise(c)
