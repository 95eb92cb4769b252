"""Text scalar functions (Column -> Column), all JVM-side built-ins.

"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow.functions._util import as_col

# Fixed patterns (must equal the reference's cleaning rules).
URL_PATTERN = r"http\S+|www\.\S+"
# [^a-zA-Z0-9\s] and [^a-zA-Z\s]: a POSIX class (ASCII only) is one table lookup a
# character, where Java tests a union of ranges one by one, 15 times as long.
NON_ALNUM_SPACE = r"[^\p{Alnum}\s]"
NON_ALPHA_SPACE = r"[^\p{Alpha}\s]"
NON_ASCII = r"[^\x00-\x7F]"
TOKEN_PATTERN = r"\b\w\w+\b"


def normalize_text(c) -> Column:
    """lower, URLs -> ' ', non [a-zA-Z0-9 whitespace] -> ' ', drop non-ASCII,
    trim (spaces only), '' -> null.  Inner runs of spaces are kept."""
    x = F.lower(as_col(c))
    x = F.regexp_replace(x, URL_PATTERN, " ")
    x = F.regexp_replace(x, NON_ALNUM_SPACE, " ")
    # The rule's next step (drop [^\x00-\x7F]) cannot match here: Java's \s is
    # ASCII-only, so the previous step already turned every non-ASCII code
    # point into a space.  Skipping it saves a full-text regex pass.
    x = F.trim(x)
    return F.nullif(x, F.lit(""))


def normalize_genre(c) -> Column:
    """lower, URLs -> ' ', non [a-zA-Z whitespace] -> ' ' (digits go, no trim)."""
    x = F.lower(as_col(c))
    x = F.regexp_replace(x, URL_PATTERN, " ")
    return F.regexp_replace(x, NON_ALPHA_SPACE, " ")


def slug(c) -> Column:
    """lower-case, every space -> '-'."""
    return F.replace(F.lower(as_col(c)), F.lit(" "), F.lit("-"))


def surrogate_key(c, unknown: str = "unknown") -> Column:
    """spaces -> '_', null -> 'unknown'."""
    return F.coalesce(F.replace(as_col(c), F.lit(" "), F.lit("_")), F.lit(unknown))


def ascii_only(c) -> Column:
    """remove every non-ASCII character."""
    return F.regexp_replace(as_col(c), NON_ASCII, "")


def combined_text(cols: Iterable) -> Column:
    """concat_ws(' ', c or '' ...) - a null column contributes ''."""
    return F.concat_ws(" ", *[F.coalesce(as_col(c), F.lit("")) for c in cols])


def first_non_null(cols: Iterable, default: str = "") -> Column:
    """first non-null text, else the default."""
    return F.coalesce(*[as_col(c) for c in cols], F.lit(default))


def contains_ci(text, needle) -> Column:
    """lower-case substring test."""
    return F.contains(F.lower(as_col(text)), F.lower(as_col(needle)))


def tokens(c) -> Column:
    """F20 tokenizer: words of >= 2 word characters of the lower-cased text."""
    return F.regexp_extract_all(F.lower(as_col(c)), F.lit(TOKEN_PATTERN), 0)


def parse_completion(c, marker: str = "Question:") -> Column:
    """text after the last marker, its first line, before the first '?', trimmed."""
    after = F.substring_index(as_col(c), marker, -1)
    first_line = F.substring_index(after, "\n", 1)
    return F.trim(F.substring_index(first_line, "?", 1))


def prompt(template_parts: list) -> Column:
    """prompt template; parts are literals (str) or Columns, null -> null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in template_parts])
