"""Timestamp functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow.functions._util import as_col

# Fixed formats (must equal the reference's).
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
DISPLAY_FORMAT = "dd MMMM yyyy"


def parse_iso(c, fmt: str = ISO_FORMAT) -> Column:
    """parse an ISO timestamp string; bad input -> null (also under ANSI)."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt))


def epoch_to_timestamp(c) -> Column:
    """epoch seconds -> timestamp (kept a timestamp; format only for display)."""
    return F.timestamp_seconds(as_col(c))


def display_date(c, fmt: str = DISPLAY_FORMAT) -> Column:
    """F8: 'dd MMMM yyyy' of a timestamp (or a timestamp string)."""
    x = as_col(c)
    return F.date_format(x, fmt)


def stamp(as_of: _dt.datetime | None = None) -> Column:
    """processing-time stamp; an injected ``as_of`` literal makes tests exact."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
