"""News: landing -> trusted -> exploitation.

Trusted step, per run: incremental read of the landing table (I1) ->
parse ``publishedAt`` and require a url (F6, P10) -> drop exact duplicates
(A1) -> rebuild missing source ids (P5) -> merge hidden duplicates per url,
newest first (A3) -> normalize the text columns (F1) -> keep the source id
(P6) -> high-water merge into the trusted table (K7) -> commit the control
row.  Exploitation step: embedding records (P18) from the trusted rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import temporal, text
from zoneflow.operators import quality, shape
from zoneflow.session import materialize
from zoneflow.sources.store import VersionedTable
from zoneflow.streaming.incremental import IncrementalLoader

TEXT_COLUMNS = ["title", "description", "content"]
KEY = ["url"]


def clean(landing: DataFrame) -> DataFrame:
    """All per-batch cleaning up to (and including) the hidden-duplicate merge
    and normalization; returns rows in the trusted schema."""
    parsed = landing.withColumn("publishedAt", temporal.parse_iso("publishedAt")).where(F.col("url").isNotNull())
    deduped = quality.dedupe(parsed)
    repaired = shape.repair_struct_id(deduped, "source")
    flat = shape.struct_to_field(repaired, "source")
    merged = quality.merge_elements(flat, KEY, ["publishedAt"], desc=True)
    return merged.select(
        "url",
        "source",
        "author",
        *[text.normalize_text(c).alias(c) for c in TEXT_COLUMNS],
        "publishedAt",
    )


def to_trusted(loader: IncrementalLoader, trusted: VersionedTable) -> int:
    """One scheduled run; returns the number of cleaned rows merged."""
    batch = loader.get_new_data()
    # The cleaned batch feeds several branches of the merge (late / fresh /
    # key checks): write it once instead of recomputing the cleaning.
    rows = materialize(trusted.spark, clean(batch), "news-clean")
    if not trusted.exists():
        trusted.create(rows)
    else:
        trusted.merge_high_water(rows, KEY, "publishedAt")
    loader.commit()  # only after the merge succeeded (at-least-once + idempotent merge)
    return rows.count()


def to_records(trusted: DataFrame) -> DataFrame:
    """Exploitation: (_id, text_to_embed, source) with a source-prefixed id (Q23)."""
    records, _ = shape.prepare_records(trusted, "url", ["content", "description", "title"], "news", key_prefix="news_")
    return records
