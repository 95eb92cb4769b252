"""Sports: nested landing records -> trusted matches, teams, venues, leagues and countries.

Match records are flattened (P4) and their texts normalized (F1).  Teams play in
two roles that are read from one scan (U1, A1) and give one row a team with each
column's first known value (A3); venues get an id from their name (F4).  What
is left of a match are its facts: the detail of teams and venues goes (P7), epoch
seconds become timestamps (F7), and copies are merged per (fixture, status),
exact ones first (A1), then those that know less than others (A3).  Loads into
the trusted matches go by the high-water mark of the match time (K7).

A league record gives a league (one row an id, W2) and a country (F13).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import text
from zoneflow.operators import merge, quality, shape

FIXTURE_KEY = ["fixture_id", "status_long"]
# where the facts of a match lie in a record; paths that a feed lacks are left out
FACTS = {
    "fixture_id": "fixture.id",
    "fixture_date": "fixture.date",
    "timestamp": "fixture.timestamp",
    "period_first": "fixture.periods.first",
    "period_second": "fixture.periods.second",
    "referee": "fixture.referee",
    "status_long": "fixture.status.long",
    "status_short": "fixture.status.short",
    "status_elapsed": "fixture.status.elapsed",
    "league": "league.id",
    "goals_home": "goals.home",
    "goals_away": "goals.away",
}
VENUE = {"venue_name": "fixture.venue.name", "venue_city": "fixture.venue.city"}
TEAM_COLUMNS = ("id", "name", "logo", "winner")
SPOKEN = ("referee", "venue_city", "venue_name", "team_away_name", "team_home_name", "status_long")


def _has(schema, path: str) -> bool:
    """Whether a nested path exists."""
    for part in path.split("."):
        if not hasattr(schema, "fieldNames") or part not in schema.fieldNames():
            return False
        schema = schema[part].dataType
    return True


def expand(landing: DataFrame, normalize: Sequence[str] = ()) -> DataFrame:
    """Match records as flat columns; ``normalize``: texts to clean (``SPOKEN``: all that people wrote)."""
    paths = FACTS | VENUE | {f"team_{role}_{c}": f"teams.{role}.{c}" for role in ("home", "away") for c in TEAM_COLUMNS}
    flat = shape.flatten(landing, {name: path for name, path in paths.items() if _has(landing.schema, path)})
    return flat.withColumns({c: text.normalize_text(c) for c in normalize if c in flat.columns})


def extract_teams(matches: DataFrame) -> DataFrame:
    """One row a team, from both roles."""
    roles = [{f"team_{c}": f"team_{role}_{c}" for c in ("id", "logo", "name")} for role in ("home", "away")]
    return quality.merge_elements(quality.dedupe(shape.union_roles(matches, roles)), ["team_id"])


def extract_venues(matches: DataFrame) -> DataFrame:
    """One row a venue; a venue without a name is unknown."""
    named = matches.select(text.surrogate_key("venue_name").alias("venue_id"), "venue_name", "venue_city")
    return quality.dedupe(quality.merge_elements(named, ["venue_id"]))


def trusted_matches(matches: DataFrame) -> DataFrame:
    """The facts of the matches, one row a (fixture, status)."""
    detail = [f"team_{role}_{c}" for role in ("home", "away") for c in ("name", "logo")]
    facts = shape.drop_present(matches.withColumn("venue_id", text.surrogate_key("venue_name")), *detail, *VENUE, "status_short")
    times = [c for c in ("timestamp", "period_first", "period_second") if c in facts.columns]
    facts = facts.withColumns({c: F.timestamp_seconds(c) for c in times})
    return quality.merge_elements(quality.dedupe(facts), FIXTURE_KEY, ["timestamp"])


def load_matches(trusted: DataFrame | None, batch: DataFrame) -> DataFrame:
    """``trusted`` after a batch of trusted matches: those beyond its latest match time are added, others are merged in."""
    return batch if trusted is None else merge.merge_high_water(trusted, batch, FIXTURE_KEY, "timestamp")[0]


def leagues(landing: DataFrame) -> DataFrame:
    """One row a league id: its country, lower-cased name and type, and logo."""
    rows = landing.select(
        F.col("league.id").alias("league_id"),
        "country",
        F.lower("league.name").alias("league_name"),
        F.lower("league.type").alias("league_type"),
        F.col("league.logo").alias("league_logo"),
    )
    return quality.first_row_per_key(quality.dedupe(rows), "league_id", ["league_name", "league_type"])


def countries(landing: DataFrame) -> DataFrame:
    """country_code, country_name and country_flag of the leagues' countries."""
    flat = landing.select(F.col("country.name").alias("name"), F.col("country.code").alias("code"), F.col("country.flag").alias("flag"))
    return quality.country_codes(flat, "name", "code", "flag")
