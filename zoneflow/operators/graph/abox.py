"""Any number of entity maps over one source, in one scan.

A fact table carries entities of several kinds (a match its referee, a film its
genre), and the same entity in many rows.  ``source_triples`` reads a source
once: every row becomes one narrow row for each map, with the columns that the
map reads and nulls for the others.  Distinct narrow rows, which Spark
pre-aggregates, are all that is mapped to triples, so a genre's triples are
made once and not once a film.  The maps below are those of the sports, film
and news tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.ids import ONT, RDF_TYPE, RES, iri, stable_hash
from zoneflow.operators.graph.mapping import PredicateMap, _iri, flag, link, literal
from zoneflow.operators.graph.tbox import TRIPLE_COLS

# FIXED VALUES: the states of a match that has been played or decided
PLAYED = ("match finished", "walkover", "technical loss", "match abandoned")


@dataclass(frozen=True)
class EntityMap:
    """A kind of entity: the columns it is made of, its IRI, class (None: left to inference) and predicates."""

    columns: tuple[str, ...]
    subject: Column
    cls: Column | str | None = None
    predicates: Sequence[PredicateMap] = ()
    guard: Column | None = None


def _triples_of(m: EntityMap, ont: str) -> Column:
    entry = lambda p, o, kind, datatype: F.struct(
        m.subject.alias("subject"), F.lit(p).alias("predicate"), o.cast("string").alias("object"), F.lit(kind).alias("object_kind"), F.lit(datatype).cast("string").alias("datatype")
    )
    out = [entry(_iri(p.predicate, ont), p.value, p.kind, p.datatype) for p in m.predicates]
    if m.cls is not None:
        out.append(entry(RDF_TYPE, F.lit(_iri(m.cls, ont)) if isinstance(m.cls, str) else m.cls, "iri", None))
    return F.array(*out)


def source_triples(df: DataFrame, maps: Sequence[EntityMap], ont: str = ONT) -> DataFrame:
    """The triples of all ``maps`` of one source; a triple with a null subject or object is left out."""
    types = {f.name: f.dataType for f in df.schema}
    used = [c for c in df.columns if any(c in m.columns for m in maps)]
    narrow = []
    for i, m in enumerate(maps):
        row = F.struct(F.lit(i).alias("__map"), *((F.col(c) if c in m.columns else F.lit(None).cast(types[c])).alias(c) for c in used))
        narrow.append(row if m.guard is None else F.when(m.guard, row))
    rows = df.select(F.explode(F.array(*narrow)).alias("r")).where("r IS NOT NULL").select("r.*").distinct()
    each = reduce(lambda rest, i: F.when(F.col("__map") == i, _triples_of(maps[i], ont)).otherwise(rest), range(len(maps) - 1, 0, -1), _triples_of(maps[0], ont))
    return rows.select(F.inline(each)).where("subject IS NOT NULL AND object IS NOT NULL").select(*TRIPLE_COLS)


def abox(sources: Mapping[str, DataFrame], maps: Mapping[str, Sequence[EntityMap]], ont: str = ONT) -> DataFrame:
    """All sources' triples as a set (U4)."""
    parts = [source_triples(df, maps[name], ont) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts).distinct()


def hashed(kind: str, column: str) -> Column:
    """The IRI of an entity that is known by a text."""
    return iri(kind, stable_hash(column))


def sports_maps() -> dict[str, list[EntityMap]]:
    """matches, leagues, teams and venues; a match counts once it has been played."""
    played = F.col("status_long").isin(*PLAYED)
    abroad = F.col("country.name") != "World"
    country = F.when(abroad, hashed("country", "country.code")).otherwise(iri("country", stable_hash(F.lit("world"))))
    match = EntityMap(
        ("fixture_id", "team_home_id", "team_away_id", "goals_home", "goals_away", "fixture_date", "status_long", "league", "referee", "venue_id"),
        iri("match", "fixture_id"),
        None,
        [
            link("match_home_team", iri("team", "team_home_id")),
            link("match_away_team", iri("team", "team_away_id")),
            literal("match_home_goals", F.col("goals_home"), "integer"),
            literal("match_away_goals", F.col("goals_away"), "integer"),
            literal("match_date", F.col("fixture_date"), "dateTime"),
            literal("match_status", F.col("status_long")),
            link("match_competition", iri("competition", "league")),
            link("match_referee", hashed("referee", "referee")),
            link("match_venue", hashed("venue", "venue_id")),
        ],
        played,
    )
    competition = EntityMap(
        ("league_id", "league_type", "league_name", "country"),
        iri("competition", "league_id"),
        F.when(F.col("league_type") == "cup", ONT + "Cup").otherwise(ONT + "League"),  # G3
        [literal("competition_name", F.col("league_name")), link("competition_country", F.when(F.col("country.name").isNotNull(), country))],
    )
    return {
        "matches": [match, EntityMap(("referee",), hashed("referee", "referee"), None, [literal("referee_name", F.col("referee"))], played)],
        "leagues": [competition, EntityMap(("country",), F.when(F.col("country.name").isNotNull(), country), None, [literal("country_name", F.col("country.name"))])],
        "teams": [EntityMap(("team_id", "team_name"), iri("team", "team_id"), None, [literal("team_name", F.col("team_name"))])],
        "venues": [EntityMap(("venue_id", "venue_name", "venue_city"), hashed("venue", "venue_id"), None, [literal("venue_name", F.col("venue_name")), literal("venue_city", F.col("venue_city"))])],
    }


def movie_maps() -> dict[str, list[EntityMap]]:
    """movie, movie_genre, genre and the category tables trending, upcoming and now_playing."""
    film = iri("film", "film_id")
    whole = [("movie_revenue", "revenue"), ("movie_budget", "budget"), ("movie_runtime", "runtime"), ("movie_vote_cnt", "vote_count")]
    facts = [
        literal("movie_title", F.col("title")),
        literal("movie_language", F.col("original_language")),
        literal("movie_release_date", F.col("release_date"), "date"),
        *(literal(p, F.when(~F.isnan(F.col(c).cast("double")), F.col(c)), "integer") for p, c in whole),
        literal("movie_adult", F.col("adult"), "boolean"),
        literal("movie_popularity", F.col("popularity"), "long"),
        literal("movie_vote_avg", F.col("vote_average"), "long"),
    ]
    columns = ("film_id", "title", "original_language", "release_date", "revenue", "budget", "runtime", "vote_count", "adult", "popularity", "vote_average")
    flags = {c: [EntityMap(("film_id",), film, None, [flag(f"{c}_movie", F.lit(True))])] for c in ("trending", "upcoming", "now_playing")}
    return {
        "movie": [EntityMap(columns, film, None, facts)],
        "movie_genre": [EntityMap(("film_id", "genre_id"), film, None, [link("has_genre", iri("genre", "genre_id"))])],
        "genre": [EntityMap(("genre_id", "genre"), iri("genre", "genre_id"), None, [literal("genre_name", F.col("genre"))])],
        **flags,
    }


def news_maps() -> dict[str, list[EntityMap]]:
    """articles (of a class each) with their authors and sources, and the keywords found in them."""
    named = lambda kind, column, predicate: EntityMap((column,), hashed(kind, column), None, [literal(predicate, F.col(column))])
    article = EntityMap(
        ("url", "cls", "author", "source", "title", "publishedAt"),
        hashed("news", "url"),
        F.concat(F.lit(ONT), F.col("cls")),
        [
            link("written_by", hashed("author", "author")),
            link("published_at", hashed("source", "source")),
            literal("news_title", F.col("title")),
            literal("news_date", F.col("publishedAt"), "dateTime"),
        ],
    )
    tag = EntityMap(("url", "keyword"), hashed("news", "url"), None, [link("related_keyword", hashed("keyword", "keyword"))])
    return {
        "articles": [article, named("author", "author", "author_name"), named("source", "source", "source_name")],
        "tags": [tag, named("keyword", "keyword", "keyword_text")],
    }


# a user's likes: the kind of thing, the predicate and how many of them
LIKES = {
    "film": ("likes_movie", (1, 3)),
    "genre": ("likes_genre", (1, 3)),
    "team": ("likes_team", (1, 3)),
    "competition": ("likes_competition", (1, 3)),
    "keyword": ("interested_in", (1, 5)),
}


def like_triples(drawn: DataFrame, key_col: str, ont: str = ONT) -> DataFrame:
    """Triples of (key, kind, item) draws, where an item is the end of an IRI."""
    predicate = reduce(lambda rest, k: F.when(F.col("kind") == k, _iri(LIKES[k][0], ont)).otherwise(rest), LIKES, F.lit(None).cast("string"))
    out = drawn.select(iri("user", key_col).alias("subject"), predicate.alias("predicate"), F.concat(F.lit(RES), "kind", F.lit("_"), F.col("item").cast("string")).alias("object"))
    return out.where("predicate IS NOT NULL").select("subject", "predicate", "object", F.lit("iri").alias("object_kind"), F.lit(None).cast("string").alias("datatype"))
