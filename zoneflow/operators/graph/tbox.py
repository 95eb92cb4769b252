"""The ontology (TBox) as data.

FIXED VALUES - these axioms must equal the reference ontology for the
inference and metrics to give the same answers.  Two of its quirks are
fixed here (SURVEY Q14, Q15): ``has_genre`` runs Movie -> Genre, and the
subclass axiom names ``Referee`` (not ``Referees``).  Names without a prefix
live in the ontology namespace; ``xsd:``/``foaf:`` are the public ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from zoneflow.functions.ids import FOAF, ONT, RDFS, XSD

# ---- FIXED VALUES: property, domain, range (46 properties) ----------------
PROPERTIES = [
    ("user_name", "User", "xsd:string"),
    ("user_country", "User", "Country"),
    ("likes_movie", "User", "Movie"),
    ("likes_genre", "User", "Genre"),
    ("likes_team", "User", "Team"),
    ("likes_competition", "User", "Competition"),
    ("interested_in", "User", "Keyword"),
    ("country_name", "Country", "xsd:string"),
    ("match_home_team", "Match", "Team"),
    ("match_away_team", "Match", "Team"),
    ("match_home_goals", "Match", "xsd:integer"),
    ("match_away_goals", "Match", "xsd:integer"),
    ("match_date", "Match", "xsd:dateTime"),
    ("match_status", "Match", "xsd:string"),
    ("match_competition", "Match", "Competition"),
    ("match_referee", "Match", "Referee"),
    ("match_venue", "Match", "Venue"),
    ("competition_country", "Competition", "Country"),
    ("competition_name", "Competition", "xsd:string"),
    ("team_name", "Team", "xsd:string"),
    ("referee_name", "Referee", "xsd:string"),
    ("venue_name", "Venue", "xsd:string"),
    ("venue_city", "Venue", "xsd:string"),
    ("movie_title", "Movie", "xsd:string"),
    ("movie_language", "Movie", "xsd:string"),
    ("movie_release_date", "Movie", "xsd:date"),
    ("movie_revenue", "Movie", "xsd:integer"),
    ("movie_budget", "Movie", "xsd:integer"),
    ("movie_runtime", "Movie", "xsd:integer"),
    ("movie_adult", "Movie", "xsd:boolean"),
    ("movie_popularity", "Movie", "xsd:long"),
    ("movie_vote_avg", "Movie", "xsd:long"),
    ("movie_vote_cnt", "Movie", "xsd:integer"),
    ("upcoming_movie", "Movie", "xsd:boolean"),
    ("trending_movie", "Movie", "xsd:boolean"),
    ("now_playing_movie", "Movie", "xsd:boolean"),
    ("has_genre", "Movie", "Genre"),
    ("genre_name", "Genre", "xsd:string"),
    ("written_by", "News", "Author"),
    ("author_name", "Author", "xsd:string"),
    ("related_keyword", "News", "Keyword"),
    ("published_at", "News", "Source"),
    ("source_name", "Source", "xsd:string"),
    ("news_title", "News", "xsd:string"),
    ("news_date", "News", "xsd:dateTime"),
    ("keyword_text", "Keyword", "xsd:string"),
]

# ---- FIXED VALUES: subclass axioms (18) ------------------------------------
SUBCLASSES = [
    ("Match", "Sports"),
    ("Competition", "Sports"),
    ("League", "Competition"),
    ("Cup", "Competition"),
    ("Team", "Sports"),
    ("Referee", "Sports"),
    ("Venue", "Sports"),
    ("Movie", "Entertainment"),
    ("Genre", "Entertainment"),
    ("Entertainment_News", "News"),
    ("Entertainment_News", "Entertainment"),
    ("Sports_News", "News"),
    ("Sports_News", "Sports"),
    ("Tech_News", "News"),
    ("Tech_News", "Technology"),
    ("User", "foaf:Person"),
    ("Referee", "foaf:Person"),
    ("Author", "foaf:Person"),
]

# ---- FIXED VALUES: subproperty axioms (3) ----------------------------------
SUBPROPERTIES = [
    ("user_name", "foaf:name"),
    ("author_name", "foaf:name"),
    ("referee_name", "foaf:name"),
]

RDFS_DOMAIN = RDFS + "domain"
RDFS_RANGE = RDFS + "range"
RDFS_SUBCLASS = RDFS + "subClassOf"
RDFS_SUBPROPERTY = RDFS + "subPropertyOf"
RDFS_CLASS = RDFS + "Class"
RDF_PROPERTY = "http://www.w3.org/1999/02/22-rdf-syntax-ns#Property"


def expand(name: str, ont: str = ONT) -> str:
    if name.startswith("xsd:"):
        return XSD + name[4:]
    if name.startswith("foaf:"):
        return FOAF + name[5:]
    return ont + name


def axioms(ont: str = ONT) -> list[tuple[str, str, str]]:
    """The 113 TBox statements as (subject, predicate, object) IRIs."""
    out = []
    for p, d, r in PROPERTIES:
        out.append((expand(p, ont), RDFS_DOMAIN, expand(d, ont)))
        out.append((expand(p, ont), RDFS_RANGE, expand(r, ont)))
    out += [(expand(a, ont), RDFS_SUBCLASS, expand(b, ont)) for a, b in SUBCLASSES]
    out += [(expand(a, ont), RDFS_SUBPROPERTY, expand(b, ont)) for a, b in SUBPROPERTIES]
    return out


TRIPLE_COLS = ["subject", "predicate", "object", "object_kind", "datatype"]
TRIPLE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TRIPLE_COLS])


def tbox_triples(spark: SparkSession, ont: str = ONT) -> DataFrame:
    """TBox as a (fixed-size, 113-row) triples DataFrame."""
    rows = [(s, p, o, "iri", None) for s, p, o in axioms(ont)]
    return spark.createDataFrame(rows, TRIPLE_SCHEMA)


def values_sql(ont: str = ONT) -> str:
    """The same axioms as a SQL VALUES list (for oracle queries)."""
    return ",\n".join(f"('{s}', '{p}', '{o}')" for s, p, o in axioms(ont))
