"""Movies: landing (database dump + category feeds) -> trusted -> exploitation.

Trusted: genres get lower-cased headers, renamed keys and normalized names,
and one row per name (W1, smallest id); the movie dump and every category
feed are conformed to one schema (P1-P3); category feeds are unioned by name
(U2, their columns differ) and the film-genre links are deduplicated (A1)
and merged per (film, genre), newest ingestion first (A3); category films
are merged per film the same way and then into the movie table (K6): columns
that no feed has stay as they are and get their default in new films only.  Exploitation: genres compacted per
film (J1 + A6), joined to films (J2), a sentence per film (F10) and
embedding records (P18).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions import text
from zoneflow.operators import enrich, merge, quality, shape

MOVIE_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("film_id", T.LongType()),
            ("title", T.StringType()),
            ("original_title", T.StringType()),
            ("original_language", T.StringType()),
            ("overview", T.StringType()),
            ("release_date", T.DateType()),
            ("revenue", T.DoubleType()),
            ("budget", T.DoubleType()),
            ("runtime", T.IntegerType()),
            ("adult", T.BooleanType()),
            ("popularity", T.DoubleType()),
            ("vote_average", T.DoubleType()),
            ("vote_count", T.LongType()),
            ("ingestion_time", T.TimestampType()),
        )
    ]
)
RENAMES = {"filmid": "film_id", "genreid": "genre_id", "collectionid": "collection_id", "status_": "status"}


def trusted_genres(genre_db: DataFrame) -> DataFrame:
    g = shape.rename_present(shape.lower_columns(genre_db), RENAMES)
    g = g.select(F.col("genre_id").cast("bigint").alias("genre_id"), text.normalize_genre("genre").alias("genre"))
    return quality.first_row_per_key(g, "genre", "genre_id")


def trusted_movies(movie_db: DataFrame) -> DataFrame:
    """The catalogue in the trusted schema, one row a film: copies are merged, what was ingested last first."""
    m = shape.rename_present(shape.lower_columns(movie_db), RENAMES, fallback={"id": "film_id"})
    return quality.merge_elements(quality.dedupe(shape.conform(m, MOVIE_SCHEMA)), ["film_id"], ["ingestion_time"], desc=True).select(*MOVIE_SCHEMA.fieldNames())


def category_links(feeds: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(one row a film with the columns that the feeds have, film-genre links) from the category feeds."""
    conformed, links = [], []
    for feed in feeds:
        f = shape.rename_present(shape.lower_columns(feed), RENAMES, fallback={"id": "film_id"})
        conformed.append(f)
        links.append(f.select(F.col("film_id").cast("bigint").alias("film_id"), F.explode("genre_ids").alias("genre_id"), "ingestion_time"))
    films = shape.union_batches(conformed)
    films = films.select(*[f.name for f in MOVIE_SCHEMA if f.name in films.columns])
    movies = quality.merge_elements(films, ["film_id"], ["ingestion_time"], desc=True)
    movie_genre = quality.merge_elements(quality.dedupe(shape.union_batches(links)), ["film_id", "genre_id"], ["ingestion_time"], desc=True)
    return movies, movie_genre


def category_films(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """(category, film_id) of the category feeds, in which films may be listed again and again."""
    ids = [shape.rename_present(shape.lower_columns(f), RENAMES, fallback={"id": "film_id"}).select(F.lit(name).alias("category"), F.col("film_id").cast("bigint").alias("film_id")) for name, f in feeds.items()]
    return quality.dedupe(shape.union_batches(ids))


def to_trusted(movie_db: DataFrame, movie_genre_db: DataFrame, genre_db: DataFrame, feeds: Sequence[DataFrame], normalize: Sequence[str] = ()):
    """Trusted movies, film-genre links and genres; ``normalize``: texts of the films to clean (F1)."""
    genres = trusted_genres(genre_db)
    movies = trusted_movies(movie_db)
    feed_movies, feed_links = category_links(feeds)
    clean = lambda df: df.withColumns({c: text.normalize_text(c) for c in normalize if c in df.columns})
    movies, feed_movies = clean(movies), clean(feed_movies)
    new_films = shape.absent_defaults(feed_movies, MOVIE_SCHEMA)
    feed_movies = shape.conform(feed_movies, MOVIE_SCHEMA, defaults=False)
    movies, _changes = merge.merge_coalesce(movies, feed_movies, ["film_id"], insert_defaults=new_films)
    db_links = shape.rename_present(shape.lower_columns(movie_genre_db), RENAMES).select("film_id", "genre_id", "ingestion_time")
    links = quality.merge_elements(quality.dedupe(db_links.unionByName(feed_links)), ["film_id", "genre_id"], ["ingestion_time"], desc=True)
    return movies, links, genres


def to_records(movies: DataFrame, links: DataFrame, genres: DataFrame) -> DataFrame:
    pairs = links.join(genres, "genre_id")  # J1
    compacted = enrich.string_agg(pairs, "film_id", "genre", "genres")  # A6
    films = movies.join(compacted, "film_id")  # J2: films without a genre are dropped
    sentence = enrich.sentence(
        ['"', F.col("title"), '" (released ', F.date_format("release_date", "yyyy-MM-dd"), ") is a ", F.col("genres"), " film: ", F.col("overview")]
    )
    records, _ = shape.prepare_records(films.withColumn("text_to_embed", sentence), "film_id", ["text_to_embed"], "movies", key_prefix="movie_")
    return records
