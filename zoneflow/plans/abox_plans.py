"""Knowledge-graph queries over the full sports, film and news maps, users' likes
and what clusters of users like best (G1-G3, G7, G8, U4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.ids import ONT, RDF_TYPE, RES
from zoneflow.operators.graph import abox, metrics, sample
from zoneflow.plans import text_plans
from zoneflow.plans.registry import register, table
from zoneflow.session import in_tasks_of

SEED = 7


def _triple(subject: str, predicate: str, value: str, rows: str, datatype: str | None = "string") -> str:
    """One kind of triple as SQL; without a datatype the object is an IRI."""
    p = RDF_TYPE if predicate == "type" else ONT + predicate
    kind, of = ("iri", "CAST(NULL AS VARCHAR)") if datatype is None else ("literal", f"'{datatype}'")
    return f"SELECT {subject} AS subject, '{p}' AS predicate, {value} AS object, '{kind}' AS object_kind, {of} AS datatype FROM {rows}"


def _iri(kind: str, value: str) -> str:
    return f"('{RES}{kind}_' || CAST({value} AS VARCHAR))"


def _hashed(kind: str, value: str) -> str:
    return f"('{RES}{kind}_' || sha256(CAST({value} AS VARCHAR)))"


def _whole(value: str) -> str:
    return f"CAST(TRY_CAST(trunc({value}) AS BIGINT) AS VARCHAR)"


def _set_sql(ctes: str, triples: list[str]) -> str:
    return f"WITH {ctes} SELECT DISTINCT * FROM ({' UNION ALL '.join(triples)}) WHERE subject IS NOT NULL AND object IS NOT NULL"


# --- sports ---------------------------------------------------------------------------

SPORTS_CTE = """
matches AS (
  SELECT o_orderkey AS fixture_id, o_custkey % 50 AS team_home_id, nullif(o_orderkey % 50, 7) AS team_away_id, nullif(CAST(trunc(o_totalprice) AS BIGINT) % 6, 5) AS goals_home,
    CAST(trunc(o_totalprice) AS BIGINT) % 4 AS goals_away, o_orderdate AS fixture_date, CASE o_orderstatus WHEN 'F' THEN 'match finished' WHEN 'O' THEN 'not started' ELSE 'walkover' END AS status_long,
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS league, CASE WHEN o_custkey % 11 <> 0 THEN 'Referee ' || CAST(o_custkey % 40 AS VARCHAR) END AS referee,
    CASE WHEN o_custkey % 13 <> 0 THEN 'v' || CAST(o_custkey % 25 AS VARCHAR) END AS venue_id
  FROM orders),
played AS (SELECT * FROM matches WHERE status_long IN ('match finished', 'walkover', 'technical loss', 'match abandoned')),
leagues AS (
  SELECT CAST(n_nationkey AS BIGINT) AS league_id, CASE WHEN n_nationkey % 3 = 0 THEN 'cup' ELSE 'league' END AS league_type, lower(n_name) AS league_name,
    CASE WHEN n_nationkey % 7 <> 6 THEN CASE WHEN n_regionkey = 0 THEN 'World' ELSE r_name END END AS country_name, 'C' || CAST(n_regionkey AS VARCHAR) AS country_code
  FROM nation JOIN region ON r_regionkey = n_regionkey),
teams AS (SELECT s_suppkey AS team_id, CASE WHEN s_suppkey % 17 <> 0 THEN lower(s_name) END AS team_name FROM supplier),
venues AS (SELECT 'v' || CAST(s_suppkey % 25 AS VARCHAR) AS venue_id, 'Venue ' || CAST(s_suppkey % 25 AS VARCHAR) AS venue_name, 'City ' || CAST(s_nationkey AS VARCHAR) AS venue_city FROM supplier)
"""
_COUNTRY = f"CASE WHEN country_name <> 'World' THEN {_hashed('country', 'country_code')} WHEN country_name IS NOT NULL THEN {_hashed('country', chr(39) + 'world' + chr(39))} END"
_MATCH, _LEAGUE = _iri("match", "fixture_id"), _iri("competition", "league_id")
SPORTS_SQL = _set_sql(
    SPORTS_CTE,
    [
        _triple(_MATCH, "match_home_team", _iri("team", "team_home_id"), "played", None),
        _triple(_MATCH, "match_away_team", _iri("team", "team_away_id"), "played", None),
        _triple(_MATCH, "match_home_goals", "CAST(goals_home AS VARCHAR)", "played", "integer"),
        _triple(_MATCH, "match_away_goals", "CAST(goals_away AS VARCHAR)", "played", "integer"),
        _triple(_MATCH, "match_date", "strftime(fixture_date, '%Y-%m-%dT%H:%M:%S')", "played", "dateTime"),
        _triple(_MATCH, "match_status", "status_long", "played"),
        _triple(_MATCH, "match_competition", _iri("competition", "league"), "played", None),
        _triple(_MATCH, "match_referee", _hashed("referee", "referee"), "played", None),
        _triple(_MATCH, "match_venue", _hashed("venue", "venue_id"), "played", None),
        _triple(_hashed("referee", "referee"), "referee_name", "referee", "played"),
        _triple(_LEAGUE, "type", f"CASE league_type WHEN 'cup' THEN '{ONT}Cup' ELSE '{ONT}League' END", "leagues", None),
        _triple(_LEAGUE, "competition_name", "league_name", "leagues"),
        _triple(_LEAGUE, "competition_country", _COUNTRY, "leagues", None),
        _triple(_COUNTRY, "country_name", "country_name", "leagues"),
        _triple(_iri("team", "team_id"), "team_name", "team_name", "teams"),
        _triple(_hashed("venue", "venue_id"), "venue_name", "venue_name", "venues"),
        _triple(_hashed("venue", "venue_id"), "venue_city", "venue_city", "venues"),
    ],
)


def sports_sources(spark, d) -> dict[str, DataFrame]:
    """Orders as matches, nations as leagues, suppliers as teams and venues."""
    nation, region = (table(spark, d, t) for t in ("nation", "region"))
    orders, supplier = (in_tasks_of(table(spark, d, t)) for t in ("orders", "supplier"))
    price = F.expr("CAST(o_totalprice AS BIGINT)")
    matches = orders.select(
        F.col("o_orderkey").alias("fixture_id"),
        (F.col("o_custkey") % 50).alias("team_home_id"),
        F.nullif(F.col("o_orderkey") % 50, F.lit(7)).alias("team_away_id"),
        F.nullif(price % 6, F.lit(5)).alias("goals_home"),
        (price % 4).alias("goals_away"),
        F.col("o_orderdate").alias("fixture_date"),
        F.when(F.col("o_orderstatus") == "F", "match finished").when(F.col("o_orderstatus") == "O", "not started").otherwise("walkover").alias("status_long"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("league"),
        F.when(F.col("o_custkey") % 11 != 0, F.concat(F.lit("Referee "), (F.col("o_custkey") % 40).cast("string"))).alias("referee"),
        F.when(F.col("o_custkey") % 13 != 0, F.concat(F.lit("v"), (F.col("o_custkey") % 25).cast("string"))).alias("venue_id"),
    )
    country = F.struct(F.when(F.col("n_regionkey") == 0, "World").otherwise(F.col("r_name")).alias("name"), F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("code"))
    leagues = nation.join(region, F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("league_id"),
        F.when(F.col("n_nationkey") % 3 == 0, "cup").otherwise("league").alias("league_type"),
        F.lower("n_name").alias("league_name"),
        F.when(F.col("n_nationkey") % 7 != 6, country).alias("country"),
    )
    teams = supplier.select(F.col("s_suppkey").alias("team_id"), F.when(F.col("s_suppkey") % 17 != 0, F.lower("s_name")).alias("team_name"))
    number = (F.col("s_suppkey") % 25).cast("string")
    venues = supplier.select(F.concat(F.lit("v"), number).alias("venue_id"), F.concat(F.lit("Venue "), number).alias("venue_name"), F.concat(F.lit("City "), F.col("s_nationkey").cast("string")).alias("venue_city"))
    return {"matches": matches, "leagues": leagues, "teams": teams, "venues": venues}


@register("abox_sports", SPORTS_SQL)
def abox_sports(spark, d):
    """G1 + G3 + U4: matches with their referees, competitions with their countries, teams, venues."""
    return abox.abox(sports_sources(spark, d), abox.sports_maps())


# --- films ----------------------------------------------------------------------------

MOVIES_CTE = """
movie AS (
  SELECT p_partkey AS film_id, p_name AS title, CASE WHEN p_size % 5 <> 0 THEN lower(p_brand) END AS original_language, DATE '2000-01-01' + CAST(p_partkey % 9000 AS INTEGER) AS release_date,
    p_retailprice AS revenue, p_size * 1000 AS budget, CASE WHEN p_size % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE p_size + 0.5 END AS runtime, p_size % 2 = 0 AS adult, p_retailprice / 10 AS popularity,
    p_size / 5.0 AS vote_average, p_partkey % 1000 AS vote_count, p_type, p_size, p_brand
  FROM part)
"""
_FILM = _iri("film", "film_id")
_GENRE = "substr(sha256(p_type), 1, 8)"
MOVIES_SQL = _set_sql(
    MOVIES_CTE,
    [
        _triple(_FILM, "movie_title", "title", "movie"),
        _triple(_FILM, "movie_language", "original_language", "movie"),
        _triple(_FILM, "movie_release_date", "strftime(release_date, '%Y-%m-%d')", "movie", "date"),
        _triple(_FILM, "movie_revenue", _whole("revenue"), "movie", "integer"),
        _triple(_FILM, "movie_budget", "CAST(budget AS VARCHAR)", "movie", "integer"),
        _triple(_FILM, "movie_runtime", _whole("runtime"), "movie WHERE NOT isnan(runtime)", "integer"),
        _triple(_FILM, "movie_vote_cnt", "CAST(vote_count AS VARCHAR)", "movie", "integer"),
        _triple(_FILM, "movie_adult", "CAST(adult AS VARCHAR)", "movie", "boolean"),
        _triple(_FILM, "movie_popularity", _whole("popularity"), "movie", "long"),
        _triple(_FILM, "movie_vote_avg", _whole("vote_average"), "movie", "long"),
        _triple(_FILM, "has_genre", _iri("genre", _GENRE), "movie", None),
        _triple(_iri("genre", _GENRE), "genre_name", "lower(p_type)", "movie"),
        _triple(_FILM, "trending_movie", "'true'", "movie WHERE p_size > 45", "boolean"),
        _triple(_FILM, "upcoming_movie", "'true'", "movie WHERE p_brand = 'Brand#1'", "boolean"),
        _triple(_FILM, "now_playing_movie", "'true'", "movie WHERE p_size < 3", "boolean"),
    ],
)


def movie_sources(spark, d) -> dict[str, DataFrame]:
    """Parts as films: their facts, genres and the three category tables."""
    part = in_tasks_of(table(spark, d, "part"))
    film, genre = F.col("p_partkey").alias("film_id"), F.substring(F.sha2("p_type", 256), 1, 8).alias("genre_id")
    movie = part.select(
        film,
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") % 5 != 0, F.lower("p_brand")).alias("original_language"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("p_partkey") % 9000).cast("int")).alias("release_date"),
        F.col("p_retailprice").alias("revenue"),
        (F.col("p_size") * 1000).alias("budget"),
        F.when(F.col("p_size") % 7 == 0, float("nan")).otherwise(F.col("p_size") + 0.5).alias("runtime"),
        (F.col("p_size") % 2 == 0).alias("adult"),
        (F.col("p_retailprice") / 10).alias("popularity"),
        (F.col("p_size") / 5.0).alias("vote_average"),
        (F.col("p_partkey") % 1000).alias("vote_count"),
    )
    return {
        "movie": movie,
        "movie_genre": part.select(film, genre),
        "genre": part.select(genre, F.lower("p_type").alias("genre")),
        "trending": part.where("p_size > 45").select(film),
        "upcoming": part.where("p_brand = 'Brand#1'").select(film),
        "now_playing": part.where("p_size < 3").select(film),
    }


@register("abox_movies", MOVIES_SQL)
def abox_movies(spark, d):
    """G1 + G2 + U4: films, their genres and the category flags, now playing included."""
    return abox.abox(movie_sources(spark, d), abox.movie_maps())


# --- news -----------------------------------------------------------------------------

NEWS_CTE = """
article AS (
  SELECT doc_id, 'https://news.example/' || CAST(doc_id AS VARCHAR) AS url, CASE lang WHEN 'en' THEN 'Entertainment_News' WHEN 'fr' THEN 'Sports_News' ELSE 'Tech_News' END AS cls,
    CASE WHEN doc_id % 5 <> 0 THEN 'Author ' || CAST(doc_id % 30 AS VARCHAR) END AS author, nullif(source, 'src0') AS source, upper(lang) || ' ' || CAST(n_chars AS VARCHAR) AS title,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS published
  FROM documents)
"""
_NEWS = _hashed("news", "url")
NEWS_SQL = _set_sql(
    text_plans.KEYWORDS_CTE
    + ", "
    + NEWS_CTE
    + ", tag AS (SELECT 'https://news.example/' || CAST(d.doc_id AS VARCHAR) AS url, k.term AS keyword FROM docs d JOIN keywords k ON k.lang = d.lang AND contains(lower(d.norm), k.term))",
    [
        _triple(_NEWS, "type", f"'{ONT}' || cls", "article", None),
        _triple(_NEWS, "written_by", _hashed("author", "author"), "article", None),
        _triple(_hashed("author", "author"), "author_name", "author", "article"),
        _triple(_NEWS, "published_at", _hashed("source", "source"), "article", None),
        _triple(_hashed("source", "source"), "source_name", "source", "article"),
        _triple(_NEWS, "news_title", "title", "article"),
        _triple(_NEWS, "news_date", "strftime(published, '%Y-%m-%dT%H:%M:%S')", "article", "dateTime"),
        _triple(_NEWS, "related_keyword", _hashed("keyword", "keyword"), "tag", None),
        _triple(_hashed("keyword", "keyword"), "keyword_text", "keyword", "tag"),
    ],
)


def news_sources(spark, d) -> dict[str, DataFrame]:
    """Documents as articles, and the keywords that their texts hold."""
    docs = table(spark, d, "documents")
    url = lambda c: F.concat(F.lit("https://news.example/"), F.col(c).cast("string")).alias("url")
    articles = docs.select(
        url("doc_id"),
        F.when(F.col("lang") == "en", "Entertainment_News").when(F.col("lang") == "fr", "Sports_News").otherwise("Tech_News").alias("cls"),
        F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("Author "), (F.col("doc_id") % 30).cast("string"))).alias("author"),
        F.nullif(F.col("source"), F.lit("src0")).alias("source"),
        F.concat_ws(" ", F.upper("lang"), F.col("n_chars").cast("string")).alias("title"),
        F.timestamp_add("MINUTE", F.col("doc_id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("publishedAt"),
    )
    return {"articles": articles, "tags": text_plans.keyword_tagging(spark, d).select(url("doc_id"), "keyword")}


@register("abox_news", NEWS_SQL)
def abox_news(spark, d):
    """G1 + G3 + U4: articles of three classes, authors, sources and keywords."""
    return abox.abox(news_sources(spark, d), abox.news_maps())


# --- likes ----------------------------------------------------------------------------

POOLS_SQL = """
pool(kind, item) AS (
  SELECT DISTINCT 'film', CAST(p_partkey AS VARCHAR) FROM part UNION SELECT DISTINCT 'genre', substr(sha256(p_type), 1, 8) FROM part UNION SELECT DISTINCT 'team', CAST(s_suppkey AS VARCHAR) FROM supplier
  UNION SELECT DISTINCT 'competition', CAST(n_nationkey AS VARCHAR) FROM nation UNION SELECT DISTINCT 'keyword', sha256(p_brand) FROM part),
item AS (SELECT kind, item, row_number() OVER (PARTITION BY kind ORDER BY item) - 1 AS idx FROM pool),
size AS (SELECT kind, count(*) AS m FROM item GROUP BY kind)
"""


def _likes_sql() -> str:
    """The draws step by step, as many as the largest number of likes."""
    limits = ", ".join(f"('{k}', '{p}', {lo}, {hi})" for k, (p, (lo, hi)) in abox.LIKES.items())
    draw = lambda x: f"('0x' || substr(sha256('{SEED}:' || kind || ':' || CAST(c_custkey AS VARCHAR) || ':{x}'), 1, 8))::BIGINT"
    steps = ""
    for i in range(max(hi for _, (_, hi) in abox.LIKES.values())):
        t = f"{draw(i)} % (m - k + {i + 1})"
        steps += f""",
s{i + 1} AS (SELECT c_custkey, kind, predicate, m, k, CASE WHEN {i} >= k THEN s WHEN list_contains(s, {t}) THEN list_append(s, m - k + {i}) ELSE list_append(s, {t}) END AS s FROM s{i})"""
    last = max(hi for _, (_, hi) in abox.LIKES.values())
    return (
        POOLS_SQL
        + f""",
limits(kind, predicate, lo, hi) AS (VALUES {limits}),
s0 AS (SELECT c_custkey, kind, predicate, m, least(lo + {draw("k")} % (hi - lo + 1), m) AS k, CAST([] AS BIGINT[]) AS s FROM customer CROSS JOIN limits JOIN size USING (kind)){steps},
likes AS (SELECT '{RES}user_' || CAST(c_custkey AS VARCHAR) AS subject, '{ONT}' || predicate AS predicate, '{RES}' || kind || '_' || item AS object, 'iri' AS object_kind, CAST(NULL AS VARCHAR) AS datatype
  FROM (SELECT c_custkey, kind, predicate, unnest(s) AS idx FROM s{last}) x JOIN item USING (kind, idx))"""
    )


def _likes(spark, d) -> DataFrame:
    part, supplier, nation = (table(spark, d, t) for t in ("part", "supplier", "nation"))
    pool = lambda df, kind, item: df.select(F.lit(kind).alias("kind"), item.cast("string").alias("item"))
    pools = [
        pool(part, "film", F.col("p_partkey")),
        pool(part, "genre", F.substring(F.sha2("p_type", 256), 1, 8)),
        pool(supplier, "team", F.col("s_suppkey")),
        pool(nation, "competition", F.col("n_nationkey")),
        pool(part, "keyword", F.sha2("p_brand", 256)),
    ]
    users = table(spark, d, "customer").select("c_custkey")
    drawn = sample.draw_from_pools(spark, users, "c_custkey", reduce(DataFrame.unionByName, pools), {k: span for k, (_, span) in abox.LIKES.items()}, SEED)
    return abox.like_triples(drawn, "c_custkey")


@register("user_likes", f"WITH {_likes_sql()} SELECT * FROM likes")
def user_likes(spark, d):
    """Every customer likes some films, genres, teams and competitions and is interested in some keywords."""
    return _likes(spark, d)


@register(
    "cluster_likes",
    f"""WITH {_likes_sql()},
names(predicate, path, object, name) AS (
  SELECT '{ONT}likes_movie', 'movie', '{RES}film_' || CAST(p_partkey AS VARCHAR), p_name FROM part
  UNION SELECT '{ONT}likes_genre', 'genre', '{RES}genre_' || substr(sha256(p_type), 1, 8), lower(p_type) FROM part
  UNION SELECT '{ONT}likes_team', 'team', '{RES}team_' || CAST(s_suppkey AS VARCHAR), lower(s_name) FROM supplier
  UNION SELECT '{ONT}likes_competition', 'competition', '{RES}competition_' || CAST(n_nationkey AS VARCHAR), lower(n_name) FROM nation
  UNION SELECT '{ONT}interested_in', 'keyword', '{RES}keyword_' || sha256(p_brand), p_brand FROM part),
member AS (SELECT '{RES}user_' || CAST(c_custkey AS VARCHAR) AS subject, CAST(c_nationkey % 6 - 1 AS BIGINT) AS cluster FROM customer),
counted AS (SELECT cluster, path AS category, name, count(*) AS n FROM member JOIN likes USING (subject) JOIN names USING (predicate, object) WHERE cluster <> -1 GROUP BY ALL)
SELECT cluster, category, name, n FROM counted QUALIFY row_number() OVER (PARTITION BY cluster, category ORDER BY n DESC, name) = 1""",
)
def cluster_likes(spark, d):
    """G7 + A15 + A16 + T2 on its five categories: what each cluster of users likes best, noise left out."""
    part, supplier, nation, customer = (table(spark, d, t) for t in ("part", "supplier", "nation", "customer"))
    named = lambda df, kind, item, predicate, name: df.select(
        F.concat(F.lit(f"{RES}{kind}_"), item.cast("string")).alias("subject"), F.lit(ONT + predicate).alias("predicate"), name.alias("object")
    ).distinct()
    names = [
        named(part, "film", F.col("p_partkey"), "movie_title", F.col("p_name")),
        named(part, "genre", F.substring(F.sha2("p_type", 256), 1, 8), "genre_name", F.lower("p_type")),
        named(supplier, "team", F.col("s_suppkey"), "team_name", F.lower("s_name")),
        named(nation, "competition", F.col("n_nationkey"), "competition_name", F.lower("n_name")),
        named(part, "keyword", F.sha2("p_brand", 256), "keyword_text", F.col("p_brand")),
    ]
    triples = reduce(DataFrame.unionByName, [_likes(spark, d).select("subject", "predicate", "object"), *names])
    members = customer.select(F.concat(F.lit(RES + "user_"), F.col("c_custkey").cast("string")).alias("user"), (F.col("c_nationkey") % 6 - 1).cast("bigint").alias("cluster"))
    paths = {"movie": ("likes_movie", "movie_title"), "genre": ("likes_genre", "genre_name"), "team": ("likes_team", "team_name")}
    paths |= {"competition": ("likes_competition", "competition_name"), "keyword": ("interested_in", "keyword_text")}
    return metrics.top_preferences(members, triples, {c: [ONT + p for p in hops] for c, hops in paths.items()})
