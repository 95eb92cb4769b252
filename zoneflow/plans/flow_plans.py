"""End-to-end flow queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from zoneflow.flows import news
from zoneflow.plans.registry import register, table
from zoneflow.session import materialize, scratch_path
from zoneflow.sources.store import VersionedTable
from zoneflow.streaming.incremental import ControlTable, IncrementalLoader


def news_landing(spark, d):
    """Documents arrive as news articles: the url is derived from the text,
    so exact copies become full-row duplicates and copies under another
    source become hidden duplicates of one url."""
    docs = table(spark, d, "documents")
    h = F.sha2(F.col("text"), 256)
    minutes = F.conv(F.substring(h, 1, 6), 16, 10).cast("int")
    published = F.timestamp_add("MINUTE", minutes, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return docs.select(
        F.when(F.col("lang") == "en", F.lit(1)).when(F.col("lang") == "fr", F.lit(1)).otherwise(F.lit(2)).alias("batch"),
        F.struct(
            F.nullif(F.col("source"), F.lit("src0")).alias("id"),
            F.concat(F.lit("Source "), F.upper("source")).alias("name"),
        ).alias("source"),
        F.when(F.col("lang") != "de", F.concat(F.lit("author_"), F.col("lang"))).alias("author"),
        F.concat(F.upper("lang"), F.lit(" news from "), F.col("source")).alias("title"),
        F.when(F.col("lang") != "en", F.concat(F.lit("About "), F.col("source"), F.lit(": "), F.col("lang"))).alias("description"),
        F.concat(F.lit("https://news.example/a/"), F.substring(h, 1, 16)).alias("url"),
        F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        F.col("text").alias("content"),
    )


def _run_flow(spark, d):
    landing_rows = news_landing(spark, d)
    landing = VersionedTable(spark, scratch_path(spark, "news-landing"))
    # Storage units: 16 url-hash buckets (publication dates here spread over decades).
    trusted = VersionedTable(spark, scratch_path(spark, "news-trusted"), unit=F.pmod(F.xxhash64("url"), F.lit(16)))
    control = ControlTable(spark, scratch_path(spark, "news-control"))
    cols = [c for c in landing_rows.columns if c != "batch"]
    landing.create(landing_rows.where(F.col("batch") == 1).select(*cols))
    news.to_trusted(IncrementalLoader(spark, control, "news", landing), trusted)  # first run: full load
    landing.append(landing_rows.where(F.col("batch") == 2).select(*cols))
    news.to_trusted(IncrementalLoader(spark, control, "news", landing), trusted)  # second run: new rows only
    return trusted.read()


_F1 = (
    r"nullif(trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), 'http\S+|www\.\S+', ' ', 'g'),"
    r" '[^a-zA-Z0-9\s]', ' ', 'g'), '[^\x00-\x7F]', '', 'g')), '')"
)

_TRUSTED_SQL = (
    r"""
WITH land AS (
  SELECT CASE WHEN lang IN ('en', 'fr') THEN 1 ELSE 2 END AS batch,
         nullif(source, 'src0') AS src_id, 'Source ' || upper(source) AS src_name,
         CASE WHEN lang <> 'de' THEN 'author_' || lang END AS author,
         upper(lang) || ' news from ' || source AS title,
         CASE WHEN lang <> 'en' THEN 'About ' || source || ': ' || lang END AS description,
         'https://news.example/a/' || substr(sha256(text), 1, 16) AS url,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(('0x' || substr(sha256(text), 1, 6))::BIGINT AS BIGINT)) AS published_at,
         text AS content
  FROM documents),
d AS (SELECT DISTINCT * FROM land),
r AS (SELECT batch, url, coalesce(src_id, replace(lower(src_name), ' ', '-')) AS source, author, title, description, content, published_at FROM d),
m AS (SELECT batch, url,
             arg_max(source, (published_at, source)) FILTER (WHERE source IS NOT NULL) AS source,
             arg_max(author, (published_at, author)) FILTER (WHERE author IS NOT NULL) AS author,
             arg_max(title, (published_at, title)) FILTER (WHERE title IS NOT NULL) AS title,
             arg_max(description, (published_at, description)) FILTER (WHERE description IS NOT NULL) AS description,
             arg_max(content, (published_at, content)) FILTER (WHERE content IS NOT NULL) AS content,
             max(published_at) AS published_at
      FROM r GROUP BY batch, url),
n AS (SELECT batch, url, source, author, """
    + _F1.format(c="title")
    + " AS title, "
    + _F1.format(c="description")
    + " AS description, "
    + _F1.format(c="content")
    + r""" AS content, published_at FROM m),
b1 AS (SELECT * FROM n WHERE batch = 1),
b2 AS (SELECT * FROM n WHERE batch = 2),
trusted AS (
  SELECT coalesce(b2.url, b1.url) AS url, coalesce(b2.source, b1.source) AS source, coalesce(b2.author, b1.author) AS author,
         coalesce(b2.title, b1.title) AS title, coalesce(b2.description, b1.description) AS description,
         coalesce(b2.content, b1.content) AS content, coalesce(b2.published_at, b1.published_at) AS "publishedAt"
  FROM b1 FULL OUTER JOIN b2 ON b1.url = b2.url)
"""
)

@register("news_to_trusted", _TRUSTED_SQL + "SELECT * FROM trusted")
def news_to_trusted(spark, d):
    # Zone-less timestamps in the output, like the source tables (the parsed
    # instants are UTC wall-clock times).
    out = _run_flow(spark, d)
    return out.withColumn("publishedAt", F.col("publishedAt").cast("timestamp_ntz"))


@register(
    "news_to_exploitation",
    _TRUSTED_SQL
    + """
SELECT 'news_' || url AS _id, coalesce(content, description, title, '') AS text_to_embed, 'news' AS source
FROM trusted WHERE coalesce(content, description, title, '') <> ''
""",
)
def news_to_exploitation(spark, d):
    return news.to_records(_run_flow(spark, d))


# --------------------------------------------------------------------------
# Movies: the part table plays the movie catalogue; p_type is the genre.
# --------------------------------------------------------------------------


def movies_landing(spark, d):
    from zoneflow.operators.graph.sample import dense_index

    part = table(spark, d, "part")
    genre_idx = dense_index(spark, part, "p_type", "gid")
    genre_db = genre_idx.select(F.col("gid").alias("GenreId"), F.col("p_type").alias("Genre"))
    genre_db = genre_db.unionByName(genre_db.select((F.col("GenreId") + 100).alias("GenreId"), "Genre"))  # same name, other id
    with_g = part.join(genre_idx, "p_type")
    movie_db = with_g.select(
        F.col("p_partkey").alias("FilmId"),
        F.col("p_name").alias("Title"),
        F.concat(F.lit("A "), F.lower("p_type"), F.lit(" story")).alias("Overview"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")).alias("Release_Date"),
        F.lit("Released").alias("Status_"),
    )
    movie_genre_db = with_g.select(
        F.col("p_partkey").alias("FilmId"), F.col("gid").alias("GenreId"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("Ingestion_Time")
    )
    feed = lambda cond, ts: with_g.where(cond).select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.array(F.col("gid")).alias("genre_ids"),
        (F.col("p_retailprice") / 10).alias("popularity"),
        F.lit(ts).cast("timestamp").alias("ingestion_time"),
    )
    trending = feed(F.col("p_size") > 30, "2024-02-01 00:00:00")
    now_playing = feed(F.col("p_size").between(20, 40), "2024-03-01 00:00:00").withColumns(
        {"begin_date": F.lit("2024-03-01"), "end_date": F.lit("2024-03-31")}
    )
    return movie_db, movie_genre_db, genre_db, [trending, now_playing]


@register(
    "movies_to_exploitation",
    r"""
WITH g AS (SELECT p_type AS genre_raw, dense_rank() OVER (ORDER BY p_type) - 1 AS genre_id FROM (SELECT DISTINCT p_type FROM part)),
genre AS (SELECT genre_id, regexp_replace(regexp_replace(lower(genre_raw), 'http\S+|www\.\S+', ' ', 'g'), '[^a-zA-Z\s]', ' ', 'g') AS genre FROM g),
movie AS (SELECT p_partkey AS film_id, p_name AS title, 'A ' || lower(p_type) || ' story' AS overview,
                 CAST(DATE '2020-01-01' + p_size AS DATE) AS release_date FROM part),
mg AS (SELECT DISTINCT p.p_partkey AS film_id, g.genre_id FROM part p JOIN g ON g.genre_raw = p.p_type),
comp AS (SELECT film_id, string_agg(DISTINCT genre, ', ' ORDER BY genre) AS genres FROM mg JOIN genre USING (genre_id) GROUP BY film_id)
SELECT 'movie_' || CAST(film_id AS VARCHAR) AS _id,
       '"' || title || '" (released ' || strftime(release_date, '%Y-%m-%d') || ') is a ' || genres || ' film: ' || overview AS text_to_embed,
       'movies' AS source
FROM movie JOIN comp USING (film_id)
""",
)
def movies_to_exploitation(spark, d):
    from zoneflow.flows import movies

    movie_db, movie_genre_db, genre_db, feeds = movies_landing(spark, d)
    trusted_movies, links, genres = movies.to_trusted(movie_db, movie_genre_db, genre_db, feeds)
    return movies.to_records(trusted_movies, links, genres)


# --------------------------------------------------------------------------
# Sports: lineitem rows arrive as nested match records (customer = home team,
# supplier = away team, supplier nation = venue).
# --------------------------------------------------------------------------


def sports_landing(spark, d):
    li = table(spark, d, "lineitem")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    supp = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = F.broadcast(table(spark, d, "nation").select("n_nationkey", "n_name"))  # 25 rows
    j = (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    venue_name = F.when(F.col("s_nationkey") != 0, F.concat(F.col("n_name"), F.lit(" Arena")))
    return j.select(
        F.struct(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
            F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
            F.struct(
                F.when(F.col("l_linestatus") == "F", F.lit("Match Finished")).otherwise(F.lit("Not Started")).alias("long"),
                F.col("l_linestatus").alias("short"),
            ).alias("status"),
            F.struct(F.lit(None).cast("bigint").alias("id"), venue_name.alias("name"), F.col("n_name").alias("city")).alias("venue"),
        ).alias("fixture"),
        F.struct(
            F.struct(
                F.col("o_custkey").alias("id"),
                F.col("c_name").alias("name"),
                F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("logo/c/"), F.col("o_custkey").cast("string"))).alias("logo"),
            ).alias("home"),
            F.struct(
                (F.col("s_suppkey") + 1000000).alias("id"),
                F.col("s_name").alias("name"),
                F.concat(F.lit("logo/s/"), F.col("s_suppkey").cast("string")).alias("logo"),
            ).alias("away"),
        ).alias("teams"),
        F.struct(F.col("l_quantity").cast("bigint").alias("home"), F.col("l_linenumber").cast("bigint").alias("away")).alias("goals"),
    )


_SPORTS_BASE = """
WITH m AS (
  SELECT o.o_custkey AS home_id, c.c_name AS home_name,
         CASE WHEN c.c_mktsegment <> 'BUILDING' THEN 'logo/c/' || CAST(o.o_custkey AS VARCHAR) END AS home_logo,
         s.s_suppkey + 1000000 AS away_id, s.s_name AS away_name, 'logo/s/' || CAST(s.s_suppkey AS VARCHAR) AS away_logo,
         CASE WHEN s.s_nationkey <> 0 THEN n.n_name || ' Arena' END AS venue_name, n.n_name AS venue_city
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey)
"""


@register(
    "sports_teams",
    _SPORTS_BASE
    + """
, t AS (SELECT DISTINCT * FROM (SELECT away_id AS team_id, away_logo AS team_logo, away_name AS team_name FROM m
                                UNION ALL SELECT home_id, home_logo, home_name FROM m))
SELECT team_id, min(team_logo) AS team_logo, min(team_name) AS team_name FROM t GROUP BY team_id
""",
)
def sports_teams(spark, d):
    from zoneflow.flows import sports

    return sports.extract_teams(sports.expand(sports_landing(spark, d)))


@register(
    "sports_venues",
    _SPORTS_BASE
    + """
SELECT coalesce(replace(venue_name, ' ', '_'), 'unknown') AS venue_id, min(venue_name) AS venue_name, min(venue_city) AS venue_city
FROM m GROUP BY 1
""",
)
def sports_venues(spark, d):
    from zoneflow.flows import sports

    return sports.extract_venues(sports.expand(sports_landing(spark, d)))


# --------------------------------------------------------------------------
# Sports, the whole flow: match facts over two loads, leagues and countries.
# --------------------------------------------------------------------------


def sports_records(spark, d):
    """Orders as nested match records with all their facts, and the tenth that is delivered again, knowing less."""
    o = table(spark, d, "orders")
    key, seconds = F.col("o_orderkey"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    done = F.col("o_orderstatus") == "F"
    price = F.expr("CAST(o_totalprice AS BIGINT)")
    team = lambda k, winner: F.struct(k.alias("id"), F.concat(F.lit("Team #"), k.cast("string")).alias("name"), F.lit("logo").alias("logo"), winner.alias("winner"))
    full = o.select(
        F.struct(
            key.alias("id"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
            seconds.alias("timestamp"),
            F.struct(seconds.alias("first"), (seconds + 3600).alias("second")).alias("periods"),
            F.when(key % 7 != 0, F.concat(F.lit("Ref. No"), (key % 90).cast("string"))).alias("referee"),
            F.struct(F.when(done, "Match Finished!").otherwise("Not Started").alias("long"), F.col("o_orderstatus").alias("short"), F.when(done, 90).alias("elapsed")).alias("status"),
            F.struct(F.when(F.col("o_custkey") % 9 != 0, F.concat(F.lit("Arena "), (F.col("o_custkey") % 25).cast("string"))).alias("name"), F.lit("Some City").alias("city")).alias("venue"),
        ).alias("fixture"),
        F.struct((key % 25).alias("id")).alias("league"),
        F.struct(team(F.col("o_custkey"), price % 5 > price % 4).alias("home"), team(F.col("o_custkey") + 1, price % 5 < price % 4).alias("away")).alias("teams"),
        F.struct((price % 5).alias("home"), (price % 4).alias("away")).alias("goals"),
    )
    again = full.where(F.col("fixture.id") % 10 == 1).withColumns(
        {"fixture": F.col("fixture").withField("referee", F.lit(None).cast("string")), "goals": F.col("goals").withField("home", F.lit(None).cast("bigint"))}
    )
    return full, again


@register(
    "sports_matches_trusted",
    """
WITH m AS (SELECT *, o_orderkey AS fixture_id, CAST(trunc(o_totalprice) AS BIGINT) % 5 AS goals_home, CAST(trunc(o_totalprice) AS BIGINT) % 4 AS goals_away, epoch(o_orderdate)::BIGINT AS match_epoch FROM orders)
SELECT fixture_id, CASE WHEN o_orderstatus = 'F' THEN 'match finished' ELSE 'not started' END AS status_long, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS fixture_date, match_epoch, match_epoch + 3600 AS second_epoch,
  CASE WHEN fixture_id % 7 <> 0 THEN 'ref  no' || CAST(fixture_id % 90 AS VARCHAR) END AS referee, CASE WHEN o_orderstatus = 'F' THEN 90 END AS status_elapsed, fixture_id % 25 AS league, goals_home, goals_away,
  o_custkey AS team_home_id, o_custkey + 1 AS team_away_id, goals_home > goals_away AS team_home_winner, CASE WHEN o_custkey % 9 <> 0 THEN 'arena_' || CAST(o_custkey % 25 AS VARCHAR) ELSE 'unknown' END AS venue_id
FROM m
""",
)
def sports_matches_trusted(spark, d):
    """A1 + A3 + F1 + F4 + F7 + K7: trusted matches after a load of the earlier matches and one of the
    later ones with some of the earlier again; copies that know less lose nothing."""
    from zoneflow.flows import sports

    full, again = sports_records(spark, d)
    batch = lambda df: sports.trusted_matches(sports.expand(df, sports.SPOKEN))
    facts = materialize(spark, batch(full.unionByName(again).unionByName(again)), "matches-facts")  # both loads read them
    cut = F.lit("1995-06-01").cast("timestamp")
    trusted = materialize(spark, sports.load_matches(None, facts.where(F.col("timestamp") < cut)), "matches")
    second = facts.where(F.col("timestamp") >= cut).unionByName(batch(again).where(F.col("timestamp") < cut))
    out = sports.load_matches(trusted, materialize(spark, second, "matches-batch"))
    return out.select(
        "fixture_id", "status_long", "fixture_date", F.unix_timestamp("timestamp").alias("match_epoch"), F.unix_timestamp("period_second").alias("second_epoch"),
        "referee", "status_elapsed", "league", "goals_home", "goals_away", "team_home_id", "team_away_id", "team_home_winner", "venue_id",
    )


_LEAGUES_SQL = """
WITH l AS (
  SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'Cup' ELSE 'League' END AS type, 'logo/l/' || CAST(n_nationkey AS VARCHAR) AS logo,
    CASE WHEN n_regionkey = 0 THEN 'World' ELSE r_name END AS country, CASE WHEN n_regionkey = 1 THEN NULL ELSE 'C' || CAST(n_regionkey // 2 AS VARCHAR) END AS code, 'Flag/' || CAST(n_regionkey AS VARCHAR) AS flag
  FROM nation JOIN region ON r_regionkey = n_regionkey)
"""


def league_records(spark, d):
    """Nations as leagues, with regions as their countries; every season brings a league's record again."""
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    rows = nation.join(region, F.col("r_regionkey") == F.col("n_regionkey"))
    league = F.struct(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") % 2 == 0, "Cup").otherwise("League").alias("type"),
        F.concat(F.lit("logo/l/"), F.col("n_nationkey").cast("string")).alias("logo"),
    )
    country = F.struct(
        F.when(F.col("n_regionkey") == 0, "World").otherwise(F.col("r_name")).alias("name"),
        F.when(F.col("n_regionkey") != 1, F.concat(F.lit("C"), F.expr("n_regionkey div 2").cast("string"))).alias("code"),
        F.concat(F.lit("Flag/"), F.col("n_regionkey").cast("string")).alias("flag"),
    )
    return rows.select(league.alias("league"), country.alias("country"), F.explode(F.sequence(F.lit(2020), F.lit(2023))).alias("season"))


@register("sports_leagues", _LEAGUES_SQL + "SELECT id AS league_id, country AS country_name, lower(name) AS league_name, lower(type) AS league_type, logo AS league_logo FROM l")
def sports_leagues(spark, d):
    """W2 + A1: one row a league, whatever the number of its season records."""
    from zoneflow.flows import sports

    out = sports.leagues(league_records(spark, d))
    return out.select("league_id", F.col("country.name").alias("country_name"), "league_name", "league_type", "league_logo")


@register(
    "sports_countries",
    _LEAGUES_SQL
    + """, c AS (SELECT DISTINCT CASE WHEN country = 'World' THEN 'wrd' ELSE coalesce(lower(code), lower(country)) END AS code, lower(country) AS name, lower(flag) AS flag FROM l)
SELECT CASE WHEN count(*) OVER (PARTITION BY code) > 1 THEN code || '-' || name ELSE code END AS country_code, name AS country_name, flag AS country_flag FROM c""",
)
def sports_countries(spark, d):
    """the countries of the leagues; a code that several share gets the name added."""
    from zoneflow.flows import sports

    return sports.countries(league_records(spark, d))


# --------------------------------------------------------------------------
# Movies: the trusted tables.
# --------------------------------------------------------------------------


@register(
    "movies_trusted",
    r"""
WITH m AS (
  SELECT p_partkey AS film_id, p_name AS title, 'a ' || lower(p_type) || ' story' AS overview, CAST(DATE '2020-01-01' + p_size AS DATE) AS release_date, p_size, p_retailprice / 10 AS price FROM part)
SELECT film_id, trim(regexp_replace(lower(title), '[^a-zA-Z0-9\s]', ' ', 'g')) AS title, overview, release_date, CASE WHEN p_size >= 20 THEN price ELSE CAST(0 AS DOUBLE) END AS popularity,
  CAST(0 AS DOUBLE) AS revenue, CAST(0 AS DOUBLE) AS budget, 0 AS runtime, CAST(0 AS BIGINT) AS vote_count, CASE WHEN p_size BETWEEN 20 AND 40 THEN '2024-03-01' WHEN p_size > 30 THEN '2024-02-01' ELSE '2023-01-01' END AS ingested,
  p_size > 30 AS trending, p_size BETWEEN 20 AND 40 AS now_playing
FROM m
""",
)
def movies_trusted(spark, d):
    """P1-P3 + A1 + A3 + F1 + U2 + K6: the trusted films in their whole schema, with the categories that list them."""
    from zoneflow.flows import movies

    movie_db, movie_genre_db, genre_db, feeds = movies_landing(spark, d)
    movie_db = movie_db.withColumn("Ingestion_Time", F.lit("2023-01-01 00:00:00").cast("timestamp"))
    # the catalogue lists some films twice
    films, _, _ = movies.to_trusted(movie_db.unionByName(movie_db.where("FilmId % 4 = 0")), movie_genre_db, genre_db, feeds, normalize=("title", "overview"))
    listed = movies.category_films({"trending": feeds[0].unionByName(feeds[0]), "now_playing": feeds[1]})
    has = listed.groupBy("film_id").agg(*(F.max(F.col("category") == c).alias(c) for c in ("trending", "now_playing")))
    out = films.join(has, "film_id", "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("trending", "now_playing")]
    return out.select("film_id", "title", "overview", "release_date", "popularity", "revenue", "budget", "runtime", "vote_count", F.date_format("ingestion_time", "yyyy-MM-dd").alias("ingested"), *flags)
