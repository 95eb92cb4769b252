"""Entity maps over one source, and draws from several pools."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from zoneflow.functions.ids import ONT, RDF_TYPE, RES, iri
from zoneflow.operators.graph import abox, sample
from zoneflow.operators.graph.mapping import flag, link, literal


def maps():
    film = abox.EntityMap(("id", "title", "genre", "old"), iri("film", "id"), "Movie", [literal("movie_title", F.col("title")), link("has_genre", iri("genre", "genre")), flag("old", F.col("old"))])
    genre = abox.EntityMap(("genre",), iri("genre", "genre"), F.when(F.col("genre") == "g0", ONT + "Odd").otherwise(ONT + "Genre"), [literal("genre_name", F.col("genre"))])
    marked = abox.EntityMap(("id", "title"), iri("film", "id"), None, [literal("marked", F.col("title"))], F.col("id") > 2)
    return [film, genre, marked]


def test_all_maps_of_a_source_in_one_scan(spark, tmp_path):
    rows = [(1, "a", "g0", True, 1), (2, "b", "g1", False, 2), (3, None, "g1", None, 3), (4, "d", None, True, 4), (None, "e", "g2", True, 5), (4, "d", None, True, 6)]
    spark.createDataFrame(rows, "id long, title string, genre string, old boolean, extra int").write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    out = abox.source_triples(source, maps())
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert "extra" not in out._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split(">")[0]
    got = Counter((r.subject.removeprefix(RES), r.predicate.removeprefix(ONT), r.object) for r in out.collect())
    expected = Counter()
    for id_, title, genre, old, _ in dict.fromkeys((*r[:4], 0) for r in rows):
        if id_ is not None:
            expected[f"film_{id_}", RDF_TYPE, ONT + "Movie"] += 1
            expected.update({(f"film_{id_}", "movie_title", title): 1} if title else {})
            expected.update({(f"film_{id_}", "has_genre", f"{RES}genre_{genre}"): 1} if genre else {})
            expected.update({(f"film_{id_}", "old", "true"): 1} if old else {})
            expected.update({(f"film_{id_}", "marked", title): 1} if title and id_ > 2 else {})
    for g in ("g0", "g1", "g2"):  # once, however many films have it
        expected[f"genre_{g}", "genre_name", g] += 1
        expected[f"genre_{g}", RDF_TYPE, ONT + ("Odd" if g == "g0" else "Genre")] += 1
    assert got == expected
    both = abox.abox({"a": source, "b": source}, {"a": maps(), "b": maps()})
    assert both.count() == len(expected)
    assert abox.source_triples(source.limit(0), maps()).count() == 0


def test_match_counts_only_when_played(spark):
    rows = [(1, 5, 6, 2, None, None, "match finished", 9, "Ref", None), (2, 5, 6, 0, 0, None, "not started", 9, "Other", None), (3, None, 6, 0, 0, None, "walkover", None, None, "v1")]
    cols = "fixture_id long, team_home_id long, team_away_id long, goals_home long, goals_away long, fixture_date timestamp_ntz, status_long string, league long, referee string, venue_id string"
    got = abox.source_triples(spark.createDataFrame(rows, cols), abox.sports_maps()["matches"]).collect()
    assert {r.subject for r in got if "match_" in r.subject} == {f"{RES}match_1", f"{RES}match_3"}
    names = [r for r in got if r.predicate == ONT + "referee_name"]
    assert [r.object for r in names] == ["Ref"]
    assert Counter(r.predicate.removeprefix(ONT) for r in got if r.subject == f"{RES}match_3") == Counter(["match_away_team", "match_home_goals", "match_away_goals", "match_status", "match_venue"])


def test_draws_from_pools(spark):
    pools = [("film", f"f{i}") for i in range(40)] + [("genre", f"g{i}") for i in range(2)] + [("team", "t0"), ("team", "t0"), ("team", None)]
    users = spark.range(4000).withColumnRenamed("id", "user")
    frame = spark.createDataFrame(pools, "kind string, item string")
    limits = {"film": (1, 3), "genre": (2, 5), "team": (0, 1), "nothing": (1, 3)}
    rows = sample.draw_from_pools(spark, users, "user", frame, limits, seed=5).collect()
    drawn = {(u, k): [] for u in range(4000) for k in limits}
    for r in rows:
        drawn[r.user, r.kind].append(r.item)
    assert all(len(set(v)) == len(v) for v in drawn.values())
    sizes = {k: Counter(len(drawn[u, k]) for u in range(4000)) for k in limits}
    assert set(sizes["film"]) == {1, 2, 3} and all(abs(n - 4000 / 3) < 200 for n in sizes["film"].values())
    assert set(sizes["genre"]) == {2} and set(sizes["team"]) == {0, 1} and set(sizes["nothing"]) == {0}
    films = Counter(i for u in range(4000) for i in drawn[u, "film"])
    assert len(films) == 40 and all(abs(n - 200) < 60 for n in films.values())  # four standard deviations
    again = sample.draw_from_pools(spark, users, "user", frame.repartition(3), limits, seed=5).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert sample.draw_from_pools(spark, users, "user", frame.limit(0), limits).count() == 0
    triples = abox.like_triples(spark.createDataFrame([(1, "film", "f3"), (1, "nothing", "x")], "user long, kind string, item string"), "user").collect()
    assert [(r.subject, r.predicate, r.object) for r in triples] == [(f"{RES}user_1", f"{ONT}likes_movie", f"{RES}film_f3")]


@pytest.mark.parametrize("name", ["World", "Spain", None])
def test_countries_of_competitions(spark, name):
    country = None if name is None else (name, "ES")
    source = spark.createDataFrame([(1, "cup", "c", country)], "league_id long, league_type string, league_name string, country struct<name: string, code: string>")
    got = {r.predicate: r.object for r in abox.source_triples(source, abox.sports_maps()["leagues"]).collect()}
    assert (ONT + "country_name" in got) == (name is not None) == (ONT + "competition_country" in got)
    assert got[RDF_TYPE] == ONT + "Cup"
