import pytest
from pyspark.sql import functions as F

from zoneflow.operators import merge as mg
from zoneflow.session import scratch_path
from zoneflow.sources.store import VersionedTable
from zoneflow.streaming.incremental import ControlTable, IncrementalLoader, stream_merge

SCHEMA = "k int, a string, b int"


def _key(r):
    return tuple((v is None, v if v is not None else 0) for v in r)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


def test_merge_coalesce_semantics(spark):
    target = spark.createDataFrame([(1, "x", 10), (2, None, None), (3, "z", 30)], SCHEMA)
    source = spark.createDataFrame([(2, "y", None), (4, None, 40), (None, "n", 1)], SCHEMA)
    snap, changes = mg.merge_coalesce(target, source, ["k"])
    # matched all-null row is updated (presence flags), null key inserted, unmatched kept
    assert rows(snap) == sorted([(1, "x", 10), (2, "y", None), (3, "z", 30), (4, None, 40), (None, "n", 1)], key=_key)
    kinds = sorted(r["_change_type"] for r in changes.collect())
    assert kinds == ["insert", "insert", "update_postimage", "update_preimage"]


def test_merge_is_idempotent(spark):
    target = spark.createDataFrame([(1, "x", None)], SCHEMA)
    source = spark.createDataFrame([(1, None, 5), (2, "b", 2)], SCHEMA)
    once, _ = mg.merge_coalesce(target, source, ["k"])
    twice, _ = mg.merge_coalesce(once, source, ["k"])
    assert rows(once) == rows(twice)


def test_merge_checks_source_uniqueness(spark):
    t = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    s = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], SCHEMA)
    with pytest.raises(ValueError):
        mg.merge_coalesce(t, s, ["k"], check_unique=True)


def test_high_water_fixes(spark):
    t = spark.createDataFrame([(1, "old", 5), (2, "two", 9)], "k int, a string, ts int")
    # row 2 arrives with a later ts (Q6: must merge, not duplicate); null ts (Q5: must not vanish)
    b = spark.createDataFrame([(2, None, 12), (3, "new", 20), (4, "nots", None), (1, "upd", 3)], "k int, a string, ts int")
    snap, _ = mg.merge_high_water(t, b, ["k"], "ts")
    assert rows(snap) == [(1, "upd", 3), (2, "two", 12), (3, "new", 20), (4, "nots", None)]
    k6, _ = mg.merge_coalesce(t, b, ["k"])
    assert rows(snap) == rows(k6)


def test_merge_replace(spark):
    t = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], SCHEMA)
    s = spark.createDataFrame([(2, None, 20), (3, "c", 3)], SCHEMA)
    assert rows(mg.merge_replace(t, s, ["k"])) == [(1, "x", 1), (2, None, 20), (3, "c", 3)]


def test_versioned_table_lifecycle(spark):
    vt = VersionedTable(spark, scratch_path(spark, "t-store"))
    assert not vt.exists() and vt.latest_version() is None
    v0 = vt.create(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    with pytest.raises(FileExistsError):
        vt.create(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    v1 = vt.append(spark.createDataFrame([(2, "b", 2)], SCHEMA))
    v2 = vt.overwrite(spark.createDataFrame([(9, "z", 9)], SCHEMA))
    assert (v0, v1, v2) == (0, 1, 2)
    assert rows(vt.read(version=1)) == [(1, "a", 1), (2, "b", 2)]
    assert rows(vt.read()) == [(9, "z", 9)]
    assert rows(vt.read_changes(1, 1)) == [(2, "b", 2)]
    assert vt.empty().count() == 0 and vt.empty().columns == ["k", "a", "b"]
    v3 = vt.append(spark.createDataFrame([(5, 6)], "k int, c int"), merge_schema=True)
    assert v3 == 3 and set(vt.read().columns) >= {"k", "a", "b"}


def test_change_feed_of_merge(spark):
    vt = VersionedTable(spark, scratch_path(spark, "t-cdf"))
    vt.create(spark.createDataFrame([(1, "a", None)], SCHEMA))
    snap, ch = mg.merge_coalesce(vt.read(), spark.createDataFrame([(1, None, 7), (2, "n", 2)], SCHEMA), ["k"])
    v = vt.merge(snap, ch)
    got = sorted((r["k"], r["_change_type"]) for r in vt.read_changes(v, v, ("insert", "update_postimage"), keep_meta=True).collect())
    assert got == [(1, "update_postimage"), (2, "insert")]


def test_incremental_loader_states(spark):
    src = VersionedTable(spark, scratch_path(spark, "t-src"))
    src.create(spark.createDataFrame([(1, "a", 1)], SCHEMA), enable_cdf=False)
    control = ControlTable(spark, scratch_path(spark, "t-control"))
    loader = IncrementalLoader(spark, control, "src", src)
    # never processed (Q21) + no change feed -> feed switched on, full load
    full = loader.get_new_data()
    assert loader.mode == "full" and rows(full) == [(1, "a", 1)] and src.cdf_enabled()
    loader.commit()
    # nothing new -> empty with the source schema (Q4)
    again = IncrementalLoader(spark, control, "src", src)
    none = again.get_new_data()
    assert again.mode == "none" and none.count() == 0 and none.columns == ["k", "a", "b"]
    src.append(spark.createDataFrame([(2, "b", 2)], SCHEMA))
    src.append(spark.createDataFrame([(3, "c", 3)], SCHEMA))
    inc = IncrementalLoader(spark, control, "src", src)
    # starts after the last processed version (Q1): the earlier rows are not re-read
    assert rows(inc.get_new_data()) == [(2, "b", 2), (3, "c", 3)]
    inc.commit()
    assert control.last_processed("src") == src.latest_version()


def test_batches_equal_full_load(spark, sf001):
    """I1 over n batches == one full load (property from the survey)."""
    ev = spark.read.parquet(f"{sf001}/events.parquet")
    src = VersionedTable(spark, scratch_path(spark, "t-batches"))
    days = [r[0] for r in ev.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()][:4]
    control = ControlTable(spark, scratch_path(spark, "t-batches-control"))
    seen = None
    for day in days:
        src.append(ev.where(F.to_date("ts") == F.lit(day)))
        loader = IncrementalLoader(spark, control, "events", src)
        batch = loader.get_new_data()
        seen = batch if seen is None else seen.unionByName(batch)
        loader.commit()
    assert rows(seen) == rows(src.read())


def test_partitioned_merge_rewrites_only_touched_units(spark):
    unit = F.col("k") % 3
    vt = VersionedTable(spark, scratch_path(spark, "t-units"), unit=unit)
    vt.create(spark.createDataFrame([(i, f"v{i}", i) for i in range(9)], SCHEMA))
    v = vt.merge_into(spark.createDataFrame([(4, None, 40), (10, "new", 10)], SCHEMA), ["k"])
    import json

    meta = json.loads([c for c in vt.history() if c.version == v][0].metadata)
    assert meta["replaced_units"] == ["1"]  # only the unit of key 4 was rewritten
    expect = [(i, f"v{i}", i) for i in range(9) if i != 4] + [(4, "v4", 40), (10, "new", 10)]
    assert rows(vt.read()) == sorted(expect, key=_key)
    assert rows(vt.read(version=0)) == [(i, f"v{i}", i) for i in range(9)]
    # replace semantics and a second merge into the same unit
    vt.merge_into(spark.createDataFrame([(4, "r", None)], SCHEMA), ["k"], "replace")
    got = {r.k: (r.a, r.b) for r in vt.read().collect()}
    assert got[4] == ("r", None) and got[10] == ("new", 10) and len(got) == 10
    # the same answer as an unpartitioned full rewrite
    flat = VersionedTable(spark, scratch_path(spark, "t-flat"))
    flat.create(spark.createDataFrame([(i, f"v{i}", i) for i in range(9)], SCHEMA))
    flat.merge_into(spark.createDataFrame([(4, None, 40), (10, "new", 10)], SCHEMA), ["k"])
    flat.merge_into(spark.createDataFrame([(4, "r", None)], SCHEMA), ["k"], "replace")
    assert rows(flat.read()) == rows(vt.read())


def test_store_high_water(spark):
    vt = VersionedTable(spark, scratch_path(spark, "t-hw"), unit=F.col("ts") % 2)
    vt.create(spark.createDataFrame([(1, "old", 5), (2, "two", 9)], "k int, a string, ts int"))
    vs = vt.merge_high_water(spark.createDataFrame([(2, None, 12), (3, "new", 20), (4, "nots", None), (1, "upd", 3)], "k int, a string, ts int"), ["k"], "ts")
    assert len(vs) == 2
    assert rows(vt.read()) == [(1, "upd", 3), (2, "two", 12), (3, "new", 20), (4, "nots", None)]


def test_merge_into_a_null_unit(spark):
    vt = VersionedTable(spark, scratch_path(spark, "t-null-unit"), unit=F.col("b") % 2)
    vt.create(spark.createDataFrame([(1, "x", None), (2, "y", 2), (3, "z", None)], SCHEMA))
    vt.merge_into(spark.createDataFrame([(1, "new", None), (2, None, 3)], SCHEMA), ["k"])
    assert rows(vt.read()) == [(1, "new", None), (2, "y", 3), (3, "z", None)]
    vt.merge_into(spark.createDataFrame([(3, "r", 1)], SCHEMA), ["k"], "replace")
    assert rows(vt.read()) == [(1, "new", None), (2, "y", 3), (3, "r", 1)]


def test_repeated_source_keys_raise(spark):
    t = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    twice = spark.createDataFrame([(2, "a", 5), (2, "b", 6)], SCHEMA)
    vt = VersionedTable(spark, scratch_path(spark, "t-twice"))
    vt.create(t)
    for merge in (
        lambda: mg.merge_coalesce(t, twice, ["k"]),
        lambda: mg.merge_replace(t, twice, ["k"]),
        lambda: mg.merge_high_water(t, twice, ["k"], "b"),
        lambda: vt.merge_into(twice, ["k"]),
        lambda: vt.merge_into(twice, ["k"], "replace"),
        lambda: vt.merge_high_water(twice, ["k"], "b"),
    ):
        with pytest.raises(ValueError):
            merge()
    assert rows(vt.read()) == [(1, "x", 1)]


def test_loader_sees_overwrites_and_replace_merges(spark):
    src = VersionedTable(spark, scratch_path(spark, "t-seen"))
    src.create(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    control = ControlTable(spark, scratch_path(spark, "t-seen-control"))
    control.update("src", 0)
    src.overwrite(spark.createDataFrame([(7, "o", 7)], SCHEMA))
    src.merge_into(spark.createDataFrame([(7, "p", 8), (8, "q", 8)], SCHEMA), ["k"], "replace")
    loader = IncrementalLoader(spark, control, "src", src)
    assert rows(loader.get_new_data(("insert", "update_postimage"))) == [(7, "o", 7), (7, "p", 8), (8, "q", 8)]
    assert loader.mode == "changes"
    # a merge without change rows cannot be read as changes: full load
    src.merge(spark.createDataFrame([(9, "s", 9)], SCHEMA), None)
    full = IncrementalLoader(spark, control, "src", src)
    assert rows(full.get_new_data()) == [(9, "s", 9)] and full.mode == "full"
    with pytest.raises(ValueError):
        src.read_changes(1, 3)


def test_stream_reads_committed_versions_only(spark):
    src = VersionedTable(spark, scratch_path(spark, "t-stream"))
    src.create(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    spark.createDataFrame([(99, "orphan", 1)], SCHEMA).write.parquet(f"{src.data_path}/_v=1")  # a write that failed before its commit
    target = VersionedTable(spark, scratch_path(spark, "t-stream-to"))
    apply = lambda df, _: target.merge_into(df, ["k"]) if target.exists() else target.create(df)
    checkpoint = scratch_path(spark, "t-stream-ckpt")
    stream_merge(spark, src, apply, checkpoint)
    assert rows(target.read()) == [(1, "a", 1)]
    src.append(spark.createDataFrame([(2, "b", 2)], SCHEMA))
    stream_merge(spark, src, apply, checkpoint)
    assert rows(target.read()) == [(1, "a", 1), (2, "b", 2)]


def test_retry_replaces_a_partial_attempt(spark):
    vt = VersionedTable(spark, scratch_path(spark, "t-retry"), unit=F.col("k") % 3)
    vt._write_version(spark.createDataFrame([(1, "failed", 1), (2, "failed", 2)], SCHEMA), 0)
    vt.create(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    assert rows(vt.read()) == [(1, "a", 1)]


def test_backfill_with_missing_versions(spark):
    vt = VersionedTable(spark, scratch_path(spark, "t-gaps"))
    made = vt.append_versions(spark.createDataFrame([(1, "a", 1, 0), (2, "b", 2, 3)], SCHEMA + ", v long"), "v")
    assert made == [0, 3] and vt.latest_version() == 3
    assert rows(vt.read()) == [(1, "a", 1), (2, "b", 2)] and rows(vt.read_changes(1, 3)) == [(2, "b", 2)]


def test_movie_feeds_keep_known_values_and_take_the_newest(spark):
    from zoneflow.flows import movies

    day = lambda n: F.to_timestamp(F.lit(f"2024-01-0{n}"))
    db = spark.createDataFrame([(1, "Old", 120)], "FilmId long, Title string, Runtime int")
    feed = lambda rows, n: spark.createDataFrame(rows, "id long, title string, genre_ids array<long>, popularity double").withColumn("ingestion_time", day(n))
    feeds = [feed([(1, "Late", [5], None), (2, "Two", [5], 2.0)], 3), feed([(1, "Early", [5], 7.0)], 2)]
    links = spark.createDataFrame([(1, 5)], "FilmId long, GenreId long").withColumn("Ingestion_Time", day(1))
    genres = spark.createDataFrame([(5, "Drama")], "GenreId long, Genre string")
    out, _, _ = movies.to_trusted(db, links, genres, feeds)
    got = {r.film_id: (r.title, r.runtime, r.popularity) for r in out.collect()}
    # no feed has a runtime: film 1 keeps its own, the new film 2 gets the default
    assert got == {1: ("Late", 120, 7.0), 2: ("Two", 0, 2.0)}
