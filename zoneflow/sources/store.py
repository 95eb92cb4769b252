"""VersionedTable: user-level versioned parquet table.

Layout under ``root``::

    _commits/commit-<v>.parquet   one row per version (version, ts, operation,
                                  props map, metadata json, base version)
    data/_v=<v>/                  rows written by version v: an append adds a
                                  directory, an overwrite/merge writes a full
                                  snapshot and becomes the new base
    changes/_commit_version=<v>/  change rows of merges (insert/update images)

A snapshot at version v is the union of ``data/_v`` in [base(v), v] read as
one scan with partition pruning.  The commit row is written last, so a
failed or retried job leaves no visible version; a version directory is
written with static overwrite, so a retry replaces a partial attempt.  Single
writer per table, as in the scheduled jobs this serves.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType(), False),
        T.StructField("ts", T.TimestampType(), True),
        T.StructField("operation", T.StringType(), False),
        T.StructField("props", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("metadata", T.StringType(), True),
        T.StructField("base", T.LongType(), True),
    ]
)

CDF_PROP = "enableChangeDataFeed"
NULL_UNIT = "__null__"  # names the null storage unit in a commit
CHANGE_COLS = ("_change_type", "_commit_version", "_commit_timestamp")


@dataclass
class Commit:
    version: int
    ts: _dt.datetime | None
    operation: str
    props: dict
    metadata: str | None
    base: int


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, unit: Column | None = None):
        """``unit``: optional storage-unit expression over the row (e.g. the
        month of a timestamp, or ``pmod(xxhash64(key), n)``).  Rows are laid
        out by unit and merges rewrite only the units holding matched keys."""
        self.spark = spark
        self.unit = unit
        self.root = root.rstrip("/")
        self.commits_path = f"{self.root}/_commits"
        self.data_path = f"{self.root}/data"
        self.changes_path = f"{self.root}/changes"
        self._history: list[Commit] | None = None  # this writer's view of the log

    # ------------------------------------------------------------------ S11
    def exists(self) -> bool:
        return len(self.history()) > 0

    # ------------------------------------------------------------- metadata
    def history(self, refresh: bool = False) -> list[Commit]:
        """The commit log (one small row per version).  Read once per
        table object and refreshed after its own commits (single writer);
        ``refresh=True`` re-reads it to see other writers' commits."""
        if self._history is not None and not refresh:
            return self._history
        try:
            rows = self.spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true").parquet(self.commits_path).collect()
        except AnalysisException:
            rows = []
        out = [Commit(r.version, r.ts, r.operation, dict(r.props or {}), r.metadata, r.base) for r in rows]
        self._history = sorted(out, key=lambda c: c.version)
        return self._history

    def history_df(self) -> DataFrame:
        return self.spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true").parquet(self.commits_path)

    def latest_version(self) -> int | None:
        """T5: latest commit."""
        h = self.history()
        return h[-1].version if h else None

    def properties(self) -> dict:
        props: dict = {}
        for c in self.history():
            props.update(c.props)
        return props

    def cdf_enabled(self) -> bool:
        return self.properties().get(CDF_PROP) == "true"

    def cdf_start_version(self) -> int | None:
        """First version at which the change feed was switched on."""
        for c in self.history():
            if c.props.get(CDF_PROP) == "true":
                return c.version
        return None

    def schema(self) -> T.StructType:
        return self.read().schema

    # ---------------------------------------------------------------- reads
    def read(self, version: int | None = None, keep_unit: bool = False) -> DataFrame:
        """S4 (latest) / S5 (time travel, ``versionAsOf``)."""
        h = self.history()
        if not h:
            raise FileNotFoundError(f"no versioned table at {self.root}")
        v = h[-1].version if version is None else version
        commit = next((c for c in h if c.version == v), None)
        if commit is None:
            raise ValueError(f"version {v} does not exist (latest {h[-1].version})")
        live = [c for c in h if commit.base <= c.version <= v and c.operation in _DATA_OPS]
        versions = [c.version for c in live]
        if self.unit is None:
            return self._read_data(versions)
        # Per storage unit, rows count from the last version that rewrote the
        # unit (a partition-aware merge) or from the base snapshot.
        replaced: dict[str, int] = {}
        for c in live:
            for u in json.loads(c.metadata or "{}").get("replaced_units", []):
                replaced[str(u)] = c.version
        df = self._scan(versions)
        if replaced:
            since = F.create_map(*[x for u, ver in replaced.items() for x in (F.lit(u), F.lit(ver))])
            unit = F.coalesce(F.col("_u").cast("string"), F.lit(NULL_UNIT))
            df = df.where(F.col("_v") >= F.coalesce(since[unit], F.lit(commit.base)))
        df = df.drop("_v")
        return df if keep_unit else df.drop("_u")

    def _scan(self, versions: Sequence[int]) -> DataFrame:
        # Explicit version directories: no listing of other versions, and the
        # schema comes from the versions actually read.
        paths = [f"{self.data_path}/_v={v}" for v in versions]
        return self.spark.read.option("basePath", self.data_path).option("mergeSchema", "true").parquet(*paths)

    def _read_data(self, versions: Sequence[int]) -> DataFrame:
        return self._scan(versions).drop("_v")

    def read_changes(self, start: int, end: int, change_types: Sequence[str] = ("insert",), keep_meta: bool = False) -> DataFrame:
        """Change rows of versions [start, end].  Appends and overwrites
        contribute their rows as inserts, merges their recorded change rows; a
        merge that recorded none raises (``changes_recorded`` tells)."""
        h = [c for c in self.history() if start <= c.version <= end]
        if not self.changes_recorded(start, end):
            raise ValueError(f"a merge among versions {start} to {end} recorded no change rows; read a snapshot")
        appends = [c.version for c in h if c.operation in ("WRITE", "CREATE", "WRITE_OVERWRITE")]
        merges = [c.version for c in h if c.operation == "MERGE"]
        ts = {c.version: c.ts for c in h}
        parts = []
        if appends:
            df = self._scan(appends).drop(*(["_u"] if self.unit is not None else []))
            parts.append(
                df.withColumn("_change_type", F.lit("insert")).withColumnRenamed("_v", "_commit_version")
            )
        if merges:
            paths = [f"{self.changes_path}/_commit_version={v}" for v in merges]
            parts.append(self.spark.read.option("basePath", self.changes_path).parquet(*paths))
        if not parts:
            return self.empty()
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        out = out.where(F.col("_change_type").isin(list(change_types)))
        ts_map = F.create_map(*[x for v in sorted(ts) for x in (F.lit(v), F.lit(ts[v]))])
        out = out.withColumn("_commit_version", F.col("_commit_version").cast("long"))
        out = out.withColumn("_commit_timestamp", ts_map[F.col("_commit_version")])
        return out if keep_meta else out.drop(*CHANGE_COLS)

    def changes_recorded(self, start: int, end: int) -> bool:
        """Whether every merge of versions [start, end] wrote its change rows."""
        merges = [c for c in self.history() if start <= c.version <= end and c.operation == "MERGE"]
        return all(json.loads(c.metadata or "{}").get("changes", False) for c in merges)

    def empty(self) -> DataFrame:
        """No rows, the table's own schema (Q4)."""
        return self.spark.createDataFrame([], self.read().schema)

    # --------------------------------------------------------------- writes
    def _commit(self, version: int, operation: str, props: dict | None, metadata: dict | None, base: int) -> None:
        row = (version, _dt.datetime.now(_dt.UTC).replace(tzinfo=None), operation, props or {}, json.dumps(metadata or {}), base)
        df = self.spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1)
        df.write.mode("overwrite").parquet(f"{self.commits_path}/commit-{version:020d}.parquet")
        self._history = None

    def _write_version(self, df: DataFrame, version: int) -> None:
        path = f"{self.data_path}/_v={version}"
        if self.unit is None:
            df.write.mode("overwrite").parquet(path)
            return
        if "_u" not in df.columns:
            df = df.withColumn("_u", self.unit)
        # REBALANCE by unit: few files per unit; AQE splits a skewed unit
        # across tasks and coalesces small ones.
        df.hint("rebalance", "_u").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_u").parquet(path)

    def _next(self) -> tuple[int, int]:
        h = self.history()
        if not h:
            return 0, 0
        return h[-1].version + 1, h[-1].base

    def create(self, df: DataFrame, enable_cdf: bool = True, metadata: dict | None = None) -> int:
        """K5: create; error if the table exists; change feed on by default."""
        if self.exists():
            raise FileExistsError(f"table exists at {self.root}")
        self._write_version(df, 0)
        self._commit(0, "CREATE", {CDF_PROP: "true"} if enable_cdf else {}, metadata, 0)
        return 0

    def append(self, df: DataFrame, metadata: dict | None = None, merge_schema: bool = False) -> int:
        """K1 / K2: append (schema evolution: ``merge_schema`` aligns by name,
        missing columns become null; readers merge parquet schemas)."""
        if not self.exists():
            return self.create(df, metadata=metadata)
        v, base = self._next()
        if merge_schema:
            current = self.read().limit(0)
            df = current.unionByName(df, allowMissingColumns=True)
        else:
            df = df.select(*self.read().columns)
        self._write_version(df, v)
        self._commit(v, "WRITE", None, metadata, base)
        return v

    def append_versions(self, df: DataFrame, version_col: str, metadata: dict | None = None) -> list[int]:
        """Backfill: append many versions in ONE write job, one version per
        distinct value of ``version_col`` (ints above the current latest
        version; versions that hold no row may be left out)."""
        first, base = self._next()
        values = sorted(r[0] for r in df.select(version_col).distinct().collect())
        if values and (values[0] is None or values[0] < first):
            raise ValueError(f"versions must start at {first} or above; got {values[:5]}...")
        created = not self.exists()
        if created and values:
            base = values[0]
        staged = df.withColumnRenamed(version_col, "_v")
        parts = ["_v"]
        if self.unit is not None:
            staged, parts = staged.withColumn("_u", self.unit), ["_v", "_u"]
        staged.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).option("partitionOverwriteMode", "dynamic").parquet(self.data_path)
        rows = [
            (v, _dt.datetime.now(_dt.UTC).replace(tzinfo=None), "CREATE" if created and v == base else "WRITE",
             {CDF_PROP: "true"} if created and v == base else {}, json.dumps(metadata or {}), base)
            for v in values
        ]
        self.spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.commits_path}/backfill-{first:020d}.parquet"
        )
        self._history = None
        return values

    def overwrite(self, df: DataFrame, metadata: dict | None = None) -> int:
        """K3 / K4: overwrite (incl. schema); becomes the new base."""
        if not self.exists():
            return self.create(df, metadata=metadata)
        v, _ = self._next()
        self._write_version(df, v)
        self._commit(v, "WRITE_OVERWRITE", None, metadata, v)
        return v

    def enable_cdf(self) -> int:
        """K9: switch the change feed on (metadata-only commit)."""
        v, base = self._next()
        self._commit(v, "SET TBLPROPERTIES", {CDF_PROP: "true"}, None, base)
        return v

    def merge(self, snapshot: DataFrame, changes: DataFrame | None, metadata: dict | None = None) -> int:
        """Commit a merge result (new full snapshot + change rows)."""
        v, _ = self._next()
        self._write_version(snapshot, v)
        self._commit(v, "MERGE", None, {**(metadata or {}), "changes": self._write_changes(changes, v)}, v)
        return v

    def _write_changes(self, changes: DataFrame | None, version: int) -> bool:
        if changes is None or not self.cdf_enabled():
            return False
        changes.write.mode("overwrite").parquet(f"{self.changes_path}/_commit_version={version}")
        return True

    def merge_into(
        self, source: DataFrame, keys: Sequence[str], how: str = "coalesce", check_unique: bool = True
    ) -> int:
        """K6 (how="coalesce") / K8 (how="replace") into this table.

        Unpartitioned tables get a new full snapshot.  With a ``unit``
        expression only the key columns of the target are scanned to find the
        units that hold matching keys (at most one row per unit reaches the
        driver); only those units are read, merged and rewritten, inserts land
        in their own units, and every other unit is carried over untouched -
        the cost follows the batch, not the table."""
        from zoneflow.operators.merge import check_source, merge_coalesce, merge_replace, replace_changes

        keys = list(keys)
        if check_unique:
            check_source(source, keys)
        # Stage the join only when both the snapshot and the change feed are
        # written from it.
        stage = self.cdf_enabled()
        if self.unit is None:
            target = self.read()
            if how == "coalesce":
                snap, changes = merge_coalesce(target, source, keys, False, stage=stage)
            else:
                snap, changes = merge_replace(target, source, keys, False), replace_changes(target, source, keys)
            return self.merge(snap, changes)
        target = self.read(keep_unit=True)
        hits = target.select(*keys, "_u").join(source.select(*keys).distinct(), keys, "left_semi")
        touched = sorted({r[0] for r in hits.select("_u").distinct().collect()}, key=str)
        # a null unit (e.g. the month of a null timestamp) is a unit too
        in_touched = F.col("_u").isin([u for u in touched if u is not None])
        if None in touched:
            in_touched = in_touched | F.col("_u").isNull()
        part = target.where(in_touched).drop("_u") if touched else target.drop("_u").limit(0)
        if how == "coalesce":
            snap, changes = merge_coalesce(part, source, keys, False, stage=stage)
        else:
            snap, changes = merge_replace(part, source, keys, False), replace_changes(part, source, keys)
        v, base = self._next()
        self._write_version(snap, v)
        replaced = [NULL_UNIT if u is None else str(u) for u in touched]
        self._commit(v, "MERGE", None, {"replaced_units": replaced, "changes": self._write_changes(changes, v)}, base)
        return v

    def merge_high_water(self, batch: DataFrame, keys: Sequence[str], ts_col: str) -> list[int]:
        """K7 at the store: rows at/below the table's max timestamp (and rows
        whose key exists - Q6 - or with a null timestamp - Q5) are merged;
        the rest is appended without touching existing data."""
        from zoneflow.operators.merge import check_source

        keys = list(keys)
        check_source(batch, keys)
        if not self.exists():
            return [self.create(batch)]
        target_keys = self.read().select(*keys)
        max_ts = self.read().agg(F.max(ts_col).alias("m")).first()["m"]
        if max_ts is None:
            return [self.merge_into(batch, keys, check_unique=False)]
        late = batch.where(F.col(ts_col).isNull() | (F.col(ts_col) <= F.lit(max_ts)))
        fresh = batch.where(F.col(ts_col) > F.lit(max_ts))
        to_merge = late.unionByName(fresh.join(target_keys, keys, "left_semi"))
        to_append = fresh.join(target_keys, keys, "left_anti")
        return [self.merge_into(to_merge, keys, check_unique=False), self.append(to_append)]


_DATA_OPS = ("CREATE", "WRITE", "WRITE_OVERWRITE", "MERGE")
