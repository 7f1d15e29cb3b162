"""Tables at rest as snapshots: immutable folders, and manifests that name a version of all tables.

A load writes its rows under ``data/<load>/<table>/part=<part>`` and nothing else. Then one manifest,
``manifests/<version>.json``, is put in place by a rename that never replaces a file. It names the folders of every part of every table.
Until it is there, readers see the version before; from then on, all of the new one. A part is a date of a fact, a hash bucket of users,
or a whole small table, so a version can share most of its folders with the one before.

Along with each part of a keyed table goes a Bloom filter of its keys (``key_filters``), in the same load's folder.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usertide.operators.in_flight import observed
from usertide.schemas import DATE_COLUMN, SLICES, TABLES, conform
from usertide.sources.key_filters import SCHEMA as FILTER_SCHEMA
from usertide.sources.key_filters import build_filter, filter_widths, may_hold

#: The stored rollup, from which user days are recomputed.
ROLLUP = "event_slices"

#: What the filter of a table holds. The keys of other tables say themselves in which part they lie.
FILTER_KEYS = {
    "dim_user": ["user_id"],
    "fact_sessions": ["session_key"],
    "fact_funnel_steps": ["session_key"],
    "fact_purchases": ["purchase_key"],
}

Parts = dict[str, list[str]]


class ConcurrentLoad(RuntimeError):
    """Another load has put its manifest in place first. Nothing of this one is seen; it can be run again."""


class Versions:
    """Numbered manifests under ``root``; the latest one counts, unless a version is given."""

    empty: dict = {"version": 0}

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark, self.root, self.version = spark, root.rstrip("/"), version
        self._texts: dict[int, str] = {}  # manifests never change

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        files = self._files()
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def versions(self) -> list[int]:
        """All versions that can be read, oldest first."""
        return sorted(int(n[:-5]) for n in self._names("manifests") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self) -> dict:
        """What the version holds; an empty one where nothing was loaded yet."""
        known = self.versions()
        if self.version is not None and self.version not in known:
            raise ValueError(f"there is no version {self.version}; there are {known}")
        if not known:
            return json.loads(json.dumps(self.empty))
        version = known[-1] if self.version is None else self.version
        if version not in self._texts:
            self._texts[version] = self.spark.read.text(f"{self.root}/manifests/{version:08d}.json", wholetext=True).first()[0]
        return json.loads(self._texts[version])

    def publish_manifest(self, manifest: dict) -> None:
        """Put a manifest in place: written beside, then renamed to a name that must not exist yet."""
        beside = self._path(f"manifests/.{uuid.uuid4().hex}")
        out = self._files().create(beside, False)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        place = self._path(f"manifests/{manifest['version']:08d}.json")
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(beside, place, self.spark._sc._gateway.new_array(rename, 0))
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                self._files().delete(beside, False)
                raise ConcurrentLoad(f"version {manifest['version']} is there already") from error
            raise


class SnapshotStore(Versions):
    """The nine tables, the rollup and the marts under ``root``, by version.

    Without ``version`` the store reads the latest one there is at each call; with it, that one for good. ``buckets`` parts hold the users;
    a store keeps the number it began with. Loads of one store exclude each other where the file system's rename does (HDFS); elsewhere they must
    not run at the same time.
    """

    def __init__(self, spark: SparkSession, root: str, version: int | None = None, buckets: int = 16):
        super().__init__(spark, root, version)
        self.empty = {"version": 0, "buckets": buckets, "tables": {}, "filters": {}, "marts": {}, "measures": {}, "streams": {}}

    def at(self, version: int) -> SnapshotStore:
        """The store as a reader of one version, whatever is loaded later."""
        return SnapshotStore(self.spark, self.root, version)

    def expire(self, keep: int) -> list[str]:
        """Delete the versions before the last ``keep``, and the loads' folders that no version left names; not while a load runs.

        Manifests go first: a reader finds either a version with all of its folders, or none.
        """
        if keep < 1:
            raise ValueError("one version at least must be kept")
        versions = self.versions()
        used = {folder.split("/")[1] for v in versions[-keep:] for folder in _folders(self.at(v).manifest())}
        files = self._files()
        for version in versions[:-keep]:
            files.delete(self._path(f"manifests/{version:08d}.json"), False)
        unused = [load for load in self._names("data") if load not in used]
        for load in unused:
            files.delete(self._path(f"data/{load}"), True)
        return unused

    # Reading ---------------------------------------------------------------------

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders]).select(*schema.names)

    def parts(self, table: str) -> Parts:
        """The folders of each part of a table."""
        return self.manifest()["tables"].get(table, {})

    def read(
        self, table: str, missing_ok: bool = False, parts: list[str] | None = None, days: tuple[date, date] | None = None
    ) -> DataFrame:
        """The table in its declared column order, or some parts of it.

        ``days``, first and last, leave out all folders of other dates. A table that was never loaded is an error, unless ``missing_ok``.
        """
        schema = SLICES if table == ROLLUP else TABLES[table]
        held = self.manifest()["tables"].get(table)
        if held is None:
            if not missing_ok:
                raise ValueError(f"{table} was never loaded to {self.root}")
            held = {}
        if days:
            held = {p: f for p, f in held.items() if str(days[0]) <= p <= str(days[1])}
        return self._read([f for p, of in held.items() if parts is None or p in parts for f in of], schema)

    def model(self) -> dict[str, DataFrame]:
        """All nine tables, of one version."""
        store = self.at(self.manifest()["version"]) if self.versions() else self
        return {table: store.read(table) for table in TABLES}

    def measures(self) -> DataFrame:
        """What was observed of the rows that each load wrote: ``version, kind, table_name, metric, value``.

        Of a full load these are the counts and NULLs of the summary; of other loads, those of the rows written.
        """
        rows = []
        for version in self.versions():
            held = self.at(version).manifest()
            rows += [(version, held["kind"], t, m, v) for t, of in held["measures"].items() for m, v in of.items()]
        return self.spark.createDataFrame(rows, "version long, kind string, table_name string, metric string, value long")

    def holds_rows(self) -> bool:
        return any(not self.read(table, missing_ok=True).isEmpty() for table in TABLES)

    def read_mart(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self.manifest()['marts'][name]}")

    # Writing ---------------------------------------------------------------------

    def part_of(self, table: str) -> Column:
        """The part that a row of the table lies in."""
        day = "event_date_utc" if table == ROLLUP else DATE_COLUMN.get(table)
        if day:
            return F.coalesce(F.col(day).cast("string"), F.lit("none"))
        if table == "dim_user":
            return F.pmod(F.xxhash64("user_id"), F.lit(self.manifest()["buckets"])).cast("string")
        return F.lit("all")

    def may_hold(self, table: str, keys_of: DataFrame) -> DataFrame:
        """The keys among these that some stored part may hold, with the part: key columns and ``part``."""
        keys = FILTER_KEYS[table]
        held = self.manifest()["filters"].get(table, {})
        filters = self._read([entry[0] for of in held.values() for entry in of], T._parse_datatype_string(FILTER_SCHEMA))
        widths = sorted({entry[1] for of in held.values() for entry in of}) or [1]
        return may_hold(keys_of, keys, filters, widths)

    def change(self, kind: str) -> Change:
        """Begin a new version from the latest one."""
        if self.version is not None:
            raise ValueError("a store that reads one version takes no loads")
        return Change(self, kind)

    def replace(self, model: dict[str, DataFrame], tasks: int = 1) -> None:
        """Replace whole tables by these, all at once."""
        change = self.change("full")
        with ThreadPoolExecutor(tasks) as pool:
            list(pool.map(lambda name: change.put(name, model[name]), model))
        change.commit()

    def publish(self, marts: dict[str, DataFrame]) -> None:
        """Store marts under their names, in a version of their own."""
        change = self.change("marts")
        for name, mart in marts.items():
            change.put_mart(name, mart)
        change.commit()


def _folders(manifest: dict) -> list[str]:
    tables = [folder for parts in manifest["tables"].values() for of in parts.values() for folder in of]
    return tables + [entry[0] for parts in manifest["filters"].values() for of in parts.values() for entry in of] + list(manifest["marts"].values())


class Change:
    """A version in the making. Nothing of it can be seen before ``commit``, and one that is given up needs no undoing."""

    def __init__(self, store: SnapshotStore, kind: str):
        self.store, self.load = store, uuid.uuid4().hex
        self.before = store.manifest()
        self.manifest = json.loads(json.dumps(self.before)) | {"version": self.before["version"] + 1, "kind": kind, "load": self.load, "measures": {}}
        self.written: dict[str, list[str]] = {}

    def put(self, table: str, rows: DataFrame, drop: list[str] | None = None) -> None:
        """Write rows of a table. They take the place of the parts ``drop``, of all if it is not given, and are added to others."""
        store, schema = self.store, SLICES if table == ROLLUP else TABLES[table]
        place = f"data/{self.load}/{table}"
        rows = conform(rows, schema).withColumn("part", store.part_of(table))
        if table in DATE_COLUMN or table in (ROLLUP, "dim_user"):
            rows = rows.hint("rebalance", F.col("part"))
        rows, seen = observed(rows, table)
        rows.write.partitionBy("part").parquet(f"{store.root}/{place}")
        self.manifest["measures"][table] = seen.get
        new = {n.removeprefix("part="): f"{place}/{n}" for n in store._names(place) if n.startswith("part=")}
        self.written[table] = sorted(new)
        held = {} if drop is None else {p: f for p, f in self.manifest["tables"].get(table, {}).items() if p not in drop}
        self.manifest["tables"][table] = held | {p: [*held.get(p, []), folder] for p, folder in new.items()}
        if table in FILTER_KEYS:
            self._put_filter(table, place if new else None, drop)

    def _put_filter(self, table: str, written: str | None, drop: list[str] | None) -> None:
        store, place = self.store, f"data/{self.load}/filters/{table}"
        part, keys = F.col("part"), FILTER_KEYS[table]
        held = {} if drop is None else {p: f for p, f in self.manifest["filters"].get(table, {}).items() if p not in drop}
        if written:
            # The names of the folders say the parts: to count them reads no column.
            schema = T.StructType([*[f for f in TABLES[table] if f.name in keys], T.StructField("part", T.StringType())])
            rows = store.spark.read.schema(schema).parquet(f"{store.root}/{written}")
            widths = {r["part"]: r["width"] for r in filter_widths(rows, part).collect()}  # a row for each part
            words = build_filter(rows, part, keys, widths).withColumn("of", F.col("part"))
            words.hint("rebalance", F.col("of")).write.partitionBy("of").parquet(f"{store.root}/{place}")
            for name in store._names(place):
                if name.startswith("of="):
                    p = name.removeprefix("of=")
                    held[p] = [*held.get(p, []), [f"{place}/{name}", widths[p]]]
        self.manifest["filters"][table] = held

    def put_mart(self, name: str, mart: DataFrame) -> None:
        place = f"data/{self.load}/marts/{name}"
        mart.write.parquet(f"{self.store.root}/{place}")
        self.manifest["marts"][name] = place

    def leave_out(self, table: str) -> None:
        """The new version does not have this table."""
        self.manifest["tables"].pop(table, None)

    def commit(self) -> int:
        """Make the version the latest one."""
        self.store.publish_manifest(self.manifest)
        return self.manifest["version"]
