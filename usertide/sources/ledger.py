"""A ledger of day shards: which ones were read, as what, and where their staged events lie.

Each refresh compares the shards that are there now with those of the ledger, by size, number of files and time of the last change, reads only the new
and changed ones, whatever their day, and puts a new version of the ledger in place. Staged events of a shard lie in a folder of
their own, so those of a changed shard take the place of the old ones, and all others stay where they are.
"""

from __future__ import annotations

import hashlib
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.operators.staging import stage_events
from usertide.schemas import RAW_EVENTS
from usertide.session import prepare
from usertide.sources.snapshots import Versions

SEEN = "shard string, bytes long, files long, modified timestamp, rows long, schema_print string, version long"


class ShardLedger(Versions):
    """The shards seen of one export, and their staged events, under ``root``.

    ``shard`` names the folders, with ``{day}`` where the day stands.
    """

    empty = {"version": 0, "shards": {}}

    def __init__(self, spark: SparkSession, root: str, version: int | None = None, shard: str = "events_{day}"):
        super().__init__(prepare(spark), root, version)
        self.shard = shard

    def look(self, src: str) -> dict[str, dict]:
        """The shards that are there: size, number of files and last change of each. One listing; no file is opened."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        files = hadoop.Path(src).getFileSystem(self.spark._jsc.hadoopConfiguration())
        found: dict[str, dict] = {}
        for folder in files.globStatus(hadoop.Path(f"{src.rstrip('/')}/{self.shard.format(day='*')}")) or []:
            held = [s for s in files.listStatus(folder.getPath()) if s.isFile() and s.getPath().getName()[0] not in "._"]
            if held:
                found[folder.getPath().getName()] = {
                    "bytes": sum(s.getLen() for s in held),
                    "files": len(held),
                    "modified": max(s.getModificationTime() for s in held),
                }
        return found

    def compare(self, src: str) -> dict[str, list[str]]:
        """The shards that are ``new``, ``changed``, the ``same`` and ``gone``."""
        there, known = self.look(src), self.manifest()["shards"]
        same = [s for s in there if s in known and all(there[s][k] == known[s][k] for k in there[s])]
        return {
            "new": sorted(s for s in there if s not in known),
            "changed": sorted(s for s in there if s in known and s not in same),
            "same": sorted(same),
            "gone": sorted(s for s in known if s not in there),
        }

    def refresh(self, src: str, tz: str = "UTC", drop_gone: bool = False) -> dict[str, list[str]]:
        """Read the new and changed shards of ``src``, and return what was found of all.

        Events of shards that are gone stay, unless ``drop_gone``. Nothing is written where nothing is new. A refresh that breaks off
        leaves the ledger as it was.
        """
        if self.version is not None:
            raise ValueError("a ledger that reads one version takes no shards")
        there, found, before = self.look(src), self.compare(src), self.manifest()
        read, version = found["new"] + found["changed"], before["version"] + 1
        shards = {s: e for s, e in before["shards"].items() if not (drop_gone and s in found["gone"])}
        if read:
            place = f"data/{uuid.uuid4().hex}"
            raw = self.spark.read.schema(RAW_EVENTS).parquet(*[f"{src.rstrip('/')}/{s}" for s in read])
            name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
            staged = stage_events(raw.withColumn("shard", F.url_decode(name)), tz, keep=["shard"])
            staged.write.partitionBy("shard").parquet(f"{self.root}/{place}")
            folders = {unquote(n.removeprefix("shard=")): f"{place}/{n}" for n in self._names(place) if n.startswith("shard=")}
            # counted in the files' footers; a row for each shard read
            counted = self.spark.read.schema("shard string").parquet(f"{self.root}/{place}").groupBy("shard").count()
            rows = {r["shard"]: r["count"] for r in counted.collect()} if folders else {}
            for s in read:
                columns = self.spark.read.parquet(f"{src.rstrip('/')}/{s}").schema.json()
                shards[s] = there[s] | {
                    "rows": rows.get(s, 0),
                    "schema_print": hashlib.sha256(columns.encode()).hexdigest()[:16],
                    "version": version,
                    "folder": folders.get(s),
                }
        if shards != before["shards"]:
            self.publish_manifest({"version": version, "shards": shards})
        return found

    def seen(self) -> DataFrame:
        """The ledger as a table; ``version`` is the one in which a shard was last read."""
        held = self.manifest()["shards"]
        rows = [(s, e["bytes"], e["files"], e["modified"], e["rows"], e["schema_print"], e["version"]) for s, e in sorted(held.items())]
        made = self.spark.createDataFrame(rows, SEEN.replace("modified timestamp", "modified long"))
        return made.withColumn("modified", F.timestamp_millis("modified"))

    def events(self) -> DataFrame:
        """Staged events of all shards of the ledger."""
        schema = stage_events(self.spark.createDataFrame([], RAW_EVENTS)).schema
        folders = [f"{self.root}/{e['folder']}" for e in self.manifest()["shards"].values() if e["folder"]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders).select(*schema.names)
