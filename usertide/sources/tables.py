"""Star-schema tables at rest and the insert-if-absent load."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.functions.columns import user_home
from usertide.schemas import BUCKET_COLUMN, DATE_COLUMN, TABLES, conform

#: The column that stored slices are bucketed by.
HOME = "user_home"


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: list[str], by: str | None = None) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``.

    Rows without a complete key never load. Several key columns are compared as
    columns, not as joined text. An anti join needs no distinct keys on its right. ``by`` names one of several
    keys that the new rows lie by and that has few of the others, as a session has few steps: these are gathered to it, so that only they are shuffled.
    """
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if by:
        rest = F.struct(*[k for k in keys if k != by])
        held = existing.groupBy(by).agg(F.collect_set(rest).alias("_held"))
        both = new.where(keyed).join(held.hint("merge"), by, "left")
        return both.where(F.col("_held").isNull() | ~F.array_contains("_held", rest)).select(*new.columns)
    return new.where(keyed).join(existing.select(*keys), keys, "left_anti").select(*new.columns)


def publish_views(frames: dict[str, DataFrame]) -> None:
    """Make the frames reachable by name from SQL."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


class TableStore:
    """The nine tables and the marts, as Parquet under ``root`` or as catalog tables in ``database``.

    Facts are stored in one folder per date, unless ``partitioned`` is off. Catalog tables
    may instead get ``buckets``: users, user days, sessions, steps and purchases are then
    stored by their key, and joins and aggregates on it read them without a shuffle; they are then not
    partitioned by date.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        database: str | None = None,
        partitioned: bool = True,
        buckets: int | None = None,
    ):
        if (root is None) == (database is None):
            raise ValueError("give either root or database")
        if buckets and not database:
            raise ValueError("only catalog tables can be bucketed")
        self.spark, self.database, self.partitioned, self.buckets = spark, database, partitioned, buckets
        self.root = root.rstrip("/") if root else None

    def _name(self, table: str) -> str:
        return f"{self.database}.{table}" if self.database else f"{self.root}/{table}"

    def read(self, table: str, missing_ok: bool = False) -> DataFrame:
        """The table in its declared column order.

        A table that was never loaded is an error, so that a mistyped place does not look clean;
        with ``missing_ok`` it is empty.
        """
        schema = TABLES[table]
        try:
            if self.database:
                found = self.spark.table(self._name(table))
            else:
                found = self.spark.read.schema(schema).parquet(self._name(table))
        except AnalysisException as error:
            if not missing_ok or error.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
            return self.spark.createDataFrame([], schema)
        return found.select(*schema.names)

    def holds_rows(self) -> bool:
        return any(not self.read(table, missing_ok=True).isEmpty() for table in TABLES)

    def read_mart(self, name: str) -> DataFrame:
        """A mart that ``publish`` stored, in this session or another."""
        return self.spark.table(self._name(name)) if self.database else self.spark.read.parquet(self._name(name))

    def publish(self, marts: dict[str, DataFrame]) -> None:
        """Store marts under their names, replacing earlier ones once all are written."""
        for name, mart in marts.items():
            writer = mart.write.mode("overwrite").format("parquet")
            side = self._beside(name)
            writer.saveAsTable(side) if self.database else writer.save(side)
        for name in marts:
            self._adopt(name)

    def replace(self, model: dict[str, DataFrame], tasks: int = 1) -> None:
        """Replace tables by these, once all of them are written; a failure before leaves the old ones as they are.

        The tables then take their places one after the other: a process that ends in between leaves some old and some new ones, and the
        one in the middle under ``_old``. A ``SnapshotStore`` has no such moment. ``tasks`` tables are written at a time.
        """
        with ThreadPoolExecutor(tasks) as pool:
            list(pool.map(lambda name: self.write(model[name], name, "overwrite", self._beside(name)), model))
        for name in model:
            self._adopt(name)

    def _beside(self, table: str) -> str:
        return f"{self.database}.{table}__next" if self.database else f"{self.root}/_next/{table}"

    def _adopt(self, table: str) -> None:
        """Put what lies beside a table in its place."""
        if self.database:
            # A renamed table would keep its partitions' old places; the rows are whole and checked by now.
            rows = self.spark.table(self._beside(table))
            if table in TABLES:
                self.write(rows, table, "overwrite")
            else:
                rows.write.mode("overwrite").format("parquet").saveAsTable(self._name(table))
            self.spark.sql(f"drop table {self._beside(table)}")
            return
        # The file system of the folder, local or not, as Spark itself reaches it.
        paths = self.spark._jvm.org.apache.hadoop.fs
        old, new = paths.Path(self._name(table)), paths.Path(self._beside(table))
        files = old.getFileSystem(self.spark._jsc.hadoopConfiguration())
        # The old one is moved aside, not deleted, until the new one has its place.
        aside = paths.Path(f"{self.root}/_old/{table}")
        files.mkdirs(aside.getParent())
        if files.exists(aside):
            files.delete(aside, True)
        held = files.exists(old)
        if held and not files.rename(old, aside):
            raise OSError(f"could not move {old.toString()} aside")
        try:
            moved = files.rename(new, old)
        except Exception:
            moved = False
        if not moved:
            if held:
                files.rename(aside, old)
            raise OSError(f"could not move {new.toString()} to {old.toString()}")
        files.delete(aside, True)
        self.spark.catalog.refreshByPath(self._name(table))

    def model(self) -> dict[str, DataFrame]:
        return {table: self.read(table) for table in TABLES}

    def create_missing(self) -> None:
        """Create every table that does not exist yet, empty and typed."""
        for table in TABLES:
            self.write(self.spark.createDataFrame([], TABLES[table]), table, "ignore")

    def write(self, df: DataFrame, table: str, mode: str, place: str | None = None) -> None:
        place = place or self._name(table)
        rows = conform(df, TABLES[table])
        key = BUCKET_COLUMN.get(table) if self.buckets else None
        day = DATE_COLUMN.get(table) if self.partitioned and not key else None
        if key:
            # Keyed like the buckets, each task writes whole buckets. Rows per key are few by now.
            rows = rows.repartition(self.buckets, key)
        elif day:
            rows = rows.hint("rebalance", F.col(day))
        writer = rows.write.mode(mode).format("parquet")
        if key:
            writer = writer.bucketBy(self.buckets, key).sortBy(key)
        elif day:
            writer = writer.partitionBy(day)
        if self.database:
            writer.saveAsTable(place)
        else:
            writer.save(place)

    def keep_slices(self, rolled: DataFrame) -> DataFrame:
        """Store the rollup of a load in buckets of users, and return it as it lies there.

        All tables of users, days, sessions and steps are then aggregated bucket by bucket, with no shuffle. A user with a large share of all slices makes
        a large bucket.
        """
        rows = rolled.withColumn(HOME, user_home()).repartition(self.buckets, HOME)
        place = self._name("event_slices")
        rows.write.mode("overwrite").format("parquet").bucketBy(self.buckets, HOME).sortBy(HOME).saveAsTable(place)
        return self.spark.table(place)

    def insert(self, df: DataFrame, table: str, keys: list[str], dates: tuple[date, date] | None = None) -> None:
        """Append the rows whose key the table does not hold. A repeated run adds nothing.

        ``dates`` are the first and last date among the new rows. Where the date is part of the key, only
        the stored rows of those dates are read.
        """
        stored = self.read(table, missing_ok=True)
        day = next((k for k in keys if k in (DATE_COLUMN.get(table), "date_day")), None)
        if dates and day:
            stored = stored.where(F.col(day).between(*[F.lit(d) for d in dates]))
        self.write(insert_if_absent(df, stored, keys, by="session_key" if table == "fact_funnel_steps" else None), table, "append")

    def rebuild(self, df: DataFrame, table: str, side: str) -> None:
        """Replace a table by a query over itself.

        The rows are first written whole to the folder ``side``, then beside the table, which takes
        their place only once they are complete.
        """
        df.write.mode("overwrite").parquet(side)
        self.replace({table: self.spark.read.schema(df.schema).parquet(side)})
