"""Exact duplicates by a tree merge of sorted digest runs.

Each input partition makes one run: its rows' digests, sorted, one entry per digest with the identifier to
keep and the number of rows. In each round ``fan_in`` neighbouring runs meet and are merged into one, until a
single run is left (a binomial tree of rounds; ``fan_in`` 2 is the plain one). All runs are cut at the same places: a stored level is a
table bucketed by key and sorted within its buckets, so a round reads the runs of a bucket together, merges them and writes them
back with no shuffle, and the last rounds are as parallel as the first. The sorts that Spark plans in a round meet sorted pieces, which
its merge sort takes as they are. The last run has one entry per key; its decisions go to the first runs by a join within buckets.
A key has no more than ``fan_in`` entries in a merge, and in the first round no more than one input partition holds: a group
of copies of any size meets nowhere in one task. Only digests move, never texts.

An entry's key is the SHA-256 of the text, its length in bytes and a second, independent hash of the text. All
three must agree at every level before two entries are taken for equal.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usertide.llm._shared import rows_that_stay, stored, whole_text, work_folder

KEY = ["digest", "n_bytes", "proof"]


def digest_rows(docs: DataFrame, work: str, id_col: str = "doc_id", text_col: str = "text", normalise=None) -> DataFrame:
    """One row per input row: id, its partition as run, a row number and the key of its text. Written once."""
    text = whole_text(text_col)
    text = normalise(text) if normalise else text
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id",
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.octet_length("t").alias("n_bytes"),
        F.xxhash64("t").alias("proof"),
    )
    return stored(rows, f"{work}/rows")


def merge_runs(runs: DataFrame, keep: str) -> DataFrame:
    """Merge entries of equal run and key: the identifier to keep and the number of rows."""
    best = F.max("best") if keep == "max" else F.min("best")
    return runs.groupBy(*KEY, "run").agg(best.alias("best"), F.sum("n").alias("n"))


def stored_runs(runs: DataFrame, path: str, buckets: int) -> DataFrame:
    """Write runs to the shared folder, bucketed by key and sorted within buckets, and read them back.

    Spark keeps buckets with a table's name only. The name goes as soon as the table is read; its files stay in the work folder.
    """
    spark, name = runs.sparkSession, f"runs_{uuid.uuid4().hex}"
    runs.write.bucketBy(buckets, *KEY).sortBy(*KEY).option("path", path).format("parquet").saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    normalise=None,
    fan_in: int = 8,
    work: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Every row with the row of its text that stays.

    Returns ``id, keep_id, group_size, kept, digest`` (binary SHA-256) and ``proof``, one row per input row.
    ``keep`` is ``max`` or ``min``, by id; ``normalise`` maps the text column before it is compared.
    ``buckets`` is the number of pieces that a run is cut into, by default the session's number of shuffle partitions.

    NULL text counts as empty, and empty texts are equal to each other. A NULL id never wins against another id; a
    group of NULL ids has a NULL ``keep_id``. Rows that repeat id and text are copies: exactly one is ``kept``.
    An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep must be 'max' or 'min'")
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    work = work_folder(docs.sparkSession, work)
    rows = digest_rows(docs, work, id_col, text_col, normalise)
    # among equal ids the row number decides, so that one row is left
    best = F.struct(F.col("id").isNotNull() if keep == "max" else F.col("id").isNull(), "id", "row")
    leaf = merge_runs(rows.select("run", *KEY, best.alias("best"), F.lit(1).cast("long").alias("n")), keep)
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = first = stored_runs(leaf.repartition(buckets, *KEY), f"{work}/level-0", buckets)
    last, level = rows.agg(F.max("run")).first()[0] or 0, 0
    while last > 0:
        last, level = last // fan_in, level + 1
        met = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        runs = stored_runs(merge_runs(met, keep), f"{work}/level-{level}", buckets)
    decided = first.select("run", *KEY).join(runs.select(*KEY, "best", "n"), KEY)
    return rows.join(decided, ["run", *KEY]).select(
        "id",
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        "digest",
        "proof",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows without copies, all columns as they were, whatever their names.

    Of equal texts the row that ``exact_dedup`` keeps stays, NULL text counting as empty; of rows that repeat its id and text as well, any one. NULL ids are
    documents like others. An empty table gives an empty one. Texts of rows that stay are not shuffled (``rows_that_stay``).
    """
    work = work_folder(docs.sparkSession, options.pop("work", None))
    found = exact_dedup(docs, id_col, text_col, work=work, **options).withColumnRenamed("digest", "key")
    text = whole_text(text_col)
    normalise = options.get("normalise")
    return rows_that_stay(docs, found, id_col, F.unhex(F.sha2(normalise(text) if normalise else text, 256)), work)
