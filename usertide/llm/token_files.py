"""Token counts of documents in flat, unindexed token files, by a separator scan.

A file is a sequence of little-endian ids; each document ends with a separator id. Files are cut into blocks. A task searches
a block for separators, all at once, and returns where they are. Documents that cross blocks are put together by a prefix scan
over the blocks of a file: how many separators lie before a block, and where the last of them is. No block is read twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from usertide.llm import bpe
from usertide.llm._shared import stored, whole_text

#: Tokens in a block.
BLOCK = 4 << 20


def opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a file or folder name, local or not."""
    url = urlparse(uri)
    if url.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), url.path
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, eod: int, width: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write each partition's texts as one flat file of ``width`` bytes an id, each followed by ``eod``.

    Returns ``id, file, ordinal``: which document of which file a row became. NULL counts as empty, and an empty text is a
    separator alone. A task that runs again writes the same file again, whole.
    """
    schema = docs.select(F.col(id_col).alias("id")).schema.add("file", IntegerType()).add("ordinal", LongType())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, path = opened(f"{folder}/tokens-{part:06d}.bin")
        other, n, coder = f"{path}.{uuid.uuid4().hex}", 0, bpe.load(tokenizer)
        with fs.open_output_stream(other) as out:
            for batch in batches:
                texts, chars, first = [], 0, n
                for i, text in enumerate(batch.column(1), 1):
                    texts.append(text.as_py())
                    chars += len(texts[-1])
                    if chars >= bpe.MAX_CHARS or i == batch.num_rows:
                        ids, size = coder.encode(texts)
                        if len(ids) and (ids.max() >= 1 << 8 * width or (ids == eod).any()):
                            raise ValueError(f"ids must fit {width} bytes and differ from {eod}")
                        flat = np.insert(ids.astype(f"<u{width}"), np.cumsum(size), eod)
                        out.write(flat.tobytes())
                        n += len(texts)
                        texts, chars = [], 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(n - first, part, np.int32)), pa.array(np.arange(first, n))],
                    names=["id", "file", "ordinal"],
                )
        fs.move(other, path)

    fs, path = opened(folder)
    fs.create_dir(path, recursive=True)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("t"))
    return stored(rows.mapInArrow(write, schema), f"{folder}-order")


def blocks_of(spark: SparkSession, folder: str, width: int, block: int = BLOCK) -> DataFrame:
    """``path, block, first, n``: the blocks of all token files of a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length")
    files = files.withColumn("tokens", F.floor(F.col("length") / width)).where("tokens > 0")
    at = files.select("path", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / block))).alias("block"))
    return at.select("path", "block", (F.col("block") * block).alias("first"), F.least(F.lit(block), F.col("tokens") - F.col("block") * block).alias("n"))


def separators(blocks: DataFrame, eod: int, width: int) -> DataFrame:
    """``path, block, first, n, at``: where in the file the separators of each block are."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = opened(row["path"])
                with fs.open_input_file(path) as f:
                    f.seek(row["first"] * width)
                    ids = np.frombuffer(f.read(row["n"] * width), f"<u{width}")
                at = np.flatnonzero(ids == eod) + row["first"]
                columns = [pa.array([row[c]], batch.schema.field(c).type) for c in ("path", "block", "first", "n")]
                lists = pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pa.array(at))
                yield pa.RecordBatch.from_arrays([*columns, lists], names=["path", "block", "first", "n", "at"])

    return blocks.mapInArrow(search, "path string, block long, first long, n long, at array<long>")


def count_documents(spark: SparkSession, folder: str, work: str, eod: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """Per document ``path, ordinal, first, n_tokens, ended``, in a folder of token files.

    ``first`` is the place of its first token; ``n_tokens`` counts its tokens without the separator. Tokens after the last separator of a
    file are a document that is not ``ended``; if there are none, there is no such document. Two separators in a row
    enclose an empty document. Bytes that are left over at a file's end are no token. Files without tokens have no documents.
    """
    blocks = blocks_of(spark, folder, width, block)
    # a row for each block, dealt out evenly to be read
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stored(separators(blocks.repartition(tasks), eod, width), f"{work}/separators")
    # the scan: a row a block, without the places of its separators
    marks = found.select("path", "block", "first", "n", F.size("at").cast("long").alias("m"), F.try_element_at("at", F.lit(-1)).alias("last"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.select(
        "path",
        "block",
        F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("since"),
    )
    each = found.join(marks, ["path", "block"])
    ends = each.select("path", "before", "since", "at", F.posexplode("at").alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("since")).otherwise(F.try_element_at("at", F.col("k"))) + 1
    ends = ends.select(
        "path", (F.col("before") + F.col("k")).alias("ordinal"), start.alias("first"), (F.col("end") - start).alias("n_tokens"), F.lit(True).alias("ended")
    )
    tail = found.groupBy("path").agg(
        F.sum(F.size("at").cast("long")).alias("ordinal"), F.max(F.try_element_at("at", F.lit(-1))).alias("last"), F.max(F.col("first") + F.col("n")).alias("tokens")
    )
    start = F.coalesce("last", F.lit(-1)) + 1
    tail = tail.where(start < F.col("tokens"))
    tail = tail.select("path", "ordinal", start.alias("first"), (F.col("tokens") - start).alias("n_tokens"), F.lit(False).alias("ended"))
    return ends.unionByName(tail)
