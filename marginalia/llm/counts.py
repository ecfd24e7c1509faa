"""Token counts by a separator scan.

Flat token files hold the ids of many documents one after the other, each ended by a separator,
without any index. Their blocks are searched for separators with NumPy, each on its own; a prefix
scan over the blocks' summaries (a window in SQL) then numbers the documents and adds what a
document has in earlier blocks, so documents may span any number of blocks.

Defined cases: a null or empty text is a document of no tokens; tokens after the last separator of
a file are a last document; empty files and blocks have no documents; a null doc_id is kept; rows
that repeat are documents of their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import cut, in_arrow, table
from .tokens import word_ids

SEPARATOR = 49407
BLOCK_TOKENS = 1 << 17
DTYPE = "<u2"
RANGE_BYTES = 64 << 20  # of a file that a task reads


def token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One flat file of 16-bit ids for each input partition, in blocks of fixed size: file, block,
    ids; and, where ids is null, the doc_ids of the file's documents from number ``block`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, file, step = word_ids(tokenizer, DTYPE), separator.to_bytes(2, "little"), TaskContext.get().partitionId(), 2 * block_tokens
        buffer, block, ordinal = bytearray(), 0, 0

        def rows(blocks: list[bytes], first: int, ids: list | None) -> pa.RecordBatch:
            numbers = [*range(first, first + len(blocks)), *([ordinal] if ids is not None else [])]
            n = len(numbers)
            lists = [None] * len(blocks) + ([ids] if ids is not None else [])
            return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.int64()), pa.array(numbers, pa.int64()), pa.array(blocks + [None] * (n - len(blocks)), pa.binary()), pa.array(lists, pa.list_(pa.int64()))], ["file", "block", "ids", "doc_ids"])

        for batch in batches:
            done: list[bytes] = []
            for text in batch.column(1):
                buffer += words.encode(text.as_py()) + end
                while len(buffer) >= step:
                    done.append(bytes(buffer[:step]))
                    del buffer[:step]
            yield rows(done, block, batch.column(0).to_pylist())
            block, ordinal = block + len(done), ordinal + batch.num_rows
        if buffer:
            yield rows([bytes(buffer)], block, None)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary")).transform(in_arrow, run, "file long, block long, ids binary, doc_ids array<long>")


class TokenFiles(DataSource):
    """Flat token files by ranges of bytes: a task reads one range of one file, in blocks, so a file
    may be of any length. Paths are what pyarrow.fs reads (local folders, s3, gs, hdfs, abfs)."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return "file string, block long, ids binary"

    def reader(self, schema) -> DataSourceReader:
        return TokenFileReader(self.options)


class TokenFileReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.block = int(options.get("block_bytes", 2 * BLOCK_TOKENS))
        self.step = max(1, int(options.get("range_bytes", RANGE_BYTES)) // self.block) * self.block

    def partitions(self) -> list[InputPartition]:
        files, root = fs.FileSystem.from_uri(self.path)
        info = files.get_file_info(root)
        every = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(root))
        kept = sorted((x.path, x.size) for x in every if x.type == fs.FileType.File and not x.base_name.startswith(("_", ".")))
        return [InputPartition((path, at, min(self.step, size - at))) for path, size in kept for at in range(0, size, self.step)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, start, length = partition.value
        files, _ = fs.FileSystem.from_uri(self.path)
        with files.open_input_file(path) as data:
            for at in range(start, start + length, self.block):
                got = data.read_at(min(self.block, start + length - at), at)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([at // self.block], pa.int64()), pa.array([got], pa.binary())], ["file", "block", "ids"])


def read_token_files(spark: SparkSession, path: str, block_bytes: int = 2 * BLOCK_TOKENS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Blocks (file, block, ids) of binary token files: a file or a folder, as a path or address;
    ``file`` is the path. ``block_bytes`` must hold whole ids."""
    spark.dataSource.register(TokenFiles)
    where = path if "://" in path or path.startswith("file:") else os.path.abspath(path)
    return spark.read.format("token_files").option("block_bytes", block_bytes).option("range_bytes", range_bytes).load(where)


def _scan(separator: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids in batch.column("ids"):
                x = np.frombuffer(ids.as_buffer(), dtype)
                at = np.flatnonzero(x == separator)
                head, tail = (int(at[0]), len(x) - 1 - int(at[-1])) if len(at) else (len(x), len(x))
                out.append((len(x), len(at), head, tail, np.diff(at) - 1))
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), *[pa.array(c, t) for c, t in zip(columns, kinds)]], ["file", "block", "n", "n_ends", "head", "tail", "inner"])

    return run


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = DTYPE) -> DataFrame:
    """file, ordinal (from 0), n_tokens without the separator, for (file, block, ids)."""
    kind = blocks.schema["file"].dataType.simpleString()
    found = blocks.select("file", "block", "ids").transform(in_arrow, _scan(separator, dtype), f"file {kind}, block long, n long, n_ends long, head long, tail long, inner array<long>")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    scan = found.select(
        "*",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.sum("tail").over(before), F.lit(0)).alias("passed"),
        F.lead("block").over(order).isNull().alias("last"),
    )
    # ``passed`` never falls, so its maximum over earlier blocks with a separator is the latest one's
    carry = F.col("passed") - F.coalesce(F.max(F.when(F.col("n_ends") > 0, F.col("passed"))).over(before), F.lit(0))
    scan = scan.withColumn("carry", carry)
    none = F.array().cast("array<bigint>")
    ended = F.when(F.col("n_ends") > 0, F.concat(F.array(F.col("carry") + F.col("head")), "inner")).otherwise(none)
    rest = F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("n"))
    open_end = F.when(F.col("last") & (rest > 0), F.array(rest)).otherwise(none)
    return scan.select("file", "first", F.posexplode(F.concat(ended, open_end)).alias("i", "n_tokens")).select("file", (F.col("first") + F.col("i")).alias("ordinal"), "n_tokens")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every document, counted in flat token files of all of them."""
    files = cut(token_files(table(spark, sf_dir, "documents")), "tokens")
    named = files.where("ids IS NULL").select("file", "block", F.posexplode("doc_ids").alias("i", "doc_id")).select("file", (F.col("block") + F.col("i")).alias("ordinal"), "doc_id")
    counted = count_tokens(files.where("ids IS NOT NULL"))
    return named.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
