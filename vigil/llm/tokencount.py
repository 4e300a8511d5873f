"""Token counts of documents in flat token files: a vectorised scan for separators.

A flat file is the ids of its documents, two bytes each, every document ended by the
end-of-document id; nothing says where documents begin. A file is scanned in blocks: one
comparison finds all separators of a block, the distances between them are the counts of the
documents inside. What is left over at the edges (tokens before a block's first separator and
after its last) is stitched by a prefix scan over one row per block, so a document may span any
number of blocks.

Files are written by Spark's text writer: a row is the packed ids of a document and the line
separator is the packed separator id. They are read as whole files; the writer bounds their size
by rows per file, and ``spark.sql.sources.binaryFile.maxLength`` refuses larger ones.

Defined cases: a null or empty text is a document of no tokens; tokens after a file's last
separator are a last document without end; an empty file has no documents; a file of an odd
number of bytes is refused; extra columns are not written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import lean
from vigil.llm.tokens import shared

END_ID = 49407
BLOCK_TOKENS = 1 << 20
ROWS_PER_FILE = 4_000


def _pack(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared(path, dtype="<u2", plain=True)
        for batch in batches:
            packed = tokenizer.pack(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["ids"])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """The ids of every text of ``docs``, each text ended by ``end_id``, as flat files.

    Texts that spell a special token are read as ordinary text, so they cannot end a document.
    """
    packed = docs.select("text").mapInArrow(lean(_pack(tokenizer)), "ids binary")
    separator = np.array([end_id], "<u2").tobytes().decode("latin-1")
    (
        packed.select(F.col("ids").cast("string").alias("value"))
        .write.option("lineSep", separator)
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", rows_per_file)
        .text(path)
    )


_BLOCKS = "file string, block int, tokens long, ends long, head long, tail long, inner array<long>"


def scan_block(ids: np.ndarray, end_id: int) -> tuple[int, int, int, np.ndarray]:
    """Separators in a block, tokens before the first and after the last (all tokens in both if
    there is none), and the counts between them."""
    at = np.flatnonzero(ids == end_id)
    if not len(at):
        return 0, len(ids), len(ids), at
    return len(at), int(at[0]), len(ids) - 1 - int(at[-1]), np.diff(at) - 1


def _scan(end_id: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(content.as_buffer(), dtype="<u2")
                for block, low in enumerate(range(0, len(ids), block_tokens)):
                    part = ids[low : low + block_tokens]
                    ends, head, tail, inner = scan_block(part, end_id)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name]),
                            pa.array([block], pa.int32()),
                            *(pa.array([x], pa.int64()) for x in (len(part), ends, head, tail)),
                            pa.array([inner], pa.list_(pa.int64())),
                        ],
                        names=["file", "block", "tokens", "ends", "head", "tail", "inner"],
                    )

    return run


def scan_files(
    spark: SparkSession, path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """One row per block of the flat files below ``path``."""
    files = spark.read.format("binaryFile").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.mapInArrow(lean(_scan(end_id, block_tokens)), _BLOCKS)


def stitch(blocks: DataFrame) -> DataFrame:
    """(file, document, start, n_tokens) for every document of the scanned files; documents are
    numbered from 0 in each file and ``start`` counts the tokens of the file before it."""
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    has_end = F.when(F.col("ends") > 0, 1).otherwise(0)
    open_ = Window.partitionBy("file", "stretch").orderBy("block")
    open_ = open_.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("long")
    placed = (
        blocks.withColumn("stretch", F.sum(has_end).over(until))
        .withColumn("running", F.sum("tail").over(open_))  # tokens since the last separator
        .withColumn("carried", F.coalesce(F.lag("running").over(order), zero))
        .withColumn("before", F.coalesce(F.sum("tokens").over(earlier), zero))
        .withColumn("ended", F.coalesce(F.sum("ends").over(earlier), zero))
        .withColumn("last", F.lead("block").over(order).isNull())
    )
    first = F.array(F.col("carried") + F.col("head"))
    closed = F.when(F.col("ends") > 0, F.concat(first, F.col("inner"))).otherwise(
        F.array().cast("array<long>")
    )
    rest = F.when(
        F.col("last") & (F.col("running") > 0), F.array(F.col("running"))
    ).otherwise(F.array().cast("array<long>"))
    listed = placed.withColumn("counts", F.concat(closed, rest)).filter(F.size("counts") > 0)
    rows = listed.select(
        "file", "block", "ended", "before", "carried", F.posexplode("counts").alias("i", "n_tokens")
    )
    inside = Window.partitionBy("file", "block").orderBy("i")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum(F.col("n_tokens") + 1).over(inside), zero)
    return rows.select(
        "file",
        (F.col("ended") + F.col("i")).alias("document"),
        (F.col("before") - F.col("carried") + passed).alias("start"),
        "n_tokens",
    )
