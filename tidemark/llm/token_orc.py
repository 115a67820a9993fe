"""Token ids in ORC: one row per document, in ascending doc_id order.

ORC keeps integers run-length encoded, and row-group minima and maxima of the ids beside Bloom filters on
doc_id, so a reader that wants some documents skips whole stripes and row groups; stripes are read in
parallel. Every file (shard) holds a range of ids, and positions are stored relative to it: a lost or repeated task
rewrites its own file only, and the totals before each file come from the two columns that hold counts.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.staging import free_shuffles
from tidemark.llm.tokens import encoder

SCHEMA = "shard int, doc_id long, start_in_shard long, n_tokens long, tokens array<int>"
OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "10000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
_ARROW = pa.schema([
    ("shard", pa.int32()), ("doc_id", pa.int64()), ("start_in_shard", pa.int64()), ("n_tokens", pa.int64()),
    ("tokens", pa.list_(pa.int32())),
])


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end: int, doc_id: str = "doc_id", text: str = "text",
    overwrite: bool = False,
) -> None:
    """Encodes each whole text (null: empty), adds ``end`` and writes the ids to ORC files under ``path``.

    Rows with the same id follow each other in the order of their texts; rows without an id come first.
    An empty table gives files without rows. ``vocabulary`` must be a path that every executor has.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start = TaskContext.get().partitionId(), 0
        encode = encoder(vocabulary, end).encode
        for batch in batches:
            ids_of = batch.column(0)
            for first, ids, counts in encode(batch.column(1).fill_null("").to_pylist()):
                ends = np.cumsum(counts)
                n = len(counts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard), pa.int32()), ids_of.slice(first, n).cast(pa.int64()),
                     pa.array(start + ends - counts, pa.int64()), pa.array(counts, pa.int64()), lists],
                    schema=_ARROW,
                )
                start += int(ends[-1])

    ordered = (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    free_shuffles(docs.sparkSession)
    ordered.mapInArrow(encoded, SCHEMA).write.options(**OPTIONS).mode("overwrite" if overwrite else "error").orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def shard_starts(written: DataFrame) -> DataFrame:
    """(shard, first): ids in all shards before each. One row per file; reads the counts only."""
    totals = written.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        offsets = lists.offsets.to_pylist()
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(3)), pa.array(np.diff(offsets), pa.int64()), pa.array(sums, pa.int64())],
            names=["shard", "doc_id", "start_in_shard", "n_tokens", "ids_crc32"],
        )


def digests(written: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard) from the files; ids are dropped before rows are joined."""
    narrow = written.select("shard", "doc_id", "start_in_shard", "tokens").mapInArrow(
        _checksums, "shard int, doc_id long, start_in_shard long, n_tokens long, ids_crc32 long"
    )
    return narrow.join(shard_starts(written), "shard").select(
        "doc_id", (F.col("first") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32", "shard"
    )
