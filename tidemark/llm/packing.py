"""Packing of token sequences into windows by minimum bin slack.

Documents longer than a window are cut into full windows and a rest. Only the number of rests of each length
matters, a table with at most as many rows as a window has tokens. Windows are planned on it one after the
other: the longest rest left must go in, and a subset-sum over bits finds the multiset of the others that
fills the window closest to its end. A filling is used as often as the counts allow, so the number of
fillings has a bound that depends on the window and not on the corpus. Rests then take their places by
their rank among rests of the same length, counted while they are cut.
"""

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.staging import stage
from tidemark.llm.tokens import encoder

PIECE = "doc_id long, start long, length long, doc_tokens long, part int, nth long, ids binary"


def cut(docs: DataFrame, vocabulary: str, end: int, window: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of at most ``window`` ids of each text (null: empty) with ``end`` added.

    ``ids`` are little-endian numbers of 32 bits, as trainers map them from files. ``part`` is the task that cut the piece
    and ``nth`` its number among that task's pieces of the same length. Rows with the same id, or the same row twice, are
    different documents, each with pieces of its own.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, end).encode
        part, used = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for batch in batches:
            ids_of = batch.column(0)
            for first, ids, counts in encode(batch.column(1).fill_null("").to_pylist()):
                ends = np.cumsum(counts)
                n = -(-counts // window)
                of = np.repeat(np.arange(len(counts)), n)
                start = (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * window
                length = np.minimum(counts[of] - start, window)
                at = (ends - counts)[of] + start
                offsets = pa.py_buffer((4 * np.concatenate((at, ends[-1:]))).astype(np.int32))
                packed = pa.Array.from_buffers(pa.binary(), len(of), [None, offsets, pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [ids_of.slice(first, len(counts)).cast(pa.int64()).take(pa.array(of)), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(counts[of], pa.int64()), pa.array(np.full(len(of), part), pa.int32()),
                     pa.array(numbered(length, used), pa.int64()), packed],
                    names=["doc_id", "start", "length", "doc_tokens", "part", "nth", "ids"],
                )

    columns = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return columns.mapInArrow(pieces, PIECE)


def numbered(length: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Numbers equal lengths one after the other, from ``used`` on, which moves on by them."""
    order = np.argsort(length, kind="stable")
    sizes = np.bincount(length, minlength=len(used))
    nth = np.empty(len(length), np.int64)
    nth[order] = np.arange(len(length)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    nth += used[length]
    used += sizes
    return nth


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and how many of each (at most ``counts``) that fill ``room`` as far as can be."""
    reach, steps, full = 1, [], 1 << room
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reach & full:
            take = min(take, left)
            new = (reach | reach << (length * take)) & ((full << 1) - 1)
            steps.append((length, take, reach))
            reach, left, take = new, left - take, take * 2
        if reach & full:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Fillings and how often each is used, until every rest has a place."""
    left, made = {x: n for x, n in counts.items() if n}, []
    lengths = sorted(left)
    while left:
        longest = lengths[-1]
        left[longest] -= 1
        chosen = fill({x: n for x, n in left.items() if n}, window - longest) if longest < window else {}
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[x] // k for x, k in chosen.items())
        made.append((chosen, times))
        for x, k in chosen.items():
            left[x] -= k * times
            if not left[x]:
                del left[x]
                lengths.pop(bisect_right(lengths, x) - 1)
    return made


def places(made: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """(length, first rank, per window, first window, offset), sorted: where ranks of a length go."""
    used: dict[int, int] = {}
    rows, first_window = [], 0
    for chosen, times in made:
        offset = 0
        for length in sorted(chosen, reverse=True):
            k = chosen[length]
            rows.append((length, used.get(length, 0), k, first_window, offset))
            used[length] = used.get(length, 0) + k * times
            offset += k * length
        first_window += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(pieces: DataFrame, window: int) -> DataFrame:
    """Adds sequence_id and offset to stored pieces.

    A piece's rank among all of its length is its number in its part plus the pieces of that length in earlier parts. So
    only counts by part and length are ranked, one row each, and no length is ever gathered in one task. The ids themselves
    move only where these counts are too many to be sent to every task: Spark decides by their measured size.
    """
    parts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(parts.select("part", "length", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")), "starts")
    counts = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one per length
    fillings = _by_length(pieces.sparkSession, places(plan(counts, window)))
    ranked = pieces.join(starts.select("part", "length", "first"), ["part", "length"]).join(F.broadcast(fillings), "length")
    rank = F.col("first") + F.col("nth")
    # The last entry of the length that begins at this rank or before it.
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(window.bit_length()))])
    entry = F.aggregate(
        halves, F.lit(0), lambda low, half: low + F.when(F.get("entries", low + half)["rank"] <= rank, half).otherwise(0)
    )
    found = ranked.withColumn("_at", F.get("entries", entry)).withColumn("_ahead", rank - F.col("_at.rank"))
    return found.select(
        "doc_id", "start", "length", "doc_tokens", "ids",
        (F.col("_at.sequence") + F.expr("_ahead DIV _at.each")).alias("sequence_id"),
        (F.col("_at.offset") + F.col("_ahead") % F.col("_at.each") * F.col("length")).alias("offset"),
    )


def _by_length(spark: SparkSession, table: np.ndarray) -> DataFrame:
    """The places as one row per length, at most as many as a window has tokens, with its entries by rank."""
    rows: dict[int, list[tuple]] = {}
    for length, *entry in table.tolist():
        rows.setdefault(length, []).append(tuple(entry))
    return spark.createDataFrame(
        [*rows.items()], "length long, entries array<struct<rank: long, each: long, sequence: long, offset: long>>"
    )


def pack(docs: DataFrame, vocabulary: str, end: int, window: int = 4096, **columns: str) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset): the pieces with their ids and places.

    Repeated rows are packed as often as they occur; an empty table gives no rows.
    """
    return place(stage(cut(docs, vocabulary, end, window, **columns), "pieces"), window)


def with_checksums(packed: DataFrame) -> DataFrame:
    """Adds ids_crc32, taken from the packed ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids"))
