"""Removal of passages that occur earlier: every window of 20 words whose words also start earlier is cut.

Recurring phrases are found by sampling that no repeated window can escape: of the 8-word phrases in each
window the one with the least hash is its anchor, so equal windows have equal anchors. Where an anchor
occurs more than once, the words of its windows (a segment) are kept; equal segments are folded, windows of the
rest are counted, and those that recur are confirmed. Confirmed windows are compiled into Aho-Corasick automata,
sharded by anchor, and all segments that can hold them are streamed through to locate every occurrence. So
each automaton reads only text with an anchor of its own, not the whole corpus.

Documents are ordered by id, null ids first. Rows with the same id and different texts are different
documents, ordered by a hash of the text; rows with the same id and text are one document and get the same
result. Texts of fewer than 20 words, empty and null ones lose nothing.
"""

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.staging import release, stage
from tidemark.llm.words import texts, words

WINDOW = 20
PHRASE = 8
#: Windows compiled into one automaton, and segments streamed through it by one task, before it is split.
PATTERNS = 20_000
STREAMED = 100_000

_NO_ID = -(1 << 63)
_FACTORS = np.random.default_rng(1).integers(1, 1 << 63, PHRASE, dtype=np.uint64) | np.uint64(1)
DOC = ["id", "version"]


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str | None = None) -> DataFrame:
    """(doc_id, text) with the key that orders documents, and the column ``keep``."""
    return docs.select(
        *([keep] if keep else []),
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("version"),
    )


def _phrases(w: list[bytes]) -> np.ndarray:
    """Hash of the phrase that starts at each word; well mixed, since the least one is the anchor."""
    of = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    n = len(w) - PHRASE + 1
    mixed = np.zeros(n, np.uint64)
    for i, factor in enumerate(_FACTORS):
        mixed += of[i:i + n] * factor
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def anchors(w: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(place of each window's anchor, phrase hashes). Of equal least phrases the first is the anchor."""
    if len(w) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = _phrases(w)
    inside = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW - PHRASE + 1)
    return np.arange(len(inside)) + inside.argmin(axis=1), hashes


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values])))
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, phrases = [], []
        for text in texts(batch.column(2)):
            of, hashes = anchors(words(text))
            at = of[np.concatenate(([True], of[1:] != of[:-1]))] if len(of) else of
            places.append(at)
            phrases.append(hashes[at].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), _lists(places, pa.int32()), _lists(phrases, pa.int64())],
            names=[*DOC, "places", "phrases"],
        )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per recurring anchor of a document: the words of all windows that have it as their anchor."""
    for batch in batches:
        ids, versions = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out: tuple[list, ...] = ([], [], [], [], [], [], [])
        for doc, version, text, places in zip(ids, versions, texts(batch.column(2)), batch.column(3).to_pylist()):
            w = words(text)
            of, hashes = anchors(w)
            joined = b" ".join(w)
            ends = (np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1).tolist()
            first = np.searchsorted(of, places, side="left").tolist()
            last = np.searchsorted(of, places, side="right").tolist()
            for place, a, b in zip(places, first, last):
                body = joined[ends[a - 1] + 1 if a else 0:ends[b + WINDOW - 2]]
                digest = xxhash.xxh64_intdigest(body, 1)
                row = (int(hashes[place].astype(np.int64)), digest - (digest >> 63 << 64), doc, version, a, b - a, body)
                for column, value in zip(out, row):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
            names=["phrase", "segment", *DOC, "start", "windows", "body"],
        )


def segments(docs: DataFrame) -> DataFrame:
    """(phrase, segment, id, version, start, windows, body) around every anchor that recurs."""
    places = stage(docs.select(*DOC, "text").mapInArrow(_anchored, "id long, version long, places array<int>, phrases array<long>"), "anchors")
    each = places.select(*DOC, F.explode(F.arrays_zip("places", "phrases")).alias("a")).select(
        *DOC, F.col("a.places").alias("place"), F.col("a.phrases").alias("phrase")
    )
    # Counted and written before it is joined, so that both sides of the join are plain and Spark may split
    # the rows of a phrase in a third of all documents.
    recurring = stage(each.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("phrase"), "recurring")
    of_doc = each.join(recurring, "phrase").groupBy(*DOC).agg(F.sort_array(F.collect_set("place")).alias("places"))
    found = stage(
        docs.join(of_doc, DOC).select(*DOC, "text", "places").mapInArrow(
            _segments, "phrase long, segment long, id long, version long, start int, windows int, body binary"
        ),
        "segments",
    )
    release(places, recurring)
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of a segment: a hash of its words and where it starts."""
    for batch in batches:
        row, place, digests = [], [], []
        for i, body in enumerate(batch.column(2).to_pylist()):
            w = words(body)
            ends = (np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1).tolist()
            starts = [0, *(e + 1 for e in ends)]
            n = len(w) - WINDOW + 1
            digests += [xxhash.xxh64_intdigest(body[starts[j]:ends[j + WINDOW - 1]]) for j in range(n)]
            row += [i] * n
            place += range(n)
        take = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.array(digests, np.uint64).view(np.int64)),
             pa.array(place, pa.int32()), *(batch.column(i).take(take) for i in (3, 4, 5))],
            names=["phrase", "segment", "digest", "place", *DOC, "start"],
        )


def confirmed(distinct: DataFrame) -> DataFrame:
    """(phrase, segment, places): windows that recur, where they occur first."""
    each = distinct.select("phrase", "segment", "body", *DOC, "start").mapInArrow(
        _counted, "phrase long, segment long, digest long, place int, id long, version long, start int"
    )
    at = F.struct(*DOC, (F.col("start") + F.col("place")).alias("at"), "segment", "place")
    return (
        each.groupBy("phrase", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first")).where("n > 1")
        .groupBy("phrase", F.col("first.segment").alias("segment")).agg(F.collect_set("first.place").alias("places"))
    )


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come shard by shard, patterns (with places) before the segments to stream."""
    shard, automaton, known, ready = None, None, {}, False
    for batch in batches:
        names = batch.schema.names
        column = {name: batch.column(names.index(name)).to_pylist() for name in names}
        out: tuple[list, list, list] = ([], [], [])
        for i, of in enumerate(zip(column["shard"], column["part"], column["share"])):
            w = words(column["body"][i])
            doc = column["id"][i], column["version"][i]
            start = column["start"][i]
            if of != shard:
                shard, known, ready = of, {}, False
                automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            if column["places"][i] is not None:
                ids = [known.setdefault(x, len(known) + 1) for x in w]
                for place in column["places"][i]:
                    automaton.add_word(tuple(ids[place:place + WINDOW]), (*doc, start + place))
                continue
            if not ready:
                automaton.make_automaton()
                ready = True
            if not len(automaton):
                continue
            ids = tuple(known.get(x, 0) for x in w)
            again = [
                end - WINDOW + 1 for end, first in automaton.iter(ids) if first < (*doc, start + end - WINDOW + 1)
            ]
            if again:
                out[0].append(column["phrase"][i])
                out[1].append(column["segment"][i])
                out[2].append(again)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32()))],
            names=["phrase", "segment", "again"],
        )


def located(distinct: DataFrame, patterns: DataFrame) -> DataFrame:
    """(phrase, segment, again): windows of each segment that occur earlier in another one or in itself.

    A shard holds the phrases of one hash value. Where it has too many patterns for one automaton they are
    split into parts, and where too many segments they are split into shares; each part meets each share.
    """
    spark = distinct.sparkSession
    n = patterns.select(F.sum(F.size("places"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // PATTERNS))
    shard = F.pmod("phrase", F.lit(shards)).alias("shard")
    # Only phrases with a pattern are streamed.
    phrases = stage(patterns.select("phrase").distinct(), "streamed-phrases")
    streamed = distinct.join(phrases, "phrase", "left_semi")
    sources = distinct.join(patterns, ["phrase", "segment"])
    rows = sources.select(shard, "phrase", "segment", *DOC, "start", "body", "places").unionByName(
        streamed.select(shard, "phrase", "segment", *DOC, "start", "body", F.lit(None).cast("array<int>").alias("places"))
    )
    rows = stage(rows, "automaton-rows")
    release(phrases)
    # One row per shard.
    sizes = rows.groupBy("shard").agg(
        F.ceil(F.sum(F.coalesce(F.size("places"), F.lit(0))) / PATTERNS).cast("int").alias("parts"),
        F.ceil(F.sum(F.col("places").isNull().cast("int")) / STREAMED).cast("int").alias("shares"),
    )
    mine = F.col("places").isNotNull()
    parts = F.when(mine, F.array(F.pmod("segment", "parts"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1).cast("array<bigint>"))
    shares = F.when(mine, F.sequence(F.lit(0), F.col("shares") - 1).cast("array<bigint>")).otherwise(F.array(F.pmod("segment", "shares")))
    dealt = (
        rows.join(sizes.where("parts > 0 and shares > 0"), "shard")
        .withColumn("part", F.explode(parts)).withColumn("share", F.explode(shares))
    )
    again = stage(
        dealt.repartition("shard", "part", "share")
        .sortWithinPartitions("shard", "part", "share", F.col("places").isNull())
        .select("shard", "part", "share", "phrase", "segment", *DOC, "start", "body", "places")
        .mapInArrow(_located, "phrase long, segment long, again array<int>")
        .groupBy("phrase", "segment").agg(F.array_distinct(F.flatten(F.collect_list("again"))).alias("again")),
        "located",
    )
    release(rows)
    return again


def repeats(docs: DataFrame) -> DataFrame:
    """(id, version, starts): in each document, the windows (by first word) that also start earlier."""
    every = segments(docs)
    where = F.struct(*DOC, "start")
    distinct = stage(
        every.groupBy("phrase", "segment").agg(F.min(where).alias("first"), F.min_by("body", where).alias("body"))
        .select("phrase", "segment", "first.*", "body"),
        "distinct-segments",
    )
    patterns = stage(confirmed(distinct), "patterns")
    again = located(distinct, patterns)
    # Written for the same reason: a segment in very many documents is one row here and very many in ``every``.
    firsts = stage(
        distinct.select("phrase", "segment", F.struct(*DOC, "start").alias("first")).join(again, ["phrase", "segment"], "left"), "firsts"
    )
    release(distinct, patterns, again)
    whole = F.sequence(F.lit(0), F.col("windows") - 1)
    return (
        every.select("phrase", "segment", *DOC, "start", "windows").join(firsts, ["phrase", "segment"])
        .withColumn("cut", F.when(where == F.col("first"), F.col("again")).otherwise(whole))
        .where("size(cut) > 0")
        .groupBy(*DOC).agg(F.sort_array(F.flatten(F.collect_list(F.transform("cut", lambda x: x + F.col("start"))))).alias("starts"))
    )


def cut(text: bytes, starts: list[int] | None) -> tuple[list[bytes], list[bytes]]:
    """(all words, words left when those of the windows at ``starts`` are removed)."""
    w = words(text)
    if not starts:
        return w, w
    removed = np.zeros(len(w) + 1, np.int64)
    np.add.at(removed, starts, 1)
    np.add.at(removed, np.asarray(starts) + WINDOW, -1)
    keep = np.cumsum(removed)[:-1] == 0
    return w, [x for x, k in zip(w, keep.tolist()) if k]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [cut(t, s) for t, s in zip(texts(batch.column(1)), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(w) for w, _ in rows], pa.int64()), pa.array([len(w) - len(k) for w, k in rows], pa.int64()),
             pa.array([hashlib.sha256(b" ".join(k)).hexdigest() for _, k in rows], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``."""
    rows = keyed(docs)
    return (
        rows.join(repeats(rows), DOC, "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "starts")
        .mapInArrow(_digests, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    )


@F.arrow_udf(T.StringType())
def _remaining(text: pa.Array, starts: pa.Array) -> pa.Array:
    return pa.array([
        b" ".join(cut(t, s)[1]).decode() if s else None for t, s in zip(texts(text), starts.to_pylist())
    ], pa.string())


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with earlier passages cut out of their texts.

    Where something is cut, the words left are joined by one space and ``n_chars`` is counted anew; other
    texts stay as they are. No row is dropped: a text that loses all its words becomes empty.
    """
    rows = keyed(docs.select(F.struct("*").alias("_row"), F.col(doc_id), F.col(text)), doc_id, text, keep="_row")
    found = rows.join(repeats(rows), DOC, "left").select("_row", _remaining("text", "starts").alias("left"))
    row, left = F.col("_row"), F.col("left")
    changed = {text: F.coalesce(left, row[text])}
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        changed[n_chars] = F.when(left.isNull(), row[n_chars]).otherwise(F.char_length(left).cast(kind))
    return found.select(*(changed.get(c, row[c]).alias(c) for c in docs.columns))
