"""Byte passages that occur twice: every 200 bytes that also start elsewhere, by a column-wise built suffix order.

Which bytes can matter is found by sampling no repeated passage can escape: of the 64-byte substrings in each
window of 200 bytes the one with the least hash is its anchor, so equal windows have equal anchors. Neighbouring
windows with one anchor make a segment. Equal segments are folded; a segment whose anchor occurs once is left out, one
that occurs twice as a whole is repeated as a whole. The different segments of an anchor are compared by construction of the
suffix order of the whole collection, column by column from the right: every round puts one more symbol before each
suffix, finds its place from the ranks of that symbol in the Burrows-Wheeler transform, and inserts it there together with
the common prefixes of its neighbours, in one sequential pass over the transform and over the prefix lengths. What has a common prefix of
200 bytes in the end is repeated. Segments are aligned at their anchors, so equal windows arrive in the same round, and a
segment none of whose windows can reach 200 any more stops early; what no other segment of the anchor can reach is
cut off before. The two sequences are rewritten in order, as files are,
but stay in memory: a collection holds whole anchors and about ``COLLECTION`` bytes.

An anchor with more than ``KINDS`` different segments is split further, without a limit: its windows are cut into runs of
16 around the anchor's place and dealt by the 185 bytes that all windows of such a run share.

Rows with the same id and text are occurrences of their own, and get the same result.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.passages import DOC, keyed
from tidemark.llm.staging import stage
from tidemark.llm.words import texts

WINDOW = 200
ANCHOR = 64
#: Anchors to choose from in a window, and windows in a segment at most.
CHOICE = WINDOW - ANCHOR + 1
KINDS = 512
QUARTER = 35
RUN = 16
CORE = WINDOW - RUN + 1
COLLECTION = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
SEGMENT = "anchor long, digest long, id long, version long, start int, windows int, place int, tie boolean"
STRING = "key long, body binary, weight long, windows int, place int, aligned boolean, id long, version long, start int"
FOUND = "id long, version long, start int, windows int"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def anchor_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the 64 bytes from each place on, put together from halves."""
    h, factor, n = _mixed(raw.astype(np.uint64) + np.uint64(1)), 0xBF58476D1CE4E5B9, 1
    while n < ANCHOR:
        h = h[:-n] * np.uint64(factor) + h[n:]
        factor, n = factor * factor % (1 << 64), 2 * n
    return _mixed(h)


def _sliding(values: np.ndarray, size: int, of: np.ufunc) -> np.ndarray:
    """Least or greatest of every ``size`` neighbours, from spans that double."""
    n = 1
    while 2 * n <= size:
        values = of(values[:-n], values[n:])
        n *= 2
    rest = size - n
    return of(values[:len(values) - rest], values[rest:]) if rest else values


def segments_of(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, start, windows, place of the anchor in the segment, tie) of a text's segments.

    A tie is an anchor that the text holds more than once: the segment may repeat itself.
    """
    if len(raw) < WINDOW:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, np.zeros(0, bool)
    h = anchor_hashes(raw)
    least = _sliding(h, CHOICE, np.minimum)
    start = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    size = np.diff(start, append=len(least))
    if size.max() > CHOICE:
        parts = -(-size // CHOICE)
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(start, parts) + nth * CHOICE
        size = np.minimum(CHOICE, np.repeat(size, parts) - nth * CHOICE)
    anchor = least[start]
    pad = np.zeros(CHOICE - 1, np.uint64)
    at = np.flatnonzero(h == _sliding(np.concatenate((pad, least, pad)), CHOICE, np.maximum))
    order = np.argsort(h[at], kind="stable")
    values = h[at][order]
    first = np.searchsorted(values, anchor)
    tie = np.searchsorted(values, anchor, side="right") - first > 1
    return anchor, start, size, at[order[first]] - start, tie


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, digests, sizes = [], [], []
        for text in texts(batch.column(2)):
            parts = segments_of(np.frombuffer(text, np.uint8))
            found.append(parts)
            sizes.append(len(parts[0]))
            digests += [
                xxhash.xxh64_intdigest(text[a:a + n + WINDOW - 1]) for a, n in zip(parts[1].tolist(), parts[2].tolist())
            ]
        take = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        anchor, start, windows, place, tie = (np.concatenate(x) if found else np.zeros(0) for x in zip(*found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor.view(np.int64)), pa.array(np.array(digests, np.uint64).view(np.int64)),
             batch.column(0).take(take), batch.column(1).take(take), pa.array(start, pa.int32()), pa.array(windows, pa.int32()),
             pa.array(place, pa.int32()), pa.array(tie)],
            names=["anchor", "digest", *DOC, "start", "windows", "place", "tie"],
        )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of chosen segments. A row that follows its like (same id and text) has nothing new to give."""
    before = None
    for batch in batches:
        chosen = batch.column(3)
        bodies, keep, of = [], [], []
        offsets = chosen.offsets.to_pylist()
        starts, windows = (chosen.values.field(name).to_pylist() for name in ("start", "windows"))
        for i, (doc, text) in enumerate(zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), texts(batch.column(2)))):
            if doc == before:
                continue
            before = doc
            for j in range(offsets[i], offsets[i + 1]):
                bodies.append(text[starts[j]:starts[j] + windows[j] + WINDOW - 1])
                keep.append(j)
                of.append(i)
        rows, take = chosen.values.take(pa.array(keep, pa.int64())), pa.array(of, pa.int64())
        column = {name: rows.field(name) for name in ("key", "weight", "windows", "place", "aligned", "start", "hot")}
        yield pa.RecordBatch.from_arrays(
            [column["key"], pa.array(bodies, pa.binary()), column["weight"], column["windows"], column["place"], column["aligned"],
             batch.column(0).take(take), batch.column(1).take(take), column["start"], column["hot"]],
            names=["key", "body", "weight", "windows", "place", "aligned", *DOC, "start", "hot"],
        )


def runs_around_anchor(body: bytes, windows: int) -> list[tuple[int, int, int, bytes]]:
    """(first window, windows, place of the anchor, shared bytes) of runs of at most 16 windows of a segment.

    A window's anchor is the first of its least hashes; a run holds neighbours with one anchor and one sixteenth of places.
    """
    h = anchor_hashes(np.frombuffer(body, np.uint8))
    at = np.arange(windows) + np.lib.stride_tricks.sliding_window_view(h, CHOICE)[:windows].argmin(axis=1)
    block = (at - np.arange(windows)) // RUN
    begins = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (block[1:] != block[:-1]))))
    out = []
    for a, n in zip(begins.tolist(), np.diff(begins, append=windows).tolist()):
        p, b = int(at[a]), int(block[a])
        core = p - b * RUN
        out.append((a, n, p - a, bytes([b]) + body[core:core + CORE]))
    return out


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        column = {name: batch.column(names.index(name)).to_pylist() for name in ("body", "weight", "windows", "id", "version", "start")}
        out: list[tuple] = []
        for body, weight, windows, doc, version, start in zip(*column.values()):
            for first, n, place, core in runs_around_anchor(body, windows):
                part = body[first:first + n + WINDOW - 1]
                digest, key = xxhash.xxh64_intdigest(part), xxhash.xxh64_intdigest(core, 1)
                out.append((key - (key >> 63 << 64), part, weight, n, place, True, doc, version, start + first, digest - (digest >> 63 << 64)))
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
            names=["key", "body", "weight", "windows", "place", "aligned", *DOC, "start", "digest"],
        )


class Collection:
    """Suffix order of many strings, built one symbol per string and round.

    ``transform`` holds the symbol before each suffix in order (0: none, or no more), ``common`` how many bytes each
    suffix shares with the one before it, up to a window's length. The first rows are the strings' empty suffixes.
    """

    def __init__(self, strings: list[bytes], windows: np.ndarray, place: np.ndarray, aligned: np.ndarray):
        self.size = np.array([len(s) for s in strings], np.int64)
        raw = np.frombuffer(b"".join(strings), np.uint8)
        self.kind = np.uint8 if not len(raw) or raw.max() < 255 else np.uint16
        self.raw = raw.astype(self.kind) + self.kind(1)
        self.ends = np.cumsum(self.size)
        self.windows, self.aligned = windows, aligned
        # Bytes from the anchor to the end; the string with most of them starts first.
        behind = self.size - place
        self.delay = np.where(aligned, behind.max(initial=0, where=aligned) - behind, 0)
        self.many = len(strings)
        self.transform = np.zeros(self.many, self.kind)
        self.common = np.zeros(self.many, np.uint8)
        self._build()

    def _symbols(self, of: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The symbol before the suffix of the given length; 0 before a whole string."""
        at = np.maximum(self.ends[of] - 1 - length, 0)
        return np.where(length < self.size[of], self.raw[at] if len(self.raw) else 0, 0).astype(self.kind)

    def _build(self) -> None:
        rows = np.zeros(0, np.int64)       # where the last suffixes are, in order
        of = np.zeros(0, np.int64)         # and whose they are
        turn = np.argsort(self.delay, kind="stable")
        starts = self.delay[turn]
        waiting = 0
        now = 0
        while waiting < self.many or len(rows):
            to = int(np.searchsorted(starts, now, side="right"))
            if to > waiting:
                fresh = np.sort(turn[waiting:to])
                waiting = to
                self.transform[fresh] = self._symbols(fresh, np.zeros(len(fresh), np.int64))
                rows, of = np.concatenate((fresh, rows)), np.concatenate((fresh, of))
            more = self.transform[rows] > 0
            rows, of = rows[more], of[more]
            now += 1
            if len(rows):
                rows, of = self._insert(rows, of, now)

    def _insert(self, rows: np.ndarray, of: np.ndarray, now: int) -> tuple[np.ndarray, np.ndarray]:
        """One round: the suffixes that begin with the symbols at ``rows`` (ascending)."""
        n = len(self.transform)
        order = np.argsort(self.transform, kind="stable")
        marked = np.zeros(n, bool)
        marked[rows] = True
        rank = np.flatnonzero(marked[order])
        came = order[rank]
        of = of[np.searchsorted(rows, came)]
        stopped = n - int(np.count_nonzero(self.transform))
        to = self.many + rank - stopped
        # Common prefixes with the neighbours of the same first symbol: one more than the least between the places
        # the two came from.
        sorted_symbols = self.transform[order[rank]]
        before, behind = np.maximum(rank - 1, 0), np.minimum(rank + 1, n - 1)
        has_before = (rank > 0) & (self.transform[order[before]] == sorted_symbols)
        has_behind = (rank + 1 < n) & (self.transform[order[behind]] == sorted_symbols)
        low = np.concatenate((order[before[has_before]], came[has_behind])) + 1
        high = np.concatenate((came[has_before], order[behind[has_behind]])) + 1
        least = self._least(low, high)
        k = int(has_before.sum())
        new = np.zeros(len(rank), np.uint8)
        new[has_before] = least[:k]
        length = self._length(of, now)
        transform, common = np.empty(n + len(rank), self.kind), np.empty(n + len(rank), np.uint8)
        kept = np.ones(n + len(rank), bool)
        kept[to] = False
        transform[kept], common[kept] = self.transform, self.common
        common[to] = new
        follower = to[has_behind] + 1
        old = kept[follower]
        common[follower[old]] = least[k:][old]
        # A string stops where even its longest suffix cannot share a window any more.
        best = np.maximum(new, np.where(to + 1 < len(common), common[np.minimum(to + 1, len(common) - 1)], 0))
        hopeless = self.aligned[of] & (best < length - self.windows[of] + 1)
        transform[to] = np.where(hopeless, 0, self._symbols(of, length))
        self.transform, self.common = transform, common
        return to, of

    def _length(self, of: np.ndarray, now: int) -> np.ndarray:
        return now - self.delay[of]

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """1 + the least common prefix in rows low..high-1, up to a window's length."""
        if not len(low):
            return np.zeros(0, np.uint8)
        order = np.argsort(low, kind="stable")
        bounds = np.empty(2 * len(low), np.int64)
        bounds[::2], bounds[1::2] = low[order], high[order]
        found = np.minimum.reduceat(np.append(self.common, 0), bounds)[::2]
        out = np.empty(len(low), np.uint8)
        out[order] = np.minimum(found, WINDOW - 1) + 1
        return out

    def repeated(self) -> list[np.ndarray]:
        """For each string, which of its windows share all their bytes with another suffix."""
        n = len(self.transform)
        again = self.common >= WINDOW
        again[:-1] |= self.common[1:] >= WINDOW
        order = np.argsort(self.transform, kind="stable")
        stopped = n - int(np.count_nonzero(self.transform))
        ahead = np.empty(n, np.int64)
        ahead[order] = np.arange(n) + self.many - stopped
        out = [np.zeros(w, bool) for w in self.windows.tolist()]
        flat = np.zeros(int(self.windows.sum()), bool)
        base = np.cumsum(self.windows) - self.windows
        row, of, length = np.arange(self.many), np.arange(self.many), 0
        while len(row):
            if length >= WINDOW:
                flat[base[of] + self.size[of] - length] = again[row]
            more = self.transform[row] > 0
            row, of = ahead[row[more]], of[more]
            length += 1
        ends = np.cumsum(self.windows)
        for i, (a, b) in enumerate(zip(base.tolist(), ends.tolist())):
            out[i] = flat[a:b]
        return out


def narrowed(group: list[tuple]) -> list[tuple]:
    """Rows (body, weight, windows, place, aligned, id, version, start) of one anchor, cut to the windows that may recur.

    All windows of a quarter, by the anchor's place in them, share the bytes in their middle; a quarter stays where another
    string has the same ones, and one of them occurs once.
    """
    if not group[0][4]:
        return group
    middles: dict[tuple[int, bytes], list[int]] = {}
    for i, (body, _, windows, place, *_) in enumerate(group):
        for q in range((place - windows + 1) // QUARTER, place // QUARTER + 1):
            at = place - q * QUARTER
            middles.setdefault((q, body[at:at + WINDOW - QUARTER + 1]), []).append(i)
    kept: list[set[int]] = [set() for _ in group]
    for (q, _), of in middles.items():
        if len(of) > 1 and any(group[i][1] == 1 for i in of):
            for i in of:
                kept[i].add(q)
    out = []
    for (body, weight, windows, place, aligned, doc, version, start), quarters in zip(group, kept):
        while quarters:
            low = high = min(quarters)
            while high + 1 in quarters:
                high += 1
            quarters -= set(range(low, high + 1))
            first, last = max(0, place - (high + 1) * QUARTER + 1), min(windows - 1, place - low * QUARTER)
            part = body[first:last + WINDOW]
            out.append((part, weight, last - first + 1, place - first, aligned, doc, version, start + first))
    return out


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; collections are cut between keys. Only strings that occur once are reported."""
    names = ["key", "body", "weight", "windows", "place", "aligned", *DOC, "start"]
    held: list[tuple] = []
    group: list[tuple] = []
    key, size = None, 0

    def found() -> pa.RecordBatch:
        body, weight, windows, place, aligned, ids, versions, starts = zip(*held)
        again = Collection(list(body), np.array(windows), np.array(place), np.array(aligned)).repeated()
        rows: list[tuple] = []
        for i, flags in enumerate(again):
            if weight[i] == 1 and flags.any():
                edges = np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))
                for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
                    rows.append((ids[i], versions[i], starts[i] + a, b - a))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[*DOC, "start", "windows"])

    for batch in batches:
        for row in zip(*(batch.column(batch.schema.names.index(name)).to_pylist() for name in names)):
            if row[0] != key and group:
                held += (more := narrowed(group))
                size += sum(len(r[0]) for r in more)
                group.clear()
                if size >= COLLECTION:
                    yield found()
                    held.clear()
                    size = 0
            key = row[0]
            group.append(row[1:])
    held += narrowed(group) if group else []
    if held:
        yield found()


def repeats(docs: DataFrame) -> DataFrame:
    """(id, version, found): the runs of windows (start, windows) of each document that start elsewhere too."""
    each = stage(docs.select(*DOC, "text").mapInArrow(_segments, SEGMENT), "byte-segments")
    # Folded first: a segment that a third of all documents hold is one row per task.
    folded = stage(
        each.groupBy("anchor", "digest").agg(
            F.count(F.lit(1)).alias("weight"), F.max("tie").alias("tie"),
            *(F.first(c).alias(c) for c in (*DOC, "start", "windows", "place")),  # of one row; any will do
        ),
        "byte-segments-folded",
    )
    anchors = stage(
        folded.groupBy("anchor").agg(
            F.sum("weight").alias("n"), F.count(F.lit(1)).alias("kinds"), F.max("tie").alias("tie"), F.count_if(F.col("weight") == 1).alias("single")
        ).where("single > 0 and (n > 1 or tie)"),
        "byte-anchors",
    )
    twice = stage(folded.where("weight > 1").select("anchor", "digest"), "byte-segments-twice")
    whole = each.join(twice, ["anchor", "digest"]).select(*DOC, "start", "windows")

    compared = folded.drop("tie").join(anchors.select("anchor", "kinds", "tie"), "anchor")
    of_doc = compared.groupBy(*DOC).agg(F.collect_list(F.struct(
        F.col("anchor").alias("key"), "weight", "start", "windows", "place", (~F.col("tie")).alias("aligned"),
        (F.col("kinds") > KINDS).alias("hot"),
    )).alias("chosen"))
    strings = stage(
        docs.join(stage(of_doc, "byte-segments-chosen"), DOC).select(*DOC, "text", "chosen").mapInArrow(_strings, f"{STRING}, hot boolean"),
        "byte-strings",
    )
    parts = stage(strings.where("hot").mapInArrow(_split, f"{STRING}, digest long"), "byte-string-parts")
    same = stage(
        parts.groupBy("key", "digest").agg(
            F.sum("weight").alias("weight"), F.any_value("body").alias("body"), F.min(F.struct("windows", "place", "aligned", *DOC, "start")).alias("first")
        ).select("key", "digest", "body", "weight", "first.*"),
        "byte-parts-folded",
    )
    keys = stage(
        same.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("weight") == 1).alias("single"))
        .where("kinds > 1 and single > 0").select("key"),
        "byte-part-keys",
    )
    twice_parts = stage(same.where("weight > 1").select("key", "digest"), "byte-parts-twice")
    whole_parts = parts.where("weight = 1").join(twice_parts, ["key", "digest"]).select(*DOC, "start", "windows")

    names = [f.split()[0] for f in STRING.split(", ")]
    rows = strings.where("not hot").select(*names).unionByName(same.join(keys, "key", "left_semi").select(*names))
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_compared, FOUND)
    every = stage(found, "byte-repeats").unionAll(whole).unionAll(whole_parts)
    # A set: equal rows of one id and text find the same runs.
    return every.groupBy(*DOC).agg(F.collect_set(F.struct("start", "windows")).alias("found"))


def spans(size: int, starts: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of bytes that the windows cover, in a text of ``size`` bytes."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + windows + WINDOW - 1, -1)
    covered = np.diff(np.concatenate(([0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0])))
    return np.flatnonzero(covered == 1), np.flatnonzero(covered == -1)


def spanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, starts, ends) of every row: where it repeats bytes, in bytes; empty lists for most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends = [], []
            for size, found in zip(batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist(), batch.column(2).to_pylist()):
                at = np.array([(f["start"], f["windows"]) for f in found or ()], np.int64).reshape(-1, 2)
                a, b = spans(len(size), at[:, 0], at[:, 1]) if len(at) else (at[:, 0], at[:, 0])
                starts.append(a)
                ends.append(b)
            lists = [pa.array([x.tolist() for x in c], pa.list_(pa.int64())) for c in (starts, ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["doc_id", "text", "starts", "ends"])

    rows = keyed(docs, doc_id, text)
    joined = rows.join(stage(repeats(rows), "byte-spans"), DOC, "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "found")
    return joined.mapInArrow(run, "doc_id long, text string, starts array<long>, ends array<long>")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, runs, digests = [], [], [], []
        for text, starts, ends in zip(texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            kept, at = hashlib.sha256(), 0
            for a, b in zip(starts, ends):
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            sizes.append(len(text))
            removed.append(sum(ends) - sum(starts))
            runs.append(len(starts))
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, removed, runs)), pa.array(digests, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; null texts count as empty, null ids stay."""
    return spanned(docs, doc_id, text).mapInArrow(_digested, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
