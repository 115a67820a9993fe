"""Near-duplicates by SimHash fingerprints that differ in two bits at most.

Equal fingerprints are folded first. The 64 bits are cut into six blocks; two fingerprints within two bits
agree on at least four of them, so every pair to find shares one of fifteen masked bit patterns. A pattern
leaves at most 22 bits free: no group of different fingerprints under it can outgrow one task, however many
documents there are. Inside a group the free bits, sorted by Gray rank, become an index whose upper nodes
hold the bits that all fingerprints below share. Two nodes whose shared bits already differ in more than two
places are pruned with everything below them; what is left is linked by a forest, never by all its pairs.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import connected_components
from tidemark.llm.staging import stage
from tidemark.llm.words import texts, words

SHINGLE = 3
SEED = 42
MAX_BITS = 2
LEAF = 16

_CUTS = (0, 11, 22, 33, 44, 54, 64)
_BLOCKS = [sum(1 << bit for bit in range(a, b)) for a, b in itertools.pairwise(_CUTS)]


def patterns(max_bits: int = MAX_BITS) -> np.ndarray:
    """Masks of the bits a pattern shares: all blocks but as many as bits may differ (five at most)."""
    return np.array([sum(_BLOCKS) - sum(out) for out in itertools.combinations(_BLOCKS, max_bits)], dtype=np.uint64)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Bits set in more than half of the XXH64 values of the shingles of the lower-cased (A-Z) words."""
    w = words(text.lower())
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[i:j], SEED) for i, j in zip(starts.tolist(), ends[size - 1:].tolist())], dtype="<u8"
    )
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        piece = hashes[part:part + (1 << 16)]
        ones += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: str, shingle: int = SHINGLE) -> Column:
    @F.arrow_udf(T.LongType())
    def found(column: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, shingle) for t in texts(column)], dtype=np.uint64).view(np.int64), pa.int64())

    return found(text)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence: neighbours there differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def links_within(codes: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """A forest over the links of different ``codes``: pairs of places, at most one fewer than codes.

    The index is a binary tree over the codes in Gray order. A node knows the bits that all its codes share
    and their values; the search goes down pairs of nodes and adds up differences in bits both sides share.
    """
    order = np.argsort(gray_rank(codes), kind="stable")
    sorted_codes = codes[order]
    parent = list(range(len(codes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []

    def link(i: int, j: int) -> None:
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            found.append((int(order[i]), int(order[j])))

    ends: dict[tuple[int, int], tuple[int, int]] = {}

    def bits(lo: int, hi: int) -> tuple[int, int]:
        """(bits set in all codes of the node, bits set in any)."""
        if (lo, hi) not in ends:
            part = sorted_codes[lo:hi]
            ends[lo, hi] = int(np.bitwise_and.reduce(part)), int(np.bitwise_or.reduce(part))
        return ends[lo, hi]

    def together(lo: int, hi: int) -> bool:
        """Whether one tree of the forest holds all codes of a node; then its inner pairs add nothing."""
        first = root(lo)
        return all(root(i) == first for i in range(lo + 1, hi))

    stack = [(0, len(codes), 0, len(codes))]
    while stack:
        a, b, c, d = stack.pop()
        all_left, any_left = bits(a, b)
        all_right, any_right = bits(c, d)
        # Bits that every code left has and none right, or the other way round.
        if ((all_left & ~any_right) | (all_right & ~any_left)).bit_count() > max_bits:
            continue
        if b - a <= LEAF and d - c <= LEAF:
            if root(a) == root(c) and together(a, b) and together(c, d):
                continue
            near = np.bitwise_count(sorted_codes[a:b, None] ^ sorted_codes[None, c:d]) <= max_bits
            for i, j in zip(*np.nonzero(near)):
                if a + i < c + j:
                    link(a + int(i), c + int(j))
            continue
        left = [(a, b)] if b - a <= LEAF else [(a, (a + b) // 2), ((a + b) // 2, b)]
        right = [(c, d)] if d - c <= LEAF else [(c, (c + d) // 2), ((c + d) // 2, d)]
        # Pushed last, searched first: nodes against themselves link near codes before far nodes meet.
        stack.extend(
            (*x, *y) for x, y in sorted(itertools.product(left, right), key=lambda p: p[0] == p[1]) if x <= y
        )
    return found


def _linked(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links inside each run of rows with the same pattern; rows come sorted by pattern."""
    masks = patterns(max_bits)
    held: tuple | None = None

    def emit(mask_no: np.ndarray, codes: np.ndarray) -> tuple[list[int], list[int]]:
        a, b = [], []
        shared = codes & masks[mask_no]
        cut = np.flatnonzero((np.diff(mask_no) != 0) | (np.diff(shared) != 0)) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(codes)]))
        for lo, hi in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            group = codes[lo:hi]
            for i, j in links_within(group, max_bits):
                a.append(int(group[i].astype(np.int64)))
                b.append(int(group[j].astype(np.int64)))
        return a, b

    def batch(pairs: tuple[list[int], list[int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in pairs], names=["a", "b"])

    for piece in batches:
        mask_no = piece.column("pattern").to_numpy(zero_copy_only=False).astype(np.int64)
        codes = piece.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        if held is not None:
            mask_no, codes = np.concatenate((held[0], mask_no)), np.concatenate((held[1], codes))
        if not len(codes):
            continue
        # The last group may go on in the next batch.
        shared = codes & masks[mask_no]
        last = (mask_no == mask_no[-1]) & (shared == shared[-1])
        keep = len(codes) - int(np.argmin(last[::-1])) if not last.all() else 0
        held = mask_no[keep:], codes[keep:]
        if keep:
            yield batch(emit(mask_no[:keep], codes[:keep]))
    if held is not None:
        yield batch(emit(*held))


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that join all fingerprints of ``distinct`` (fp) which a chain of near pairs joins."""
    masks = F.array(*[F.lit(int(m.astype(np.int64))) for m in patterns(max_bits)])
    spread = distinct.select("fp", F.posexplode(masks).alias("pattern", "mask")).select(
        "fp", "pattern", F.col("fp").bitwiseAND(F.col("mask")).alias("shared")
    )
    return (
        spread.repartition("pattern", "shared")
        .sortWithinPartitions("pattern", "shared")
        .mapInArrow(lambda batches: _linked(batches, max_bits), "a long, b long")
    )


def fingerprinted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row, written once; null and empty texts have fingerprint 0."""
    return stage(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(text, shingle).alias("fp")), "fingerprints")


def groups(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, group) of every fingerprint of ``marked``: the least fingerprint, as a long, that near pairs lead to."""
    each = marked.select("fp").distinct()
    nodes = connected_components(fingerprint_links(each, max_bits)).select(F.col("node").alias("fp"), "component")
    return each.join(nodes, "fp", "left").select("fp", F.coalesce("component", "fp").alias("group"))


def near_duplicates(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Adds component_id to (doc_id, fp): the least doc_id that near pairs lead to, its own included.

    Rows of a group whose ids are all null get null.
    """
    of = stage(groups(marked, max_bits), "groups")
    folded = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = folded.join(of, "fp").groupBy("group").agg(F.min("least").alias("component_id"))
    # Written out, so that both sides of the join with the rows are plain and a hot fingerprint can be split.
    named = stage(of.join(least, "group").select("fp", "component_id"), "components")
    return marked.join(named, "fp")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one row left of each group of near-duplicates: the one with the least id.

    Rows without an id come last; of rows with the same id any one stays.
    """
    rows = stage(
        docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("n"),
                    fingerprints(text, shingle).alias("fp")),
        "fingerprinted",
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "n")
    # The best row of each fingerprint first, then of each group: no group of rows meets in one place.
    folded = rows.groupBy("fp").agg(F.min(order).alias("best"))
    kept = folded.join(groups(rows, max_bits), "fp").groupBy("group").agg(F.min("best").alias("best")).select(F.col("best.n").alias("n"))
    return rows.join(kept, "n", "left_semi").select("row.*")
