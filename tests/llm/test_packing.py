"""Packing: the filling against all multisets, the plan and the places against the tokenizer."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing as P


@pytest.mark.parametrize("seed", range(40))
def test_filling_is_the_closest(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(0, 5))}
    room = rng.randint(0, 60)
    chosen = P.fill(counts, room)
    assert all(0 < k <= counts[x] for x, k in chosen.items())
    best = max(
        (total for take in itertools.product(*(range(n + 1) for n in counts.values()))
         if (total := sum(k * x for k, x in zip(take, counts))) <= room), default=0,
    )
    assert sum(k * x for x, k in chosen.items()) == best


def test_plan_places_every_rest():
    rng = random.Random(4)
    counts = {rng.randint(1, 4096): rng.randint(1, 50) for _ in range(600)} | {4096: 100_000, 7: 3_000_000}
    made = P.plan(counts, 4096)
    used = defaultdict(int)
    for chosen, times in made:
        assert sum(x * k for x, k in chosen.items()) <= 4096
        for x, k in chosen.items():
            used[x] += k * times
    assert used == counts and len(made) < 2000
    ideal = sum(x * n for x, n in counts.items()) / 4096
    assert sum(times for _, times in made) <= 1.001 * ideal + 1


def test_pieces(spark, documents, nothing):
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(vocabulary)
    got = P.with_checksums(P.pack(documents, vocabulary, 2, window=128)).collect()
    want = defaultdict(int)
    for doc_id, text in documents.select("doc_id", "text").collect():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for start in range(0, len(ids), 128):
            piece = ids[start:start + 128]
            want[doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    held = defaultdict(int)
    of = defaultdict(list)
    for r in got:
        held[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        of[r.sequence_id].append((r.offset, r.length))
    assert held == want
    for pieces in of.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= 128
    assert sorted(of) == list(range(len(of)))
    assert P.pack(nothing, vocabulary, 2).isEmpty()


def test_numbers_go_on_from_batch_to_batch():
    rng = random.Random(3)
    used, seen = np.zeros(21, np.int64), defaultdict(int)
    for _ in range(5):
        length = np.array([rng.randint(1, 20) for _ in range(rng.randint(0, 60))], np.int64)
        want = []
        for x in length.tolist():
            want.append(seen[x])
            seen[x] += 1
        assert P.numbered(length, used).tolist() == want
    assert {x: n for x, n in enumerate(used.tolist()) if n} == dict(seen)


def test_repeated_rows_of_one_length(spark):
    """A third of all rows alike: they are numbered in every task, and each gets its own place."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.range(3000).selectExpr("id % 7 as doc_id", "if(id % 3 = 0, 'one two', concat('w', id, ' three')) as text").repartition(6)
    got = P.pack(docs, vocabulary, 2, window=64).collect()
    assert len(got) == 3000 and len({(r.sequence_id, r.offset) for r in got}) == 3000
