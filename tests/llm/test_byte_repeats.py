"""Repeated bytes against a count of all windows, and the suffix order against a sort of all suffixes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import byte_repeats as B, registered


def plain(rows: list[tuple]) -> Counter:
    raw = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(hash(b[i:i + 200]) for _, b in raw for i in range(len(b) - 199))
    out: Counter = Counter()
    for doc, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[hash(b[i:i + 200])] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def collection(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    prose = lambda n, of="abcdefghij klé\x00€": "".join(rng.choice(of) for _ in range(n))
    shared = [prose(rng.randint(150, 900)) for _ in range(5)]
    line = prose(rng.choice([60, 120, 197, 203]))
    rows: list[tuple] = [(i, shared[0][:n]) for i, n in enumerate((0, 1, 63, 64, 199, 200, 201))]
    for i in range(10, 70):
        body = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(shared)
            a = rng.randrange(len(part))
            body += [prose(rng.randint(0, 90)), part[a:a + rng.randint(1, 500)], line if rng.random() < 0.7 else ""]
        rows.append((i, "".join(body)))
    rows += [(80, "x" * 700), (81, "ab" * 300), (82, prose(7) * 80), (83, prose(230) * 3), (84, prose(400) + "x" * 230), (85, None)]
    rows += [(86, rows[20][1]), (20, rows[20][1]), (20, rows[20][1]), (None, rows[30][1]), (None, None)]
    return rows


@pytest.mark.parametrize("kinds, size", [(4096, 1 << 20), (0, 4000), (2, 1)])
def test_documents(spark, monkeypatch, kinds, size):
    """With anchors compared as they are, all of them split, and each one in a collection of its own."""
    monkeypatch.setattr(B, "KINDS", kinds)
    monkeypatch.setattr(B, "COLLECTION", size)
    rows = collection(kinds)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as id", "'c' as key", "'c' as found", "'c' as version")
    got = Counter(tuple(r) for r in B.digests(docs.repartition(5)).collect())
    assert got == plain(rows)
    assert sum(r[2] > 0 for r in got) > 20


def test_odd_input(spark, documents, nothing):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert Counter(tuple(r) for r in B.digests(documents).collect()) == plain(rows)
    assert B.digests(nothing).isEmpty()


@pytest.mark.parametrize("seed", range(6))
def test_suffix_order(seed):
    """The transform and the common prefixes of a small collection, against all its suffixes sorted."""
    rng = random.Random(seed)
    strings = [bytes(rng.choice(b"ab\xff\x00" if seed % 2 else b"abc") for _ in range(rng.randint(1, 25))) for _ in range(rng.randint(1, 30))]
    n = len(strings)
    place = np.array([rng.randrange(len(s)) for s in strings])
    made = B.Collection(strings, np.ones(n, np.int64), place, np.zeros(n, bool))
    # Symbols are one more than bytes; each string ends in a symbol of its own, below all others.
    suffixes = sorted(([*(x + 1000 for x in s[i:]), k], s, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
    want = [s[i - 1] + 1 if i else 0 for _, s, i in suffixes]
    assert made.transform.tolist() == want
    prefix = lambda x, y: next(k for k in range(99) if x[k] != y[k])
    assert made.common.tolist()[1:] == [prefix(x[0], y[0]) for x, y in zip(suffixes, suffixes[1:])]


def test_aligned_strings_that_stop_early():
    """Strings around one anchor: those without a shared window stop, the others are found all the same."""
    rng = random.Random(1)
    prose = lambda n: bytes(rng.randrange(97, 123) for _ in range(n))
    middle, strings, place = prose(70), [], []
    left, right = prose(100), prose(100)
    for kind in range(40):
        a = left[rng.randrange(0, 50):] if kind % 3 else prose(60)
        b = right[:rng.randrange(60, 100)] if kind % 4 else prose(90)
        strings.append(a + middle + b)
        place.append(len(a))
    keep = [i for i, s in enumerate(strings) if len(s) >= 200]
    strings, place = [strings[i] for i in keep], [place[i] for i in keep]
    windows = np.array([len(s) - 199 for s in strings])
    made = B.Collection(strings, windows, np.array(place), np.ones(len(strings), bool))
    seen = Counter(s[i:i + 200] for s in strings for i in range(len(s) - 199))
    assert [x.tolist() for x in made.repeated()] == [[seen[s[i:i + 200]] > 1 for i in range(len(s) - 199)] for s in strings]
    assert len(made.transform) < sum(map(len, strings)) + len(strings)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in registered.op12_column_suffixes(spark, "/root/testdata/sf0.001").collect()) == plain(rows)
