"""Runs of words against a plain search, extensions against a plain comparison, and the query's digests."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import periodic as P, registered


def plain_runs(w: list) -> list[tuple[int, int, int]]:
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_words(doc_id: int | None, text: str | None) -> list[str]:
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def plain_row(doc_id: int | None, text: str | None) -> tuple:
    w = plain_words(doc_id, text)
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + length for s, length, q in runs)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(kept)))


def repeating(rng: random.Random, n: int, kinds: int) -> list[int]:
    out: list[int] = []
    while len(out) < n:
        unit = [rng.randrange(kinds) for _ in range(rng.randint(1, 9))]
        out += (unit * rng.randint(1, 12))[:rng.randint(1, 60)] if rng.random() < 0.6 else unit
    return out[:n]


@pytest.mark.parametrize("seed", range(12))
def test_runs(monkeypatch, seed):
    """Short and long texts, few and many different words, and candidates in small lots."""
    rng = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(P, "_SHORT", 40)
        monkeypatch.setattr(P, "_PAIRS", [])
        monkeypatch.setattr(P, "_GRID", 64)
    kinds = rng.choice([1, 2, 3, 50])
    held = [repeating(rng, rng.choice([0, 1, 5, 6, 7, 30, 90, 400]), kinds) for _ in range(25)]
    got = P.runs_of([np.array(w, np.int64) for w in held])
    assert [[tuple(r) for r in g.tolist()] for g in got] == [plain_runs(w) for w in held]


@pytest.mark.parametrize("seed, kinds", [(0, 1), (1, 2), (2, 3), (3, 30)])
def test_extensions(seed, kinds):
    rng = random.Random(seed)
    w = repeating(rng, 300, kinds)
    line = [kinds, *w, kinds + 1]
    grammar = P.Grammar(np.array(line, np.int64), 2)
    assert max(len(s) for s in grammar.symbol[1:]) < len(line) and len(grammar.symbol[-1]) <= 4
    pairs = [(i, j) for i in range(1, 301, 7) for j in range(i + 1, 301, 5)]
    i, j = (np.array(x) for x in zip(*pairs))
    ahead, behind = grammar.extension(i, j), grammar.reversed().extension(301 - j, 301 - i)
    for a, b, x, y in zip(i.tolist(), j.tolist(), ahead.tolist(), behind.tolist()):
        n = next(k for k in range(400) if line[a + k] != line[b + k])
        m = next(k for k in range(400) if line[a - k] != line[b - k])
        assert (x, y) == (n, m)


def test_a_long_text_of_one_word():
    w = np.zeros(100_000, np.int64)
    assert P.runs_of([w])[0].tolist() == [[0, 100_000, 1]]


def test_documents(spark, documents, nothing):
    got = Counter(tuple(r) for r in P.digests(documents).collect())
    assert got == Counter(plain_row(r.doc_id, r.text) for r in documents.collect())
    assert P.digests(nothing).isEmpty()


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = sorted(tuple(r) for r in registered.op13_recompression(spark, "/root/testdata/sf0.001").collect())
    short = {r.doc_id: r.text for r in docs if len((r.text or "").split()) < 1500}
    assert len(got) == len(docs)
    assert [r for r in got if r[0] in short] == sorted(plain_row(d, t) for d, t in short.items())
    assert sum(r[1] > 0 for r in got) > len(got) // 20
