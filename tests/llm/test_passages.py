"""Repeated passages against a set of all windows seen so far."""

import hashlib
import random
import re

import pytest

from tidemark.llm import passages as P


def plain(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    seen, out = set(), {}
    for doc, text in sorted(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        again = [False] * len(w)
        for i in range(len(w) - 19):
            window = tuple(w[i:i + 20])
            if window in seen:
                again[i:i + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(x for x, a in zip(w, again) if not a)
        out[doc] = len(w), sum(again), hashlib.sha256(kept.encode()).hexdigest()
    return out


def collection(seed: int, words: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    prose = lambda n: [f"w{rng.randrange(words)}" for _ in range(n)]
    shared = [prose(rng.randint(15, 70)) for _ in range(6)]
    rows = []
    for doc in range(60):
        body = []
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(shared)
            a = rng.randrange(len(part))
            body += prose(rng.randint(0, 12)) + part[a:a + rng.randint(1, 60)]
        if doc % 7 == 0:
            body += ["same"] * rng.randint(0, 45)
        rows.append((doc, rng.choice([" ", "\n", "\t  "]).join(body)))
    return rows + [(60, rows[9][1]), (61, rows[9][1]), (62, "")]


@pytest.mark.parametrize("seed, words, patterns, streamed", [(1, 5000, 20_000, 100_000), (2, 4, 20_000, 100_000), (3, 60, 7, 5)])
def test_every_repeated_window_goes(spark, monkeypatch, seed, words, patterns, streamed):
    monkeypatch.setattr(P, "PATTERNS", patterns)
    monkeypatch.setattr(P, "STREAMED", streamed)
    rows = collection(seed, words)
    got = P.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == plain(rows)


def test_odd_rows(documents, nothing, spark):
    got = P.digests(documents).collect()
    assert len(got) == documents.count()
    assert all(r.n_removed == 0 for r in got if r.doc_id in (0, 1, 2, 3, 12))
    # Rows without an id come first, so theirs is the passage that stays.
    assert [r.n_removed for r in got if r.doc_id is None and r.n_words] == [0]
    assert next(r for r in got if r.doc_id == 6).n_removed == 60
    cut = P.without_repeats(documents)
    assert cut.columns == documents.columns and cut.count() == documents.count()
    by_id = {r.doc_id: r for r in cut.collect()}
    assert by_id[6].text == "" and by_id[6].n_chars == 0 and by_id[6].row == "clash"
    assert by_id[2].text == " \n\t " and by_id[0].text is None
    assert P.digests(nothing).isEmpty() and P.without_repeats(nothing).isEmpty()
