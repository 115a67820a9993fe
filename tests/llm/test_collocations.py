"""Phrases and their scores against plain counting, and the automata on their own."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import collocations as C, registered


def plain_grams(rows: list[tuple]) -> dict[str, Counter]:
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        of = counts.setdefault("und" if lang is None else lang, Counter())
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = tuple(re.findall("[^\x20\x09]+", piece))
            of.update(w[i:i + k] for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return counts


def plain(rows: list[tuple], first: int = 2000, least: int = 10, inside: int = 50) -> list[tuple]:
    out = []
    for lang, f in sorted(plain_grams(rows).items()):
        n = sum(c for g, c in f.items() if len(g) == 1)
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        ranked = []
        for g, a in found.items():
            longer = [b for h, b in found.items() if len(h) == 3 and len(g) == 2 and g in (h[:2], h[1:])]
            if any(100 * b >= inside * a for b in longer):
                continue
            score, _, left, right = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            ranked.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def prose(rng: random.Random, n: int) -> str:
    vocabulary = ["the", "The", "of", "a", "b\x1cc", "é", "Öl", "x\x00y", "zz"]
    fixed = ["new york city", "new york", "vice versa", "of the"]
    return "".join(
        rng.choice(fixed if rng.random() < 0.3 else vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\r\n"])
        for _ in range(n)
    )


@pytest.mark.parametrize("block, chunk, united", [(2_000_000, 4 << 20, 4_000_000), (40, 60, 20)])
def test_documents(spark, documents, nothing, monkeypatch, block, chunk, united):
    """Whole, and with blocks, parts of texts and unions cut as small as they come."""
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "CHUNK", chunk)
    monkeypatch.setattr(C, "UNITED", united)
    rng = random.Random(2)
    more = [(100 + i, prose(rng, rng.randint(1, 90)), rng.choice(["en", "en", "de", None])) for i in range(80)]
    docs = documents.select("doc_id", "text", "lang").unionAll(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    rows = [(r.lang, r.text) for r in docs.collect()]
    for first, inside in ((2000, 50), (7, 90)):
        got = sorted(tuple(r) for r in C.collocations(docs.withColumn("words", docs.lang), first, inside=inside).collect())
        assert got == sorted(plain(rows, first, inside=inside))
    assert C.collocations(nothing).isEmpty()


def test_automata_hold_and_add_counts():
    rng = random.Random(4)
    shards = []
    for _ in range(6):
        block = C.Block()
        tokens = [rng.choice(b"a b c d e".split() + [b"\n"]) for _ in range(rng.randint(0, 300))]
        block.add(tokens)
        shards.append((tokens, block.counted()))
    want = plain_grams([("x", " ".join(t.decode() for t in tokens).replace("\n", ".")) for tokens, _ in shards])["x"]
    got = Counter()
    for at in range(4):
        dumps = [a.dump() for _, counted in shards for r, a in C.dealt(*counted, 4) if r == at]
        automaton, _ = C.united(dumps, least=1)
        w = [x.decode() for x in automaton.words]
        got.update({(w[i],): n for i, n in zip(automaton.w1.tolist(), automaton.n1.tolist()) if n})
        first, second, n2 = automaton.pairs()
        got.update({(w[i], w[j]): n for i, j, n in zip(first.tolist(), second.tolist(), n2.tolist()) if n})
        arc, third, n3 = automaton.triples(np.arange(len(second)))
        got.update({(w[first[i]], w[second[i]], w[k]): n for i, k, n in zip(arc.tolist(), third.tolist(), n3.tolist())})
        assert len(automaton.cs) <= len(automaton.state) + 1
    assert got == want


def test_equal_states_are_kept_once():
    size = np.array([1, 2, 0, 1, 2, 1])
    w3, n3 = np.array([4, 1, 2, 4, 1, 2, 4]), np.array([9, 1, 1, 9, 1, 1, 8])
    state, cs, w, n = C.shared_states(size, w3, n3, 10)
    assert state[0] == state[3] != state[5] and state[1] == state[4] and cs[state[2]] == 0 and len(w) == len(n) == 4


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text").collect()
    got = registered.op11_weighted_automata(spark, "/root/testdata/sf0.001")
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain([tuple(r) for r in rows]))
