"""SimHash: fingerprints bit by bit, links and groups against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tidemark.llm import components, simhash as M


def plain_fingerprint(text: str) -> int:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(codes: list[int], max_bits: int = 2) -> list[int]:
    group = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= max_bits and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def near_codes(rng: random.Random, n: int, bits: int) -> list[int]:
    codes = [rng.getrandbits(bits) for _ in range(n // 4)] or [0]
    while len(codes) < n:
        code = rng.choice(codes)
        for _ in range(rng.randint(1, 4)):
            code ^= 1 << rng.randrange(bits)
        codes.append(code)
    return sorted(set(codes))


@pytest.mark.parametrize("n, bits, seed", [(1, 64, 0), (2, 64, 1), (60, 64, 2), (300, 64, 3), (400, 22, 4), (900, 12, 5)])
def test_forest_joins_what_near_pairs_join(n, bits, seed):
    codes = near_codes(random.Random(seed), n, bits)
    links = M.links_within(np.array(codes, np.uint64))
    assert len(links) <= len(codes) - 1
    assert all((codes[i] ^ codes[j]).bit_count() <= 2 for i, j in links)
    group = list(range(len(codes)))
    for i, j in links:
        low, high = sorted((group[i], group[j]))
        group = [low if g == high else g for g in group]
    assert group == plain_groups(codes)


def test_any_two_near_codes_share_a_pattern():
    rng = random.Random(6)
    assert all(64 - int(m).bit_count() <= 22 for m in M.patterns())
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)
        assert any(a & int(m) == b & int(m) for m in M.patterns())


def test_other_lengths_and_distances(spark):
    codes = near_codes(random.Random(9), 200, 64)
    links = M.fingerprint_links(spark.createDataFrame([(c - (c >> 63 << 64),) for c in codes], "fp long"), max_bits=3).collect()
    group = {c: c for c in codes}
    for a, b in links:
        a, b = a & (1 << 64) - 1, b & (1 << 64) - 1
        low, high = sorted((group[a], group[b]))
        group = {c: low if g == high else g for c, g in group.items()}
    want = plain_groups(codes, 3)
    assert [codes.index(group[c]) for c in codes] == want
    assert M.fingerprint(b"one two three four", 4) != M.fingerprint(b"one two three four", 3)


def test_gray_neighbours_differ_in_one_bit():
    codes = np.arange(64, dtype=np.uint64)
    order = codes[np.argsort(M.gray_rank(codes))]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()


def test_components_of_a_long_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7)]
    got = dict(components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1100)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_documents(spark, documents, nothing):
    rng = random.Random(8)
    base = " ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(90)) for _ in range(300))
    near = [(100 + i, base.replace("aaa1", f"zzz{i}", 1)) for i in range(12)]
    docs = documents.select("doc_id", "text").unionAll(spark.createDataFrame(near, "doc_id long, text string"))
    rows = docs.collect()
    codes = [plain_fingerprint(r.text or "") for r in rows]
    groups = plain_groups(codes)
    least = {}
    for r, g in zip(rows, groups):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    want = Counter((r.doc_id, c, least.get(g)) for r, c, g in zip(rows, codes, groups))
    got = M.near_duplicates(M.fingerprinted(docs)).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want
    assert M.near_duplicates(M.fingerprinted(nothing)).isEmpty()
    kept = M.one_of_each(documents)
    assert kept.columns == documents.columns
    of = {r.text: g for r, g in zip(rows, groups)}
    assert Counter(of[r.text] for r in kept.collect()) == Counter({of[r.text] for r in documents.collect()})
