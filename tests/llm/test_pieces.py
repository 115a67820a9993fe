"""Pieces: the search against a plain one over a dictionary, decoding, the double array."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import pieces as P

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return P.Pieces(MODEL)


def test_double_array():
    rng = random.Random(1)
    keys = {bytes(rng.choice(b"abc\xff\x00") for _ in range(rng.randint(1, 6))): i for i, _ in enumerate(range(400))}
    trie = P.DoubleArray(keys)

    def find(key):
        state = 0
        for byte in key:
            to = trie.base[state] + byte
            if trie.check[to] != state:
                return -1
            state = to
        return trie.value[state]

    assert all(find(k) == v for k, v in keys.items())
    for _ in range(2000):
        key = bytes(rng.choice(b"abcd\xff\x00") for _ in range(rng.randint(1, 7)))
        assert find(key) == keys.get(key, -1)


def plain(model, by_piece, text):
    """Best score and ids of a text, character by character over the whole text."""
    text = P.MARKER + text.replace(" ", P.MARKER)
    best = [(0.0, [])] + [(-float("inf"), [])] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + 48) + 1):
            if (piece := by_piece.get(text[i:j])) is not None:
                score, path = best[i][0] + model.scores[piece], [piece]
            elif j == i + 1:
                score, path = best[i][0] + model.unknown, model.bytes[list(text[i].encode())].tolist()
            else:
                continue
            if score > best[j][0]:
                best[j] = score, best[i][1] + path
    return best[-1]


def test_search_and_decoding(model):
    by_piece = {s.decode().replace(" ", P.MARKER): i for i, s in enumerate(model.spelled) if s and i not in set(model.bytes.tolist())}
    rng = random.Random(2)
    parts = ["a", "b", "the", " ", "  ", "é", "\n", "\t", "中", "日本", "😀", "ing", "tion", "x", "ß", "qu", "\x00", "Ω"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    made = []
    for _, ids, counts in P.PieceEncoder(model).encode(texts):
        made += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    is_byte = set(model.bytes.tolist())
    for text, ids in zip(texts, made):
        assert model.decode(ids) == text
        want_score, want = plain(model, by_piece, text)
        assert sum(i in is_byte for i in ids) == sum(i in is_byte for i in want)
        own = sum(model.scores[i] for i in ids if i not in is_byte)
        assert own == pytest.approx(sum(model.scores[i] for i in want if i not in is_byte))
    assert model.decode([*model.bytes[[0xE9, 0x41]].tolist()]) == "�A"


def test_rows(documents, nothing, model):
    got = P.encoded(documents, MODEL, with_ids=True).collect()
    assert len(got) == documents.count() and all(r.round_trip for r in got)
    assert all(r.n_pieces == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    assert all(r.n_pieces == 0 for r in got if r.doc_id in (0, 1))
    assert P.encoded(nothing, MODEL).isEmpty()
