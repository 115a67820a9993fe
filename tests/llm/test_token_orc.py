"""Token ids in ORC against the tokenizer on whole texts, and what the files hold."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_orc as O
from tidemark.llm import tokens

END = 2
PARTS = [
    "a", "b", "é", "β", "е", "'s", "'", "don't", "²", "5", "12", "́", "á", "\n", "\n\n", " ", "  ", "\t", "\x1c",
    "\x85", " ", " ", "<|endoftext|>", "<|startoftext|>", "X", "Σ", "ΑΣ", "ǅ", "中", "😀", "-", "...", "_", "\r\n", "İ", "ﬁ",
]


def whole(vocabulary: str):
    tokenizer = Tokenizer.from_file(vocabulary)
    return lambda text: [*tokenizer.encode(text, add_special_tokens=False).ids, END]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_stretches_give_the_ids_of_whole_texts(monkeypatch, name):
    """The cache is too small and the blocks too short on purpose."""
    monkeypatch.setattr(tokens, "BLOCK", 2_000)
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    encode, made = whole(public_tokenizers.path(name)), []
    for _, ids, counts in tokens.Encoder(public_tokenizers.path(name), END, kept=50).encode(texts):
        made += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert made == [encode(t) for t in texts]


def test_files(spark, documents, nothing, tmp_path):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    path = f"file://{tmp_path}/ids"
    O.write_tokens(documents, path, vocabulary, END)
    written = O.read_tokens(spark, path)
    encode = whole(vocabulary)
    rows = sorted(documents.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for doc_id, text in rows:
        ids = np.array(encode(text or ""), "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = O.digests(written).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    assert [tuple(r) for r in got] == want
    assert {r.tokens[-1] for r in written.collect()} == {END}
    for file in (tmp_path / "ids").glob("*.orc"):
        held = pyarrow.orc.ORCFile(file)
        ids = [x if x is not None else -1 for x in held.read(["doc_id"])["doc_id"].to_pylist()]
        assert held.compression == "ZSTD" and ids == sorted(ids)
    one = written.where("doc_id = 9")
    assert "EqualTo(doc_id,9)" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 1
    empty = f"file://{tmp_path}/none"
    O.write_tokens(nothing, empty, vocabulary, END)
    assert O.digests(O.read_tokens(spark, empty)).isEmpty()
    with pytest.raises(Exception, match="already exists"):
        O.write_tokens(nothing, empty, vocabulary, END)
    O.write_tokens(documents, empty, vocabulary, END, overwrite=True)
    assert O.read_tokens(spark, empty).count() == documents.count()


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_asked_of_the_model_and_get_the_ids_of_the_whole_library(file):
    words = ["Word", " word", " ÉCOLE", "ſtraße", " ǅ", "ŉ", " İstanbul", "x1", " it's", "\n\nso", "", " ", ",", "日本", "don't"]
    encoder = tokens.Encoder(public_tokenizers.path(file), 2)
    asked, marked = [], encoder._marked
    encoder._marked = lambda stretches: (asked.extend(stretches), marked(stretches))[1]
    ids, sizes = encoder._encode(words)
    assert not {"Word", " word", " ÉCOLE", "ſtraße", " ǅ", "ŉ"} & set(asked) and {" İstanbul", "x1", "日本"} <= set(asked)
    plain = [Tokenizer.from_file(public_tokenizers.path(file)).encode(w, add_special_tokens=False).ids for w in words]
    assert [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])] == plain
