"""Packed sequences hold the token ids themselves, in op10 and in the pipeline's last stage."""

import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import packing as P, registered


def test_sequences_hold_the_ids(spark, documents):
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(vocabulary)
    rows = documents.where("doc_id is not null and doc_id <> 4")
    want = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in rows.collect()}
    for got, window in ((P.pack(rows, vocabulary, 2, window=128), 128), (corpus_pipeline.packed(spark, rows, ""), 4096)):
        sequences, docs = defaultdict(list), defaultdict(list)
        for r in got.collect():
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert len(ids) == r.length
            sequences[r.sequence_id].append((r.offset, ids))
            docs[r.doc_id].append((r.start, ids))
        assert {d: [i for _, ids in sorted(x) for i in ids] for d, x in docs.items()} == want
        for x in sequences.values():
            whole = []
            for offset, ids in sorted(x):
                assert offset == len(whole)
                whole += ids
            assert len(whole) <= window


def test_op10_digests_the_packed_ids(spark):
    got = registered.op10_bin_slack(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want += [
            (doc_id, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes()), len(ids)) for at in range(0, len(ids), 4096)
        ]
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got.collect()) == sorted(want)
