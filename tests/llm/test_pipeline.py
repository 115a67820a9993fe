"""The corpus pipeline against plain versions of its stages, each on its own input."""

import hashlib
from collections import Counter

import corpus_pipeline
from test_host_rules import plain_counts
from test_passages import plain
from test_simhash import plain_fingerprint, plain_groups

from tidemark.llm import byte_cnn, host_rules
from tidemark.llm.staging import stage

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs = []
    for name, apply in corpus_pipeline.STAGES:
        outs.append((docs.collect(), docs := stage(apply(spark, docs, SF), name)))
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [sorted(r.doc_id for r in out.collect()) for _, out in outs]

    before = outs[0][0]
    failed = {r.doc_id for r in before if (c := plain_counts(r.text or ""))[0] < 10 or 100 * c[4] > 20 * c[0]}
    of = Counter(r.source for r in before)
    bad = Counter(r.source for r in before if r.doc_id in failed)
    mean, weight = host_rules.beta_prior(
        len(before), len(failed), len(of), sum(n * n for n in of.values()), sum(bad[s] ** 2 / n for s, n in of.items())
    )
    rate = {s: mean if weight is None else (bad[s] + weight * mean) / (n + weight) for s, n in of.items()}
    assert ids[0] == sorted(r.doc_id for r in before if r.doc_id not in failed and rate[r.source] <= 0.5)

    before = outs[1][0]
    frame = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    model = byte_cnn.train(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = model.score([(r.text or "").encode() for r in before])
    assert ids[1] == sorted(r.doc_id for r, s in zip(before, scores) if s >= 0.7)

    before = sorted(outs[2][0])
    groups = plain_groups([plain_fingerprint(r.text or "") for r in before])
    assert ids[2] == sorted(before[g].doc_id for g in set(groups))

    want = plain([(r.doc_id, r.text) for r in outs[3][0]])
    for r in outs[3][1].collect():
        assert r.n_chars == len(r.text)
        assert hashlib.sha256(" ".join(r.text.split()).encode()).hexdigest() == want[r.doc_id][2]

    pieces = outs[4][1].collect()
    assert sorted({r.doc_id for r in pieces}) == ids[3]
    held = Counter()
    for r in pieces:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 4096 and sum(held.values()) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())


def test_odd_and_empty_input(spark, documents, nothing):
    for docs in (documents.select("doc_id", "text", "lang", "source", "n_chars"), nothing):
        for name, apply in corpus_pipeline.STAGES:
            docs = stage(apply(spark, docs, SF), name)
    assert docs.isEmpty()
