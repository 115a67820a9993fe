"""The byte classifier: gradients, held-out accuracy, odd rows, texts of any length."""

import zlib

import numpy as np
import pytest

from tidemark.llm import byte_cnn as C


def test_chunks_cover_every_byte():
    for n in (0, 1, C.CHUNK - 1, C.CHUNK, C.CHUNK + 1, C.CHUNK + C.STEP, C.CHUNK + C.STEP + 1, 5000):
        text = bytes(1 + i % 255 for i in range(n))
        cut = C.chunks(text)
        whole = np.zeros((len(cut) - 1) * C.STEP + C.CHUNK, np.uint8)
        for i, piece in enumerate(cut):
            whole[i * C.STEP:i * C.STEP + C.CHUNK] = piece
        assert bytes(whole[:n]) == text and not whole[n:].any()


def test_gradients_are_those_of_the_loss():
    model = C.Model()
    for name in ("bytes", "filters", "bias", "head", "offset"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    model.bias += 0.1
    bodies = [b"some words " * 60, b"X", b"other WORDS!! " * 9]
    labels, weights = np.array([1.0, 0.0, 0.0]), np.array([0.5, 2.0, 1.0])

    def loss():
        p = model.score(bodies)
        return float((-weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).mean())

    gradients = model._gradients([C.chunks(b) for b in bodies], labels, weights)
    rng = np.random.default_rng(1)
    for values, gradient in zip(model.weights(), gradients):
        for at in np.argsort(-np.abs(gradient), axis=None)[:3].tolist() + rng.integers(0, values.size, 3).tolist():
            at = np.unravel_index(at, values.shape)
            before, h = values[at], 1e-6
            values[at] = before + h
            up = loss()
            values[at] = before - h
            down = loss()
            values[at] = before
            assert gradient[at] == pytest.approx((up - down) / (2 * h), rel=1e-3, abs=1e-6)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.where("doc_id < 5000")
    got = C.classify(docs.where("doc_id < 5000"), C.train(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 300 and np.mean([r.predicted == r.quality for r in held]) > 0.97


def test_odd_rows(spark, documents, nothing):
    rows = [(3, 1, 0), (4, 0, 0), (4, 1, 0), (5, None, None), (None, 1, 0), (9, 0, 0), (9, 0, 1), (10, 1, 1), (11, 0, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    got = C.classify(documents, C.train(documents, labels)).collect()
    assert len(got) == documents.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    none = labels.where("false")
    assert {r.score for r in C.classify(documents, C.train(documents, none)).collect()} == {1.0}
    assert C.classify(nothing, C.train(nothing, none)).isEmpty()


def test_a_long_text_is_passed_over_and_the_sample_goes_on():
    sizes = [(1, 30), (0, 10), (1, 90), (1, 20), (0, 60), (0, 40)]
    assert C.within(sizes, 100) == [0, 1, 3, 5]
    assert C.within([], 100) == [] and C.within([(0, 51)], 100) == []


def test_sample_of_skewed_labels(spark, monkeypatch):
    """One very long text, an id with very many rows, label rows without a document, and a class that most documents have."""
    monkeypatch.setattr(C, "TEXT_BYTES", 1000)
    monkeypatch.setattr(C, "SAMPLE_BYTES", 4000)
    learned = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    long, often, *rest = learned[:200]
    rows = [(long, "y" * 1001), (often, "b"), *[(often, "a")] * 500, *((i, f"text {i}") for i in rest)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in learned for _ in range(2)], "doc_id long, quality int")
    bodies, y, weights = C.training_rows(docs, labels)
    assert sorted(bodies) == sorted([b"a", *(f"text {i}".encode() for i in rest)])
    assert {b: v for b, v in zip(bodies, y)} == {b"a": often % 5 > 0, **{f"text {i}".encode(): i % 5 > 0 for i in rest}}
    # Labels of documents that are not there weigh nothing.
    assert np.allclose(weights, 1)


def test_sample_is_bounded_by_class(spark, monkeypatch):
    monkeypatch.setattr(C, "SAMPLE_BYTES", 400)
    learned = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(i, "z" * (150 if i % 7 == 0 else 20)) for i in learned], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in learned], "doc_id long, quality int")
    bodies, y, weights = C.training_rows(docs, labels)
    for label in (0, 1):
        assert 180 < sum(len(b) for b, v in zip(bodies, y) if v == label) <= 200
    share = sum(i % 3 > 0 for i in learned) / len(learned)
    assert weights[y == 1].sum() / weights.sum() == pytest.approx(share)
