"""Repeated passages: one passage in most documents, with joins that Spark splits."""

import random

import pytest
from test_passages import plain

from tidemark.llm import passages as P

SPLIT = {
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1kb",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def splitting(spark):
    before = {key: spark.conf.get(key, None) for key in SPLIT}
    for key, value in SPLIT.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_passage_in_most_documents(spark, splitting):
    rng = random.Random(8)
    prose = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    hot = prose(45)
    rows = [(i, f"{prose(rng.randint(0, 30))} {hot if i % 5 else prose(30)} {prose(rng.randint(0, 30))}") for i in range(400)]
    got = P.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(16)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == plain(rows)
    assert sum(r.n_removed > 0 for r in got) == 319
