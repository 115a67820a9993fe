"""Stages: released files go, other stages stay."""

import os

import pyarrow as pa
import pytest

from tidemark.llm import staging, tokens
from tidemark.llm.staging import release, stage
from tidemark.llm.words import texts


def test_release(spark):
    first, second, empty = (stage(spark.range(n), "released") for n in (5, 7, 0))
    folders = [os.path.dirname(df.inputFiles()[0]).removeprefix("file:") for df in (first, second)]
    release(first, empty)
    assert [os.path.exists(f"/{f.lstrip('/')}") for f in folders] == [False, True]
    assert second.count() == 7


def test_other_tables_are_not_released(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/mine")
    with pytest.raises(ValueError, match="not a stage"):
        release(spark.read.parquet(f"{tmp_path}/mine"))
    assert spark.read.parquet(f"{tmp_path}/mine").count() == 3


def test_batches_of_texts_are_bounded_from_the_first_stage_on(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    staging.stage(spark.range(1), "bounded")
    assert spark.conf.get(setting) == str(staging.BATCH)


def test_a_worker_that_reads_texts_as_bytes_keeps_no_encoders():
    tokens._ENCODERS["some", 2] = object()
    assert texts(pa.array(["a", None])) == [b"a", b""]
    assert not tokens._ENCODERS
