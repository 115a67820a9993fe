"""Tables that a job with several steps writes once and reads again."""

import uuid

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes handed to a worker at a time; batches of whole texts would grow to many times that, in Spark and in the worker.
BATCH = 4 << 20


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, the folder that driver and executors share.

    Where it is unset, as in tests, the session's warehouse stands in.
    """
    return f"{_base(spark)}/{name}-{uuid.uuid4().hex}"


def _base(spark: SparkSession) -> str:
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/stages").rstrip("/")


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes ``df`` as Parquet and reads it back, so that no lost executor makes later steps start over.

    The shuffle files behind a written table are of no more use; Spark is told to drop them, from the first stage on.
    """
    spark, path = df.sparkSession, stage_path(df.sparkSession, name)
    free_shuffles(spark)
    bound_batches(spark)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*stages: DataFrame) -> None:
    """Deletes the files of stages that nothing reads any more: what came of them has been written itself.

    Only folders that stand directly in the folder of stages go; given a table from elsewhere it is an error.
    """
    for df in stages:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        base = jvm.org.apache.hadoop.fs.Path(_base(df.sparkSession))
        files = base.getFileSystem(conf)
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            if not path.getParent().toUri().getPath() == files.makeQualified(base).toUri().getPath():
                raise ValueError(f"not a stage: {folder}")
            files.delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Set once for the session: shuffle files go when the query that made them has been written."""
    if spark.conf.get(FREE_SHUFFLES) != "true":
        spark.conf.set(FREE_SHUFFLES, "true")


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's bound on batches of texts, unless it is set lower or was set by an operator with a bound of its own."""
    if int(spark.conf.get(BATCH_BYTES).rstrip("bB")) > 4 * BATCH:
        spark.conf.set(BATCH_BYTES, str(BATCH))
