"""Small control files beside tables: created by one writer only, or replaced in one step.

On a local disk the system's own exclusive creation and renaming are used; elsewhere those of the Hadoop file
system, which are atomic on HDFS and on stores that create and rename conditionally.
"""

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str) -> tuple:
    """(Hadoop path, its file system, the path on a local disk or None)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return at, system, at.toUri().getPath() if system.getUri().getScheme() == "file" else None


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates the file with this text, or tells that it exists. Of several writers at once one succeeds."""
    at, system, local = _opened(spark, path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        # The text is complete before the name exists: linking fails where the name is taken.
        aside = f"{local}.{uuid.uuid4().hex}"
        with open(aside, "w") as out:
            out.write(text)
        try:
            os.link(aside, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
    try:
        out = system.create(at, False)
    except Py4JJavaError as error:
        if system.exists(at):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def replace(spark: SparkSession, path: str, text: str) -> None:
    """Puts the text in place of what the file held: a reader sees the one or the other, whole."""
    at, system, local = _opened(spark, path)
    aside = f"{path}.{uuid.uuid4().hex}"
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        aside = f"{local}.{uuid.uuid4().hex}"
        with open(aside, "w") as out:
            out.write(text)
        os.replace(aside, local)
        return
    create_new(spark, aside, text)
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(jvm.org.apache.hadoop.fs.Path(aside), at, options)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Renames the file; of several movers at once one succeeds."""
    at, system, local = _opened(spark, path)
    other, _, local_to = _opened(spark, to)
    if local is not None:
        try:
            os.rename(local, local_to)
            return True
        except FileNotFoundError:
            return False
    return system.rename(at, other)


def read(spark: SparkSession, path: str) -> str | None:
    """The file's text, None where there is none."""
    at, system, local = _opened(spark, path)
    if local is not None:
        try:
            with open(local) as held:
                return held.read()
        except FileNotFoundError:
            return None
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, sorted; nothing where there is none."""
    at, system, _ = _opened(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder with all it holds."""
    at, system, _ = _opened(spark, path)
    system.delete(at, True)
