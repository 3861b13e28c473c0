"""Names and small texts in whatever store holds a table, through the Hadoop file system of its path."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a folder, none if it is missing. What lies below them is not listed."""
    files = _files(spark, path)
    if not files.exists(_path(spark, path)):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(_path(spark, path)) if s.isDirectory())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below a folder, none if it is missing."""
    files = _files(spark, path)
    if not files.exists(_path(spark, path)):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(_path(spark, path)) if s.isFile())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds; a missing one is no error."""
    _files(spark, path).delete(_path(spark, path), True)


def get_text(spark: SparkSession, path: str) -> str:
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Write a small file that readers see whole or not at all: written beside its place, then renamed.

    Without `replace` a file that is there already stays, and the answer is False.
    """
    beside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    files = _files(spark, beside)
    stream = files.create(_path(spark, beside))
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE if replace else rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(_path(spark, beside)), files.makeQualified(_path(spark, path)), how)
    except Py4JJavaError as e:
        remove(spark, beside)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True
