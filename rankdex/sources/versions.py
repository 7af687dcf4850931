"""Numbered versions of something, each claimed by one writer, as files in a folder."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DIGITS = 12


def _path(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def claim(spark: SparkSession, folder: str, number: int, content: str) -> bool:
    """Make version ``number`` with ``content``, if no writer has made it. Of any writers
    that try, one succeeds, and readers see its whole content or no file.

    The content is written under a name of its own, which then becomes the version's
    where that name is free: by a link on a local disk, else by a rename that does not
    replace, which HDFS does in one step. An object store has to offer the same.
    """
    temporary, fs = _path(spark, folder, f".{uuid.uuid4().hex}")
    target, _ = _path(spark, folder, f"{number:0{_DIGITS}}")
    out = fs.create(temporary, True)
    out.write(bytearray(content, "utf-8"))
    out.close()
    try:
        if fs.getScheme() == "file":
            local = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, temporary)]
            spark._jvm.java.nio.file.Files.createLink(*local)
        else:
            _rename(spark, temporary, target)
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    finally:
        fs.delete(temporary, False)
    return True


def _rename(spark: SparkSession, source, target) -> None:
    """Rename, but never onto a file that exists."""
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, options)


def latest(spark: SparkSession, folder: str) -> int:
    """The highest number claimed, 0 if there is none."""
    path, fs = _path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return max((int(name) for name in names if name.isdigit()), default=0)


def content(spark: SparkSession, folder: str, number: int) -> str:
    path, fs = _path(spark, folder, f"{number:0{_DIGITS}}")
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it; none need be there."""
    found, fs = _path(spark, path)
    fs.delete(found, True)
