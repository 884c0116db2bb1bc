"""Names and small texts in any folder that Spark can reach (local, HDFS, object store)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, path: str) -> list[str]:
    """Entries of a folder, sorted; none where there is no folder."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, path).listStatus(_path(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    source = _system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """A new file that readers see whole or not at all; False if the name is taken."""
    system, parent, name = _system(spark, path), *path.rsplit("/", 1)
    own = f"{parent}/.{name}.{uuid.uuid4().hex}"
    sink = system.create(_path(spark, own), False)
    sink.write(bytearray(text.encode()))
    sink.close()
    done = not exists(spark, path) and system.rename(_path(spark, own), _path(spark, path))
    if not done:
        system.delete(_path(spark, own), False)
    return done


def remove(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)
