"""What the file system of a path, whatever it is, says about its files."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def changed(spark: SparkSession, path: str) -> int | None:
    """Time of the last change of a path, or None if there is none."""
    where, system = _system(spark, path)
    return system.getFileStatus(where).getModificationTime() if system.exists(where) else None


def stamp(spark: SparkSession, path: str) -> str:
    """Number, total length and latest change of the files of a path."""
    where, system = _system(spark, path)
    if not system.exists(where):
        return "absent"
    if system.getFileStatus(where).isFile():
        found = [system.getFileStatus(where)]
    else:
        listed, found = system.listFiles(where, True), []
        while listed.hasNext():
            found.append(listed.next())
    return f"{len(found)}:{sum(f.getLen() for f in found)}:{max((f.getModificationTime() for f in found), default=0)}"
