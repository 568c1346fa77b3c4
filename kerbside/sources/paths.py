"""Metadata-only questions to the file system of a path, and the removal of folders."""

from __future__ import annotations

from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Entry(NamedTuple):
    """One file or folder of a listing; a folder has no length. Times are milliseconds of the epoch."""

    path: str
    name: str
    is_folder: bool
    length: int
    modified: int

    @property
    def identity(self) -> str:
        """What changes when the file is written again."""
        return f"{self.path}|{self.length}|{self.modified}"


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def entries(spark: SparkSession, pattern: str) -> list[Entry]:
    """What matches ``pattern``, sorted by path; one listing call, no file is opened."""
    fs, path = _open(spark, pattern)
    found = [
        Entry(
            s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime()
        )
        for s in fs.globStatus(path) or []
    ]
    return sorted(found)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching ``pattern``, sorted."""
    return [e.path for e in entries(spark, pattern)]


def data_files(spark: SparkSession, path: str) -> list[Entry]:
    """The parquet files of ``path``: itself, or those directly in the folder."""
    inside = entries(spark, f"{path.rstrip('/')}/*.parquet")
    return [e for e in inside or entries(spark, path) if not e.is_folder]


def exists(spark: SparkSession, path: str) -> bool:
    return bool(glob(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a whole folder; nothing happens when there is none."""
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another place; what is above it is made."""
    fs, source = _open(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file whole."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that is not there yet; False when it is."""
    fs, hadoop_path = _open(spark, path)
    if fs.exists(hadoop_path):
        return False
    try:
        stream = fs.create(hadoop_path, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception.getClass().getName()):
            raise
        return False
    stream.write(bytearray(text.encode()))
    stream.close()
    return True
