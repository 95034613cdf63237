"""Driver-side file-system questions, answered by the file system the path belongs to."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path is on the machine's own file system."""
    files, _ = _open(spark, path)
    return files.getUri().getScheme() == "file"


def is_file(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _open(spark, path)
    return files.exists(hadoop_path) and files.getFileStatus(hadoop_path).isFile()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern; none if the folder is missing."""
    files, hadoop_path = _open(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(hadoop_path) or []]


def exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _open(spark, path)
    return files.exists(hadoop_path)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file; its folder is created as well."""
    files, hadoop_path = _open(spark, path)
    files.create(hadoop_path, True).close()


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another place in the same file system."""
    files, hadoop_path = _open(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if not files.rename(hadoop_path, target):
        raise OSError(f"could not move {path} to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in place of whatever is there."""
    files, hadoop_path = _open(spark, path)
    stream = files.create(hadoop_path, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    files, hadoop_path = _open(spark, path)
    stream = files.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def literal(path: str) -> str:
    """`path` as a pattern that matches nothing but itself."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove a folder when the application ends. The folder is created if need be."""
    files, hadoop_path = _open(spark, path)
    files.mkdirs(hadoop_path)
    files.deleteOnExit(hadoop_path)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    files, hadoop_path = _open(spark, path)
    return files.getContentSummary(hadoop_path).getLength()


def files_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the Parquet files below a folder."""
    files, hadoop_path = _open(spark, path)
    found, number, size = files.listFiles(hadoop_path, True), 0, 0
    while found.hasNext():
        status = found.next()
        if status.getPath().getName().endswith(".parquet"):
            number, size = number + 1, size + status.getLen()
    return number, size


def delete(spark: SparkSession, path: str) -> None:
    files, hadoop_path = _open(spark, path)
    files.delete(hadoop_path, True)
