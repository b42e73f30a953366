"""The few file system questions Spark's readers and writers cannot answer.

Uses the Hadoop file system of the running session, so it works on any store Spark can read.
Only names and sizes pass through the driver, never rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return bool(fs.exists(hadoop_path))


def is_complete(spark: SparkSession, path: str) -> bool:
    """A directory whose write job was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers N of the committed sub-directories `<prefix>N`, ascending."""
    names = [n for n in child_names(spark, path) if n.startswith(prefix)]
    numbers = sorted(int(n[len(prefix):]) for n in names if n[len(prefix):].isdigit())
    return [n for n in numbers if is_complete(spark, f"{path}/{prefix}{n}")]


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def write_text(spark: SparkSession, directory: str, name: str, text: str) -> None:
    """A small file that readers see as a whole or not at all; one of that name is replaced."""
    fs, target = _open(spark, f"{directory}/{name}")
    hidden = spark._jvm.org.apache.hadoop.fs.Path(f"{directory}/_{name}")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(hidden, target):
        raise OSError(f"could not write {directory}/{name}")


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.mkdirs(hadoop_path)
