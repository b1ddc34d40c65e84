"""File-system steps of the batch protocol, on whatever file system the session's paths name."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory, sorted; none if it does not exist."""
    fs, p = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Data files below a directory at any depth, as full paths."""
    fs, p = _resolve(spark, path)
    found, out = fs.listFiles(p, True), []
    while found.hasNext():
        file = found.next().getPath()
        if not file.getName().startswith(("_", ".")):
            out.append(file.toString())
    return sorted(out)


def is_empty(spark: SparkSession, path: str) -> bool:
    return not child_names(spark, path)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a directory; False if it is not there (any more)."""
    fs, p = _resolve(spark, source)
    if not fs.exists(p):
        return False
    _, t = _resolve(spark, target)
    fs.mkdirs(t.getParent())
    if not fs.rename(p, t):
        raise OSError(f"could not move {source} to {target}")
    return True


def make(spark: SparkSession, path: str) -> None:
    """Make an empty directory, and those above it."""
    fs, p = _resolve(spark, path)
    if not fs.mkdirs(p):
        raise OSError(f"could not make {path}")


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.delete(p, True)
