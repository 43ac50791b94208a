"""Small file-system operations on the driver, through Hadoop's API so that any
store Spark can reach works. For names and pointers only, never for data."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; empty if it does not exist."""
    p, fs = hadoop_path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def matches(spark: SparkSession, glob: str) -> bool:
    """Whether any path matches the pattern."""
    p, fs = hadoop_path(spark, glob)
    found = fs.globStatus(p)
    return bool(found) and len(found) > 0


def read_small(spark: SparkSession, path: str) -> str:
    p, fs = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with ``text``; False if it exists already."""
    p, fs = hadoop_path(spark, path)
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def list_files(spark: SparkSession, glob: str) -> list[tuple[str, int]]:
    """(path, length) of the files that match a pattern; names and sizes only."""
    p, fs = hadoop_path(spark, glob)
    return [(s.getPath().toString(), s.getLen()) for s in (fs.globStatus(p) or []) if s.isFile()]


def publish(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a finished file to its public name, replacing what has that name
    in one step where the store can (as HDFS and local file systems do)."""
    a, fs = hadoop_path(spark, src)
    b, _ = hadoop_path(spark, dst)
    if not fs.exists(b):
        if fs.rename(a, b):
            return
        if not fs.exists(b):
            raise OSError(f"{src} could not be renamed to {dst}")
    jvm = spark._jvm
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(a.toUri(), spark._jsc.hadoopConfiguration()).rename(a, b, overwrite)


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.mkdirs(p)
