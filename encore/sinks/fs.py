"""Minimal file-system operations through the Hadoop FileSystem API, so the
same code works on HDFS, object stores and local disk."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-directories (empty when path is absent)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    jvm = spark.sparkContext._jvm
    return bool(fs.rename(p, jvm.org.apache.hadoop.fs.Path(dst)))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    """Recursive delete (a no-op when absent)."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def modified_ms(spark: SparkSession, path: str) -> int | None:
    """Modification time (epoch ms), or None when absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    return int(fs.getFileStatus(p).getModificationTime())


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Full names of the data files that a path or glob stands for, sorted
    (names that begin with '_' or '.' are left out, as Spark's readers do)."""
    fs, p = _fs(spark, pattern)
    found, todo = [], list(fs.globStatus(p) or [])
    while todo:
        s = todo.pop()
        name = s.getPath().getName()
        if name[:1] in ("_", "."):
            continue
        if s.isDirectory():
            todo.extend(fs.listStatus(s.getPath()))
        else:
            found.append(s.getPath().toString())
    return sorted(found)


def head(spark: SparkSession, path: str, size: int) -> bytes:
    """The first ``size`` bytes of a file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()
