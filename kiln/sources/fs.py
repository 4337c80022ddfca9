"""Small file-system helpers over the Hadoop FileSystem of the session.

They work the same for local paths, HDFS and object stores, because they go
through the Hadoop client Spark itself uses. Only metadata (names, sizes)
comes back to the driver, never data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    _, q = _fs(spark, dst)
    return bool(fs.rename(p, q))


def size_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """(file count, total bytes) of the data files under ``path``: one content
    summary, whatever the number of files."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0, 0
    s = fs.getContentSummary(p)
    done = fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    return int(s.getFileCount()) - int(done), int(s.getLength())


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
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def list_dirs(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of the sub-directories of ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(st.getPath().toString(), int(st.getModificationTime())) for st in fs.listStatus(p) if st.isDirectory()]
