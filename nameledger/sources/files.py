"""A few calls on whatever file system a path names (local, HDFS, object store)."""

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def names_in(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file that must not exist yet: a hidden copy of its own, then one rename.

    Every writer has its own draft. HDFS refuses a rename onto an existing file, which makes the second of two
    writers fail. A local folder or an object store may overwrite instead: there, one writer at a time.
    """
    fs = _fs(spark, path)
    parent, name = path.rsplit("/", 1)
    draft = f"{parent}/.{name}.{uuid.uuid4().hex}.draft"
    stream = fs.create(_path(spark, draft), False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if exists(spark, path) or not fs.rename(_path(spark, draft), _path(spark, path)):
        delete_tree(spark, draft)
        raise FileExistsError(f"{path} was written by someone else")


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file, read by the file system itself: no job is run for it."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def bytes_in(spark: SparkSession, path: str) -> int:
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def delete_tree(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)
