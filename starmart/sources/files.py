"""Folders and small files of any file system that Spark can reach."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path in its form."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def url_path(spark: SparkSession, path: str) -> str:
    """The path without scheme and host, in the form in which Spark names files."""
    system, where = _at(spark, path)
    return system.makeQualified(where).toUri().getRawPath()


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, in order; none if it does not exist."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return []
    return sorted(found.getPath().getName() for found in system.listStatus(where))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target must not exist yet."""
    system, where = _at(spark, source)
    _, to = _at(spark, target)
    if system.exists(to):
        raise FileExistsError(target)
    system.mkdirs(to.getParent())
    if not system.rename(where, to):
        raise OSError(f"{source} cannot be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder if it exists."""
    system, where = _at(spark, path)
    system.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, as a whole."""
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears as a whole: written beside its place, then renamed to it."""
    system, where = _at(spark, f"{path}.new")
    stream = system.create(where, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    remove(spark, path)
    move(spark, f"{path}.new", path)
