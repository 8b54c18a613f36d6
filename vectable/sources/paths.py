"""Small-file and directory calls on whatever file system a URI names.

Only descriptors (a few kB) and directory names pass through here; rows never do.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a directory holds; none if there is no such directory."""
    fs, p = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    if not fs.mkdirs(p):
        raise OSError(f"cannot create {path}")


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.delete(p, True)


def delete_empty(spark: SparkSession, path: str) -> None:
    """Delete the folder if nothing is in it."""
    fs, p = _resolve(spark, path)
    try:
        fs.delete(p, False)
    except Py4JJavaError as error:
        if not error.java_exception.getClass().getSimpleName().startswith("PathIsNotEmpty"):
            if fs.exists(p) and not fs.listStatus(p):
                raise


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as another process must name it."""
    fs, p = _resolve(spark, path)
    return fs.makeQualified(p).toString()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Create the file; an existing one is an error."""
    fs, p = _resolve(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put the file in the place of one of that name, in one step where the file system renames in one."""
    fs, target = _resolve(spark, path)
    hidden = target.getParent().suffix(f"/.{uuid.uuid4().hex}")
    write_new_text(spark, hidden.toString(), text)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    try:
        if fs.getUri().getScheme() == "file":
            # The checksum beside the old file would not fit the new one.
            source, place, checksum = [
                jvm.java.nio.file.Paths.get(p.toUri().getPath(), _no_parts(spark))
                for p in (hidden, target, target.getParent().suffix(f"/.{target.getName()}.crc"))
            ]
            jvm.java.nio.file.Files.deleteIfExists(checksum)
            moves = gateway.new_array(jvm.java.nio.file.CopyOption, 1)
            moves[0] = jvm.java.nio.file.StandardCopyOption.ATOMIC_MOVE
            jvm.java.nio.file.Files.move(source, place, moves)
        else:
            files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            renames = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            renames[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
            files.rename(hidden, target, renames)
    finally:
        fs.delete(hidden, False)


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with its whole content in one step; False if there is one of that name.

    The content is written under a name of its own, which is then linked (on a local file system) or
    renamed to ``path`` without overwriting: of writers that publish the same path one succeeds, and no
    reader sees a part.
    """
    fs, target = _resolve(spark, path)
    hidden = target.getParent().suffix(f"/.{uuid.uuid4().hex}")
    write_new_text(spark, hidden.toString(), text)
    jvm = spark._jvm
    try:
        if target.toUri().getScheme() in (None, "file") and fs.getUri().getScheme() == "file":
            local = [jvm.java.nio.file.Paths.get(p.toUri().getPath(), _no_parts(spark)) for p in (target, hidden)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            files.rename(hidden, target, options)
        return True
    except Py4JJavaError as error:
        kind = error.java_exception.getClass().getSimpleName()
        if kind in ("FileAlreadyExistsException", "FileExistsException"):
            return False
        raise
    finally:
        fs.delete(hidden, False)


def _no_parts(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
