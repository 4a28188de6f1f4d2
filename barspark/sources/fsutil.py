"""Path helpers that work on any Hadoop file system (local, HDFS, object stores).

Used for existence checks and the small manifest files that make a new table version visible in
one step; data itself is always read and written by Spark.
"""

from __future__ import annotations

import contextlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Open scratch scopes (innermost last): paths created while a scope is open are removed when it
# closes.  Only jobs whose actions finish inside the scope use one; lazily returned DataFrames
# must not read tables of a closed scope.
_SCOPES: list[list[str]] = []


def join(base: str, *parts: str) -> str:
    out = base.rstrip("/")
    for p in parts:
        out = f"{out}/{p.strip('/')}"
    return out


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write to a temporary sibling, then rename to a new name; ``FileExistsError`` if the name is taken.

    The rename itself refuses a taken name where the file system can (``FileContext`` without overwrite), so of
    two writers one fails.
    """
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    if fs.exists(p):
        raise FileExistsError(path)
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not _rename_new(spark, fs, tmp, p):
        fs.delete(tmp, False)
        raise FileExistsError(path)


def _rename_new(spark: SparkSession, fs, source, target) -> bool:
    """Rename to a name that is free; false if it is not (any more)."""
    jvm = spark.sparkContext._jvm
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    except Py4JJavaError:  # a store without a FileContext: its own rename
        return bool(fs.rename(source, target))
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), no_overwrite)
    except Py4JJavaError as exc:
        if "FileAlreadyExists" in exc.java_exception.getClass().getName():
            return False
        raise
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """``create_text`` that replaces an older file (for files that a retry rewrites with the same name)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, False)
    create_text(spark, path, text)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of a small pointer file, read on the driver without a Spark job."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text.strip()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a machine-local temp dir)."""
    from barspark.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark)
    path = join(base, "barspark-scratch", f"{name}-{uuid.uuid4().hex}")
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch tables created inside the block once it has finished."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.pop()
        for path in paths:
            remove(spark, path)
