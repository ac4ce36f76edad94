"""Folders and small files on whatever file system the session uses: layer paths, creation if absent, replacement by rename, scratch space."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def _locate(spark: SparkSession, path: str):
    """The Hadoop path and the file system that serves it."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    located, files = _locate(spark, path)
    return files.exists(located)


def folder_names(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names below ``path`` that match ``pattern``; none if there is no such folder."""
    located, files = _locate(spark, f"{path}/{pattern}")
    return sorted(status.getPath().getName() for status in files.globStatus(located) or [])


def read_file(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; none if there is no such file."""
    located, files = _locate(spark, path)
    if not files.exists(located):
        return None
    stream = files.open(located)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_age(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was last changed; 0 if it is gone."""
    located, files = _locate(spark, path)
    if not files.exists(located):
        return 0.0
    return time.time() - files.getFileStatus(located).getModificationTime() / 1000


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with ``text`` unless it exists; False if it does. Of several at once only one succeeds.

    ``text`` must differ between callers, so that a caller whose request was answered late knows its own file.
    """
    located, files = _locate(spark, path)
    if files.getScheme() == "file":
        return _linked(located.toUri().getPath(), text)
    try:
        stream = files.create(located, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
    except Py4JJavaError:
        held = read_file(spark, path)
        if held is None:
            raise
        return held == text
    return True


def _linked(path: str, text: str) -> bool:
    """A local file that gets its name, which must be free, when it is complete."""
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    unnamed = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(unnamed, "x") as file:
        file.write(text)
    try:
        os.link(unnamed, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(unnamed)
    return True


def sibling(path: str, role: str) -> str:
    """A fresh folder next to ``path``; the underscore hides it from readers of the parent folder."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_{role}-{name}-{uuid.uuid4().hex}"


def replace_folder(spark: SparkSession, incoming: str, target: str) -> None:
    """Put the finished folder ``incoming`` in the place of ``target``.

    The old content is set aside by one rename and the new content takes its place by another. Between the two the target does
    not exist, but the old content is complete beside it, and whoever writes next puts it back first
    (:func:`recover_folder`), so a process that dies at any point loses nothing. A
    rename never lands inside an existing folder: of two writers at once, one fails and its folder stays aside.
    """
    recover_folder(spark, target)
    aside = None
    if folder_exists(spark, target):
        aside = sibling(target, "outgoing")
        _rename(spark, target, aside)
    try:
        _rename(spark, incoming, target)
    except BaseException:
        if aside:
            recover_folder(spark, target)
        raise
    if aside:
        drop_folder(spark, aside)


def drop_folder(spark: SparkSession, path: str) -> None:
    located, files = _locate(spark, path)
    files.delete(located, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """A rename that fails if the target exists."""
    jvm = spark._jvm
    old, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        old.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration()
    )
    plainly = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(old, new, plainly)


def _set_aside(spark: SparkSession, path: str) -> str | None:
    """The newest old content of ``path`` that an interrupted swap left beside it."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    pattern, files = _locate(spark, f"{parent}/_outgoing-{name}-" + "[0-9a-f]" * 32)
    found = files.globStatus(pattern)
    newest = max(found or [], key=lambda status: status.getModificationTime(), default=None)
    return newest.getPath().toString() if newest else None


def recover_folder(spark: SparkSession, path: str) -> None:
    """Put back the content of ``path`` if a swap was interrupted after it had been set aside."""
    if not folder_exists(spark, path) and (aside := _set_aside(spark, path)):
        _rename(spark, aside, path)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, removed when the session's JVM ends.

    It lies under ``spark.checkpoint.dir``, or the checkpoint folder set on the context.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    path = f"{base.rstrip('/')}/rentmill-{label}-{uuid.uuid4().hex}"
    located, files = _locate(spark, path)
    files.mkdirs(located)
    files.deleteOnExit(located)
    return path


@contextmanager
def written_once(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as a table in scratch space, for several jobs to read instead of computing it again.

    The table goes when the block ends, so everything built on it must be stored by then.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, name)
    try:
        df.write.parquet(f"{folder}/{name}")
        yield spark.read.parquet(f"{folder}/{name}")
    finally:
        drop_folder(spark, folder)
