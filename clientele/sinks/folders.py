"""Folders on any file system that Spark can write to: list, move, delete, and exchange one for another."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConflictError(RuntimeError):
    """Somebody else has written what this write was about to."""


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, in order; nothing where there is no folder."""
    system, place = _place(spark, path)
    return sorted(x.getPath().getName() for x in system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    system, place = _place(spark, target)
    system.mkdirs(place.getParent())
    if not system.rename(_place(spark, source)[1], place):
        raise OSError(f"{source} could not be moved to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _place(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole or not at all; of two writers of one name the second fails."""
    system, place = _place(spark, path)
    draft = f"{place.getParent()}/_draft-{uuid.uuid4().hex}"
    stream = system.create(_place(spark, draft)[1], False)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    whole = system.makeQualified(place)
    context = hadoop.FileContext.getFileContext(whole.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(_place(spark, draft)[1]), whole, no_options)
    except Py4JJavaError as error:
        remove(spark, draft)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise ConflictError(f"{path} is there already") from None
        raise


def replace_folder(spark: SparkSession, root: str, folder: str, write: Callable[[str], None]) -> None:
    """Exchange ``folder``, which lies under ``root``, for what ``write`` puts into the folder that it is given.

    The new content is written beside the old, under a name that readers skip. Only when that has ended without an error
    the old folder is moved aside, the new one into its place, and the old one deleted; a write that fails leaves the old
    content. Between the two moves there is neither; if they are cut short, the old content lies in ``_old-...``.
    """
    mark = uuid.uuid4().hex
    fresh, old = f"{root.rstrip('/')}/_new-{mark}", f"{root.rstrip('/')}/_old-{mark}"
    try:
        write(fresh)
    except Exception:
        remove(spark, fresh)
        raise
    replaced = exists(spark, folder)
    if replaced:
        move(spark, folder, old)
    try:
        move(spark, fresh, folder)
    except Exception:
        if replaced:
            move(spark, old, folder)
        raise
    if replaced:
        remove(spark, old)
