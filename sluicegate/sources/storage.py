"""Folder probes through the session's Hadoop file system (HDFS, object stores, local disks)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def child_names(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names of the sub-folders ``prefix*``, in order; one listing."""
    fs, path = _file_system(spark, folder)
    if not fs.exists(path):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(path))
    return sorted(n for n in names if n.startswith(prefix))


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Was the write to this folder committed? A failed job leaves no ``_SUCCESS``."""
    fs, marker = _file_system(spark, f"{folder}/_SUCCESS")
    return fs.exists(marker)


def completed(spark: SparkSession, folder: str, names: Sequence[str]) -> list[str]:
    """Those of the sub-folders that are complete, asked for a few at a time."""
    with ThreadPoolExecutor(16) as pool:
        complete = list(pool.map(lambda n: is_complete(spark, f"{folder}/{n}"), names))
    return [n for n, c in zip(names, complete) if c]


def replace_folder(spark: SparkSession, new: str, old: str) -> None:
    """Put a complete folder in another's place. The old one steps aside first and goes when the new one is there;
    if the second move fails it comes back."""
    fs, source = _file_system(spark, new)
    target, aside = (_file_system(spark, p)[1] for p in (old, f"{new}-replaced"))
    there = fs.exists(target)
    if there and not fs.rename(target, aside):
        raise OSError(f"{old} could not be moved aside")
    if not fs.rename(source, target):
        if there:
            fs.rename(aside, target)
        raise OSError(f"{new} could not be moved to {old}")
    if there:
        fs.delete(aside, True)


def remove_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def modified(spark: SparkSession, path: str) -> int:
    """When the file or folder was last changed, in milliseconds."""
    fs, at = _file_system(spark, path)
    return fs.getFileStatus(at).getModificationTime()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole."""
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file with this content if there is none; says whether it did.

    The content is written under a name of its own first and then given the name asked for, which fails where another
    has taken it: nobody sees half a file, and of two writers one is told that it came too late. HDFS and local
    disks do that in one step; an object store needs conditional writes for it.
    """
    fs, at = _file_system(spark, path)
    folder, _, _ = path.rpartition("/")
    _, beside = _file_system(spark, f"{folder}/_new-{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    jvm = spark._jvm
    none = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, at, none)
    except Py4JJavaError as error:
        fs.delete(beside, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True
