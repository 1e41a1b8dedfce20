"""Looking at storage through the session's own file system layer."""

from __future__ import annotations

import codecs

from pyspark.sql import SparkSession

READ_BYTES = 1 << 16


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever storage the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_finished(spark: SparkSession, path: str) -> bool:
    """Whether a full write of a folder has been committed.

    Dynamic partition overwrites leave no such mark; ask :func:`path_exists` there.
    """
    return path_exists(spark, f"{path}/_SUCCESS")


def remove_empty(spark: SparkSession, path: str) -> None:
    """Deletes a folder that holds nothing but the mark of a finished write.

    A folder that another write is filling at the same time is not empty, and stays.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    storage = target.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in storage.listStatus(target)]
    if set(names) <= {"_SUCCESS"}:
        for name in names:
            storage.delete(spark._jvm.org.apache.hadoop.fs.Path(target, name), False)
        storage.delete(target, False)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; nothing in it is opened."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    storage = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in storage.listStatus(target))


def first_bytes(spark: SparkSession, path: str, most: int) -> bytes:
    """The beginning of a file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(stream.readNBytes(most))
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """The first line that is not blank, without its end; empty if there is none.

    Compressed files are read through the codec that their suffix names. No more is read than the
    line needs, in steps of ``READ_BYTES``.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    stream = target.getFileSystem(conf).open(target)
    try:
        codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
        if codec is not None:
            stream = codec.createInputStream(stream)
        decoder = codecs.getincrementaldecoder(encoding)("replace")
        text = ""
        while True:
            part = bytes(stream.readNBytes(READ_BYTES))
            *lines, text = (text + decoder.decode(part, final=not part)).split("\n")
            for line in lines if part else [*lines, text]:
                line = line.removeprefix("\ufeff").rstrip("\r")
                if line.strip():
                    return line
            if not part:
                return ""
    finally:
        stream.close()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of intermediate data, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
