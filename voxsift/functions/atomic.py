"""Small files that appear whole and once, in any file system Spark can write to.

A numbered file that can be created only once is all that stored runs need:
whoever creates the next number has won, everybody else looks again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_ATTEMPTS = 100


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, in order; hidden and unfinished ones are left out."""
    place, fs = _place(spark, folder)
    if not fs.exists(place):
        return []
    found = (status.getPath().getName() for status in fs.listStatus(place))
    return sorted(name for name in found if not name.startswith((".", "_")))


def read_text(spark: SparkSession, path: str) -> str:
    place, fs = _place(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with its whole content, or return False if it is there already.

    The content is written aside first. It takes its name by a hard link on local
    disks, and by a rename that never overwrites elsewhere; both fail if the name is taken.
    """
    place, fs = _place(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    try:
        if fs.getUri().getScheme() == "file":
            local = lambda p: jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri())
            jvm.java.nio.file.Files.createLink(local(place), local(aside))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(fs.makeQualified(aside), fs.makeQualified(place), never)
        return True
    except Exception:
        if not fs.exists(place):
            raise
        return False
    finally:
        fs.delete(aside, False)


def put_next(spark: SparkSession, folder: str, content: Callable[[str | None], str]) -> str:
    """Create the next numbered file of a folder; returns its text.

    ``content`` gets the text of the file before it (None for the first one). If
    somebody else takes the number meanwhile, it is asked again with their text.
    """
    for _ in range(_ATTEMPTS):
        taken = names(spark, folder)
        text = content(read_text(spark, f"{folder}/{taken[-1]}") if taken else None)
        number = int(taken[-1]) + 1 if taken else 1
        if put_if_absent(spark, f"{folder}/{number:012d}", text):
            return text
    raise RuntimeError(f"{folder}: others took the next number {_ATTEMPTS} times")


def latest(spark: SparkSession, folder: str) -> str | None:
    """The text of the file with the highest number."""
    taken = names(spark, folder)
    return read_text(spark, f"{folder}/{taken[-1]}") if taken else None
