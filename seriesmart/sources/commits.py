"""Numbered manifests that appear whole and once: the commits of a folder of tables.

A manifest is written aside under a name of its own and then given its number. On a local file
system that is a hard link, on HDFS and stores with its renames a rename that fails if the number is taken;
both are one step, so of two writers one gets the number, and a writer that dies leaves at most a file
that no reader looks at. Other stores (object stores) show a file only once it is whole, but cannot exclude a
second writer: there one writer at a time must see to it.
"""

import json
import os
import uuid

from pyspark.sql import SparkSession

FOLDER, ASIDE = "published", "_writing"
RENAMING = {"hdfs", "viewfs", "abfs", "abfss"}


class VersionTaken(Exception):
    """Another writer published this version first."""


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, path: str) -> list[str]:
    files, where = files_of(spark, path)
    return [item.getPath().getName() for item in files.listStatus(where)] if files.exists(where) else []


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The numbers that are taken."""
    found = (name.removesuffix(".json") for name in names_in(spark, f"{root}/{FOLDER}") if name.endswith(".json"))
    return sorted(int(name) for name in found if name.isdigit())


def content(spark: SparkSession, root: str, number: int) -> dict | None:
    """What a manifest says; None if it is gone, or is no whole manifest."""
    files, where = files_of(spark, f"{root}/{FOLDER}/{number}.json")
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def newest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The last whole manifest and its number; 0 and nothing if there is none."""
    for number in reversed(numbers(spark, root)):
        found = content(spark, root, number)
        if found is not None:
            return number, found
    return 0, {}


def put(spark: SparkSession, root: str, number: int, manifest: dict) -> None:
    """Publishes a manifest under its number; :class:`VersionTaken` if there is one."""
    text = json.dumps(manifest).encode()
    final = f"{root}/{FOLDER}/{number}.json"
    files, where = files_of(spark, final)
    files.mkdirs(where.getParent())
    scheme = files.getUri().getScheme()
    if scheme == "file":
        _link(where.toUri().getPath(), text)
    elif scheme in RENAMING:
        _rename(spark, root, final, text)
    elif files.exists(where):
        raise VersionTaken(final)
    else:
        _write(files, where, text)


def _link(final: str, text: bytes) -> None:
    folder, name = os.path.split(final)
    aside = f"{folder}/{ASIDE}"
    os.makedirs(aside, exist_ok=True)
    own = f"{aside}/{uuid.uuid4().hex}"
    with open(own, "wb") as file:
        file.write(text)
        file.flush()
        os.fsync(file.fileno())
    try:
        os.link(own, f"{folder}/{name}")
    except FileExistsError as problem:
        raise VersionTaken(final) from problem
    finally:
        os.unlink(own)


def _write(files, where, text: bytes) -> None:
    stream = files.create(where, False)
    stream.write(bytearray(text))
    stream.close()


def _rename(spark: SparkSession, root: str, final: str, text: bytes) -> None:
    files, own = files_of(spark, f"{root}/{FOLDER}/{ASIDE}/{uuid.uuid4().hex}")
    _write(files, own, text)
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    where = hadoop.Path(final)
    try:
        hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(own, where, how)
    except Exception as problem:
        files.delete(own, False)
        if files.exists(where):
            raise VersionTaken(final) from problem
        raise


def drop(spark: SparkSession, root: str, number: int) -> None:
    files, where = files_of(spark, f"{root}/{FOLDER}/{number}.json")
    files.delete(where, False)


def drop_old(spark: SparkSession, path: str, held: set[str], before_ms: int) -> list[str]:
    """Removes what a folder holds besides ``held``, unless it changed since; the names of what went."""
    files, where = files_of(spark, path)
    gone = []
    if files.exists(where):
        for item in files.listStatus(where):
            name = item.getPath().getName()
            if name not in held and item.getModificationTime() < before_ms:
                files.delete(item.getPath(), True)
                gone.append(name)
    return gone
