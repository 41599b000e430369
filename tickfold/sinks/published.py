"""Sets of folders that are published at once.

A writer puts each table of a set into a new folder and then adds one numbered
manifest to ``_published`` beside them.  A manifest appears by a rename that
fails where its number is taken, so readers see the set before it or the whole
new one, a writer that dies leaves the old set as it was, and of two writers
that started from the same set one is told so.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

FOLDER = "_published"
_NAME = re.compile(r"(\d{12})\.json")


class PublishedMeanwhile(RuntimeError):
    """Another writer has published since the set that this one started from."""


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    where, fs = _path(spark, path)
    fs.delete(where, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    where, fs = _path(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(where)) if fs.exists(where) else []


def current(spark: SparkSession, root: str) -> dict | None:
    """The last manifest of ``root`` (with its ``number``), or None."""
    root = root.rstrip("/")
    found = [m for m in map(_NAME.fullmatch, folders(spark, f"{root}/{FOLDER}")) if m]
    if not found:
        return None
    where, fs = _path(spark, f"{root}/{FOLDER}/{found[-1][0]}")
    stream = fs.open(where)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) | {"number": int(found[-1][1])}


def publish(spark: SparkSession, root: str, content: dict, after: dict | None) -> dict:
    """Add the manifest that follows ``after`` (what :func:`current` gave)."""
    root = root.rstrip("/")
    number = after["number"] + 1 if after else 1
    target, fs = _path(spark, f"{root}/{FOLDER}/{number:012d}.json")
    draft, _ = _path(spark, f"{root}/{FOLDER}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(draft, target, options)  # never replaces a manifest
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(target):
            raise PublishedMeanwhile(f"{root}: manifest {number} is there already") from e
        raise
    return content | {"number": number}


def resolve(spark: SparkSession, path: str) -> str:
    """Where the table ``path`` lies now: what the manifest beside it says, else ``path``."""
    root, _, name = path.rstrip("/").rpartition("/")
    found = current(spark, root) if root else None
    return ((found or {}).get("tables") or {}).get(name, path)
