"""The four tables as versions that are published together.

A version names parquet folders per table.  A load writes its rows into folders of its own,
and shows by one small file, its manifest, which is written last: readers get all four
tables of the version before or all four of the new one.  A load that fails, or whose driver
is lost, leaves folders that no manifest names; `remove_old` deletes them.

Plain replacing and appending (`sources.catalog`, `sources.files`) goes table by table.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from orderlens.model import LOAD_ORDER, SCHEMAS, Tables
from orderlens.operators.durable import file_system
from orderlens.plans.integrity import require_integrity
from orderlens.sources.files import conform

_MANIFESTS, _ROWS = "versions", "rows"


def publish_tables(tables: Tables, folder: str, verify: bool = True) -> int:
    """Write the four tables as a new version that replaces all rows; its number.

    With `verify`, a broken key, constraint or reference stops the load before anything
    is written.
    """
    if verify:
        require_integrity(tables)
    return _publish(tables, folder, {name: [] for name in LOAD_ORDER}, None)


def publish_appended(tables: Tables, folder: str, verify: bool = True) -> int:
    """Write a new version with the rows of the last one and these; its number.

    Only the new rows are written: the version names the folders of the last one too.
    With `verify`, the new rows are checked against each other and the stored ones
    before anything is written.
    """
    spark = tables.customers.sparkSession
    last = versions(spark, folder)[-1:]
    if not last:
        return publish_tables(tables, folder, verify)
    if verify:
        require_integrity(tables, stored=read_version(spark, folder, last[0]))
    return _publish(tables, folder, _manifest(spark, folder, last[0]), last[0])


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    return [n for n in _numbers(spark, folder) if _manifest(spark, folder, n) is not None]


def read_version(spark: SparkSession, folder: str, version: int | None = None) -> Tables:
    """The four tables of a version, by default the last."""
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        wanted = "a version" if version is None else f"version {version}"
        raise LookupError(f"no {wanted} of the tables in {folder!r}; there are {known}")
    named = _manifest(spark, folder, known[-1] if version is None else version)
    return Tables(**{
        name: spark.read.schema(SCHEMAS[name]).parquet(*[f"{folder}/{_ROWS}/{at}/{name}" for at in named[name]])
        for name in LOAD_ORDER
    })


def remove_old(spark: SparkSession, folder: str, keep: int = 1) -> None:
    """Delete all but the last `keep` versions, and every folder that none of those names.

    That includes the folders of a load under way: call it when there is none.
    """
    if keep < 1:
        raise ValueError("at least one version has to stay")
    kept = versions(spark, folder)[-keep:]
    named = {at for n in kept for folders in _manifest(spark, folder, n).values() for at in folders}
    # Manifests go first: no version ever names a folder that is gone.
    for n in _numbers(spark, folder):
        if n not in kept:
            path, files = file_system(spark, _manifest_path(folder, n))
            files.delete(path, False)
    for at in _names(spark, f"{folder}/{_ROWS}"):
        if at not in named:
            path, files = file_system(spark, f"{folder}/{_ROWS}/{at}")
            files.delete(path, True)


def _publish(tables: Tables, folder: str, before: dict[str, list[str]], last: int | None) -> int:
    spark = tables.customers.sparkSession
    number = max(_numbers(spark, folder), default=0) + 1
    at = uuid.uuid4().hex
    for name in LOAD_ORDER:
        conform(tables[name], name).write.parquet(f"{folder}/{_ROWS}/{at}/{name}")
    if last is not None and versions(spark, folder)[-1] != last:
        raise RuntimeError(f"another load published to {folder!r} meanwhile; nothing was changed, load again")
    text = json.dumps({name: before[name] + [at] for name in LOAD_ORDER})
    path, files = file_system(spark, _manifest_path(folder, number))
    try:
        # The file system lets one load create the file.
        stream = files.create(path, False)
    except Py4JJavaError as error:
        if files.exists(path):
            raise RuntimeError(f"another load published version {number} of {folder!r}; load again") from error
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return number


def _manifest_path(folder: str, number: int) -> str:
    return f"{folder}/{_MANIFESTS}/{number:08d}.json"


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, files = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = [n.removesuffix(".json") for n in _names(spark, f"{folder}/{_MANIFESTS}") if n.endswith(".json")]
    return sorted(int(n) for n in names if n.isdecimal())


def _manifest(spark: SparkSession, folder: str, number: int) -> dict[str, list[str]] | None:
    """The folders per table; None for a manifest whose writing was cut off."""
    path, files = file_system(spark, _manifest_path(folder, number))
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None
