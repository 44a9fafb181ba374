"""Versioned sets of tables: every write is new files, a version is one entry.

``<folder>/data/<write>/<table>`` holds the Parquet files of one write and
``<folder>/versions/<number>.json`` names, for one version, the files of each
table.  An entry is written under a temporary name and renamed to the next free
number, which fails if another writer took it; the loser reads the new entry,
carries its tables over and tries again.  A reader opens one entry and so sees
one version whatever is written meanwhile.  A failed write leaves files that no
entry names; ``expire`` deletes them with those of old versions.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..scratch import remove_path


class NoSnapshot(LookupError):
    """The folder has no such version."""


def _store(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return jvm.org.apache.hadoop.fs.Path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _entry_path(folder: str, version: int) -> str:
    return f"{folder}/versions/{version:012d}.json"


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    path, fs = _store(spark, folder)
    at = path(f"{folder}/versions")
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _entry(spark: SparkSession, folder: str, version: int) -> dict:
    return json.loads(spark.read.text(_entry_path(folder, version), wholetext=True).first()["value"])


def _publish(spark: SparkSession, folder: str, version: int, entry: dict) -> bool:
    """Put the entry in place unless its number is taken."""
    path, fs = _store(spark, folder)
    temp = path(f"{folder}/versions/.entry-{uuid.uuid4().hex}")
    stream = fs.create(temp, False)
    stream.write(bytearray(json.dumps(entry).encode()))
    stream.close()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(temp, path(_entry_path(folder, version)), no_options)
    except Py4JJavaError as e:
        fs.delete(temp, False)
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


class Snapshot(Mapping):
    """The tables of one version by name; ``get`` of a missing table is None."""

    def __init__(self, spark: SparkSession, folder: str, version: int, tables: dict):
        self._spark, self._folder, self.version, self._tables = spark, folder, version, tables

    def __getitem__(self, name: str) -> DataFrame:
        t = self._tables[name]
        return self._spark.read.schema(StructType.fromJson(t["schema"])).parquet(f"{self._folder}/{t['path']}")

    def __iter__(self):
        return iter(sorted(self._tables))

    def __len__(self) -> int:
        return len(self._tables)


def open_snapshot(spark: SparkSession, folder: str, version: int | None = None) -> Snapshot:
    """The newest version, or the one asked for."""
    known = versions(spark, folder)
    if not known or version not in (None, *known):
        raise NoSnapshot(f"{folder}: no version" if version is None else f"{folder}: no version {version}")
    number = known[-1] if version is None else version
    return Snapshot(spark, folder, number, _entry(spark, folder, number)["tables"])


def read_marts_or_none(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame | None]:
    """The named tables of the newest version; None for each that is missing,
    and for all where nothing was committed yet."""
    try:
        snapshot = open_snapshot(spark, folder)
    except NoSnapshot:
        return dict.fromkeys(names)
    return {name: snapshot.get(name) for name in names}


def commit_tables(tables: dict[str, DataFrame], folder: str, inherit: bool = True, partition_by: dict[str, list[str]] | None = None,
                  attempts: int = 100) -> int:
    """Write the tables and commit them as one version; its number.

    With ``inherit`` tables of the version before that are not written again
    are part of the new one, without a copy.
    """
    if not tables:
        raise ValueError("no tables to write")
    spark = next(iter(tables.values())).sparkSession
    write = uuid.uuid4().hex
    own = {}
    for name, df in tables.items():
        df.write.partitionBy(*(partition_by or {}).get(name, [])).parquet(f"{folder}/data/{write}/{name}")
        own[name] = {"path": f"data/{write}/{name}", "schema": json.loads(df.schema.json())}
    for _ in range(attempts):
        known = versions(spark, folder)
        last = known[-1] if known else 0
        old = _entry(spark, folder, last)["tables"] if inherit and last else {}
        if _publish(spark, folder, last + 1, {"version": last + 1, "tables": {**old, **own}}):
            return last + 1
    raise RuntimeError(f"{folder}: other writers took {attempts} versions in a row")


def expire(spark: SparkSession, folder: str, keep: int = 2, min_age: float = 86_400.0) -> list[int]:
    """Delete all versions but the newest ``keep``, then every write that no kept
    version names and that is older than ``min_age`` seconds, so that a write not
    yet committed is left alone.  Readers of a deleted version fail from then on."""
    if keep < 1:
        raise ValueError("at least one version has to be kept")
    known = versions(spark, folder)
    gone = known[:-keep]
    for v in gone:
        remove_path(spark, _entry_path(folder, v))
    used = {t["path"].split("/")[1] for v in known[-keep:] for t in _entry(spark, folder, v)["tables"].values()}
    path, fs = _store(spark, folder)
    at = path(f"{folder}/data")
    for status in fs.listStatus(at) if fs.exists(at) else []:
        old = time.time() - status.getModificationTime() / 1000.0 >= min_age
        if old and status.getPath().getName() not in used:
            remove_path(spark, status.getPath().toString())
    return gone
