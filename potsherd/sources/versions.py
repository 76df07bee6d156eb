"""Folders of versions: what a version consists of stands in one small file, which appears whole or not at all.

Readers follow the last such file, so they see the state before a write or after it, never half of it. A write that dies
leaves folders that no file names; the same version written again writes them anew. One writer at a time is assumed, as a
stream's batches come.
"""

from __future__ import annotations

import atexit
import json
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from potsherd.operators.hierarchy import checkpoints


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _path(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    files, where = _path(spark, path)
    files.delete(where, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder."""
    files, where = _path(spark, path)
    return files.getContentSummary(where).getLength() if files.exists(where) else 0


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    files, where = _path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()) if files.exists(where) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    files, where = _path(spark, f"{root}/versions")
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(int(n) for n in names if n.isdigit())


def commit(spark: SparkSession, root: str, version: int, told: dict) -> None:
    """Make ``told`` the version's content: written beside and then renamed, which a file system does at once."""
    files, draft = _path(spark, f"{root}/versions/_draft-{uuid.uuid4().hex}")
    out = files.create(draft, True)
    try:
        out.write(bytearray(json.dumps(told, sort_keys=True).encode()))
    finally:
        out.close()
    _, done = _path(spark, f"{root}/versions/{version:020d}")
    if not files.rename(draft, done):
        files.delete(draft, False)
        raise ValueError(f"version {version} of {root} is there already")


def content(spark: SparkSession, root: str, version: int | None = None, before: int | None = None) -> dict | None:
    """What a version consists of, the last one (before another) if none is named; null if there is none."""
    known = [v for v in versions(spark, root) if (version is None or v == version) and (before is None or v < before)]
    if not known:
        return None
    rows = spark.read.text(f"{root}/versions/{known[-1]:020d}", wholetext=True).collect()
    return json.loads(rows[0].value)


def forget(spark: SparkSession, root: str, keep: int = 2) -> list[dict]:
    """Delete all but the last ``keep`` version files; returns the contents of those that stay, for their folders are still in use."""
    known = versions(spark, root)
    for v in known[:-keep]:
        remove(spark, f"{root}/versions/{v:020d}")
    return [c for v in known[-keep:] if (c := content(spark, root, v)) is not None]


def publish(tables: dict[str, DataFrame], root: str) -> int:
    """Write several tables as the next version of ``root``: all of them are replaced at once, and only once all are written.

    A table may be read from the version before. What is not in ``tables`` stays as it was. Returns the version.
    """
    spark = next(iter(tables.values())).sparkSession
    older = content(spark, root) or {"tables": {}}
    version = max(versions(spark, root), default=-1) + 1
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/data/{version}/{name}")
    commit(spark, root, version, {"tables": older["tables"] | {name: f"data/{version}/{name}" for name in tables}})
    return version


def published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    told = content(spark, root, version)
    if told is None or name not in told["tables"]:
        raise ValueError(f"no published table {name} in {root}")
    return spark.read.parquet(f"{root}/{told['tables'][name]}")


_folders: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder, removed when Python ends."""
    place = f"{checkpoints(spark)}/{name}-{uuid.uuid4().hex}"
    _folders.append((spark, place))
    return place


@atexit.register
def _clean() -> None:
    for spark, place in _folders:
        try:
            remove(spark, place)
        except Exception:  # the session may be gone by now
            return
