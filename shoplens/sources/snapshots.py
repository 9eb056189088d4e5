"""A table whose parts are replaced together, in one step.

A snapshot folder holds data folders, which are written once and never
changed, and numbered manifests.  A manifest names the folder of every part
(a month, a bucket, ...); the highest-numbered manifest is the table.  A
change writes new data folders first and then one new manifest, put in place
by a rename that fails where that number exists.  So a reader sees all of a
change or nothing of it, a part that lost all its rows is gone from the new
manifest, a killed write leaves the old table (its data folders are named by
no manifest), and of two writers at a time one gets :class:`SnapshotConflict`.

Paths go through Hadoop's file systems, so the folder may lie in any store
that Spark reads; the store must rename files atomically.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

PART = "snapshot_part"
_KEY = re.compile(r"[A-Za-z0-9][A-Za-z0-9.-]*\Z")
_MANIFEST = re.compile(r"(\d{12})\.json\Z")


class SnapshotConflict(RuntimeError):
    """Another writer has changed the table since this one read it."""


class _Files:
    """The few file operations a snapshot needs, by Hadoop's file system of the folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.gateway, self.jvm = spark.sparkContext._gateway, spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def statuses(self, folder: str) -> list:
        at = self.path(folder)
        return list(self.fs.listStatus(at)) if self.fs.exists(at) else []

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.statuses(folder)]

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """Write a file in one step; FileExistsError where it is there already."""
        folder, name = path.rsplit("/", 1)
        scratch, target = self.path(f"{folder}/.{name}.{uuid.uuid4().hex}"), self.path(path)
        stream = self.fs.create(scratch, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        plain = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.makeQualified(target).toUri(), self.conf)
        try:
            context.rename(scratch, target, plain)
        except Exception as exc:
            self.fs.delete(scratch, False)
            if self.fs.exists(target):
                raise FileExistsError(path) from exc
            raise

    def remove(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


class SnapshotTable:
    """The table stored in one snapshot folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = _Files(spark, self.root)

    # --- reading

    def versions(self) -> list[int]:
        found = map(_MANIFEST.match, self.files.names(f"{self.root}/manifests"))
        return sorted(int(m[1]) for m in found if m)

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of ``version`` (default: the newest), None for a table that was never written."""
        versions = self.versions()
        if version is None:
            if not versions:
                return None
            version = versions[-1]
        elif version not in versions:
            raise ValueError(f"no version {version} in {self.root}")
        return json.loads(self.files.read(self._manifest_path(version)))

    def exists(self) -> bool:
        return bool(self.versions())

    def parts(self, version: int | None = None) -> list[str]:
        return sorted((self.manifest(version) or {"parts": {}})["parts"])

    def notes(self, version: int | None = None) -> dict:
        """What the writer noted about the table, e.g. the parameters it was built with."""
        return (self.manifest(version) or {"notes": {}})["notes"]

    def read(self, parts: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """The table, or the named parts of it (those it has); other parts' files are not listed.

        The frame stays on the version found now, whatever is written later.
        """
        manifest = self.manifest(version)
        if manifest is None:
            raise ValueError(f"no snapshot in {self.root}")
        wanted = manifest["parts"] if parts is None else [p for p in parts if p in manifest["parts"]]
        return self.read_staged({p: manifest["parts"][p] for p in wanted}, T.StructType.fromJson(manifest["schema"]))

    def read_staged(self, staged: dict[str, str], schema: T.StructType) -> DataFrame:
        paths = [f"{self.root}/{folder}" for folder in staged.values()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # --- writing

    def stage(self, rows: DataFrame, part: Column, order: list[Column] | None = None) -> dict[str, str]:
        """Write rows by part into a fresh data folder; a commit makes them part of the table.

        ``part`` must give a name of letters, digits, dots and dashes.  Rows
        of a part are brought together, a large part over several files; with
        ``order`` each file is sorted.
        """
        folder = f"data/{uuid.uuid4().hex}"
        named = rows.withColumn(PART, part.cast("string")).hint("rebalance", PART)
        if order:
            named = named.sortWithinPartitions(PART, *order)
        named.write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        keys = [n.split("=", 1)[1] for n in self.files.names(f"{self.root}/{folder}") if n.startswith(f"{PART}=")]
        odd = [k for k in keys if not _KEY.match(k)]
        if odd:
            raise ValueError(f"not a part name: {odd[0]}")
        return {k: f"{folder}/{PART}={k}" for k in keys}

    def commit(
        self,
        staged: dict[str, str],
        schema: T.StructType,
        replaced: Iterable[str] | None,
        base: dict | None,
        notes: dict | None = None,
    ) -> int:
        """Switch to ``base`` without the parts ``replaced`` (None: all) and with the staged ones."""
        kept = {} if replaced is None or base is None else {k: v for k, v in base["parts"].items() if k not in set(replaced)}
        if kept.keys() & staged.keys():
            raise ValueError(f"rows outside the replaced parts: {sorted(kept.keys() & staged.keys())[0]}")
        if kept and T.StructType.fromJson(base["schema"]) != schema:
            raise ValueError("the rows' columns differ from the table's; write it anew as a whole")
        version = 1 + (base["version"] if base else 0)
        manifest = {
            "version": version,
            "schema": json.loads(schema.json()),
            "notes": notes if notes is not None else (base or {}).get("notes", {}),
            "parts": kept | staged,
        }
        try:
            self.files.put(self._manifest_path(version), json.dumps(manifest, indent=1, sort_keys=True))
        except FileExistsError as exc:
            raise SnapshotConflict(f"version {version} of {self.root} was written by another job") from exc
        return version

    def replace(self, rows: DataFrame, part: Column, replaced: Iterable[str] | None = None, notes: dict | None = None) -> int:
        """Replace the named parts (None: the whole table) by ``rows``; a named part without rows is gone."""
        base = self.manifest()
        return self.commit(self.stage(rows, part), nullable(rows.schema), replaced, base, notes)

    def vacuum(self, keep: int = 2, older_than_hours: float = 24) -> int:
        """Remove what the newest ``keep`` manifests do not name; returns the folders removed.

        Folders younger than ``older_than_hours`` stay: a job may be writing them.
        """
        if keep < 1:
            raise ValueError("the newest version is always kept")
        versions, before = self.versions(), (time.time() - 3600 * older_than_hours) * 1000
        used = {folder for v in versions[-keep:] for folder in self.manifest(v)["parts"].values()}
        for v in versions[:-keep]:
            self.files.remove(self._manifest_path(v))
        removed = 0
        for status in self.files.statuses(f"{self.root}/data"):
            if status.getModificationTime() > before:
                continue
            folder = f"data/{status.getPath().getName()}"
            parts = [f"{folder}/{n}" for n in self.files.names(f"{self.root}/{folder}")]
            if not used & set(parts):
                self.files.remove(f"{self.root}/{folder}")
                removed += 1
                continue
            for unused in set(parts) - used:
                if f"/{PART}=" in unused:
                    self.files.remove(f"{self.root}/{unused}")
                    removed += 1
        return removed

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:012d}.json"


def nullable(schema: T.StructType) -> T.StructType:
    """The schema as Parquet gives it back: every column may be NULL."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
