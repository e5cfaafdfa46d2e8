"""All-or-nothing publication of several tables.

A run stages each output as Parquet under a new version folder. Publishing then writes one small manifest that names
the current folder of every table, or of every date of a dated table. Readers follow the newest manifest, so they see
all outputs of a run or none, and a run that dies halfway leaves no trace in what they read. A rerun of a streaming
batch that is already in the manifest does nothing.

Runs may overlap. A finished manifest gets its version number by a rename that fails when the number is taken; the run
then builds on the newer manifest, unless that one has changed an output that this run replaces as well.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from beaconlake.functions.clock import epoch_ms

_MANIFEST = "kind string, name string, part string, path string"


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder of any Hadoop file system; none when it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []


def modified_ms(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.getFileStatus(folder).getModificationTime()


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder in one step; False when the target exists."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    context = hadoop.FileContext.getFileContext(old.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(old, new, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


class ConflictingRuns(RuntimeError):
    """Another run has published an output that this run was about to replace."""


@dataclass(frozen=True)
class _Entry:
    kind: str  # 'table' or 'stream'
    name: str
    part: str  # 'column=value' of a dated table, '' for a table published whole
    path: str  # folder below the root; for a stream, its last batch id


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> list[int]:
        """Numbers of all manifests, newest first."""
        names = folder_names(self.spark, f"{self.root}/manifest")
        return sorted((int(name.split("=")[1]) for name in names if name.startswith("version=")), reverse=True)

    def _newest(self) -> int:
        """Newest complete manifest; one without its success marker belongs to a run that died."""
        for version in self._versions():
            if "_SUCCESS" in folder_names(self.spark, f"{self.root}/manifest/version={version}"):
                return version
        return 0

    def _entries(self, version: int) -> list[_Entry]:
        """Current manifest: one row per table or per date of a table, so its size follows the calendar."""
        if not version:
            return []
        rows = self.spark.read.schema(_MANIFEST).json(f"{self.root}/manifest/version={version}")
        return [_Entry(row.kind, row.name, row.part or "", row.path) for row in rows.collect()]

    def read(self, table: str, parts: list[str] | None = None) -> DataFrame | None:
        """Published rows of a table, or of some of its dates; None when there are none."""
        entries = [e for e in self._entries(self._newest()) if e.kind == "table" and e.name == table]
        if parts is not None:
            entries = [e for e in entries if e.part in parts]
        if not entries:
            return None
        paths = [f"{self.root}/{e.path}/{e.part}".rstrip("/") for e in entries]
        df = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*paths)
        return df.drop("version")

    def clean(self, now: datetime, grace: timedelta = timedelta(days=1)) -> list[str]:
        """Delete manifests and data folders that no reader of the last ``grace`` can need; returns the data folders.

        Folders younger than ``grace`` stay, as they may belong to a run that has not published yet.
        """
        limit = epoch_ms(now) - grace // timedelta(milliseconds=1)
        newest = self._newest()
        kept, old = {newest}, []
        for version in self._versions():
            path = f"{self.root}/manifest/version={version}"
            (old.append(path) if version < newest and modified_ms(self.spark, path) < limit else kept.add(version))
        used = {entry.path for version in kept for entry in self._entries(version)}
        dropped = []
        for table in folder_names(self.spark, self.root):
            for name in folder_names(self.spark, f"{self.root}/{table}"):
                path = f"{table}/{name}"
                stale = name.startswith("version=") and table != "manifest" and path not in used
                if stale and modified_ms(self.spark, f"{self.root}/{path}") < limit:
                    delete_folder(self.spark, f"{self.root}/{path}")
                    dropped.append(path)
        staged = [n for n in folder_names(self.spark, f"{self.root}/manifest") if n.startswith("_staged-")]  # of runs that died
        for path in [*old, *(f"{self.root}/manifest/{name}" for name in staged)]:
            if modified_ms(self.spark, path) < limit:
                delete_folder(self.spark, path)
        return dropped

    def begin(self, stream: str | None = None, batch: int | None = None) -> Run:
        return Run(self, stream, batch)


class Run:
    """Outputs of one run, invisible until ``publish``."""

    def __init__(self, store: Store, stream: str | None, batch: int | None):
        self.store, self.stream, self.batch = store, stream, batch
        self.base = self._published()
        self.entries = dict(self.base)
        # Runs that overlap never share a folder.
        self.folder = f"version={uuid.uuid4().hex}"

    def _published(self) -> dict[tuple[str, str, str], _Entry]:
        return {(e.kind, e.name, e.part): e for e in self.store._entries(self.store._newest())}

    @property
    def done(self) -> bool:
        """True when this streaming batch was published before a restart."""
        last = self.entries.get(("stream", self.stream, ""))
        return last is not None and int(last.path) >= self.batch

    def stage(self, table: str, df: DataFrame, part: str | None = None) -> None:
        """Write one output: dated by column ``part``, replacing those dates, or whole."""
        path = f"{table}/{self.folder}"
        target = f"{self.store.root}/{path}"
        if part is None:
            self.drop(table)
            df.write.mode("overwrite").parquet(target)
            self.entries[("table", table, "")] = _Entry("table", table, "", path)
            return
        df.write.mode("overwrite").partitionBy(part).parquet(target)
        for name in folder_names(self.store.spark, target):
            if name.startswith(f"{part}="):
                self.entries[("table", table, name)] = _Entry("table", table, name, path)

    def parts(self, table: str) -> list[str]:
        """Dates of a table as this run would publish it."""
        return sorted(part for kind, name, part in self.entries if (kind, name) == ("table", table))

    def drop(self, table: str, parts: list[str] | None = None) -> None:
        """Leave a table, or some of its dates, out of what this run publishes."""
        for key in [k for k in self.entries if k[:2] == ("table", table) and (parts is None or k[2] in parts)]:
            del self.entries[key]

    def _changes(self) -> dict[tuple[str, str, str], _Entry | None]:
        keys = self.base.keys() | self.entries.keys()
        return {key: self.entries.get(key) for key in keys if self.base.get(key) != self.entries.get(key)}

    def publish(self) -> None:
        if self.stream is not None:
            self.entries[("stream", self.stream, "")] = _Entry("stream", self.stream, "", str(self.batch))
        spark, root = self.store.spark, f"{self.store.root}/manifest"
        while True:
            rows = [(e.kind, e.name, e.part, e.path) for e in self.entries.values()]
            staged = f"{root}/_staged-{uuid.uuid4().hex}"
            spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.json(staged)
            number = max(self.store._versions(), default=0) + 1
            published = self._published()
            if published == self.base and renamed(spark, staged, f"{root}/version={number}"):
                self.base = dict(self.entries)
                return
            delete_folder(spark, staged)
            self._rebase(self._published())

    def _rebase(self, published: dict[tuple[str, str, str], _Entry]) -> None:
        """Put this run's changes on top of what others have published since it began."""
        changes = self._changes()
        clash = sorted(key[1:] for key in changes if published.get(key) != self.base.get(key))
        if clash:
            raise ConflictingRuns(f"published by another run meanwhile: {clash}")
        self.base = published
        merged = published | {key: entry for key, entry in changes.items() if entry is not None}
        self.entries = {key: entry for key, entry in merged.items() if key not in changes or changes[key] is not None}
