"""A store that shows a run as a whole or not at all (K2 + K3 + K5 as one commit).

A run writes its snapshots, best-model rows and models under its own id:

    <store>/snapshots/run=<id>/refresh_date=<r>/   <store>/best/run=<id>/refresh_date=<r>/
    <store>/models/run=<id>/                       <store>/manifest/v00000007.json

Nothing reads them until the run is published: one small manifest, written aside and
renamed into place, says for every refresh which run holds it. Readers list the newest
manifest and open only the folders it names. So a run killed at any point leaves the
former state readable, a reader that started before a publication keeps a consistent
set of folders, and a rerun of a refresh replaces it as a whole (also families it no
longer has) without touching a file. Two runs that publish at once get consecutive
manifests: the rename fails for the second, which then builds on the first.

The newest or oldest refresh (S5, S6) is a key of the manifest, or the name of a folder of
a plainly partitioned table: no data file is opened to find it.
"""

from __future__ import annotations

import json
import time
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFEST = "manifest"
ATTEMPTS = 50


class _Files:
    """The file system of a path, through Hadoop's own classes."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def names(self, p: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        if not self.exists(p):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(p)))

    def age(self, p: str) -> float:
        return time.time() - self.fs.getFileStatus(self.path(p)).getModificationTime() / 1000

    def read(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, p: str, text: str) -> None:
        stream = self.fs.create(self.path(p), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def rename(self, a: str, b: str) -> bool:
        """Moves ``a`` to the new name ``b``; false if ``b`` exists."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(b).toUri(), self.conf)
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.path(a), self.path(b), none)
        except Exception:
            if self.exists(b):
                return False
            raise
        return True

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)


def _versions(files: _Files, store: str) -> list[str]:
    return [n for n in files.names(f"{store}/{MANIFEST}") if n.startswith("v") and n.endswith(".json")]


def manifest(spark: SparkSession, store: str) -> dict[str, str] | None:
    """Refresh -> run of the newest manifest; None where nothing was ever published."""
    files = _Files(spark, store)
    versions = _versions(files, store)
    return json.loads(files.read(f"{store}/{MANIFEST}/{versions[-1]}"))["refreshes"] if versions else None


def new_run() -> str:
    return uuid.uuid4().hex


def stage(df: DataFrame, store: str, table: str, run: str) -> None:
    """Writes a table of a run, by refresh; it can't be seen yet."""
    df.write.mode("errorifexists").partitionBy("refresh_date").parquet(f"{store}/{table}/run={run}")


def publish(spark: SparkSession, store: str, run: str, refreshes: list[str]) -> int:
    """Makes the refreshes of a staged run the ones that are read; returns the version."""
    files = _Files(spark, store)
    for _ in range(ATTEMPTS):
        versions = _versions(files, store)
        now = json.loads(files.read(f"{store}/{MANIFEST}/{versions[-1]}"))["refreshes"] if versions else {}
        version = int(versions[-1][1:-5]) + 1 if versions else 1
        aside = f"{store}/{MANIFEST}/.{run}-{version}"
        if files.exists(aside):
            files.delete(aside)
        files.write(aside, json.dumps({"refreshes": now | {r: run for r in refreshes}}, sort_keys=True))
        if files.rename(aside, f"{store}/{MANIFEST}/v{version:08d}.json"):
            return version
        files.delete(aside)
    raise RuntimeError(f"no manifest could be published in {store}: others publish all the time")


def refreshes(spark: SparkSession, path: str) -> list[str]:
    """Refreshes of a table, ascending, from the manifest beside it or else from its folders."""
    store = path.rstrip("/").rsplit("/", 1)[0]
    listed = manifest(spark, store)
    if listed is not None:
        return sorted(listed)
    prefix = "refresh_date="
    return sorted(unquote(n[len(prefix):]) for n in _Files(spark, path).names(path) if n.startswith(prefix))


def read(spark: SparkSession, path: str, schema: T.StructType, only: list[str] | None = None) -> DataFrame:
    """Rows of a table of the store (``only`` of these refreshes): the folders the newest
    manifest names, or an empty frame."""
    store, table = path.rstrip("/").rsplit("/", 1)
    listed = {r: run for r, run in (manifest(spark, store) or {}).items() if only is None or r in only}
    files = _Files(spark, store)
    held = {run: set(files.names(f"{store}/{table}/run={run}")) for run in set(listed.values())}
    folders = [f"{store}/{table}/run={run}/refresh_date={r}" for r, run in sorted(listed.items())
               if f"refresh_date={r}" in held[run]]  # a refresh without a row has no folder
    if not folders:
        return spark.createDataFrame([], schema)
    data = T.StructType([f for f in schema.fields if f.name != "refresh_date"])
    whole = T.StructType([*data.fields, T.StructField("run", T.StringType()), T.StructField("refresh_date", T.StringType())])
    found = spark.read.schema(whole).option("basePath", f"{store}/{table}").parquet(*folders)
    return found.select(*[f.name for f in schema.fields])


def models_path(spark: SparkSession, store: str, origin: str) -> str:
    """Folder of the models that made the published refresh ``origin``."""
    listed = manifest(spark, store) or {}
    if origin not in listed:
        raise FileNotFoundError(f"{store}: no published run of {origin}")
    return f"{store}/models/run={listed[origin]}"


def vacuum(spark: SparkSession, store: str, keep_versions: int = 2, min_age_s: float = 86_400.0) -> list[str]:
    """Deletes runs that none of the newest ``keep_versions`` manifests names and whose folders
    are older than ``min_age_s`` (younger ones may be at work), and older manifests. Returns
    the runs deleted."""
    files = _Files(spark, store)
    versions = _versions(files, store)
    kept = versions[-max(1, keep_versions):]
    named = {run for v in kept for run in json.loads(files.read(f"{store}/{MANIFEST}/{v}"))["refreshes"].values()}
    gone = set()
    for table in files.names(store):
        for name in files.names(f"{store}/{table}") if table != MANIFEST else []:
            run = name.removeprefix("run=")
            if name.startswith("run=") and run not in named and files.age(f"{store}/{table}/{name}") >= min_age_s:
                files.delete(f"{store}/{table}/{name}")
                gone.add(run)
    for v in versions[:-len(kept)] if kept else []:
        files.delete(f"{store}/{MANIFEST}/{v}")
    return sorted(gone)

