"""One commit for all tables of a run.

A run writes its tables into a folder of its own and then commits them by a manifest, a small file that appears in one step.
Readers look up the latest manifest first, so they see all tables of one run: the earlier one until the new manifest is there,
also when a run breaks off between its tables. Manifests are numbered; of two runs that commit at the same time each takes a
number of its own. Old runs stay readable until `vacuum` deletes them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RUNS, MANIFESTS = "_runs", "_manifests"


class _Files:
    """Whole small files, through the file system that tables lie in."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        place = self._path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(place)) if self.fs.exists(place) else []

    def age_s(self, path: str) -> float:
        return time.time() - self.fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """False if the file is there already."""
        try:
            stream = self.fs.create(self._path(path), False)
        except Py4JJavaError as error:
            if self.fs.exists(self._path(path)):
                return False
            raise error
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


def _numbers(files: _Files, path: str) -> list[int]:
    return [int(n[:-5]) for n in files.names(f"{path}/{MANIFESTS}") if n.endswith(".json")]


def history(spark: SparkSession, path: str) -> list[dict[str, Any]]:
    """All manifests that are there, the oldest first."""
    files = _Files(spark, path)
    return [json.loads(files.read(f"{path}/{MANIFESTS}/{n:012d}.json")) for n in _numbers(files, path)]


def committed(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The latest manifest: number, run, note, and the schema of each table; None before the first commit."""
    files = _Files(spark, path)
    numbers = _numbers(files, path)
    return json.loads(files.read(f"{path}/{MANIFESTS}/{numbers[-1]:012d}.json")) if numbers else None


def read_committed(spark: SparkSession, path: str, name: str, manifest: dict[str, Any] | None = None) -> DataFrame | None:
    """A table of the latest run, or of that of a manifest; None where no run with this table has been committed. Take one
    manifest for several tables, so that they are of the same run."""
    manifest = manifest or committed(spark, path)
    if manifest is None or name not in manifest["tables"]:
        return None
    schema = T.StructType.fromJson(manifest["tables"][name])
    return spark.read.schema(schema).parquet(f"{path}/{RUNS}/{manifest['run']}/{name}")


def commit_tables(spark: SparkSession, path: str, write: Callable[[str], None], names: Sequence[str], note: str = "") -> dict[str, Any]:
    """`write` is given a folder and writes the named tables into folders of it; then they are committed together. What it
    raises passes through, and nothing is committed. Returns the manifest."""
    files = _Files(spark, path)
    run = uuid.uuid4().hex
    folder = f"{path}/{RUNS}/{run}"
    write(folder)
    tables = {}
    for name in names:
        if not [n for n in files.names(f"{folder}/{name}") if n.endswith(".parquet") or "=" in n]:
            spark.createDataFrame([], "empty string").write.mode("overwrite").parquet(f"{folder}/{name}")  # a table without any row
        tables[name] = spark.read.parquet(f"{folder}/{name}").schema.jsonValue()
    number = max(_numbers(files, path), default=0) + 1
    while not files.create(f"{path}/{MANIFESTS}/{number:012d}.taken", run):
        number += 1
    manifest = {"number": number, "run": run, "note": note, "tables": tables}
    draft = f"{path}/{MANIFESTS}/{run}.draft"
    files.create(draft, json.dumps(manifest))
    files.rename(draft, f"{path}/{MANIFESTS}/{number:012d}.json")  # from here on readers see the run
    return manifest


def vacuum(spark: SparkSession, path: str, keep: int = 2, abandoned_s: float = 7 * 86400) -> list[str]:
    """Delete the tables of all but the last `keep` committed runs, and of runs that were never committed and are older than
    `abandoned_s`. Returns the deleted runs."""
    files = _Files(spark, path)
    known = history(spark, path)
    kept = {m["run"] for m in known[-max(1, keep) :]}
    old = {m["run"]: m["number"] for m in known if m["run"] not in kept}
    gone = []
    for run in files.names(f"{path}/{RUNS}"):
        if run in old or (run not in kept and files.age_s(f"{path}/{RUNS}/{run}") > abandoned_s):
            if run in old:  # first out of the readers' sight
                files.delete(f"{path}/{MANIFESTS}/{old[run]:012d}.json")
            files.delete(f"{path}/{RUNS}/{run}")
            gone.append(run)
    return gone
