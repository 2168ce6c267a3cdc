"""Tables kept as snapshots: data first, then a manifest that names it.

A table is a folder with `data/<uuid>` per snapshot and `manifests/<number>.json`. A snapshot exists once its manifest
does, and readers follow manifests only, so a writer that dies leaves data that nobody sees and the snapshot before it
as it was. A manifest is created without overwriting: of two writers that build on the same snapshot one gets
`SnapshotConflict`, and its data is deleted. Everything goes through the file system that the path belongs to.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from shapelens.session import folder_of


class SnapshotConflict(RuntimeError):
    """Another writer has written a snapshot since this one read the table."""


@dataclass(frozen=True)
class Snapshot:
    number: int
    run: str
    folder: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.folder)


def _text(store, path) -> str:
    stream = store.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, object]]:
    store, root = folder_of(spark, f"{path}/manifests")
    found = []
    for status in store.listStatus(root) if store.exists(root) else []:
        name = re.fullmatch(r"(\d+)\.json", status.getPath().getName())
        if name:
            found.append((int(name[1]), status.getPath()))
    return sorted(found, key=lambda m: m[0])


def last_number(spark: SparkSession, path: str) -> int:
    """Number of the latest manifest, whole or not; 0 before the first."""
    return max((n for n, _ in _manifests(spark, path)), default=0)


def snapshots(spark: SparkSession, path: str) -> list[Snapshot]:
    """All snapshots, oldest first. A manifest that its writer did not finish names none."""
    store, _ = folder_of(spark, path)
    found = []
    for number, manifest in _manifests(spark, path):
        try:
            content = json.loads(_text(store, manifest))
        except json.JSONDecodeError:
            continue
        found.append(Snapshot(number, content["run"], f"{path}/data/{content['data']}"))
    return found


def current(spark: SparkSession, path: str, run: str | None = None) -> Snapshot | None:
    """The latest snapshot, or the latest one of `run`; None if there is none."""
    return next((s for s in reversed(snapshots(spark, path)) if run is None or s.run == run), None)


def write_snapshot(rows: DataFrame, path: str, run: str, after: int | None = None) -> Snapshot:
    """Write `rows` as the snapshot that follows number `after`: the latest one when writing begins, if not given.

    Pass the number of the snapshot that the rows were made from, so that what another writer has added meanwhile is a
    conflict and not lost.
    """
    spark = rows.sparkSession
    after = last_number(spark, path) if after is None else after
    data = uuid.uuid4().hex
    rows.write.parquet(f"{path}/data/{data}")
    store, manifest = folder_of(spark, f"{path}/manifests/{after + 1:012d}.json")
    try:
        out = store.create(manifest, False)
    except Py4JJavaError as error:
        if not error.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
            raise
        store.delete(folder_of(spark, f"{path}/data/{data}")[1], True)
        raise SnapshotConflict(f"snapshot {after + 1} of {path} has been written by another run") from None
    out.write(bytearray(json.dumps({"run": run, "data": data}).encode()))
    out.close()
    return Snapshot(after + 1, run, f"{path}/data/{data}")


def expire(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the last `keep` snapshots: the manifest first, so that no reader finds one without its data."""
    store, _ = folder_of(spark, path)
    manifests = dict(_manifests(spark, path))
    for old in snapshots(spark, path)[:-keep]:
        store.delete(manifests[old.number], False)
        store.delete(folder_of(spark, old.folder)[1], True)
