"""Tables under one root whose batches become visible together.

A batch writes every table to a folder of its own and then one small commit file that names the
folders. Readers take only folders that a commit names: they see all tables of a batch, or none. A
batch that is run again writes new folders, and its commit takes the place of the old one.

Compaction gathers the committed folders of a day into few large files per table and records, in a
snapshot, the last number folded of each writer; a folded batch that is run again adds nothing.
Folders that no commit names any more stay until `vacuum`, so that readers at work can finish.

Snapshots lie in a folder of their own, so that a batch need not list the commits before it. (Roots that were
begun without that folder have them among the commits.)

Files are reached through the Hadoop file system of the root; a commit is created under another
name and renamed, so it is either whole or not there. (While a batch's commit is replaced by that of a
new run, there is a moment without either.)
"""

import json
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from alarmloom.session import staging

COMMITS = "_commits"
SNAPSHOTS = "_snapshots"
SNAPSHOT = "snapshot"
BATCH_COLUMN = "batch_id"
FILE_BYTES = 128 << 20
# Wide rows that compress well make small files of much work: a file has no more values than a task writes
# in some ten seconds.
FILE_VALUES = 40_000_000


class _Files:
    """The few file operations that commits need."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(folder)))

    def size(self, folder: str) -> int:
        return self.fs.getContentSummary(self._path(folder)).getLength()

    def read(self, name: str) -> dict:
        stream = self.fs.open(self._path(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, name: str, content: dict) -> None:
        folder, last = name.rsplit("/", 1)
        hidden = f"{folder}/.{last}-{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(hidden))
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if self.exists(name):
            self.fs.delete(self._path(name), False)
        if not self.fs.rename(self._path(hidden), self._path(name)):
            raise RuntimeError(f"another writer holds {name}")

    def make(self, folder: str = "") -> None:
        self.fs.mkdirs(self._path(folder))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def _commit_name(writer: str, batch_id: int) -> str:
    return f"{COMMITS}/{writer}-{batch_id:012d}.json"


def _snapshots(files: _Files) -> list[str]:
    folder = _snapshot_folder(files)
    return [f"{folder}/{n}" for n in files.names(folder) if n.startswith(f"{SNAPSHOT}-")]


def _snapshot_folder(files: _Files) -> str:
    return SNAPSHOTS if files.exists(SNAPSHOTS) else COMMITS


def _make_folders(files: _Files) -> None:
    if not files.exists(COMMITS):
        files.make(SNAPSHOTS)
        files.make(COMMITS)


def _is_folded(files: _Files, batch_id: int, writer: str) -> bool:
    snapshots = _snapshots(files)
    return bool(snapshots) and batch_id <= files.read(snapshots[-1])["folded"].get(writer, -1)


def _state(files: _Files) -> tuple[dict, dict[str, dict]]:
    """The last snapshot, and the commits that are not part of it by file name."""
    snapshots = _snapshots(files)
    snapshot = files.read(snapshots[-1]) if snapshots else {"folded": {}, "tables": {}}
    commits = {}
    for name in files.names(COMMITS):
        if name.startswith((f"{SNAPSHOT}-", ".")):
            continue
        writer, number = name.removesuffix(".json").rsplit("-", 1)
        if int(number) > snapshot["folded"].get(writer, -1):
            commits[name] = files.read(f"{COMMITS}/{name}")
    return snapshot, commits


def make_folder(spark: SparkSession, path: str) -> None:
    """A folder that a reader may wait at before anything is in it."""
    _Files(spark, path).make("")


def uses_commits(spark: SparkSession, root: str) -> bool:
    return _Files(spark, root).exists(COMMITS)


def is_committed(spark: SparkSession, root: str, batch_id: int, writer: str = "batch") -> bool:
    files = _Files(spark, root)
    return files.exists(_commit_name(writer, batch_id)) or _is_folded(files, batch_id, writer)


def write_tables(
    spark: SparkSession,
    root: str,
    batch_id: int,
    tables: dict[str, DataFrame] | Iterator[tuple[str, DataFrame]],
    writer: str = "batch",
) -> None:
    """The rows of one batch for several tables, visible only once all of them are written.

    `writer` keeps the numbers of several writers of one root apart. A batch that compaction has
    folded is not written again.
    """
    files = _Files(spark, root)
    _make_folders(files)
    if _is_folded(files, batch_id, writer):
        return
    written = {}
    for table, rows in dict(tables).items():
        rows = rows.withColumn(BATCH_COLUMN, F.lit(int(batch_id)).cast("long"))
        folder = f"{table}/{writer}-{batch_id:012d}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{files.root}/{folder}")
        written[table] = {"folder": folder, "schema": rows.schema.json()}
    day = datetime.now(timezone.utc).date().isoformat()
    files.write(
        _commit_name(writer, batch_id), {"batch": int(batch_id), "day": day, "tables": written}
    )


def _folders(files: _Files, table: str, after: int | None = None) -> tuple[list[str], str | None]:
    """Folders of a table, without those of single batches up to number `after`, and its layout."""
    snapshot, commits = _state(files)
    known = snapshot["tables"].get(table, {"folders": [], "schema": None, "last": -1})
    schema = known["schema"]
    folders = list(known["folders"]) if after is None or known["last"] > after else []
    for commit in commits.values():
        if table in commit["tables"]:
            schema = commit["tables"][table]["schema"]
            if after is None or commit["batch"] > after:
                folders.append(commit["tables"][table]["folder"])
    return folders, schema


def has_table(spark: SparkSession, root: str, table: str) -> bool:
    return _folders(_Files(spark, root), table)[1] is not None


def last_batch(spark: SparkSession, root: str, table: str) -> int | None:
    """The highest batch number that has written the table."""
    snapshot, commits = _state(_Files(spark, root))
    found = [c["batch"] for c in commits.values() if table in c["tables"]]
    found += [snapshot["tables"][table]["last"]] if table in snapshot["tables"] else []
    return max(found, default=None)


def read_committed(
    spark: SparkSession, root: str, table: str, after: int | None = None
) -> DataFrame:
    """All committed rows of a table with the number of their batch, by the layout last written; with
    `after` only those of later batches."""
    files = _Files(spark, root)
    folders, schema = _folders(files, table, after)
    if schema is None:
        raise FileNotFoundError(f"nothing is committed for {table} in {root}")
    layout = StructType.fromJson(json.loads(schema))
    if not folders:
        return spark.createDataFrame([], layout)
    rows = spark.read.schema(layout).parquet(*[f"{files.root}/{f}" for f in folders])
    return rows if after is None else rows.filter(F.col(BATCH_COLUMN) > after)


def compact(
    spark: SparkSession, root: str, file_bytes: int = FILE_BYTES, file_values: int = FILE_VALUES
) -> dict[str, int]:
    """Folds all committed batches into day partitions; returns the last number folded by writer.

    Rows keep their batch number. The snapshot that names the new folders is the commit: a run that
    fails before it leaves everything as it was.
    """
    files = _Files(spark, root)
    snapshot, commits = _state(files)
    if not commits:
        return snapshot["folded"]
    folded = dict(snapshot["folded"])
    for name in commits:
        writer, number = name.removesuffix(".json").rsplit("-", 1)
        folded[writer] = max(folded.get(writer, -1), int(number))
    turn = len(_snapshots(files))
    by_day: dict[tuple[str, str], list[str]] = {}
    tables = {t: known | {"folders": list(known["folders"])} for t, known in snapshot["tables"].items()}
    for commit in commits.values():
        for table, own in commit["tables"].items():
            by_day.setdefault((table, commit["day"]), []).append(own["folder"])
            known = tables.setdefault(table, {"folders": [], "schema": None, "last": -1})
            known["schema"], known["last"] = own["schema"], max(known["last"], commit["batch"])
    for (table, day), folders in by_day.items():
        layout = StructType.fromJson(json.loads(tables[table]["schema"]))
        rows = spark.read.schema(layout).parquet(*[f"{files.root}/{f}" for f in folders])
        values = rows.count() * len(layout)
        wanted = max(1, -(-sum(map(files.size, folders)) // file_bytes), -(-values // file_values))
        target = f"{table}/day={day}/fold-{turn:06d}-{uuid.uuid4().hex[:8]}"
        rows.coalesce(wanted).write.parquet(f"{files.root}/{target}")
        tables[table]["folders"].append(target)
    files.write(f"{_snapshot_folder(files)}/{SNAPSHOT}-{turn:06d}.json", {"folded": folded, "tables": tables})
    return folded


def vacuum(spark: SparkSession, root: str) -> int:
    """Deletes what no reader starting now would read; returns how many folders went.

    Folders of batches that are being written are not in a commit yet: run it while no writer is.
    """
    files = _Files(spark, root)
    snapshot, commits = _state(files)
    live = {f for t in snapshot["tables"].values() for f in t["folders"]}
    live |= {own["folder"] for c in commits.values() for own in c["tables"].values()}
    gone = 0
    for table in {f.split("/", 1)[0] for f in live}:
        for name in files.names(table):
            inner = [f"{table}/{name}/{n}" for n in files.names(f"{table}/{name}")] if name.startswith("day=") else [f"{table}/{name}"]
            for folder in inner:
                if folder not in live:
                    files.delete(folder)
                    gone += 1
    kept = {f"{COMMITS}/{name}" for name in commits} | set(_snapshots(files)[-1:])
    for folder in (COMMITS, SNAPSHOTS):
        for name in files.names(folder):
            if f"{folder}/{name}" not in kept:
                files.delete(f"{folder}/{name}")
    return gone


def table_writer(
    root: str,
    tables: dict[str, Callable[[DataFrame], DataFrame]],
    writer: str = "batch",
    replace: bool = False,
) -> Callable[[DataFrame, int], None]:
    """One stream into several tables that become visible together; the batch is staged while more than
    one table reads it: files are read in splits and by column, where cached partitions are read whole. A
    batch that is committed already is written again only if `replace`, one that is folded never."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files = _Files(spark, root)
        if _is_folded(files, batch_id, writer):
            return
        if not replace and files.exists(_commit_name(writer, batch_id)):
            return
        with staging(spark) as stage:
            rows = stage(batch, "batch") if len(tables) > 1 else batch
            write_tables(spark, root, batch_id, {t: make(rows) for t, make in tables.items()}, writer)

    return write
