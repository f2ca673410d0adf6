"""What must hold at any size: bounded files and batches, commits that do not read the whole log."""

import math

import pytest
from pyspark.sql import functions as F

from alarmloom.plans import catalog
from alarmloom.session import new_folder
from alarmloom.sinks import commits


def events_folder(spark, path, rows):
    events = spark.range(rows).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id")).alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.lit("click").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit("{}").alias("props"),
    )
    events.write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.mark.parametrize("rows", [0, 9, 4000, 10001, 9999])
def test_a_replay_is_cut_into_full_files_by_many_tasks(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(catalog.streams, "FLUSH_ROWS", 100)
    folder = new_folder(spark, "flush")
    lanes = catalog._flush_files(spark, events_folder(spark, tmp_path / "in", rows), folder)
    messages = math.ceil(rows / 4)
    files = spark.read.parquet(folder).groupBy(F.input_file_name().alias("f")).count().collect()
    sizes = sorted(r["count"] for r in files)
    assert sum(sizes) == messages and len(sizes) == math.ceil(messages / 100)
    assert all(size == 100 for size in sizes[1:]) and sizes[-1:] != [0]
    assert lanes == max(1, min(catalog.ADMIT_LANES, len(sizes)))


def test_several_lanes_admit_all_messages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog.streams, "FLUSH_ROWS", 100)
    row = catalog.admitted_batches(spark, events_folder(spark, tmp_path / "in", 10001)).first()
    assert tuple(row) == (2501, 26, 100)


def test_a_batch_does_not_list_the_commits_before_it(spark, tmp_path, monkeypatch):
    root, rows = str(tmp_path / "t"), spark.range(2)
    commits.write_tables(spark, root, 0, {"a": rows})
    listed, names = [], commits._Files.names
    monkeypatch.setattr(
        commits._Files, "names", lambda self, folder: listed.append(folder) or names(self, folder)
    )
    assert not commits.is_committed(spark, root, 1)
    commits.write_tables(spark, root, 1, {"a": rows})
    assert commits.COMMITS not in listed
    monkeypatch.undo()
    assert commits.compact(spark, root) == {"batch": 1}
    commits.write_tables(spark, root, 1, {"a": rows})
    commits.vacuum(spark, root)
    assert commits.is_committed(spark, root, 1)
    assert commits.read_committed(spark, root, "a").count() == 4


def test_a_root_with_its_snapshots_among_the_commits_stays_readable(spark, tmp_path):
    root, rows = str(tmp_path / "t"), spark.range(2)
    (tmp_path / "t" / commits.COMMITS).mkdir(parents=True)
    for number in (0, 1):
        commits.write_tables(spark, root, number, {"a": rows})
    commits.compact(spark, root)
    commits.write_tables(spark, root, 2, {"a": rows})
    assert not (tmp_path / "t" / commits.SNAPSHOTS).exists()
    commits.vacuum(spark, root)
    assert commits.read_committed(spark, root, "a").count() == 6


def test_tables_of_a_batch_share_staged_rows(spark, tmp_path, monkeypatch):
    """Cached rows are read a whole partition at a time, files in splits."""
    from pyspark.sql import DataFrame

    def refused(self, *_):
        raise AssertionError("kept in memory")

    monkeypatch.setattr(DataFrame, "persist", refused)
    root = str(tmp_path / "t")
    made = {"even": lambda b: b.filter("id % 2 = 0"), "odd": lambda b: b.filter("id % 2 = 1")}
    write = commits.table_writer(root, made)
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    assert commits.read_committed(spark, root, "even").count() == 3
    commits.compact(spark, root)
    again = commits.table_writer(root, made, replace=True)
    monkeypatch.setattr(commits, "write_tables", refused)
    again(spark.range(5), 0)
    assert commits.read_committed(spark, root, "odd").count() == 2


def test_encoding_spreads_with_the_table(spark, tmp_path, monkeypatch):
    from alarmloom.sources import samples

    folder = events_folder(spark, tmp_path / "in", 1000)
    cores = spark.sparkContext.defaultParallelism
    assert samples._events(spark, folder).rdd.getNumPartitions() == cores
    length = samples._version(spark, folder)[1]
    monkeypatch.setattr(samples, "EVENT_BYTES", length // (3 * cores))
    assert samples._events(spark, folder).rdd.getNumPartitions() >= 3 * cores
    assert samples._events(spark, folder).count() == 1000


def test_compaction_bounds_the_values_of_a_file(spark, tmp_path):
    root = str(tmp_path / "t")
    wide = spark.range(0, 800, 1, 8).select("id", *[F.lit("-1").alias(f"c{i}") for i in range(8)])
    commits.write_tables(spark, root, 0, {"wide": wide})
    commits.compact(spark, root, file_values=2000)
    assert len(list((tmp_path / "t" / "wide").glob("day=*/fold-*/part-*"))) == 4
    assert commits.read_committed(spark, root, "wide").count() == 800


def test_a_part_of_the_replay_has_a_file_per_core(spark, tmp_path, monkeypatch):
    class Stopped(Exception):
        pass

    seen = []

    def stop(_, folder, max_files_per_trigger):
        seen.append(max_files_per_trigger)
        seen.append(spark.read.parquet(folder).select(F.input_file_name()).distinct().count())
        raise Stopped

    monkeypatch.setattr(catalog.files, "message_stream", stop)
    with pytest.raises(Stopped):
        catalog._late_stream(spark, events_folder(spark, tmp_path / "in", 8000))
    cores = spark.sparkContext.defaultParallelism
    assert seen[0] >= cores and seen[1] > cores


@pytest.mark.parametrize("keep_rejects", [False, True])
def test_alarms_are_not_walked_by_a_filter_on_the_join_key(spark, messages, keep_rejects):
    from alarmloom.plans import jobs

    text = '{"basicMessageBasicList":[{"verifyFunctionModuleCode":6,"verifyTypeId":"x"},{"verifyFunctionModuleCode":null,"verifyTypeId":1}]}'
    rows = jobs.classified_alarms(messages([(0, 0, 1, text)]), keep_rejects=keep_rejects)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "BIGINT" in line]
    assert rows.count() == (2 if keep_rejects else 1)
