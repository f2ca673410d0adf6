"""Streams: equal to batch, restartable, repeatable, several micro-batches."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from alarmloom.operators import merge, nested
from alarmloom.plans import jobs
from alarmloom.sinks import commits
from alarmloom.sinks.tables import read_table, write_batch, write_lines
from alarmloom.sources.files import message_stream, text_line_stream, text_lines
from alarmloom.streaming import changelog
from alarmloom.streaming import merge as stream_merge
from alarmloom.streaming import queries as streams


def alarm_text(module, kind):
    return json.dumps(
        {
            "messageDeviceSerialId": "S",
            "basicMessageBasicList": [{"verifyFunctionModuleCode": module, "verifyTypeId": kind}],
        }
    )


def minute(messages, start, count=40):
    rows = []
    for i in range(count):
        module, kind = [(5, 5), (5, 3), (6, 1), (4, 1)][i % 4]
        rows.append((i % 2, start * 1000 + i, start + (i * 7) % 60, alarm_text(module, kind)))
    return messages(rows)


def add_file(frame, folder):
    frame.coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, folder, root, checkpoint, generation=2, seconds=20, files=None):
    stream = message_stream(spark, str(folder), max_files_per_trigger=1)
    started = jobs.start_alarm_stream(
        stream, str(root), str(checkpoint), generation, seconds, "arrival", trigger_seconds=None,
        files_per_trigger=files,
    )
    for query in started:
        query.awaitTermination()


def merged_details(spark, root):
    parts = [jobs.read_merged(spark, str(root), t) for t in ("bus_twarning", "bus_cwarning")]
    return parts[0].unionByName(parts[1])


def check_against_batch(spark, root, whole):
    """Details and summaries of the stream are those of one batch over all messages."""
    rows = merge.with_window(jobs.is_merged(jobs.classified_alarms(whole, 2)), 20)
    expected = merge.merge_details(rows, 100).select("uuid", "pid")
    found = merged_details(spark, root).select("uuid", "pid")
    assert found.count() == expected.count()
    assert found.exceptAll(expected).isEmpty()
    warnings = jobs.stream_warnings(spark, str(root))
    summaries = warnings.filter(F.col("pid").isNotNull()).select("pid", "date", "size")
    batch = merge.merge_summaries(rows).select("pid", "date", F.col("size").cast("string"))
    assert summaries.count() == batch.count()
    assert summaries.exceptAll(batch).isEmpty()
    assert summaries.agg(F.sum(F.col("size").cast("long"))).first()[0] == found.count()
    immediate = warnings.filter(F.col("pid").isNull())
    assert immediate.count() == jobs.is_immediate(jobs.classified_alarms(whole, 2)).count()


def test_stream_over_several_batches_and_a_restart_equals_batch(spark, messages, tmp_path):
    folder, root, checkpoint = (tmp_path / n for n in ("in", "out", "cp"))
    parts = [minute(messages, start) for start in (0, 60, 120)]
    for part in parts[:2]:
        add_file(part, folder)
    run(spark, folder, root, checkpoint)
    add_file(parts[2], folder)
    add_file(messages([(0, 9_000_000, 1000, alarm_text(6, 1))]), folder)  # closes all windows
    run(spark, folder, root, checkpoint)
    run(spark, folder, root, checkpoint)  # nothing new: nothing more is written
    assert merged_details(spark, root).count() == 90
    check_against_batch(spark, root, parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert jobs.reconcile_merged(spark, str(root), 0, 2, 20) == 0


def test_late_rows_are_merged_by_the_reconcile_job(spark, messages, tmp_path):
    """Rows behind closed windows: in the middle of a group, before its first row, after its last, and
    of a label that its window had not seen."""
    folder, root, checkpoint = (tmp_path / n for n in ("in", "out", "cp"))
    first, second = minute(messages, 2), minute(messages, 100)
    late = messages([
        (0, 1, 20, alarm_text(5, 5)), (1, 2, 39, alarm_text(5, 5)), (0, 3, 30, alarm_text(6, 1)),
        (0, 4, 25, alarm_text(6, 7)), (1, 5, 0, alarm_text(5, 3)),
    ])
    end = messages([(0, 9_000_000, 1000, alarm_text(6, 1))])
    for part in (first, second, late, end):
        add_file(part, folder)
        run(spark, folder, root, checkpoint)
    whole = first.unionByName(second).unionByName(late)
    before = merged_details(spark, root).count()
    rows = jobs.is_merged(jobs.classified_alarms(whole, 2)).count()
    assert before == rows - 5  # stored in `classified` only
    assert jobs.reconcile_merged(spark, str(root), 0, 2, 20) >= 4
    check_against_batch(spark, root, whole)
    assert jobs.reconcile_merged(spark, str(root), 1, 2, 20) == 0
    # A second late row of a group that was merged anew; only hours from `since` on are looked at.
    more = messages([(0, 6, 21, alarm_text(5, 5))])
    add_file(more, folder)
    run(spark, folder, root, checkpoint)
    assert jobs.reconcile_merged(spark, str(root), 2, 2, 20, since=60) == 0
    assert jobs.reconcile_merged(spark, str(root), 2, 2, 20, since=20) == 1
    check_against_batch(spark, root, whole.unionByName(more))
    with pytest.raises(ValueError):
        jobs.reconcile_merged(spark, str(root), 2, 2, 20)
    commits.compact(spark, f"{root}/merged")
    commits.vacuum(spark, f"{root}/merged")
    check_against_batch(spark, root, whole.unionByName(more))


def test_failed_reconcile_leaves_nothing(spark, messages, tmp_path, monkeypatch):
    folder, root, checkpoint = (tmp_path / n for n in ("in", "out", "cp"))
    parts = [minute(messages, 2), minute(messages, 100), messages([(0, 1, 20, alarm_text(5, 5))])]
    for part in parts:
        add_file(part, folder)
        run(spark, folder, root, checkpoint)
    before = merged_details(spark, root).count()
    write = commits._Files.write
    monkeypatch.setattr(commits._Files, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        jobs.reconcile_merged(spark, str(root), 0, 2, 20)
    monkeypatch.setattr(commits._Files, "write", write)
    assert merged_details(spark, root).count() == before
    assert jobs.reconcile_merged(spark, str(root), 0, 2, 20) == 1
    assert merged_details(spark, root).count() == before + 1


def test_the_topic_is_read_by_one_query_only(spark, messages, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "out"
    add_file(minute(messages, 0), folder)
    started = jobs.start_alarm_stream(
        message_stream(spark, str(folder)), str(root), str(tmp_path / "cp"), 2, 20, "arrival",
        trigger_seconds=None,
    )
    for query in started:
        query.awaitTermination()
    sources = [[s["description"] for s in q.lastProgress["sources"]] for q in started]
    assert [len(s) for s in sources] == [1, 1, 1]
    assert str(folder) in sources[0][0]
    assert all(f"{root}/classified" in s[0] for s in sources[1:])
    # Only the merge keeps state, and that is a count per window and label.
    states = [q.lastProgress["stateOperators"] for q in started]
    assert [len(s) for s in states] == [0, 0, 1]


def test_bounded_run_on_the_processing_clock_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.start_alarm_stream(
            message_stream(spark, str(tmp_path)), str(tmp_path), str(tmp_path),
            clock="processing", trigger_seconds=None,
        )


def test_processing_clock_merges_what_arrives_together(spark, messages, tmp_path):
    folder = tmp_path / "in"
    add_file(minute(messages, 0), folder)
    stream = message_stream(spark, str(folder))
    rows = jobs.is_merged(jobs.classified_alarms(stream, 2, clock="processing"))
    query = streams.start(
        rows.select("event_ts", "type_label"),
        streams.table_writer(str(tmp_path / "out"), {"t": lambda b: b}),
        str(tmp_path / "cp"),
        seconds=None,
    )
    query.awaitTermination()
    found = read_table(spark, str(tmp_path / "out"), "t")
    assert found.select("event_ts").distinct().count() == 1  # the time of the batch
    assert found.count() == 30


def test_windows_close_by_the_clock_without_new_alarms(spark, messages, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "out"
    add_file(minute(messages, 0).unionByName(messages([(0, 1, 1, '{"a":')])), folder)
    started = jobs.start_alarm_stream(
        message_stream(spark, str(folder)), str(root), str(tmp_path / "cp"), 2, 2,
        clock="processing", trigger_seconds=1,
    )
    deadline = time.time() + 90

    def written():
        merged, now = f"{root}/merged", "bus_warning"
        return commits.has_table(spark, merged, now) and read_table(spark, merged, now).count() == 2

    while time.time() < deadline and not written():
        time.sleep(2)
    for query in started:
        query.stop()
    details = [read_table(spark, f"{root}/merged", t) for t in ("bus_cwarning", "bus_twarning")]
    assert [d.count() for d in details] == [20, 10]
    summaries = read_table(spark, f"{root}/merged", "bus_warning")
    assert sorted((r.verifyTypeId, r.size) for r in summaries.collect()) == [
        ("IP扫描事件", "20"),
        ("标签目的地址未在白名单告警", "10"),
    ]
    assert read_table(spark, f"{root}/immediate", "bus_warning").count() == 10
    assert read_table(spark, f"{root}/immediate", "rejects").first().reject_reason == "malformed"


@pytest.mark.parametrize("job, table", [("vendor", "bus_ahwarning"), ("metadata", "bus_ahmetadata")])
def test_line_jobs_as_batch_and_stream(spark, messages, tmp_path, job, table):
    frame = messages([(0, 0, 1, '{"name":"a","sip":"b"}'), (0, 1, 1, "{"), (0, 2, 1, '[{"name":"c"}]\n')])
    jobs.run_line_batch(job, frame, str(tmp_path / "batch"), 0)
    add_file(frame, tmp_path / "in")
    jobs.start_line_stream(
        job, message_stream(spark, str(tmp_path / "in")), str(tmp_path / "stream"),
        str(tmp_path / "cp"), clock="arrival", trigger_seconds=None,
    ).awaitTermination()
    for name, count in ((table, 2), ("rejects", 1)):
        batch = read_table(spark, str(tmp_path / "batch"), name)
        stream = read_table(spark, str(tmp_path / "stream"), name)
        assert batch.count() == stream.count() == count
        assert batch.exceptAll(stream).isEmpty()


def test_stream_state_is_a_count_per_window_and_label(spark, messages, tmp_path):
    layout = "event_ts timestamp, route string, type_label string"
    rows = spark.readStream.schema(layout).parquet(str(tmp_path))
    plan = stream_merge.closed_windows(rows, 20)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Aggregate [") == 1 and "count(1) AS size" in plan
    assert "Join" not in plan and "collect_list" not in plan and "min_by" not in plan


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    for _ in range(2):
        write_batch(spark.range(5), str(tmp_path), "t", 4)
    write_batch(spark.range(3), str(tmp_path), "t", 5)
    found = {r.batch_id: r["count"] for r in read_table(spark, str(tmp_path), "t").groupBy("batch_id").count().collect()}
    assert found == {4: 5, 5: 3}


def test_one_stream_into_two_tables(spark, tmp_path):
    write = streams.table_writer(
        str(tmp_path), {"odd": lambda b: b.filter("id % 2 = 1"), "even": lambda b: b.filter("id % 2 = 0")}
    )
    write(spark.range(10), 0)
    assert read_table(spark, str(tmp_path), "odd").count() == 5
    assert read_table(spark, str(tmp_path), "even").count() == 5


def test_tables_of_a_batch_become_visible_together(spark, tmp_path):
    """A writer that fails between two tables leaves nothing visible; the rerun gives each row once."""
    root, broken = str(tmp_path), [True]

    def second(batch):
        return batch.select(F.raise_error(F.lit("lost")).cast("long").alias("id")) if broken[0] else batch

    write = streams.table_writer(root, {"one": lambda b: b, "two": second})
    with pytest.raises(Exception, match="lost"):
        write(spark.range(4), 0)
    assert not commits.has_table(spark, root, "one")
    with pytest.raises(FileNotFoundError):
        read_table(spark, root, "one")
    broken[0] = False
    for _ in range(2):
        write(spark.range(4), 0)
    write(spark.range(2), 1)
    for table in ("one", "two"):
        found = {r.batch_id: r["count"] for r in read_table(spark, root, table).groupBy("batch_id").count().collect()}
        assert found == {0: 4, 1: 2}
    assert commits.vacuum(spark, root) in (1, 2)  # folders of the failed attempt
    assert [len(os.listdir(tmp_path / table)) for table in ("one", "two")] == [2, 2]


def test_compaction_keeps_the_rows_and_refuses_folded_batches(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        commits.write_tables(spark, root, n, {"t": spark.range(n, n + 3).repartition(3)})
        commits.write_tables(spark, root, n, {"u": spark.range(1)}, writer="other")

    def rows():
        return sorted(map(tuple, read_table(spark, root, "t").collect()))

    before = rows()
    assert commits.compact(spark, root) == {"batch": 3, "other": 3}
    assert rows() == before
    commits.write_tables(spark, root, 2, {"t": spark.range(100)})  # folded: adds nothing
    assert rows() == before and commits.is_committed(spark, root, 2)
    commits.write_tables(spark, root, 4, {"t": spark.range(2)})
    assert commits.compact(spark, root) == {"batch": 4, "other": 3}
    assert commits.compact(spark, root) == {"batch": 4, "other": 3}
    assert rows() == sorted(before + [(0, 4), (1, 4)])
    assert commits.vacuum(spark, root) == 9
    assert rows() == sorted(before + [(0, 4), (1, 4)])
    folders = [f for f in os.listdir(f"{root}/t")]
    assert all(f.startswith("day=") for f in folders)
    files = [f for d, _, names in os.walk(f"{root}/t") for f in names if f.endswith(".parquet")]
    assert len(files) == 2  # one per compaction
    assert read_table(spark, root, "t").filter("batch_id > 3").count() == 2
    assert commits.read_committed(spark, root, "t", after=3).count() == 2
    assert commits.read_committed(spark, root, "t", after=9).count() == 0


def test_replaced_commit_and_changed_layout(spark, tmp_path):
    root = str(tmp_path)
    commits.write_tables(spark, root, 0, {"t": spark.range(3)})
    commits.write_tables(spark, root, 0, {"t": spark.range(5)})
    assert read_table(spark, root, "t").count() == 5
    commits.write_tables(spark, root, 1, {"t": spark.range(1).withColumn("more", F.lit("x"))})
    found = read_table(spark, root, "t")
    assert found.columns == ["id", "more", "batch_id"] and found.filter("more is null").count() == 5


def counts_of(spark, tmp_path, batches, write, mode="update"):
    folder = str(tmp_path / "in")
    for values in batches:
        spark.createDataFrame([(v,) for v in values], "id bigint").coalesce(1).write.mode(
            "append"
        ).parquet(folder)
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(folder)
    counts = nested.count_by(stream, "id")
    streams.start(counts, write, str(tmp_path / "cp"), mode, seconds=None).awaitTermination()


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_changing_counts(spark, tmp_path, mode):
    write = streams.table_writer(str(tmp_path / "out"), {"counts": lambda b: b})
    counts_of(spark, tmp_path, ([1, 1, 2], [1, 3]), write, mode)
    latest = changelog.latest_counts(spark, str(tmp_path / "out"), "counts", "id")
    assert {r.id: r.n for r in latest.collect()} == {1: 3, 2: 1, 3: 1}
    written = read_table(spark, str(tmp_path / "out"), "counts").count()
    assert written == (4 if mode == "update" else 5)  # update: only the changed counts


@pytest.mark.parametrize("every", [1, 2, 100])
def test_changelog_retracts_what_it_had_added(spark, tmp_path, every):
    root = str(tmp_path / "out")
    write = changelog.change_writer(root, "counts", "id", snapshot_every=every)
    counts_of(spark, tmp_path, ([1, 1, None], [1, 3], [3, None, 4], [1]), write)
    log = read_table(spark, root, "counts").collect()
    by_batch = [sorted((r.id or 0, r.n, r.added) for r in log if r.batch_id == b) for b in range(4)]
    assert by_batch == [
        [(0, 1, True), (1, 2, True)],
        [(1, 2, False), (1, 3, True), (3, 1, True)],
        [(0, 1, False), (0, 2, True), (3, 1, False), (3, 2, True), (4, 1, True)],
        [(1, 3, False), (1, 4, True)],
    ]
    expected = {None: 2, 1: 4, 3: 2, 4: 1}
    for _ in range(2):
        folded = changelog.folded(spark, root, "counts", "id").collect()
        assert {r.id: (r.n, r.balance) for r in folded} == {k: (n, 1) for k, n in expected.items()}
        latest = changelog.latest_counts(spark, root, "counts", "id").collect()
        assert {r.id: r.n for r in latest} == expected
        write(spark.createDataFrame([(1, 9)], "id bigint, n bigint"), 3)  # repeated: adds nothing
        commits.compact(spark, root)


def test_a_snapshot_spares_the_log_before_it(spark, tmp_path):
    root = str(tmp_path)
    write = changelog.change_writer(root, "counts", "id", snapshot_every=2)
    for n in range(5):
        write(spark.createDataFrame([(1, n)], "id bigint, n bigint"), n)
    plan = changelog.latest_counts(spark, root, "counts", "id")
    read = {f.rsplit("/", 2)[-2].rsplit("-", 1)[0] for f in plan.inputFiles()}
    assert read == {"batch-000000000003", "batch-000000000004"}
    assert [tuple(r) for r in plan.collect()] == [(1, 4)]


def test_append_mode_refuses_a_changing_result(spark, tmp_path):
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path))
    with pytest.raises(Exception, match="(?i)append"):
        nested.count_by(stream, "id").writeStream.outputMode("append").format("noop").option(
            "checkpointLocation", str(tmp_path / "cp")
        ).start()


WORDS = ["hello me you her", "hello me you", "hello me", "hello"]


@pytest.mark.parametrize("files", [1, 2])
def test_lines_copied_into_a_number_of_files(spark, tmp_path, files):
    (tmp_path / "words.txt").write_text("\n".join(WORDS))
    out = str(tmp_path / "out")
    write_lines(text_lines(spark, str(tmp_path / "words.txt")), out, files)
    assert sorted(r.value for r in text_lines(spark, out).collect()) == sorted(WORDS)
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == files


def test_directory_of_wide_characters(spark, tmp_path):
    inner = tmp_path / "dir" / "deep"
    inner.mkdir(parents=True)
    (tmp_path / "dir" / "a.txt").write_text("文件夹 文件夹", encoding="utf-8")
    (inner / "b.txt").write_text("文件夹 文件夹\n文件夹 文件夹", encoding="utf-8")
    flat = text_lines(spark, str(tmp_path / "dir"))
    deep = text_lines(spark, str(tmp_path / "dir"), recursive=True)
    assert (flat.count(), deep.count()) == (1, 3)
    assert {r.value for r in deep.collect()} == {"文件夹 文件夹"}


def test_text_stream_into_text_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "words.txt").write_text("\n".join(WORDS))
    lines = text_line_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    streams.file_stream(
        lines, str(tmp_path / "out"), str(tmp_path / "cp"), "text", seconds=None
    ).awaitTermination()
    found = spark.read.text(str(tmp_path / "out"))
    assert sorted(r.value for r in found.collect()) == sorted(WORDS)


def test_text_stream_goes_on_after_a_restart(spark, tmp_path):
    folder, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    for name, lines in (("a", WORDS[:2]), ("b", WORDS[2:]), (None, [])):
        if name:
            (folder / f"{name}.txt").write_text("\n".join(lines))
        streams.file_stream(text_line_stream(spark, str(folder)), out, cp, "text", None).awaitTermination()
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted(WORDS)
    assert len(os.listdir(f"{out}/_spark_metadata")) >= 2


def test_admission_by_count(spark, messages, tmp_path):
    minute(messages, 0, 25).coalesce(1).write.option("maxRecordsPerFile", 10).parquet(str(tmp_path / "in"))
    write = streams.table_writer(str(tmp_path / "out"), {"t": lambda b: b.select("offset")})
    stream = message_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    streams.start(stream, write, str(tmp_path / "cp"), seconds=None).awaitTermination()
    sizes = read_table(spark, str(tmp_path / "out"), "t").groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [5, 10, 10]
