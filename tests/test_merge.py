"""Batch merge against a plain Python model, skew, and the plans."""

import json
import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from alarmloom.operators import merge, project
from alarmloom.plans import jobs
from alarmloom.session import shared_folder, staging
from alarmloom.sinks.tables import read_table


def skewed(messages, count=600):
    """One label holds most of the rows; many rows share a time stamp."""
    rng = random.Random(7)
    rows = []
    for offset in range(count):
        module, kind = (5, 5) if rng.random() < 0.7 else rng.choice([(6, 1), (6, 9), (5, 99), (4, 1)])
        doc = {
            "messageDeviceSerialId": f"S{offset}",
            "basicMessageBasicList": [
                {"verifyFunctionModuleCode": module, "verifyTypeId": kind, "srcPort": offset}
            ],
        }
        rows.append((offset % 3, offset, rng.randrange(0, 90), json.dumps(doc)))
    return messages(rows)


def model(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r.route, r.type_label, r.win)].append(r)
    result = {}
    for key, members in groups.items():
        members.sort(key=lambda r: (r.event_ts, r.partition, r.offset, r.pos))
        result[key] = (members[0].uuid, members[-1].date, len(members))
    return result


def test_merge_equals_the_model(messages):
    rows = merge.with_window(jobs.is_merged(jobs.classified_alarms(skewed(messages), 2)), 20)
    expected = model(rows.collect())
    summaries = {
        (r.route, r.type_label, r.win): (r.pid, r.date, r.size)
        for r in merge.merge_summaries(rows).collect()
    }
    assert summaries == expected
    heads = {
        (r.route, r.type_label, r.win): (r.pid, r.last_date, r.size)
        for r in merge.merge_heads(rows).collect()
    }
    assert heads == expected
    for bound in (None, 100):
        details = merge.merge_details(rows, bound).collect()
        assert len(details) == rows.count()
        assert all(d.pid == expected[(d.route, d.type_label, d.win)][0] for d in details)


def test_bounded_merge_broadcasts_and_the_other_salts(messages):
    rows = merge.with_window(jobs.is_merged(jobs.classified_alarms(skewed(messages), 2)), 20)
    bounded = merge.merge_details(rows, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in bounded and "salt" not in bounded
    for bound in (None, merge.BROADCAST_ROWS + 1):
        open_ended = merge.merge_details(rows, bound)._jdf.queryExecution().optimizedPlan()
        assert "salt" in open_ended.toString()


def test_no_window_operator_gathers_a_key(messages):
    rows = merge.with_window(jobs.is_merged(jobs.classified_alarms(skewed(messages), 2)), 20)
    for frame in (merge.merge_details(rows), merge.merge_summaries(rows)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "collect_list" not in plan
    assert "partial_min_by" in plan


def test_ends_are_a_hash_aggregate_and_only_rows_at_the_ends_are_sorted(messages):
    rows = merge.with_window(jobs.is_merged(jobs.classified_alarms(skewed(messages), 2)), 20)
    ends = merge.merge_ends(rows)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in ends and "SortAggregate" not in ends
    for frame in (merge.merge_heads(rows, max_heads=100), merge.merge_summaries(rows, max_heads=100)):
        lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
        at = max(i for i, line in enumerate(lines) if "SortAggregate" in line)
        below = lines[at + 1 :]
        # Below the sorted aggregate comes the filter on the two times, within the join with the ends.
        join = next(i for i, line in enumerate(below) if "Join" in line)
        assert "first_ts" in below[join] and "last_ts" in below[join]
        assert not any("min_by" in line for line in below)


def test_ties_at_the_ends_go_by_position(messages):
    def doc(n):
        body = {"verifyFunctionModuleCode": 5, "verifyTypeId": 5, "srcPort": n}
        return json.dumps({"basicMessageBasicList": [body, body]})

    rows = jobs.is_merged(jobs.classified_alarms(
        messages([(1, 7, 3, doc(1)), (0, 9, 3, doc(2)), (0, 8, 3, doc(3)), (2, 1, 3, doc(4))]), 2
    ))
    rows = merge.with_window(rows, 20)
    for bound in (None, 1):
        found = merge.merge_summaries(rows, max_heads=bound).collect()
        assert [(r.partition, r.offset, r.pos, r["size"]) for r in found] == [(0, 8, 0, 8)]


def test_same_label_of_two_routes_does_not_mix(messages):
    def doc(module):
        body = {"verifyFunctionModuleCode": module, "verifyTypeId": 99}
        return json.dumps({"basicMessageBasicList": [body]})

    rows = jobs.is_merged(
        jobs.classified_alarms(messages([(0, 0, 1, doc(5)), (0, 1, 2, doc(6))]), 2)
    )
    summaries = merge.merge_summaries(merge.with_window(rows, 20)).collect()
    assert {(r.route, r.type_label, r.size) for r in summaries} == {
        ("camouflage", "模拟", 1),
        ("transformation", "模拟", 1),
    }


def test_windows_are_aligned_to_the_epoch(messages):
    rows = jobs.is_merged(jobs.classified_alarms(skewed(messages), 2))
    found = {r.win for r in merge.with_window(rows, 20).select("win").distinct().collect()}
    assert found == {0, 20, 40, 60, 80}


def test_batch_job_writes_all_tables_and_can_be_repeated(spark, messages, tmp_path):
    frame = skewed(messages).unionByName(messages([(0, 9999, 5, '{"a":')]))
    for _ in range(2):
        jobs.run_alarm_batch(frame, str(tmp_path), batch_id=3, generation=2, seconds=20)
    tables = {
        name: read_table(spark, str(tmp_path), name)
        for name in ("bus_warning", "bus_twarning", "bus_cwarning", "rejects")
    }
    rows = jobs.classified_alarms(frame, 2)
    details = tables["bus_twarning"].count() + tables["bus_cwarning"].count()
    assert details == jobs.is_merged(rows).count()
    warnings = tables["bus_warning"]
    summaries = warnings.filter(F.col("pid").isNotNull())
    assert summaries.agg(F.sum(F.col("size").cast("bigint"))).first()[0] == details
    assert warnings.count() - summaries.count() == jobs.is_immediate(rows).count()
    assert [r.reject_reason for r in tables["rejects"].collect()] == ["malformed"]
    orphans = tables["bus_cwarning"].join(summaries.select("uuid"), F.col("pid") == summaries.uuid, "left_anti")
    assert orphans.isEmpty()


def test_batch_jobs_leave_no_staged_tables(spark, messages, tmp_path):
    folder = Path(shared_folder(spark).removeprefix("file://")) / "alarmloom"
    before = set(folder.glob("*"))
    jobs.run_alarm_batch(skewed(messages), str(tmp_path / "a"), batch_id=1)
    jobs.run_report_batch(skewed(messages), str(tmp_path / "b"), batch_id=1)
    assert set(folder.glob("*")) == before
    with pytest.raises(ValueError), staging(spark) as stage:
        stage(spark.range(3), "dropped")
        raise ValueError
    assert set(folder.glob("*")) == before


def test_first_job_has_one_detail_table_and_no_time_text(spark, messages, tmp_path):
    jobs.run_alarm_batch(skewed(messages), str(tmp_path), batch_id=1, generation=0)
    details = read_table(spark, str(tmp_path), "bus_twarning_local")
    assert "currenttime" not in details.columns and "pid" in details.columns
    assert not (tmp_path / "bus_cwarning").exists()
    assert "currenttime" not in read_table(spark, str(tmp_path), "bus_warning_local").columns


def test_summary_is_the_first_row(messages):
    rows = merge.with_window(jobs.is_merged(jobs.classified_alarms(skewed(messages), 1)), 20)
    summaries = project.summary_rows(merge.merge_summaries(rows), 1).collect()
    details = {r.uuid: r for r in project.detail_rows(merge.merge_details(rows, 100), 1).collect()}
    for s in summaries:
        first = details[s.uuid]
        assert s.pid == s.uuid == first.pid
        assert (s.srcPort, s.messageDeviceSerialId) == (first.srcPort, first.messageDeviceSerialId)
