"""One query per operator, over inputs derived from the test tables."""

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from alarmloom.functions import documents
from alarmloom.functions.identity import dashed, stable_id
from alarmloom.operators import alarms as al
from alarmloom.operators import backfill, classify, merge, nested, packets, project, records
from alarmloom.plans import jobs
from alarmloom.schemas import MESSAGE_SCHEMA, MODULE_KEY, NESTED_REPORT_SCHEMA, TYPE_KEY
from alarmloom.session import configure, new_folder, stage
from alarmloom.sinks import commits
from alarmloom.sinks.tables import read_table, write_batch, write_lines
from alarmloom.sources import files, samples
from alarmloom.sources.kafka import byte_values, text_values
from alarmloom.streaming import changelog
from alarmloom.streaming import merge as stream_merge
from alarmloom.streaming import queries as streams

# The test events spread over 30 days, so the queries merge by the hour.
WINDOW = 3600
WINDOW_SIZES = [20, 120, 3600]

VENDOR_KEYS = ["deviceId", "eventId", "direction", "date", "srcAddress", "name"]
METADATA_KEYS = ["device_id", "sess_id", "uri", "content_length ", "sip", "file_list", "method"]


# --- Alarms -------------------------------------------------------------------------------------


def _alarms(spark, sf_dir, generation=2, **sample):
    messages = text_values(samples.alarm_messages(spark, sf_dir, **sample), null_as_empty=True)
    parsed = records.parse_alarm_messages(messages)
    return al.usable_alarms(al.explode_alarms(parsed, generation))


def explode_alarms(spark, sf_dir):
    alarm = F.col("alarm")
    return _alarms(spark, sf_dir).select(
        "uuid",
        "date",
        "currenttime",
        "event_level",
        "pos",
        "messageDeviceSerialId",
        "messageDeviceDescribe",
        "messageNumber",
        "reserved",
        "tempVerifyCode",
        documents.field_text(alarm, MODULE_KEY).alias("module"),
        documents.field_text(alarm, TYPE_KEY).alias("kind"),
        documents.field_text(alarm, "srcIp").alias("srcIp"),
        documents.field_text(alarm, "srcPort").alias("srcPort"),
    )


def _classified(generation, columns=("module_code", "type_code", "module_label"), **sample):
    def query(spark, sf_dir):
        rows = classify.classify(_alarms(spark, sf_dir, generation, **sample), generation)
        return rows.select("uuid", *columns, "type_label", "incidentdescription", "route")

    return query


def _route_counts(generation):
    def query(spark, sf_dir):
        rows = classify.classify(_alarms(spark, sf_dir, generation), generation)
        return rows.groupBy("route", "type_label").agg(F.count("*").alias("n"))

    return query


def route_messages(spark, sf_dir):
    return classify.route_messages(_alarms(spark, sf_dir)).select(
        "partition", "offset", "pos", "route"
    )


def immediate_alarms(spark, sf_dir):
    rows = jobs.is_immediate(jobs.classified_alarms(samples.alarm_messages(spark, sf_dir), 2))
    return _with_zone(project.immediate_rows(rows, 2))


def report_rows(spark, sf_dir):
    return _reported(project.report_rows(_alarms(spark, sf_dir)))


def _reported(rows):
    """The report with its time as a number, which compares alike everywhere."""
    return _with_zone(rows).withColumn("messageTime", F.unix_micros("messageTime"))


def _with_zone(rows):
    return rows.withColumn("zoneTag", F.try_element_at("extras", F.lit("zoneTag"))).drop("extras")


# --- Merge --------------------------------------------------------------------------------------


def _merge_rows(spark, sf_dir, generation):
    rows = jobs.classified_alarms(samples.alarm_messages(spark, sf_dir), generation)
    return merge.with_window(jobs.is_merged(rows), WINDOW)


def _staged_merge_rows(spark, sf_dir, generation, *columns):
    """The summaries and the details need the rows more than once; staged, the messages are parsed once."""
    rows = _merge_rows(spark, sf_dir, generation)
    return stage(rows.select(*merge.KEYS, *al.ARRIVAL, "date", *columns), "merge-rows")


def _staged_ends(rows):
    ends = stage(merge.merge_ends(rows), "merge-ends")
    return {"ends": ends, "max_heads": ends.count()}


def _merge_detail(generation):
    def query(spark, sf_dir):
        rows = _staged_merge_rows(spark, sf_dir, generation)
        details = merge.merge_details(rows, **_staged_ends(rows))
        return details.select("uuid", "pid", "route", "type_label", "win", "date")

    return query


def merge_detail_salted(spark, sf_dir):
    """The same details without a bound on the summaries: the joins go by salted keys."""
    details = merge.merge_details(_staged_merge_rows(spark, sf_dir, 2))
    return details.select("uuid", "pid", "route", "type_label", "win", "date")


def _merge_summary(generation):
    def query(spark, sf_dir):
        rows = _staged_merge_rows(spark, sf_dir, generation, "currenttime")
        return merge.merge_summaries(rows, **_staged_ends(rows)).select(
            *merge.KEYS, "uuid", "pid", "date", "currenttime", "size"
        )

    return query


def merge_by_window_size(spark, sf_dir):
    rows = jobs.is_merged(jobs.classified_alarms(samples.alarm_messages(spark, sf_dir), 2))
    return merge.window_sizes(rows, WINDOW_SIZES)


def _warning_table_rows(generation):
    """The whole warning table of a batch run: immediate alarms and summaries."""

    def query(spark, sf_dir):
        root = _alarm_batch(spark, sf_dir, generation)
        rows = read_table(spark, root, al.GENERATIONS[generation].warning_table)
        return _with_zone(rows).drop("batch_id")

    return query


def _detail_table_rows(generation):
    """All detail tables of a batch run."""

    def query(spark, sf_dir):
        root = _alarm_batch(spark, sf_dir, generation)
        rows = None
        for table in jobs.detail_tables(generation).values():
            part = read_table(spark, root, table).withColumn("table", F.lit(table))
            rows = part if rows is None else rows.unionByName(part)
        return _with_zone(rows).drop("batch_id")

    return query


def _alarm_batch(spark, sf_dir, generation):
    root = new_folder(spark, "alarm-batch")
    messages = samples.alarm_messages(spark, sf_dir)
    jobs.run_alarm_batch(messages, root, batch_id=1, generation=generation, seconds=WINDOW)
    return root


# --- Streams ------------------------------------------------------------------------------------


def _recorded(spark, messages, name):
    """The messages as a folder of files that a stream can replay."""
    path = new_folder(spark, name)
    messages.select(*MESSAGE_SCHEMA.names).write.parquet(path)
    return files.message_stream(spark, path)


@contextmanager
def _state_partitions(spark):
    """A stream fixes its number of state partitions at its first start. On a local session that
    is the number of cores; on a cluster the configured number stays."""
    name = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(name)
    if spark.sparkContext.master.startswith("local"):
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(name, str(min(int(configured), cores)))
    try:
        yield
    finally:
        spark.conf.set(name, configured)


def _finish(spark, start, *arguments, **options):
    with _state_partitions(spark):
        start(*arguments, **options, seconds=None).awaitTermination()


# The test events spread over 30 days: folders of 15 days, not of an hour. A part of the replay is as many
# files as tasks read it, one per core or more; of the classified files a batch takes about as many as one
# part makes.
STREAM_SPAN = 15 * 86400
STREAM_TASKS = 4
STREAM_FILES = 10


def _late_stream(spark, sf_dir):
    """The whole stream job over a replay in which one of seven messages comes last, long after its time,
    and the reconcile job after it. Returns the root."""
    messages = samples.alarm_messages(spark, sf_dir).select(*MESSAGE_SCHEMA.names)
    late = F.col("offset") % 7 == 3
    folder, root = new_folder(spark, "messages"), new_folder(spark, "alarms")
    tasks = max(STREAM_TASKS, spark.sparkContext.defaultParallelism)
    parts = [messages.filter(~late), messages.filter(late).unionByName(samples.flush_message(messages, WINDOW))]
    for part in parts:
        part.repartition(tasks).write.mode("append").parquet(folder)
    stream = files.message_stream(spark, folder, max_files_per_trigger=tasks)
    with _state_partitions(spark):
        for query in jobs.start_alarm_stream(
            stream, root, new_folder(spark, "checkpoint"), 2, WINDOW, clock="arrival",
            trigger_seconds=None, span=STREAM_SPAN, files_per_trigger=STREAM_FILES * tasks,
        ):
            query.awaitTermination()
    jobs.reconcile_merged(spark, root, 0, 2, WINDOW, span=STREAM_SPAN)
    return root


def _heads(spark, root):
    return jobs.read_merged(spark, root, jobs.HEADS).drop("batch_id")


def merge_summary_stream(spark, sf_dir):
    """Summaries alone: narrow classified rows in their table, windows closed by the stream, their rows
    merged as in a batch."""
    messages = samples.alarm_messages(spark, sf_dir)
    recorded = messages.unionByName(samples.flush_message(messages, WINDOW))
    stream = _recorded(spark, recorded, "messages")
    rows = jobs.is_merged(jobs.classified_alarms(stream, 2)).select(
        *al.ARRIVAL, "date", "currenttime", "route", "type_label"
    )
    path, root = new_folder(spark, "classified"), new_folder(spark, "merged")
    schema = streams.classified_schema(rows)

    def write(batch, batch_id):
        groups = stage(batch.select(*merge.KEYS), "closed")
        first, last = groups.agg(F.min("win"), F.max("win")).first()
        if first is None:
            return
        stored = streams.read_classified(spark, path, schema)
        closed = stream_merge.rows_of_windows(stored, WINDOW, first, last, STREAM_SPAN).drop("span")
        closed = stage(merge.meet(closed, groups, groups.count(), how="left_semi"), "closed-rows")
        merged = merge.merge_summaries(closed, **_staged_ends(closed))
        commits.write_tables(spark, root, batch_id, {"merged": merged})

    with _state_partitions(spark):
        streams.classified_stream(
            rows, path, new_folder(spark, "checkpoint"), None, STREAM_SPAN
        ).awaitTermination()
    keys = streams.stream_classified(spark, path, schema).select("event_ts", "route", "type_label")
    closing = stream_merge.closed_windows(keys, WINDOW)
    _finish(spark, streams.start, closing, write, new_folder(spark, "checkpoint"))
    return read_table(spark, root, "merged").select(
        *merge.KEYS, "uuid", "pid", "date", "currenttime", "size"
    )


def merge_detail_stream(spark, sf_dir):
    root = _late_stream(spark, sf_dir)
    rows = None
    for table in jobs.detail_tables(2).values():
        part = jobs.read_merged(spark, root, table).select("uuid", "pid", "date")
        rows = part if rows is None else rows.union(part)
    heads = _heads(spark, root).select(*merge.KEYS, "pid")
    return rows.join(heads, "pid").select("uuid", "pid", "route", "type_label", "win", "date")


CHANGE_BATCHES = 4


def _count_changelog(spark, sf_dir):
    """Counts per user over several micro-batches, each with its retractions and additions."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id")
    folder, root = new_folder(spark, "events"), new_folder(spark, "counts")
    events.repartition(CHANGE_BATCHES).write.parquet(folder)
    stream = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    )
    writer = changelog.change_writer(root, "counts", "user_id", snapshot_every=2)
    counts = nested.count_by(stream, "user_id")
    _finish(spark, streams.start, counts, writer, new_folder(spark, "checkpoint"), mode="update")
    return root


def count_by_id_stream(spark, sf_dir):
    """The current counts, out of the last snapshot and what came after it."""
    return changelog.latest_counts(spark, _count_changelog(spark, sf_dir), "counts", "user_id")


def count_by_id_changelog(spark, sf_dir):
    """The whole changelog added up: what is retracted had been added, so each key balances to one."""
    return changelog.folded(spark, _count_changelog(spark, sf_dir), "counts", "user_id")


# Batches of a replay run one after the other, so a long one is replayed by several queries side by side.
ADMIT_LANES = 16


def _flush_files(spark, sf_dir, folder):
    """The messages as files of FLUSH_ROWS rows, the last one of the rest, in folders by lane; returns how
    many lanes. Rows are numbered by file and place, and a file is written by the task that has its number."""
    messages = samples.alarm_messages(spark, sf_dir)
    placed = messages.select(
        *MESSAGE_SCHEMA.names,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place"),
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("file").count().withColumn(
        "start", F.coalesce(F.sum("count").over(before), F.lit(0))
    )
    total = messages.count()
    if not total:
        messages.select(*MESSAGE_SCHEMA.names).write.parquet(f"{folder}/lane=0")
        return 1
    lanes = min(ADMIT_LANES, -(-total // streams.FLUSH_ROWS))
    flush = F.call_function("div", F.col("start") + F.col("place"), F.lit(streams.FLUSH_ROWS))
    numbered = placed.join(F.broadcast(starts), "file").withColumn("flush", flush)
    numbered.repartition("flush").select(
        *MESSAGE_SCHEMA.names, (F.col("flush") % lanes).alias("lane")
    ).write.option("maxRecordsPerFile", streams.FLUSH_ROWS).partitionBy("lane").parquet(folder)
    return lanes


def admitted_batches(spark, sf_dir):
    """A replay that admits at most FLUSH_ROWS messages to a batch, as a buffered sink flushes."""
    folder, root = new_folder(spark, "messages"), new_folder(spark, "admitted")
    running = []
    with _state_partitions(spark):
        for lane in range(_flush_files(spark, sf_dir, folder)):
            stream = files.message_stream(spark, f"{folder}/lane={lane}", max_files_per_trigger=1)
            admitted = {"admitted": _admitted(lane)}
            writer = streams.table_writer(root, admitted, writer=f"lane{lane}")
            running.append(
                streams.start(stream, writer, new_folder(spark, "checkpoint"), seconds=None)
            )
        for query in running:
            query.awaitTermination()
    sizes = read_table(spark, root, "admitted").groupBy("lane", "batch_id").count()
    return sizes.agg(
        F.sum("count").alias("messages"),
        F.count("*").alias("batches"),
        F.max("count").alias("largest"),
    )


def _admitted(lane):
    return lambda batch: batch.select("partition", "offset", F.lit(lane).alias("lane"))


def packet_files(spark, sf_dir):
    """Packets decoded on a stream into files, read back."""
    stream = _recorded(spark, byte_values(samples.packet_records(spark, sf_dir)), "packets")
    path = new_folder(spark, "packet-files")
    flows = packets.decode_packets(stream).drop("key", "value")
    _finish(
        spark, streams.file_stream, flows, path, new_folder(spark, "checkpoint"), format="parquet"
    )
    return spark.read.parquet(path).select(
        "partition", "offset", "flow_index", "protocol", "srcIp", "destIp", "srcPort", "destPort"
    )


# --- Vendor alerts, metadata, schema-less records -------------------------------------------------


def vendor_alert_rows(spark, sf_dir):
    return jobs.vendor_rows(samples.vendor_lines(spark, sf_dir))


def metadata_rows(spark, sf_dir):
    return jobs.metadata_rows(samples.metadata_lines(spark, sf_dir))


def _schemaless(lines, keys, **options):
    parsed = records.parse_loose_lines(text_values(lines, null_as_empty=True), **options)
    rows = project.schemaless_rows(records.usable(parsed))
    return project.pivot_fields(rows, keys).withColumn("extras", F.size("extras"))


def schemaless_rows(spark, sf_dir):
    return _schemaless(samples.vendor_lines(spark, sf_dir, plain_brackets=True), VENDOR_KEYS)


def schemaless_metadata_rows(spark, sf_dir):
    rows = _schemaless(samples.metadata_lines(spark, sf_dir), METADATA_KEYS)
    return rows.withColumnRenamed("content_length ", "content_length_key")


def _line_table(job, encode, **options):
    """What a line job has written to its table, read back."""

    def query(spark, sf_dir):
        root = new_folder(spark, f"lines-{job}")
        jobs.run_line_batch(job, encode(spark, sf_dir, **options), root, batch_id=0)
        return read_table(spark, root, jobs.LINE_JOBS[job][0]).drop("batch_id")

    return query


vendor_table_rows = _line_table("vendor", samples.vendor_lines)
metadata_table_rows = _line_table("metadata", samples.metadata_lines)


def schemaless_table_rows(spark, sf_dir):
    written = _line_table("vendor_loose", samples.vendor_lines, plain_brackets=True)
    rows = project.pivot_fields(written(spark, sf_dir), VENDOR_KEYS)
    return rows.withColumn("extras", F.size("extras"))


def schemaless_metadata_table_rows(spark, sf_dir):
    written = _line_table("metadata_loose", samples.metadata_lines)
    rows = project.pivot_fields(written(spark, sf_dir), METADATA_KEYS)
    return rows.withColumn("extras", F.size("extras")).withColumnRenamed(
        "content_length ", "content_length_key"
    )


def vendor_table_compacted(spark, sf_dir):
    """The vendor table after three batches, compacted twice, with a repeated batch in between."""
    lines = samples.vendor_lines(spark, sf_dir)
    root = new_folder(spark, "lines-compacted")
    parts = [lines.filter(F.col("offset") % 3 == n) for n in range(3)]
    jobs.run_line_batch("vendor", parts[0], root, batch_id=0)
    jobs.run_line_batch("vendor", parts[1], root, batch_id=1)
    commits.compact(spark, root)
    jobs.run_line_batch("vendor", parts[1], root, batch_id=1)
    jobs.run_line_batch("vendor", parts[2], root, batch_id=2)
    commits.compact(spark, root)
    commits.vacuum(spark, root)
    return read_table(spark, root, jobs.LINE_JOBS["vendor"][0]).drop("batch_id")


def backfill_table_rows(spark, sf_dir):
    root = new_folder(spark, "backfill")
    jobs.run_backfill_batch(samples.backfill_lines(spark, sf_dir), root, batch_id=0)
    return read_table(spark, root, jobs.BACKFILL_TABLE).drop("batch_id")


def report_table_rows(spark, sf_dir):
    root = new_folder(spark, "report")
    jobs.run_report_batch(samples.alarm_messages(spark, sf_dir), root, batch_id=0)
    return _reported(read_table(spark, root, jobs.REPORT_TABLE).drop("batch_id"))


def typed_record_counts(spark, sf_dir):
    """Records read with a declared schema, and those that are no whole object."""
    typed = nested.typed_records(
        samples.alarm_messages(spark, sf_dir, broken=True), NESTED_REPORT_SCHEMA
    )
    outcome = F.coalesce("reject_reason", F.lit("read")).alias("outcome")
    return typed.groupBy(outcome).agg(F.count("*").alias("n"))


def reject_counts(spark, sf_dir):
    """Everything left out, by source and reason."""
    alarms = jobs.alarm_rejects(samples.alarm_messages(spark, sf_dir, broken=True))
    vendor = text_values(samples.vendor_lines(spark, sf_dir, trailing=True), null_as_empty=True)
    metadata = text_values(
        samples.metadata_lines(spark, sf_dir, trailing=True), null_as_empty=True
    )
    lines = samples.backfill_lines(spark, sf_dir)
    parts = [
        alarms.select("topic", "reject_reason"),
        records.rejects(records.parse_vendor_lines(vendor)).select("topic", "reject_reason"),
        records.rejects(records.parse_metadata_lines(metadata)).select("topic", "reject_reason"),
        backfill.backfill_rejects(lines).select(
            F.lit("backfill").alias("topic"), "reject_reason"
        ),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("topic", "reject_reason").agg(F.count("*").alias("n"))


# --- Packets --------------------------------------------------------------------------------------


def packet_header(spark, sf_dir):
    records_in = samples.packet_records(spark, sf_dir)
    return packets.decode_header(records_in).select("partition", "offset", *packets.HEADER_FIELDS)


def packet_flow(spark, sf_dir):
    flows = packets.decode_flow(samples.packet_records(spark, sf_dir))
    return flows.select(
        "partition",
        "offset",
        "destMac",
        "srcMac",
        "ethType",
        "protocol",
        "srcIp",
        "destIp",
        "srcPort",
        "destPort",
        F.hex("packetData").alias("packetData"),
    )


def packet_dropped(spark, sf_dir):
    outcomes = packets.dropped_packets(samples.packet_records(spark, sf_dir))
    return outcomes.select("outcome", F.col("count").alias("n"))


def packet_key(spark, sf_dir):
    value = F.col("value")
    return samples.packet_records(spark, sf_dir).select(
        "partition",
        "offset",
        packets.packet_key(value).alias("packet_key"),
        packets.packet_key(value, "serial_seq").alias("serial_seq"),
    )


# --- CSV, Wi-Fi, nested tables, text ----------------------------------------------------------------


def csv_backfill(spark, sf_dir):
    return jobs.backfill_rows(samples.backfill_lines(spark, sf_dir))


def wifi_rows(spark, sf_dir):
    return project.wifi_rows(samples.wifi_lines(spark, sf_dir))


def nested_table(spark, sf_dir):
    report = nested.nested_report(samples.alarm_messages(spark, sf_dir))
    report.createOrReplaceTempView("report")
    table = spark.sql("SELECT * FROM report")
    return table.select(
        "messageDeviceSerialId",
        "messageNumber",
        "reserved",
        "tempVerifyCode",
        "messageSplit",
        F.inline("basicMessageBasicList"),
    )


def nested_typed(spark, sf_dir):
    typed = nested.typed_report(samples.usage_lines(spark, sf_dir))
    return typed.select("userId", "day", F.inline("data"))


def nested_fields(spark, sf_dir):
    return nested.numbered_fields(nested_typed(spark, sf_dir))


def dashed_id_format(spark, sf_dir):
    lines = samples.usage_lines(spark, sf_dir)
    row_id = stable_id(F.col("topic"), F.col("partition"), F.col("offset"))
    return lines.select("partition", "offset", dashed(row_id).alias("uuid"))


def _document_lines(spark, sf_dir):
    documents_in = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents_in.select(F.explode(F.split("text", "\n", -1)).alias("value"))


def text_copy(spark, sf_dir):
    path = new_folder(spark, "text-copy")
    write_lines(_document_lines(spark, sf_dir), path)
    return files.text_lines(spark, path)


def text_copy_stream(spark, sf_dir):
    """Text files from a stream that is stopped and started again while files arrive."""
    folder, out = new_folder(spark, "lines"), new_folder(spark, "text-stream")
    checkpoint = new_folder(spark, "checkpoint")
    half = F.col("doc_id") % 2
    documents_in = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for part in (0, 1):
        lines = documents_in.filter(half == part).select(
            F.explode(F.split("text", "\n", -1)).alias("value")
        )
        lines.write.mode("append").option("lineSep", "\n").text(folder)
        # The second start goes on from the checkpoint: files of the first half are not read again.
        _finish(
            spark, streams.file_stream, files.text_line_stream(spark, folder), out, checkpoint,
            format="text",
        )
    return files.text_lines(spark, out)


def raw_line_table(spark, sf_dir):
    root = new_folder(spark, "raw-lines")
    rows = _document_lines(spark, sf_dir).select(F.col("value").alias("size"))
    write_batch(rows, root, "netcat2", 0)
    return read_table(spark, root, "netcat2").drop("batch_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "explode_alarms": explode_alarms,
    "classify_gen0": _classified(0),
    "classify_gen1": _classified(1),
    "classify_gen2": _classified(2),
    "strict_code_match": _classified(1, mixed_codes=True),
    "route_counts_gen0": _route_counts(0),
    "route_counts_gen1": _route_counts(1),
    "route_counts_gen2": _route_counts(2),
    "route_messages": route_messages,
    "merge_detail_gen0": _merge_detail(0),
    "merge_detail": _merge_detail(1),
    "merge_detail_gen2": _merge_detail(2),
    "merge_detail_salted": merge_detail_salted,
    "merge_summary_gen0": _merge_summary(0),
    "merge_summary": _merge_summary(1),
    "merge_summary_gen2": _merge_summary(2),
    "merge_summary_stream": merge_summary_stream,
    "merge_detail_stream": merge_detail_stream,
    "merge_by_window_size": merge_by_window_size,
    "immediate_alarms": immediate_alarms,
    "report_rows": report_rows,
    "warning_table_rows": _warning_table_rows(2),
    "warning_table_rows_gen1": _warning_table_rows(1),
    "warning_table_rows_gen0": _warning_table_rows(0),
    "detail_table_rows": _detail_table_rows(2),
    "detail_table_rows_gen1": _detail_table_rows(1),
    "detail_table_rows_gen0": _detail_table_rows(0),
    "vendor_alert_rows": vendor_alert_rows,
    "metadata_rows": metadata_rows,
    "schemaless_rows": schemaless_rows,
    "schemaless_metadata_rows": schemaless_metadata_rows,
    "vendor_table_rows": vendor_table_rows,
    "metadata_table_rows": metadata_table_rows,
    "schemaless_table_rows": schemaless_table_rows,
    "schemaless_metadata_table_rows": schemaless_metadata_table_rows,
    "vendor_table_compacted": vendor_table_compacted,
    "backfill_table_rows": backfill_table_rows,
    "report_table_rows": report_table_rows,
    "typed_record_counts": typed_record_counts,
    "reject_counts": reject_counts,
    "packet_header": packet_header,
    "packet_flow": packet_flow,
    "packet_dropped": packet_dropped,
    "packet_key": packet_key,
    "packet_files": packet_files,
    "csv_backfill": csv_backfill,
    "wifi_rows": wifi_rows,
    "nested_table": nested_table,
    "nested_typed": nested_typed,
    "nested_fields": nested_fields,
    "count_by_id_stream": count_by_id_stream,
    "count_by_id_changelog": count_by_id_changelog,
    "admitted_batches": admitted_batches,
    "dashed_id_format": dashed_id_format,
    "text_copy": text_copy,
    "text_copy_stream": text_copy_stream,
    "raw_line_table": raw_line_table,
}


def _configured(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _configured(query) for name, query in QUERIES.items()}
