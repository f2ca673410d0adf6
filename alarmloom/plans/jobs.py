"""The five jobs end to end, as batch plans and as streaming queries."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from alarmloom.operators import alarms as al
from alarmloom.operators import backfill, classify, merge, packets, project, records
from alarmloom.schemas import MESSAGE_SCHEMA, METADATA_COLUMNS, VENDOR_COLUMNS
from alarmloom.session import staging
from alarmloom.sinks import commits
from alarmloom.sinks.commits import table_writer
from alarmloom.sinks.tables import read_table
from alarmloom.sources.kafka import text_values
from alarmloom.streaming import merge as stream_merge
from alarmloom.streaming import queries as streams
from alarmloom.streaming.merge import SPAN
from alarmloom.streaming.queries import start

REJECTS = "rejects"


def classified_alarms(
    messages: DataFrame,
    generation: int = 2,
    clock: str = "arrival",
    strict: bool = False,
    keep_rejects: bool = False,
) -> DataFrame:
    """Messages to classified, routed alarms.

    Bad messages and alarms are left out, or fail the job if `strict`, or stay under the route
    `rejected` if `keep_rejects`.
    """
    parsed = records.parse_alarm_messages(text_values(messages, null_as_empty=True), clock)
    if keep_rejects:
        exploded = al.explode_alarms(parsed, generation, keep_rejects=True)
        return classify.route_rejects(classify.classify(exploded, generation))
    # Rejected messages have no alarm list, so exploding leaves them out without a filter.
    exploded = al.explode_alarms(records.strict(parsed) if strict else parsed, generation)
    keep = records.strict if strict else al.usable_alarms
    return classify.classify(keep(exploded), generation)


def alarm_rejects(messages: DataFrame) -> DataFrame:
    """Messages and nested alarms that `classified_alarms` leaves out, with the reason."""
    parsed = records.parse_alarm_messages(text_values(messages, null_as_empty=True))
    return records.rejects(al.explode_alarms(parsed, keep_rejects=True))


MERGED_ROUTES = [classify.TRANSFORMATION, classify.CAMOUFLAGE]


def is_merged(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("route").isin(MERGED_ROUTES))


def is_immediate(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("route") == classify.LABEL)


def detail_tables(generation: int) -> dict[str, str]:
    """Route to detail table."""
    job = al.GENERATIONS[generation]
    tables = {classify.TRANSFORMATION: job.transformation_table}
    if job.camouflage_table is not None:
        tables[classify.CAMOUFLAGE] = job.camouflage_table
    return tables


HEADS = "merged_heads"
REPLACED = "merged_replaced"
LATE = "late"


def _merged_tables(
    merged: DataFrame, generation: int, stage: Callable[..., DataFrame]
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Staged summaries of staged rows of merged routes, and the detail tables.

    How many summaries there are is known before rows meet them, so they are broadcast only within
    a bound; else the join goes by salted keys.
    """
    ends = stage(merge.merge_ends(merged), "ends")
    count = ends.count()
    summaries = stage(merge.merge_summaries(merged, ends=ends, max_heads=count), "summaries")
    details = merge.attach_pid(merged, summaries, count)
    tables = {
        table: project.detail_rows(details.filter(F.col("route") == route), generation)
        for route, table in detail_tables(generation).items()
    }
    return summaries, tables


def run_alarm_batch(
    messages: DataFrame,
    root: str,
    batch_id: int,
    generation: int = 2,
    seconds: int | None = None,
) -> None:
    """One bounded slice of messages into the alarm tables, which become visible together.

    The messages are parsed once, into a staged table with a folder per route (rejects included),
    and every later step reads only its routes. The staged tables are deleted when the job ends.
    """
    job = al.GENERATIONS[generation]
    spark = messages.sparkSession
    rows = classified_alarms(messages, generation, keep_rejects=True)
    rows = merge.with_window(rows, seconds or job.window_seconds)
    with staging(spark) as stage:
        rows = stage(rows, "classified", by="route")
        rejected = rows.filter(F.col("route") == classify.REJECTED)
        rows = rows.drop("value", "reject_reason")
        summaries, tables = _merged_tables(is_merged(rows), generation, stage)
        tables[job.warning_table] = project.immediate_rows(is_immediate(rows), generation).unionByName(
            project.summary_rows(summaries, generation), allowMissingColumns=True
        )
        tables[REJECTS] = records.rejects(rejected)
        commits.write_tables(spark, root, batch_id, tables)


def start_alarm_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    generation: int = 2,
    seconds: int | None = None,
    clock: str = "processing",
    delay: str | None = None,
    trigger_seconds: int | None = 8,
    files_per_trigger: int | None = None,
    span: int = SPAN,
) -> list[StreamingQuery]:
    """Three queries. The first reads the topic, once, into the table `classified`. The others read
    that table: alarms and rejects stored at once (no state), and merged alarms (a count per open
    window as state).

    With the processing clock a heartbeat closes windows while no message comes; a run without a
    trigger would end before that, so it needs the arrival clock. Alarms that come later than
    `delay` stay in `classified` until `reconcile_merged` brings them in. A run without a trigger
    finishes the first query before it starts the others.
    """
    if clock == "processing" and trigger_seconds is None:
        raise ValueError("a bounded run would leave its last windows open: use clock='arrival'")
    if delay is None:
        # Rows reach the table a trigger after their time.
        delay = "0 seconds" if clock == "arrival" else f"{2 * (trigger_seconds or 0)} seconds"
    job = al.GENERATIONS[generation]
    spark = messages.sparkSession
    seconds = seconds or job.window_seconds
    everything = classified_alarms(messages, generation, clock, keep_rejects=True)
    schema, path = streams.classified_schema(everything), f"{root}/classified"
    reading = streams.classified_stream(everything, path, f"{checkpoint}/classified", trigger_seconds, span)
    if trigger_seconds is None:
        reading.awaitTermination()
    stored = streams.stream_classified(spark, path, schema, files_per_trigger).drop("span")
    immediate = start(
        stored.filter(F.col("route").isin(classify.LABEL, classify.REJECTED)),
        table_writer(
            f"{root}/immediate",
            {
                job.warning_table: lambda b: project.immediate_rows(is_immediate(b), generation),
                REJECTS: records.rejects,
            },
        ),
        f"{checkpoint}/immediate",
        seconds=trigger_seconds,
    )
    rows = is_merged(stored).select("event_ts", "route", "type_label")
    if clock == "processing":
        rows = stream_merge.with_heartbeat(rows)
    merged = start(
        stream_merge.closed_windows(rows, seconds, delay),
        _closed_writer(root, schema, generation, seconds, span),
        f"{checkpoint}/merged",
        seconds=trigger_seconds,
    )
    return [reading, immediate, merged]


def _write_groups(
    spark: SparkSession,
    root: str,
    schema: StructType,
    generation: int,
    seconds: int,
    span: int,
    groups: DataFrame,
    batch_id: int,
    writer: str,
    replaced: DataFrame | None = None,
) -> None:
    """All stored rows of the staged `groups` (route, label, window) merged and written, with the
    heads of the groups, as one commit."""
    first, last = groups.agg(F.min("win"), F.max("win")).first()
    with staging(spark) as stage:
        classified = streams.read_classified(spark, f"{root}/classified", schema)
        rows = stream_merge.rows_of_windows(is_merged(classified), seconds, first, last, span)
        rows = merge.meet(rows, groups.select(*merge.KEYS), groups.count(), how="left_semi")
        rows = stage(rows.drop("value", "reject_reason", "span"), "closed-rows")
        summaries, tables = _merged_tables(rows, generation, stage)
        tables[al.GENERATIONS[generation].warning_table] = project.summary_rows(summaries, generation)
        tables[HEADS] = summaries.select(*merge.KEYS, "pid", F.col("date").alias("last_date"), "size")
        version = F.lit(0 if replaced is None else batch_id + 1).cast("long").alias("version")
        tables = {table: made.select("*", version) for table, made in tables.items()}
        if replaced is not None:
            tables[REPLACED] = replaced.select("pid", version)
        commits.write_tables(spark, f"{root}/merged", batch_id, tables, writer)


def _closed_writer(root: str, schema: StructType, generation: int, seconds: int, span: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if commits.is_committed(spark, f"{root}/merged", batch_id, "closed"):
            return
        with staging(spark) as stage:
            groups = stage(is_merged(batch).select(*merge.KEYS), "closed")
            if not groups.isEmpty():
                _write_groups(
                    spark, root, schema, generation, seconds, span, groups, batch_id, "closed"
                )

    return write


def read_merged(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of merged alarms as last merged: rows of groups that were merged anew are left out in
    their older form."""
    folder = f"{root}/merged"
    rows = read_table(spark, folder, table)
    if commits.has_table(spark, folder, REPLACED):
        anew = read_table(spark, folder, REPLACED).groupBy("pid").agg(F.max("version").alias("newest"))
        old = (rows["pid"] == anew["pid"]) & (rows["version"] < anew["newest"])
        rows = rows.join(anew, old, "left_anti")
    return rows.drop("version")


def reconcile_merged(
    spark: SparkSession,
    root: str,
    number: int,
    generation: int = 2,
    seconds: int | None = None,
    since: int | None = None,
    span: int = SPAN,
) -> int:
    """Merges anew the groups of closed windows that got rows after they were merged; returns how many.

    Closed are the windows up to the last that the stream has merged; `since` (epoch seconds) leaves
    older ones alone. A group is merged whole from the stored rows: details, count, last date, and a
    new id where the late row is the first. Everything becomes visible in one commit of `number`;
    a second run finds nothing to do, and a run that failed leaves nothing.
    """
    if commits.is_committed(spark, f"{root}/merged", number, LATE):
        raise ValueError(f"number {number} is taken")
    if not commits.has_table(spark, f"{root}/merged", HEADS):
        return 0
    seconds = seconds or al.GENERATIONS[generation].window_seconds
    schema = streams.classified_schema(
        classified_alarms(spark.createDataFrame([], MESSAGE_SCHEMA), generation, keep_rejects=True)
    )
    heads = read_merged(spark, root, HEADS)
    last = heads.agg(F.max("win")).first()[0]
    if since is not None:
        since = since // seconds * seconds
        heads = heads.filter(F.col("win") >= since)
    with staging(spark) as stage:
        heads = stage(heads, "heads")
        classified = streams.read_classified(spark, f"{root}/classified", schema)
        rows = stream_merge.rows_of_windows(is_merged(classified), seconds, since, last, span)
        groups = stage(stream_merge.late_groups(rows, heads), "late")
        count = groups.count()
        if count:
            replaced = heads.join(groups, merge.KEYS).select("pid")
            _write_groups(
                spark, root, schema, generation, seconds, span, groups, number, LATE, replaced
            )
    return count


def stream_warnings(spark: SparkSession, root: str, generation: int = 2) -> DataFrame:
    """Immediate alarms and summaries that `start_alarm_stream` has written so far."""
    table = al.GENERATIONS[generation].warning_table
    return read_table(spark, f"{root}/immediate", table).unionByName(
        read_merged(spark, root, table), allowMissingColumns=True
    )


# Tables of the line formats, with their columns where these are declared.
LINE_JOBS = {
    "vendor": ("bus_ahwarning", VENDOR_COLUMNS, records.parse_vendor_lines),
    "metadata": ("bus_ahmetadata", METADATA_COLUMNS, records.parse_metadata_lines),
    "vendor_loose": ("bus_ahwarning_local", None, records.parse_loose_lines),
    "metadata_loose": ("Matedata", None, records.parse_loose_lines),
}
BACKFILL_TABLE = "bus_twarning_local"
REPORT_TABLE = "report"


def _parsed_lines(job: str, lines: DataFrame, mode: str, clock: str) -> DataFrame:
    return LINE_JOBS[job][2](text_values(lines, null_as_empty=True), mode, clock)


def _line_rows(job: str, parsed: DataFrame) -> DataFrame:
    columns = LINE_JOBS[job][1]
    rows = records.usable(parsed)
    return project.schemaless_rows(rows) if columns is None else project.fixed_projection(rows, columns)


def vendor_rows(lines: DataFrame, mode: str = "reference", clock: str = "arrival") -> DataFrame:
    return _line_rows("vendor", _parsed_lines("vendor", lines, mode, clock))


def metadata_rows(lines: DataFrame, mode: str = "reference", clock: str = "arrival") -> DataFrame:
    return _line_rows("metadata", _parsed_lines("metadata", lines, mode, clock))


def _line_writer(job: str, root: str, replace: bool = False):
    tables = {LINE_JOBS[job][0]: lambda b: _line_rows(job, b), REJECTS: records.rejects}
    return table_writer(root, tables, replace=replace)


def _without_read_text(parsed: DataFrame) -> DataFrame:
    """Only rejects keep their raw text; of the others the document is all that the tables read."""
    return parsed.withColumn("value", F.when(F.col("reject_reason").isNotNull(), F.col("value")))


def run_line_batch(
    job: str, lines: DataFrame, root: str, batch_id: int, mode: str = "reference"
) -> None:
    """One slice of a line format into its table, and what cannot be parsed."""
    parsed = _parsed_lines(job, lines, mode, "arrival")
    _line_writer(job, root, replace=True)(_without_read_text(parsed), batch_id)


def start_line_stream(
    job: str,
    lines: DataFrame,
    root: str,
    checkpoint: str,
    mode: str = "reference",
    clock: str = "processing",
    trigger_seconds: int | None = 8,
) -> StreamingQuery:
    """The same without end. There is no state and no shuffle."""
    parsed = _without_read_text(_parsed_lines(job, lines, mode, clock))
    return start(parsed, _line_writer(job, root), checkpoint, seconds=trigger_seconds)


def packet_rows(messages: DataFrame) -> DataFrame:
    return packets.decode_packets(messages)


def backfill_rows(lines: DataFrame) -> DataFrame:
    return backfill.backfill_rows(lines)


def run_backfill_batch(lines: DataFrame, root: str, batch_id: int) -> None:
    """Historical CSV into its table; lines with too few fields are kept aside."""
    tables = {
        BACKFILL_TABLE: backfill.backfill_rows(lines),
        f"{BACKFILL_TABLE}_rejects": backfill.backfill_rejects(lines),
    }
    commits.write_tables(lines.sparkSession, root, batch_id, tables)


def run_report_batch(messages: DataFrame, root: str, batch_id: int) -> None:
    """Raw alarms, not classified, into the report table, with the rejects."""
    parsed = records.parse_alarm_messages(text_values(messages, null_as_empty=True))
    with staging(messages.sparkSession) as stage:
        alarms = stage(al.explode_alarms(parsed, keep_rejects=True), "report")
        tables = {
            REPORT_TABLE: project.report_rows(al.usable_alarms(alarms)),
            REJECTS: records.rejects(alarms),
        }
        commits.write_tables(messages.sparkSession, root, batch_id, tables)
