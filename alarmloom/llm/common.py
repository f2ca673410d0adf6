"""Helpers shared by the corpus operators: reading, row keys, word hashes, and counters by slot."""

import ctypes
import gc
import hashlib
import os
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from alarmloom.session import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEGMENT = 1 << 16
FAN_IN = 64
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that no node must install it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="alarmloom-"), "alarmloom.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, top))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder. Texts may be long, so Arrow batches are kept to 500 rows or 32 MB,
    whichever is less; the settings stay, since the rows are read when the caller asks for them."""
    ship(spark)
    spark.conf.set(ARROW_ROWS, "500")
    spark.conf.set(ARROW_BYTES, "32m")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(rows: DataFrame, name: str) -> str:
    """`name`, or the first of `name`_1, `name`_2 ... that no column of `rows` has in any case."""
    taken, free, number = {c.lower() for c in rows.columns}, name, 0
    while free.lower() in taken:
        number += 1
        free = f"{name}_{number}"
    return free


def ranked(rows: DataFrame, order: list[Column], name: str, rank: str) -> DataFrame:
    """The rows staged with their rank, from 0, in the given order.

    Rows are range-partitioned and sorted; a row's rank is its place in its partition plus the rows of
    the partitions before it. One number per partition comes to the driver.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number holds the partition in its upper bits and the place in it in the lower 33.
    written = stage(ordered.withColumn(rank, F.monotonically_increasing_id()), name)
    part = F.shiftright(F.col(rank), 33)
    sizes = written.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).collect()
    before, total = {}, 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        before[r["part"]], total = total, total + r["rows"]
    if not before:
        return written
    # One row per partition of the shuffle, whatever the data: safe to broadcast.
    own = free_name(written, "offset")
    offsets = rows.sparkSession.createDataFrame(list(before.items()), "part long, before long")
    offsets = offsets.select(F.struct("part", "before").alias(own))
    place = F.col(rank).bitwiseAND(F.lit((1 << 33) - 1))
    met = written.join(F.broadcast(offsets), part == F.col(f"{own}.part"))
    return met.withColumn(rank, F.col(f"{own}.before") + place).drop(own)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A 64-bit hash of a row's id and text, defined for nulls and repeated ids too. It spreads rows
    and draws samples; it does not tell rows apart, which `numbered` does."""
    own, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return F.xxhash64(own.isNull(), own, text.isNull(), text)


def _straight_from_files(docs: DataFrame) -> bool:
    """Is each row one row of a file, and only projected and filtered?"""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan.nodeName() == "LogicalRelation" and bool(docs.inputFiles())


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows with a number of their own each, and the name of that column, which no column of `docs`
    has. Retries and other partitionings keep the numbers.

    Rows read straight from files are numbered by their file and their place in it, without being
    written again; others are staged with their number. The list of files, which the driver holds
    anyway, is joined by broadcast.
    """
    number, spark = free_name(docs, "number"), docs.sparkSession
    try:
        placed = docs.select(F.col("_metadata.file_path"), F.col("_metadata.row_index")).select("file_path")
    except AnalysisException:
        placed = None
    if placed is None or not _straight_from_files(docs):
        return stage(docs.withColumn(number, F.monotonically_increasing_id()), name), number
    paths = sorted(r["file_path"] for r in placed.distinct().collect())
    files = spark.createDataFrame(list(enumerate(paths)), "file long, path string")
    own = free_name(docs, "file")
    files = F.broadcast(files.select(F.struct("file", "path").alias(own)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    rows = docs.select(*columns, at.alias(number)).join(files, F.col(f"{number}.file_path") == F.col(f"{own}.path"))
    # The file's number stands above the lower 33 bits, like a partition's in Spark's own row numbers.
    found = F.shiftleft(F.col(f"{own}.file"), 33) + F.col(f"{number}.row_index")
    return rows.select(*columns, found.alias(number)), number


def crc_of_id(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


class Memo(dict):
    """A function's results by argument; emptied when it holds `most`, so memory stays bounded."""

    def __init__(self, function: Callable, most: int = 250_000):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.function(key)
        return value


def release() -> None:
    """Gives memory that a task no longer uses back to the system: Spark's Python workers live on, and
    what they keep is missing to the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # no such call outside glibc


def hash64(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (two multiply and shift rounds)."""
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(31))


# --- Counters by slot ---------------------------------------------------------------------------

PARTS = "segment int, part int, counts binary"


def packed(counts: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(counts, np.uint32).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint32)


def slot_counts(
    rows: DataFrame, slots_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], width: int
) -> DataFrame:
    """(segment, counts): how often each slot below `width` occurs over all rows.

    Every task counts its own rows and sends one compressed array per segment of 65,536 slots that
    it met; the arrays are then added in groups of at most 64, level by level, so that no task
    gathers more than 64 arrays of a segment however many tasks there are. Slots wait in 32 bits and
    are sorted in place: a task holds some 32 MB of them.
    """
    kind = np.min_scalar_type(max(width - 1, SEGMENT))

    def count(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        waiting, held, totals = [], 0, {}

        def settle():
            slots = np.concatenate(waiting)
            waiting.clear()
            slots.sort()
            starts = np.searchsorted(slots, np.arange(0, width, SEGMENT, dtype=kind))
            ends = np.append(starts[1:], len(slots))
            for segment in np.flatnonzero(ends > starts).tolist():
                own = slots[starts[segment] : ends[segment]] % kind.type(SEGMENT)
                counted = np.bincount(own.astype(np.int64), minlength=SEGMENT)
                if segment in totals:
                    counted = counted + unpacked(totals[segment])
                totals[segment] = packed(counted)

        for batch in batches:
            for slots in slots_of(batch):
                waiting.append(slots.astype(kind))
                held += len(slots)
                if held >= 1 << 22:
                    settle()
                    held = 0
        if waiting:
            settle()
        waiting.clear()
        release()
        for segment, counts in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), pa.array([part], pa.int32()),
                 pa.array([counts], pa.binary())],
                ["segment", "part", "counts"],
            )

    def add(group):
        total = np.zeros(SEGMENT, np.uint32)
        for data in group.column("counts"):
            total = total + unpacked(data.as_py())
        return pa.table(
            {"segment": group.column("segment")[:1], "part": group.column("part")[:1],
             "counts": pa.array([packed(total)], pa.binary())}
        )

    parts = rows.mapInArrow(count, PARTS)
    left = rows.rdd.getNumPartitions()
    while True:
        parts = parts.withColumn("part", (F.col("part") / FAN_IN).cast("int"))
        parts = parts.groupBy("segment", "part").applyInArrow(add, PARTS)
        left = -(-left // FAN_IN)
        if left <= 1:
            return parts.select("segment", "counts")


def slot_table(counts: DataFrame, width: int) -> np.ndarray:
    """All counters in one array; its size is set by `width`, not by the data."""
    total = np.zeros(width, np.uint32)
    for row in counts.toLocalIterator():
        at = row.segment * SEGMENT
        own = unpacked(row.counts)[: width - at]
        total[at : at + len(own)] = own
    return total


# --- Bloom filters ------------------------------------------------------------------------------

HASHES = 4
BITS_PER_KEY = 16
MOST_BITS = 1 << 28


def bloom_width(keys: int) -> int:
    """16 bits a key, between 2^16 and 2^28 bits (32 MB).

    Beyond 16 million keys the filter gets fuller and lets more keys pass; whatever passes is
    checked exactly afterwards, so results do not depend on it.
    """
    return min(MOST_BITS, max(SEGMENT, -(-keys * BITS_PER_KEY // SEGMENT) * SEGMENT))


def bloom_slots(first: np.ndarray, second: np.ndarray, width: int) -> np.ndarray:
    """The `HASHES` slots of each key, one row per hash."""
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    return (first[None, :] + steps * (second[None, :] | np.uint64(1))) % np.uint64(width)


def bloom_bits(slots: DataFrame, slots_of, width: int, least: int) -> np.ndarray:
    """Bit i is set if slot i was met `least` times or more; packed, at most 32 MB.

    With `least` = 2 this is the second of two stacked filters: a key that occurs twice has all
    its slots met twice, so it always passes.
    """

    def threshold(batches):
        for batch in batches:
            bits = [np.packbits(unpacked(c.as_py()) >= least).tobytes() for c in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([zlib.compress(b, 1) for b in bits], pa.binary())],
                ["segment", "bits"],
            )

    counted = slot_counts(slots, slots_of, width)
    total = np.zeros(width // 8, np.uint8)
    for row in counted.mapInArrow(threshold, "segment int, bits binary").toLocalIterator():
        own = np.frombuffer(zlib.decompress(row.bits), np.uint8)
        at = row.segment * SEGMENT // 8
        total[at : at + len(own)] = own[: len(total) - at]
    return total


def passes(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For each key (column of `slots`): are all its bits set?"""
    slots = slots.astype(np.int64)
    return ((bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1).all(axis=0)


# --- Connected components -----------------------------------------------------------------------


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for every node of `edges` (a, b); label: the smallest node it can reach.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    chains halve; labels are written to the shared folder after each round. Only joins and
    aggregates with map-side partials are used: a hub with many edges is no group of its own.
    """
    both = stage(
        edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges"
    )
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("label")
        ),
        f"{name}-labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        lower = stage(lower, f"{name}-lower")
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = stage(
            lower.join(jump, "label").select(
                "node", F.col("next").alias("label"), (F.col("next") != F.col("old")).alias("moved")
            ),
            f"{name}-labels",
        )
        labels = moved.select("node", "label")
        if moved.filter("moved").isEmpty():
            return labels
