"""Exact deduplication with two Bloom filters: only possibly repeated texts are shuffled.

The first pass counts, in four slots per text hash, whether a slot was met twice. The second pass
probes: a text with a slot met only once has no copy and goes straight through. The others, true
copies and a few false alarms, are grouped by their full digest with map-side partials.

Rows are numbered once, in a staged table; of equal texts exactly one row stays.

Defined results: null text counts as empty, so null and empty texts are copies of each other; of
equal texts the largest id stays (any non-null id before a null one), of rows that also share the id
the first of the table; an empty table gives an empty table; extra columns pass, whatever their names.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from alarmloom.llm import common
from alarmloom.session import stage

def digest(text: str = "text") -> Column:
    """SHA-256 of the text in UTF-8 after lower-casing A-Z."""
    return F.unhex(F.sha2(common.ascii_lower(common.text_or_empty(text)).cast("binary"), 256))


def _halves(digests: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = np.frombuffer(b"".join(digests.to_pylist()), np.uint64).reshape(-1, 4)
    return words[:, 0], words[:, 1]


def repeat_filter(digests: DataFrame) -> np.ndarray:
    """Bits of the filter of digests met twice, over one column of digests."""
    width = common.bloom_width(digests.count())

    def slots_of(batch):
        yield common.bloom_slots(*_halves(batch.column(0)), width).ravel()

    return common.bloom_bits(digests, slots_of, width, least=2)


def _prober(spark, bits: np.ndarray):
    shared, width = spark.sparkContext.broadcast(bits), len(bits) * 8

    @F.pandas_udf("boolean")
    def maybe(column):
        import pandas as pd

        slots = common.bloom_slots(*_halves(pa.array(column, pa.binary())), width)
        return pd.Series(common.passes(shared.value, slots))

    return maybe


def _first(number: str = "number") -> Column:
    """Orders the rows of equal texts: the one that stays has the largest value."""
    return F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), -F.col(number))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, digest, `keep_id`, `group_size`, `kept`."""
    keys = docs.select(F.col(f"`{id_col}`").alias("doc_id"), digest(f"`{text_col}`").alias("digest"))
    keys = stage(keys.withColumn("number", F.monotonically_increasing_id()), "dedup")
    maybe = _prober(keys.sparkSession, repeat_filter(keys.select("digest")))
    probed = keys.withColumn("maybe", maybe(F.col("digest")))
    single = probed.filter(~F.col("maybe")).select(
        "doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    again = stage(probed.filter("maybe").select("doc_id", "digest", "number"), "dedup-again")
    groups = stage(
        again.groupBy("digest").agg(
            F.max_by("number", _first()).alias("keep"),
            F.max("doc_id").alias("keep_id"),
            F.count("*").alias("group_size"),
        ),
        "dedup-groups",
    )
    found = again.join(groups, "digest").select(
        "doc_id", "digest", "keep_id", "group_size", (F.col("number") == F.col("keep")).alias("kept")
    )
    return single.unionByName(found)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; rows without a copy are never shuffled."""
    rows, number = common.numbered(docs, "dedup-rows")
    narrow = rows.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        digest(f"`{text_col}`").alias("digest"),
        F.col(number).alias("number"),
    )
    narrow = stage(narrow, "dedup")
    maybe = _prober(rows.sparkSession, repeat_filter(narrow.select("digest")))
    again = stage(narrow.filter(maybe(F.col("digest"))), "dedup-again")
    best = again.groupBy("digest").agg(F.max_by("number", _first()).alias("number")).select("number")
    gone = stage(again.join(best, "number", "left_anti").select(F.col("number").alias(number)), "dedup-gone")
    # Rows pass by their digest once more; only those it may be repeated for meet the list.
    key = common.free_name(rows, "digest")
    probed = rows.withColumn(key, maybe(digest(f"`{text_col}`")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    passing, met = probed.filter(~F.col(key)), probed.filter(F.col(key))
    left = met.join(gone.hint("merge"), number, "left_anti")
    return passing.select(*columns).unionByName(left.select(*columns))


def op7_exact_dedup(spark, sf_dir):
    return copies(common.table(spark, sf_dir, "documents")).select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP7_SQL = """
WITH normal AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       text_sha256
FROM normal WINDOW same AS (PARTITION BY text_sha256)
"""
