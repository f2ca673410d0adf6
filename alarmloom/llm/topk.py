"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector cut into segments of w components has in each segment a mean and a deviation. The squared
distance of two vectors is at least the sum of w ((difference of means)^2 + (difference of
deviations)^2), so their inner product is at most the sum of w (mean mean' + deviation deviation').
Few long segments give a cheap, loose bound, many short ones a tight one: candidates go through the
levels coarse to fine, and only what may still enter a query's k best is scored in full, in integers.

Rows lie in blocks of `ROWS`, queries in blocks of `BLOCK`. First each query meets the rows of its own
row block: its k-th score there is a bar that its k best must reach. Then the grid of query blocks and
row blocks is cut down by the blocks' coarse statistics, and the pairs of blocks that are left meet, each
in a task of its own choosing; nothing is broadcast and nothing but counts comes to the driver. Each
pair sends its k best per query, and a window over those few gives the final ranks.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do
rows without an id; a query row meets every row but itself, so rows that repeat its id are candidates
too, and query rows that repeat an id have k results each; vectors of another length than the query's
have no inner product with it and are passed over; empty vectors score 0; components and scores beyond
a long are held at its ends; an empty table gives an empty table; extra columns are ignored.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from alarmloom.llm import common
from alarmloom.session import stage

LEVELS = (2, 8, 32)
BLOCK = 2048
ROWS = 4096
SPREAD = 64
CELLS = 1 << 21
LONG = 1 << 63
BLOCKS = (
    "block long, width int, ids binary, numbers binary, bars binary, matrix binary, "
    "low array<double>, high array<double>, deviation array<double>, bar double"
)
FOUND = "query long, query_id long, vec_id long, score long"


def integer_vector(column: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if the vector takes no part."""
    usable = F.col(column).isNotNull() & F.forall(
        column,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    values = F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(usable, values)


def segment_statistics(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments in turn, each times the root of the segment's length."""
    parts = np.array_split(np.arange(matrix.shape[1]), min(segments, matrix.shape[1]) or 1)
    out = np.empty((len(matrix), 2 * len(parts)))
    for i, part in enumerate(parts):
        own, root = matrix[:, part], math.sqrt(len(part))
        if len(part):
            out[:, 2 * i], out[:, 2 * i + 1] = own.mean(axis=1) * root, own.std(axis=1) * root
        else:
            out[:, 2 * i : 2 * i + 2] = 0
    return out


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two integer matrices, held at the ends of a long."""
    if not len(x) or not x.shape[1]:
        return np.zeros(len(x), np.int64)
    # Python's own integers: the absolute value of the least long is none.
    largest = [max(-int(m.min()), int(m.max())) for m in (x, y)]
    if largest[0] * largest[1] * x.shape[1] < LONG:
        return np.einsum("ij,ij->i", x, y)
    sums = (sum(a * b for a, b in zip(p, q)) for p, q in zip(x.tolist(), y.tolist()))
    return np.array([min(LONG - 1, max(-LONG, s)) for s in sums], np.int64)


class Rows:
    """Vectors of one length: ids, row numbers, integers, and for queries the score to reach."""

    def __init__(self, ids, numbers, matrix, bars=None):
        self.ids, self.numbers, self.matrix = ids, numbers, matrix
        self.bars = np.full(len(ids), -np.inf) if bars is None else bars
        self.real = matrix.astype(np.float64)
        self.norm = np.sqrt((self.real**2).sum(axis=1))

    @classmethod
    def unpacked(cls, width, ids, numbers, bars, matrix):
        ids = np.frombuffer(ids, np.int64)
        values = np.frombuffer(matrix, np.int64).reshape(len(ids), width)
        return cls(ids, np.frombuffer(numbers, np.int64), values, np.frombuffer(bars, np.float64))

    def take(self, rows) -> "Rows":
        return Rows(self.ids[rows], self.numbers[rows], self.matrix[rows], self.bars[rows])


def best(queries: Rows, rows: Rows, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score): the k best rows of each query that may reach its bar, by score and id."""
    of, to = np.arange(len(queries.ids)), np.arange(len(rows.ids))
    may = queries.numbers[:, None] != rows.numbers[None, :]
    width = queries.matrix.shape[1]
    slack = 1e-9 * width * float(queries.norm.max(initial=0)) * float(rows.norm.max(initial=0)) + 1e-6
    if np.isfinite(queries.bars).any():
        for segments in LEVELS:
            bound = segment_statistics(queries.real[of], segments) @ segment_statistics(
                rows.real[to], segments
            ).T
            may &= bound + slack >= queries.bars[of, None]
            of_left, to_left = may.any(axis=1), may.any(axis=0)
            may, of, to = may[of_left][:, to_left], of[of_left], to[to_left]
            if not len(of):
                break
    none = np.zeros(0, np.int64)
    if not len(of) or not len(to):
        return none, none, none
    # Products as floats and how far they may be off, held at the ends of a long like the scores.
    about = queries.real[of] @ rows.real[to].T
    error = (width + 8) * 2.0**-50 * queries.norm[of, None] * rows.norm[None, to]
    bar = queries.bars[of]
    if len(to) > k:
        least = np.where(may, np.clip(about - error, -float(LONG), float(LONG)), -np.inf)
        bar = np.maximum(bar, np.partition(least, len(to) - k, axis=1)[:, len(to) - k])
    most = np.clip(about + error, -float(LONG), float(LONG))
    at, column = np.nonzero(may & (most >= bar[:, None]))
    at, column = of[at], to[column]
    step = max(1, CELLS // max(1, width))
    score = np.concatenate(
        [none]
        + [
            exact_products(queries.matrix[at[i : i + step]], rows.matrix[column[i : i + step]])
            for i in range(0, len(at), step)
        ]
    )
    order = np.lexsort((rows.ids[column], ~score, at))
    at, column, score = at[order], column[order], score[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    return at[place < k], column[place < k], score[place < k]


def _packer(most: int):
    """Puts the vectors of a task (vec_id, number, v, bar) into blocks of at most `most` of one length."""

    def pack(batches):
        held = {}

        def block(width):
            rows = held.pop(width)
            ids, numbers, vectors, bars = zip(*rows)
            matrix = np.array(vectors, np.int64).reshape(len(rows), width)
            found = segment_statistics(matrix.astype(np.float64), LEVELS[0])
            means, deviations = found[:, ::2], found[:, 1::2]
            columns = [
                [numbers[0]], [width], [np.array(ids, np.int64).tobytes()],
                [np.array(numbers, np.int64).tobytes()], [np.array(bars, np.float64).tobytes()],
                [matrix.tobytes()], [means.min(axis=0)], [means.max(axis=0)], [deviations.max(axis=0)],
                [min(bars)],
            ]
            kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 4 + [pa.list_(pa.float64())] * 3 + [pa.float64()]
            names = [c.split()[0] for c in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                width = len(row[2])
                held.setdefault(width, []).append(row)
                if len(held[width]) >= most:
                    yield block(width)
        for width in list(held):
            yield block(width)

    return pack


def _unpacked(batch, prefix: str = ""):
    """The blocks of an Arrow batch, one after another."""
    names = ["width", "ids", "numbers", "bars", "matrix"]
    columns = [batch.column("width" if n == "width" else prefix + n) for n in names]
    for values in zip(*columns):
        yield Rows.unpacked(*[v.as_py() for v in values])


def _bars(row_blocks: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(number, vec_id, v, bar) of the queries: the k-th score in their own block, if it has so many."""

    def search(batches):
        for batch in batches:
            for rows in _unpacked(batch):
                # In a row block the column of bars marks the queries.
                queries = rows.take(np.flatnonzero(rows.bars > 0))
                queries.bars = np.full(len(queries.ids), -np.inf)
                at, _, score = best(queries, rows, k)
                full = np.bincount(at, minlength=len(queries.ids)) == k
                last = np.searchsorted(at, np.flatnonzero(full), side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries.numbers[full]), pa.array(score[last].astype(np.float64))],
                    ["number", "bar"],
                )

    found = stage(row_blocks.mapInArrow(search, "number long, bar double"), "top-bars")
    # A bar is a float; half a unit in its last place below it is still sure to be no higher.
    lower = F.col("bar") - F.abs("bar") * 2.0**-52
    return asked.join(found, "number", "left").select(
        "vec_id", "number", "v", F.coalesce(lower, F.lit(float("-inf"))).alias("bar")
    )


def _pairs(query_blocks: DataFrame, row_blocks: DataFrame) -> DataFrame:
    """(q, block): the pairs of blocks whose coarse statistics let some query reach its bar."""
    names = ["low", "high", "deviation"]
    spread = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    q = query_blocks.select(
        F.col("block").alias("q"), "width", "bar", *[F.col(n).alias(f"q_{n}") for n in names],
        spread.alias("part"),
    )
    r = row_blocks.select(
        "block", "width", *names, F.pmod(F.xxhash64("block"), F.lit(SPREAD)).cast("int").alias("part")
    )

    def total(column):
        return F.aggregate(column, F.lit(0.0), lambda a, x: a + x)

    def highest(z):
        return F.greatest(
            z["q_low"] * z["low"], z["q_low"] * z["high"], z["q_high"] * z["low"], z["q_high"] * z["high"]
        )

    means = F.transform(F.arrays_zip("q_low", "q_high", "low", "high"), highest)
    deviations = F.zip_with("q_deviation", "deviation", lambda x, y: x * y)
    scale = F.aggregate(means, F.lit(0.0), lambda a, x: a + F.abs(x))
    bound = total(means) + total(deviations)
    bound = bound + 1e-9 * (scale + total(deviations)) + 1e-6
    return q.join(r, ["width", "part"]).filter(bound >= F.col("bar")).select("q", "block")


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
    rows_in_block: int = ROWS,
) -> DataFrame:
    """Each query row's k best rows by inner product of the integer vectors, ties to smaller ids."""
    vectors = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), integer_vector(vector_col).alias("v")
    ).filter("vec_id is not null and v is not null")
    vectors = stage(vectors.withColumn("number", F.monotonically_increasing_id()), "vectors")
    mark = F.coalesce(is_query, F.lit(False))
    marked = vectors.select("vec_id", "number", "v", mark.cast("double").alias("bar"))
    row_blocks = stage(marked.mapInArrow(_packer(rows_in_block), BLOCKS), "row-blocks")
    asked = stage(vectors.filter(mark).select("vec_id", "number", "v"), "queries")
    barred = stage(_bars(row_blocks, asked, k), "barred")
    parts = max(1, math.ceil(asked.count() / block))
    spread = barred.repartition(parts, "number")
    query_blocks = stage(spread.mapInArrow(_packer(block), BLOCKS), "query-blocks")

    payload = ["ids", "numbers", "bars", "matrix"]
    pairs = stage(_pairs(query_blocks, row_blocks), "block-pairs")
    own = row_blocks.select("block", "width", *payload)
    their = query_blocks.select(F.col("block").alias("q"), *[F.col(n).alias(f"q_{n}") for n in payload])
    met = pairs.join(own, "block").join(their, "q")

    def search(batches):
        for batch in batches:
            for some, queries in zip(_unpacked(batch), _unpacked(batch, "q_")):
                at, column, score = best(queries, some, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries.numbers[at]), pa.array(queries.ids[at]),
                     pa.array(some.ids[column]), pa.array(score)],
                    ["query", "query_id", "vec_id", "score"],
                )

    found = met.mapInArrow(search, FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_exact_top_k(spark, sf_dir):
    rows = common.table(spark, sf_dir, "embeddings")
    return top_k(rows, F.col("vec_id") % 50 == 0)


OP5_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS n, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(range(1, len(q.v) + 1),
              lambda i: CAST(q.v[i] AS HUGEINT) * c.v[i])), 0) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.n <> c.n AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER)
         AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
