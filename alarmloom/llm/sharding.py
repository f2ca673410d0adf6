"""Shards along a Hilbert curve over several metadata dimensions, cut into runs of equal row count.

Each dimension is quantised to 2^BITS steps: numbers by their approximate quantiles, strings by a
hash (equal values meet; their order carries nothing). The cell's place on the curve comes from a
bit-by-bit state machine over small tables, all in built-in functions. Rows are range-partitioned
by (curve index, id), and a row's global place is its place in the partition plus the rows of the
partitions before it, so no task sees more than its range. Law `rows`: shard counts differ by one
at most. `write_shards` writes the whole rows with the bounds of every dimension in each shard, and
`read_shards` reads only the shards that given ranges can touch.

Defined results: null text has no bytes (size 16, crc32 of nothing); null metadata take step 0;
repeated rows get places of their own; an empty table gives an empty table; extra columns pass.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from alarmloom.llm import common

BITS = 4
NUMERIC = {"byte", "short", "integer", "int", "long", "bigint", "float", "double"}


def _gray(i: int) -> int:
    return i ^ (i >> 1)


def _tables(dims: int) -> dict[str, list[int]]:
    """For each sub-cube on the curve: its inverse Gray code, entry corner and direction."""

    def ones(i):
        return (~i & (i + 1)).bit_length() - 1

    size = 1 << dims
    inverse = [0] * size
    for i in range(size):
        inverse[_gray(i)] = i
    entry = [0] + [_gray(2 * ((w - 1) // 2)) for w in range(1, size)]
    direction = [0] + [ones(w - 1 if w % 2 == 0 else w) % dims for w in range(1, size)]
    return {"inverse": inverse, "entry": entry, "direction": direction}


def hilbert_index(steps: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of the cell with the given steps (ints below 2^bits)."""
    dims = len(steps)
    mask = (1 << dims) - 1
    tables = {k: F.array(*map(F.lit, v)) for k, v in _tables(dims).items()}

    def turned_left(value: Column, by: Column) -> Column:
        by = F.pmod(by, F.lit(dims))
        left = F.call_function("shiftleft", value, by)
        return left.bitwiseOR(F.call_function("shiftright", value, F.lit(dims) - by)).bitwiseAND(
            F.lit(mask)
        )

    def level(state: Column, bit: Column) -> Column:
        corner = F.lit(0)
        for d, step in enumerate(steps):
            one = F.call_function("shiftright", step, bit).bitwiseAND(F.lit(1))
            corner = corner + one * (1 << d)
        turned = turned_left(corner.bitwiseXOR(state["entry"]), -(state["direction"] + 1))
        return F.struct(
            state["index"].alias("index"),
            state["entry"].alias("entry"),
            state["direction"].alias("direction"),
            F.get(tables["inverse"], turned).alias("w"),
        )

    def advance(state: Column, bit: Column) -> Column:
        met = level(state, bit)
        # One-element lists bind the sub-cube once instead of repeating its expression.
        return F.element_at(
            F.transform(
                F.array(met),
                lambda s: F.struct(
                    (s["index"] * (1 << dims) + s["w"]).alias("index"),
                    s["entry"]
                    .bitwiseXOR(turned_left(F.get(tables["entry"], s["w"]), s["direction"] + 1))
                    .alias("entry"),
                    F.pmod(
                        s["direction"] + F.get(tables["direction"], s["w"]) + 1, F.lit(dims)
                    ).alias("direction"),
                ),
            ),
            1,
        )

    start = F.struct(
        F.lit(0).cast("long").alias("index"),
        F.lit(0).alias("entry"),
        F.lit(0).alias("direction"),
    )
    order = F.array(*[F.lit(b) for b in reversed(range(bits))])
    return F.aggregate(order, start, advance, lambda s: s["index"])


def quantised(rows: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """Step of each dimension; numeric bounds are 2^bits - 1 approximate quantiles."""
    count = 1 << bits
    kinds = dict(rows.dtypes)
    numbers = [d for d in dims if kinds[d] in NUMERIC]
    bounds = {}
    if numbers:
        wanted = [i / count for i in range(1, count)]
        found = rows.agg(
            *[F.percentile_approx(d, wanted, 2000).alias(f"q{i}") for i, d in enumerate(numbers)]
        ).first()
        bounds = {d: found[f"q{i}"] or [] for i, d in enumerate(numbers)}
    steps = []
    for d in dims:
        if d in bounds:
            passed = [F.when(F.col(d) > F.lit(b), 1).otherwise(0) for b in bounds[d]]
            steps.append(sum(passed, F.lit(0)).cast("int"))
        else:
            hashed = F.pmod(F.xxhash64(d), F.lit(count)).cast("int")
            steps.append(F.when(F.col(d).isNull(), 0).otherwise(hashed))
    return steps


def hilbert_shards(
    rows: DataFrame, dims: list[str], shards: int, id_col: str = "doc_id", bits: int = BITS
) -> DataFrame:
    """Adds `shard` (0 to shards - 1) and `slot` (place in the shard) to all rows; where a column has such
    a name, the new one is called by the first free one of name_1, name_2 ...

    Give it the columns that the shards shall hold: they are moved once, in the range shuffle.
    """
    steps, names = quantised(rows, dims, bits), []
    placed = rows
    for step in steps:
        names.append(common.free_name(placed, "step"))
        placed = placed.withColumn(names[-1], step)
    curve = common.free_name(placed, "curve")
    placed = placed.withColumn(curve, hilbert_index([F.col(n) for n in names], bits)).drop(*names)
    at = common.free_name(placed, "place")
    numbered = common.ranked(placed, [F.col(curve), F.col(f"`{id_col}`")], "curve", at)
    total = numbered.count()
    shard, slot = common.free_name(rows, "shard"), common.free_name(rows, "slot")
    # Exact integers: cast of a quotient of longs, and the first place of a shard.
    numbered = numbered.withColumn(shard, F.expr(f"cast(`{at}` * {shards} div {max(total, 1)} as int)"))
    first = F.expr(f"(`{shard}` * {total}L + {shards - 1}) div {shards}")
    return numbered.withColumn(slot, F.col(at) - first).drop(curve, at)


def write_shards(sharded: DataFrame, dims: list[str], folder: str) -> DataFrame:
    """Writes the rows of `hilbert_shards` to `folder` and returns the shards' bounds.

    `folder`/rows has one folder per shard with all columns; every file holds its rows in slot order.
    The rows are not moved: they lie in curve order already, and a shard that spans several tasks
    gets a file from each. `folder`/bounds has a row per shard: rows, and min, max and nulls of
    dimension i as min_i, max_i and nulls_i. NaN is above all numbers, as Spark orders it.
    `folder`/layout is an empty table with the columns of the rows.
    """
    spark = sharded.sparkSession
    rows = sharded.sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").parquet(f"{folder}/rows")
    spark.createDataFrame([], sharded.schema).write.parquet(f"{folder}/layout")
    written = spark.read.schema(sharded.schema).parquet(f"{folder}/rows")
    found = [F.count("*").alias("rows")]
    for i, d in enumerate(dims):
        value = F.col(f"`{d}`")
        found += [
            F.min(value).alias(f"min_{i}"),
            F.max(value).alias(f"max_{i}"),
            F.count_if(value.isNull()).alias(f"nulls_{i}"),
        ]
    bounds = written.groupBy("shard").agg(*found)
    bounds.write.parquet(f"{folder}/bounds")
    return spark.read.schema(bounds.schema).parquet(f"{folder}/bounds")


def read_shards(
    spark: SparkSession, folder: str, dims: list[str], ranges: dict[str, tuple]
) -> DataFrame:
    """The written rows with every dimension of `ranges` between its two values, both included.

    Shards whose bounds lie outside a range are not read. None as a value leaves that side open.
    """
    met = spark.read.parquet(f"{folder}/bounds")
    layout = spark.read.parquet(f"{folder}/layout").schema
    rows = spark.read.schema(layout).parquet(f"{folder}/rows")
    for d, (low, high) in ranges.items():
        i, value = dims.index(d), F.col(f"`{d}`")
        kept = value.isNotNull()
        met = met.filter(F.col(f"min_{i}").isNotNull())
        if low is not None:
            kept, met = kept & (value >= F.lit(low)), met.filter(F.col(f"max_{i}") >= F.lit(low))
        if high is not None:
            kept, met = kept & (value <= F.lit(high)), met.filter(F.col(f"min_{i}") <= F.lit(high))
        rows = rows.filter(kept)
    # One number per shard, at most as many as were asked for.
    return rows.filter(F.col("shard").isin([r.shard for r in met.select("shard").collect()]))


def op9_hilbert_sharding(spark, sf_dir):
    """Whole rows go through the operator; the digests are taken of what comes out."""
    docs = common.table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    sharded = hilbert_shards(docs.withColumn("size", size), ["source", "lang", "size", "doc_id"], 40)
    return sharded.select(
        "doc_id",
        "size",
        F.crc32(common.text_or_empty().cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
