"""Mixing sources to target weights by entropy balancing.

Among all rates per document that meet the token targets, the ones that stay closest to the corpus
(least relative entropy, weighted by tokens) are exponentials of a dual vector with one entry per
target. The dual is convex and solved by Newton steps. Documents that share the levels of all target
dimensions, say source and language, form a cell and have one rate. With several dimensions the cells
couple the targets: each step sums gradient and curvature over the cells as a Spark job. With one
dimension every target stands alone, and its steps are a column of the table of levels. Rates are cut
off at `cap`. They are then rounded into whole copies, group by group: every document gets the whole
part, and documents in a hash order get one copy more while they fit what is left of the group's
tokens; a few exchanges then bring the group nearer its share.

Sizes and targets of levels are tables of any length. Only with several dimensions do the duals (one
number per target) and the curvature (one per pair of targets that meet) come to the driver.

Defined results: null and empty texts have size 0 and take 0 words; a null level is a level of its own
and comes last; repeated rows are rounded each by itself, and reruns give the same bag of rows on any
partitioning; an empty table gives an empty table; extra columns pass, whatever their names.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from alarmloom.llm import common
from alarmloom.session import scratch, stage

GROUP = 512
STEPS = 60
EXCHANGES = 4
ROUGH = 0.005
WEIGHTS = [3.0, 1.0, 2.0]
# Types of the columns that tell rows apart; equal rows may change places.
HASHED = {"string", "long", "integer", "short", "byte", "double", "float", "boolean", "date", "timestamp",
          "binary", "decimal"}


def word_count(text: str = "text") -> Column:
    """Number of words between the blanks space and x09 to x0D; null counts as empty."""
    blanks = F.regexp_replace(common.text_or_empty(text), r"[^\x20\x09-\x0D]+", "a")
    return F.length(F.translate(blanks, " \t\n\x0b\x0c\r", "")).cast("long")


def levels_of(base: DataFrame, dim: str, weights: list[float], share: float, cap: float) -> DataFrame:
    """(value, level, size, target) of one dimension: levels in code point order take the weights in turn
    and share `share` of all tokens; what exceeds `cap` times a level goes to the others."""
    counted = base.groupBy(F.col(dim).alias("value")).agg(F.sum("size").alias("size"))
    order = [F.col("value").isNull(), F.col("value")]
    rows = common.ranked(counted, order, "mix-levels", "level")
    turn = F.get(F.array(*map(F.lit, map(float, weights))), F.pmod("level", F.lit(len(weights))).cast("int"))
    rows = stage(rows.withColumn("weight", turn), "mix-weighted")
    return _with_targets(rows, share, cap)


def _with_targets(rows: DataFrame, share: float, cap: float) -> DataFrame:
    """Adds `target`. Every round closes the levels that the others' share would fill; only sums over the
    closed and the open ones come to the driver."""
    unit, total = None, rows.agg(F.sum("size")).first()[0] or 0
    while True:
        over = F.lit(False) if unit is None else F.col("weight") * unit > cap * F.col("size")
        sums = rows.agg(
            F.sum(F.when(over, F.col("size")).otherwise(0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
        ).first()
        closed, open_ = sums[0] or 0, sums[1] or 0.0
        if not open_:
            return rows.withColumn("target", cap * F.col("size"))
        left = (share * total - cap * closed) / open_
        if unit is not None and left <= unit:
            # Nothing was closed since the last round.
            capped = F.when(over, cap * F.col("size"))
            return rows.withColumn("target", capped.otherwise(F.col("weight") * unit))
        unit = left


def lone_rates(levels: DataFrame, cap: float) -> DataFrame:
    """Adds `rate` for a dimension by itself: the curvature is diagonal, so each level's Newton steps
    depend on no other's."""
    size = F.col("size").cast("double")

    def step(dual: Column, _: Column) -> Column:
        met = size * F.least(F.lit(cap), F.exp(dual))
        move = (F.col("target") - met) / (met + 1e-9)
        return dual + F.greatest(F.lit(-2.0), F.least(F.lit(2.0), move))

    dual = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.lit(0.0), step)
    return levels.withColumn("rate", F.least(F.lit(cap), F.exp(dual)))


def solve_dual(cells: DataFrame, targets: np.ndarray, cap: float) -> np.ndarray:
    """Dual vector of the cells' rates. `cells`: levels (the targets a cell counts for), mass.

    A cell's rate is exp(sum of its levels' duals), at most `cap`. Where the cap holds, the curvature
    just below it stands in for zero, so that a step leads back. Each step maps over the cells
    with the current duals and adds gradient and curvature by map-side partials; only sums per
    target, and per pair of targets that meet in a cell, come to the driver.
    """
    spark, duals = cells.sparkSession, np.zeros(len(targets))

    def sums(at: np.ndarray):
        shared = spark.sparkContext.broadcast(at)

        def part(batches):
            for batch in batches:
                out = {}
                for levels, mass in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    rate = min(cap, math.exp(min(50.0, float(shared.value[levels].sum()))))
                    for i in levels:
                        key = (i, -1)
                        out[key] = out.get(key, 0.0) + mass * rate
                        for j in levels:
                            out[i, j] = out.get((i, j), 0.0) + mass * rate
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in out], pa.int32()),
                        pa.array([k[1] for k in out], pa.int32()),
                        pa.array(list(out.values()), pa.float64()),
                    ],
                    ["i", "j", "v"],
                )

        added = cells.mapInArrow(part, "i int, j int, v double").groupBy("i", "j")
        return added.agg(F.sum("v").alias("v")).collect()

    for _ in range(STEPS):
        met, curve = np.zeros(len(targets)), {}
        for row in sums(duals):
            if row.j < 0:
                met[row.i] = row.v
            else:
                curve[row.i, row.j] = row.v
        gap = targets - met
        if np.all(np.abs(gap) <= 1e-9 * np.maximum(1.0, targets)):
            break
        i, j = (np.array([k[n] for k in curve], np.int64) for n in (0, 1))
        values = np.array(list(curve.values()))
        move = _conjugate(lambda x: np.bincount(i, values * x[j], len(targets)) + 1e-9 * x, gap)
        duals = duals + np.clip(move, -2.0, 2.0)
    return duals


def _conjugate(times, right, rounds: int = 200) -> np.ndarray:
    """Solves `times(x) = right` for a positive operator by conjugate gradients."""
    x, rest = np.zeros_like(right), right.copy()
    along, norm = rest.copy(), float(rest @ rest)
    for _ in range(rounds):
        if norm <= 1e-24 * max(1.0, float(right @ right)):
            break
        turned = times(along)
        step = norm / float(along @ turned)
        x, rest = x + step * along, rest - step * turned
        new = float(rest @ rest)
        along, norm = rest + new / norm * along, new
    return x


def _chosen(order, size, able, goal: float) -> tuple[np.ndarray, float]:
    """Documents that get one copy more, and what is left of `goal` tokens: in the given order
    while they fit, then exchanges that come nearer."""
    extra, left = np.zeros(len(size), bool), goal
    for at in order:
        if able[at] and size[at] <= left:
            extra[at] = True
            left -= size[at]
    for _ in range(EXCHANGES):
        change = np.where(~extra & able, size, 1 << 60)[:, None] - np.append(
            np.where(extra, size, -(1 << 60)), 0
        )
        into, out = divmod(int(np.abs(left - change).argmin()), len(size) + 1)
        if abs(left - change[into, out]) >= abs(left) - 1e-9:
            break
        extra[into] = True
        if out < len(size):
            extra[out] = False
        left -= float(change[into, out])
    return extra, left


def _rated_cells(
    base: DataFrame, dims: list[str], weights: list[list[float]], share: float, cap: float
) -> tuple[DataFrame, DataFrame]:
    """Cells (the dimensions, rows, rate) and the levels of the first dimension."""
    levels = [levels_of(base, d, w, share, cap) for d, w in zip(dims, weights)]
    cells = base.groupBy(*dims).agg(F.sum("size").alias("mass"), F.count("*").alias("rows"))
    if len(dims) == 1:
        rated = lone_rates(levels[0], cap).select(F.struct("value", "rate").alias("own"))
        same = F.col(dims[0]).eqNullSafe(F.col("own.value"))
        return stage(cells.join(rated, same).select(*dims, "rows", "own.rate"), "mix-cells"), levels[0]
    names, targets = [], []
    for number, (dim, own) in enumerate(zip(dims, levels)):
        found = own.orderBy("level").select("target").collect()
        at = F.struct("value", (F.col("level") + len(targets)).cast("int").alias("level"))
        cells = cells.join(
            own.select(at.alias(f"at{number}")), F.col(dim).eqNullSafe(F.col(f"at{number}.value"))
        )
        names.append(f"at{number}.level")
        targets += [r["target"] for r in found]
    cells = stage(cells.select(*dims, "rows", F.array(*names).alias("levels"), "mass"), "mix-cells")
    full = cells.filter("mass > 0").select("levels", F.col("mass").cast("double"))
    duals = solve_dual(full, np.array(targets), cap)
    shared = base.sparkSession.sparkContext.broadcast(duals)

    @F.pandas_udf("double")
    def rate(levels):
        import pandas as pd

        own = [shared.value[np.array(x, np.int64)].sum() for x in levels]
        return pd.Series(np.minimum(cap, np.exp(np.minimum(50.0, own))), dtype="float64")

    return stage(cells.select(*dims, "rows", rate("levels").alias("rate")), "mix-rated"), levels[0]


def _items(base: DataFrame) -> DataFrame:
    """Adds `item`: the place of a row among the rows equal to it, from 0. Equal rows are placed within
    the partitions that hold them, and the partitions one after another, so no group is gathered."""
    part = F.shiftright("number", 33)
    base = base.withColumn("part", part)
    held = base.groupBy("row_key", "part").agg(F.count("*").alias("own"))
    order = Window.partitionBy("row_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.withColumn("before", F.coalesce(F.sum("own").over(order), F.lit(0)))
    several = stage(before.filter("own > 1 or before > 0"), "mix-repeated")
    local = Window.partitionBy("row_key", "part").orderBy("number")
    return (
        base.join(several.select("row_key", "part", "before"), ["row_key", "part"], "left")
        .withColumn("item", F.coalesce("before", F.lit(0)) + F.row_number().over(local) - 1)
        .drop("part", "before")
    )


def mix(
    docs: DataFrame,
    weights: list[float] | list[list[float]] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    by: str | list[str] = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    number: str | None = None,
) -> DataFrame:
    """Per row of `docs` doc_id, number, size, copies and taken, and of its level in the first dimension
    of `by` source_size and target. With several dimensions `weights` has a list for each.

    `number`: a column that numbers the rows, as `common.numbered` gives it; else they are numbered here.
    """
    dims = [by] if isinstance(by, str) else list(by)
    lists = [weights] if isinstance(by, str) else weights
    names = [f"dim{i}" for i in range(len(dims))]
    own = F.monotonically_increasing_id() if number is None else F.col(number)
    plain = [
        F.col(f"`{f.name}`") for f in docs.schema.fields
        if f.name != number and f.dataType.typeName() in HASHED
    ]
    nulls = [c.isNull() for c in plain]
    base = stage(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            F.xxhash64(*plain, *nulls).alias("row_key"),
            *[F.col(f"`{d}`").cast("string").alias(n) for d, n in zip(dims, names)],
            word_count(f"`{text_col}`").alias("size"),
            own.alias("number"),
        ),
        "mix",
    )
    cells, levels = _rated_cells(base, names, lists, share, cap)
    same = [F.col(f"r.{n}").eqNullSafe(F.col(f"c.{n}")) for n in names]
    rated = _items(base).alias("r").join(cells.alias("c"), same).select(
        "r.*", "c.rate", F.ceil(F.col("c.rows") / GROUP).alias("groups")
    )
    rated = rated.withColumn("turn", F.xxhash64("row_key", "item"))
    rated = rated.withColumn("own", F.pmod(F.xxhash64("turn"), F.col("groups")))

    def round_(group):
        group = group.sort_by([("turn", "ascending"), ("row_key", "ascending")])
        size = np.array(group.column("size"))
        rate = np.array(group.column("rate"))
        copies = np.floor(rate + 1e-9).astype(np.int64)
        goal = float(((rate - copies) * size).sum())
        able = copies + 1 <= cap
        extra, left = _chosen(np.arange(len(size)), size, able, goal)
        if abs(left) > ROUGH * float((rate * size).sum()):
            # A few large documents: longest first comes nearer.
            other, rest = _chosen(np.argsort(-size, kind="stable"), size, able, goal)
            extra = other if abs(rest) < abs(left) else extra
        copies += extra
        kept = group.select(["doc_id", "number", names[0], "size"])
        return kept.append_column("copies", pa.array(copies, pa.int64()))

    rounded = rated.groupBy(*names, "own").applyInArrow(
        round_,
        f"doc_id {dict(base.dtypes)['doc_id']}, number long, {names[0]} string, size long, copies long",
    )
    level = levels.select(F.struct("value", "size", "target").alias("level"))
    return rounded.join(level, F.col(names[0]).eqNullSafe(F.col("level.value"))).select(
        "doc_id",
        "number",
        "size",
        F.col("level.size").alias("source_size"),
        "level.target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix with all their columns, each as often as it has copies."""
    rows, number = common.numbered(docs, "mix-rows")
    copies = common.free_name(rows, "copies")
    with scratch(docs.sparkSession) as kept:
        dealt = mix(rows, number=number, **options).filter("copies > 0")
        dealt = kept(dealt.select(F.col("number").alias(number), F.col("copies").alias(copies)), "mix-copies")
    often = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    kept = rows.join(dealt.hint("merge"), number)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns], often.alias(copies)).drop(copies)


def op1_mixing_to_target_weights(spark, sf_dir):
    return mix(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )
