"""Importance resampling towards a target distribution over hashed words and word pairs.

Every word and every pair of consecutive words falls into one of `BUCKETS` buckets by the CRC-32 of
its bytes. The totals of all documents and of the target's texts give each bucket a gain; a
document's weight is the mean gain of its features, and Gumbel noise drawn from its id makes the
highest scores a sample by weight.

Head and tail of the vocabulary: the most frequent words are broadcast with the state of their CRC,
the most frequent pairs with their bucket, both bounded by `HEAD_WORDS` and `HEAD_PAIRS`. A feature
that is not among them is computed directly: a pair goes on from the state of its first word. Both
ways give the same bucket, so the head sets only the speed, and all totals are exact.

Defined results: null and empty texts have no features and weight 0; a null id draws its noise from
the prefix alone; repeated rows count and are drawn each by itself, in any order among themselves; an
empty table gives an empty table, an empty target is a target without features; extra columns pass,
and the score takes a name that no column has.
"""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from alarmloom.llm import common
from alarmloom.session import stage

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
HEAD_WORDS = 50_000
HEAD_PAIRS = 100_000
OFTEN = 8
HELD = 300_000
# Bytes outside words become blanks, A-Z lower case; bytes above 0x7F belong to words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


class _States(dict):
    """CRC states of the head's words; of any other word directly."""

    def __missing__(self, word):
        return zlib.crc32(word)


class _PairBuckets(dict):
    """Buckets of the head's pairs; of any other pair from the state of its first word."""

    def __init__(self, states, pairs, buckets):
        super().__init__()
        self.states, self.buckets = states, buckets
        for pair in pairs:
            self[pair] = self.__missing__(pair)

    def __missing__(self, pair):
        return zlib.crc32(b" " + pair[1], self.states[pair[0]]) % self.buckets


class Head:
    """The broadcast part of the vocabulary: frequent words and pairs."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int = BUCKETS):
        self.words, self.pairs, self.buckets = words, pairs, buckets

    def opened(self) -> "Head":
        """With its tables, which each worker builds for itself."""
        if not hasattr(self, "states"):
            self.states = _States((w, zlib.crc32(w)) for w in self.words)
            self.pair_buckets = _PairBuckets(self.states, self.pairs, self.buckets)
        return self

    def buckets_of(self, words: list[bytes]) -> np.ndarray:
        """Bucket of every word, then of every pair of consecutive words."""
        count = len(words)
        if not count:
            return np.zeros(0, np.int64)
        single = np.fromiter(map(self.states.__getitem__, words), np.int64, count) % self.buckets
        pairs = map(self.pair_buckets.__getitem__, zip(words, words[1:]))
        return np.concatenate([single, np.fromiter(pairs, np.int64, count - 1)])


def learn_head(
    texts: DataFrame, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS, buckets: int = BUCKETS
) -> Head:
    """The most frequent words and pairs of all texts (one binary column), at most as many as given.

    A task sends what it met `OFTEN` times or more among the features it held at once: what is left
    out is rare there, and would only have been a little faster in the head.
    """

    def count(batches):
        held = Counter(), Counter()

        def settle():
            found = [(f, n) for own in held for f, n in own.items() if n >= OFTEN]
            pair = [isinstance(f, tuple) for f, _ in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] if p else f for (f, _), p in zip(found, pair)], pa.binary()),
                 pa.array([f[1] if p else None for (f, _), p in zip(found, pair)], pa.binary()),
                 pa.array([n for _, n in found], pa.int64())],
                ["word", "next", "n"],
            )
            for own in held:
                own.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = words_of(text)
                held[0].update(found)
                held[1].update(zip(found, found[1:]))
                if len(held[0]) + len(held[1]) >= HELD:
                    yield from settle()
        yield from settle()

    met = texts.mapInArrow(count, "word binary, next binary, n long")
    met = stage(met.groupBy("word", "next").agg(F.sum("n").alias("n")), "head")

    def most(rows, number):
        """As many of the most frequent as `number` allows, found by the histogram of the counts."""
        steps = sorted(((r["n"], r["count"]) for r in rows.groupBy("n").count().collect()), reverse=True)
        cut = None
        for n, count in steps:
            number -= count
            if number < 0:
                break
            cut = n
        return [] if cut is None else rows.filter(F.col("n") >= cut).orderBy("word", "next").collect()

    return Head(
        [bytes(r["word"]) for r in most(met.filter("next is null"), words)],
        [(bytes(r["word"]), bytes(r["next"])) for r in most(met.filter("next is not null"), pairs)],
        buckets,
    )


def bucket_totals(texts: DataFrame, shared, buckets: int = BUCKETS) -> list[int]:
    """Features in each bucket over all texts; at most one row per bucket comes to the driver."""

    def count(batches):
        head, total = shared.value.opened(), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(head.buckets_of(words_of(text)), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], ["bucket", "n"]
        )

    added = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = [0] * buckets
    for row in added.collect():
        totals[row["bucket"]] = row["n"]
    return totals


def gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln(((t + 1) (S + buckets)) / ((s + 1) (T + buckets)))) of each bucket."""
    all_s, all_t = float(sum(source) + len(source)), float(sum(target) + len(target))
    return [
        math.floor(1000 * math.log(((t + 1) * all_s) / ((s + 1) * all_t)))
        for s, t in zip(source, target)
    ]


class Model:
    def __init__(self, head: Head, gain: list[int]):
        self.head, self.gain = head, gain


def fit(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text",
        buckets: int = BUCKETS, **head) -> Model:
    """Head, totals and gains from all texts of `docs` and `target`."""
    own = docs.select(F.col(f"`{text_col}`").cast("binary"))
    wanted = target.select(F.col(f"`{target_col}`").cast("binary"))
    found = learn_head(own, buckets=buckets, **head)
    shared = docs.sparkSession.sparkContext.broadcast(found)
    gain = gains(bucket_totals(own, shared, buckets), bucket_totals(wanted, shared, buckets))
    shared.destroy()
    return Model(found, gain)


def scored(
    docs: DataFrame,
    model: Model,
    name: str = "importance",
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """All rows and columns with one more, a struct of n_words, n_features, weight and score.

    It is called `name`, or if a column has that name, the first free one of `name`_1, `name`_2 ...
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(texts):
        import pandas as pd

        own = shared.value
        head, gain, rows = own.head.opened(), np.array(own.gain, np.int64), []
        for text in texts:
            found = words_of(text)
            buckets = head.buckets_of(found)
            features = len(buckets)
            rows.append((len(found), features, int(gain[buckets].sum()) // features if features else 0))
        return pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    own = common.free_name(docs, name)
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(seeded.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    return docs.withColumn(own, weigh(F.col(f"`{text_col}`").cast("binary"))).withColumn(
        own, F.col(own).withField("score", F.col(own)["weight"] + noise)
    )


def resampled(
    rows: DataFrame,
    name: str = "importance",
    id_col: str = "doc_id",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """The rows of `scored` with `rank` in the struct `name`: 1, 2, 3 ... for the `percent` highest scores
    among the N rows of `least_words` words or more, floor(percent * N / 100) rows; null for others.

    A score is a whole number between about -35,000 and 55,000, so the histogram of scores is small at
    any size. It tells the cut and the first rank of each score; only rows of equal score are ordered.
    """
    rows = stage(rows, "importance")
    score, able = F.col(name)["score"], F.col(name)["n_words"] >= least_words
    met = rows.filter(able).groupBy(score.alias("s")).count().collect()
    wanted = percent * sum(r["count"] for r in met) // 100
    first, before = [], 0
    for r in sorted(met, key=lambda r: -r["s"]):
        if before >= wanted:
            break
        first.append((r["s"], before))
        before += r["count"]
    cut = first[-1][0] if first else None
    none = F.lit(None).cast("long")
    drawn = able & (score >= F.lit(cut)) if first else F.lit(False)
    left = rows.filter(~F.coalesce(drawn, F.lit(False))).withColumn(
        name, F.col(name).withField("rank", none)
    )
    if not first:
        return left
    offsets = rows.sparkSession.createDataFrame(first, "__score long, __before long")
    order = Window.partitionBy(score).orderBy(
        F.col(f"`{id_col}`").asc_nulls_last(), F.col(name)["n_features"], F.col(name)["weight"]
    )
    place = F.broadcast(offsets.select(F.struct("__score", "__before").alias("place")))
    columns = rows.columns
    ranked = (
        rows.filter(drawn)
        .withColumn(name, F.col(name).withField("turn", F.row_number().over(order).cast("long")))
        .join(place, F.col(name)["score"] == F.col("place.__score"))
    )
    rank = F.col("place.__before") + F.col(name)["turn"]
    ranked = ranked.withColumn(
        name, F.col(name).withField("rank", F.when(rank <= wanted, rank)).dropFields("turn")
    )
    return left.unionByName(ranked.select(*[F.col(f"`{c}`") for c in columns]))


def op13_importance_resampling(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    target = common.table(spark, sf_dir, "benchmark").select("text")
    rows = scored(docs, fit(docs, target)).drop("text")
    return resampled(rows).select(
        "doc_id", "importance.n_features", "importance.weight", "importance.score", "importance.rank"
    )


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
wanted AS (
  SELECT regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
of_docs AS (
  SELECT d, unnest(list_concat(words, list_transform(range(1, len(words)),
           lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM docs),
of_wanted AS (
  SELECT unnest(list_concat(words, list_transform(range(1, len(words)),
           lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM wanted),
features AS (SELECT feature FROM of_docs UNION SELECT feature FROM of_wanted),
bytes AS (
  SELECT feature, hex(encode(feature)) AS h FROM features),
crcs AS (
  SELECT feature, xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(
           range(0, (len(h) // 2)::BIGINT), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
             lambda r, z: xor(r >> 1, (r & 1) * 3988292384))), 4294967295::UBIGINT) % 10000 AS bucket
  FROM bytes),
s AS (SELECT bucket, count(*) AS n FROM of_docs JOIN crcs USING (feature) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM of_wanted JOIN crcs USING (feature) GROUP BY bucket),
gains AS (
  SELECT s.bucket, CAST(floor(1000 * ln(
           ((coalesce(t.n, 0) + 1) * ((SELECT sum(n) FROM s) + 10000)::DOUBLE)
           / ((s.n + 1) * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t ON s.bucket = t.bucket),
weights AS (
  SELECT d, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total
  FROM of_docs JOIN crcs USING (feature) JOIN gains USING (bucket) GROUP BY d),
scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
         coalesce(CAST(floor(total / n_features) AS BIGINT), 0) AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')),
           1, 8) AS UBIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS noise
  FROM docs LEFT JOIN weights USING (d)),
ordered AS (
  SELECT *, weight + noise AS score, n_words >= 20 AS able,
         row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id,
                            n_features, weight) AS place
  FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN able AND place <= (SELECT 25 * count(*) // 100 FROM ordered WHERE able)
            THEN place END AS rank
FROM ordered
"""
