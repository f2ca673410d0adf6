"""Toxicity by weak supervision: many voters, a label model over them, a linear classifier.

Words that mark the toxic class of a bounded labelled sample become voters, one each, however many
there are; patterns of the text are voters too. No word is known beforehand. A voter says toxic or clean, or abstains. The label model estimates, by
expectation and maximisation without labels, how often each voter speaks in either class, and from
what is left between two voters within a class how far they say the same thing: correlated voters
share their weight. A logistic regression is fitted to the posterior labels, and its offset and
scale are set on the sample's labels.

Defined results: null and empty texts get the score of a text in which no voter says toxic; without
labels of both classes every score is 0; repeated rows score alike; documents with several labels
count as toxic if one says so; an empty table gives an empty table; extra columns pass through.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from alarmloom.llm import common
from alarmloom.llm.linear import bounded_sample, fit_logistic, sigmoid
from alarmloom.session import stage

SAMPLE = 24_000
LEAST_DOCS = 4
EVEN = 4.0
SURE = 30.0
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Voters:
    """The voters over one text: words of the lexicon, then patterns."""

    PATTERNS = ("two", "four", "dense", "repeated", "early", "none")

    def __init__(self, lexicon: list[str]):
        self.index = {w: i for i, w in enumerate(lexicon)}
        self.size = len(lexicon) + len(self.PATTERNS)

    def votes(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(votes, features): 1 where a voter speaks; word counts in logs and pattern values.

        All voters speak for toxic but the last, which speaks for clean if no other does.
        """
        words = words_of(text)
        index = self.index
        hits = [index[w] for w in words if w in index]
        votes, features = np.zeros(self.size), np.zeros(self.size)
        counts = np.bincount(np.array(hits, np.int64), minlength=len(index)) if hits else None
        base = len(index)
        if hits:
            votes[:base] = counts > 0
            features[:base] = np.log1p(counts)
            distinct = len(set(hits))
            first = next(i for i, w in enumerate(words) if w in index)
            votes[base:] = (
                distinct >= 2,
                distinct >= 4,
                len(hits) * 100 >= len(words),
                counts.max() >= 2,
                first < 50,
                False,
            )
            features[base:] = (
                math.log(distinct),
                distinct >= 4,
                min(1.0, 20 * len(hits) / len(words)),
                counts.max() >= 2,
                first < 50,
                0.0,
            )
        else:
            votes[-1] = features[-1] = 1.0
        return votes, features


def learn_lexicon(sample: DataFrame, least: int = LEAST_DOCS) -> list[str]:
    """All words whose presence marks toxic rows of the sample; their number is bounded by it.

    Counted by Spark over the distinct words of each different text. A word is taken if its rows,
    `least` or more of them toxic, are toxic by EVEN to one or more, and if its likelihood ratio
    against the sample's share exceeds SURE, so that chance among many rare words is ruled out.
    """

    def spread(batches):
        for batch in batches:
            words, toxic = [], []
            for text, label in zip(*[c.to_pylist() for c in batch.columns]):
                own = set(words_of(text))
                words += own
                toxic += [label] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"]
            )

    totals = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return []
    counted = (
        sample.select("text", "toxic")
        .dropDuplicates(["text"])
        .mapInArrow(spread, "word string, toxic int")
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
        .filter(F.col("bad") >= least)
    )
    counted = stage(counted, "toxic-words")
    with_word = (F.col("bad") + 0.5) / (F.col("n") - F.col("bad") + 0.5)
    share = bad / (bad + good)

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    clean = F.col("n") - F.col("bad")
    ratio = 2 * (
        part(F.col("bad"), F.col("n") * share) + part(clean, F.col("n") * (1 - share))
    )
    marked = counted.filter((with_word > EVEN) & (ratio > SURE))
    return sorted(r.word for r in marked.select("word").collect())


class LabelModel:
    """How often each voter speaks in either class, and how much of its say is its own."""

    def __init__(self, votes: np.ndarray, prior: float, rounds: int = 50):
        speaks = votes > 0
        toxic = speaks[:, :-1].any(axis=1)
        post = np.where(toxic, 0.7, 0.05 * prior + 0.01)
        self.prior, self.share = prior, np.ones(votes.shape[1])
        for _ in range(rounds):
            yes = ((post[:, None] * speaks).sum(axis=0) + 0.1) / (post.sum() + 0.2)
            no = (((1 - post)[:, None] * speaks).sum(axis=0) + 0.02) / ((1 - post).sum() + 0.2)
            self.yes, self.no = np.clip(yes, 1e-5, 1 - 1e-5), np.clip(no, 1e-5, 1 - 1e-5)
            self.share = self._shares(speaks, post)
            self.prior = float(np.clip(post.mean(), 1e-3, 0.9))
            new = self.posterior(votes)
            if np.abs(new - post).max(initial=0) < 1e-6:
                break
            post = new

    def _shares(self, speaks, post):
        """One over one plus the correlations with the other voters that remain in each class."""
        total = np.zeros((speaks.shape[1],) * 2)
        for weight, rate in ((post, self.yes), (1 - post, self.no)):
            gap = speaks - rate
            cover = (gap * weight[:, None]).T @ gap / max(1e-9, weight.sum())
            scale = np.sqrt(np.maximum(1e-9, np.diag(cover)))
            total += 0.5 * np.clip(cover / np.outer(scale, scale) - 0.1, 0, 1)
        np.fill_diagonal(total, 0)
        return 1 / (1 + total.sum(axis=1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        speaks = votes > 0
        told = np.log(self.yes / self.no) * self.share
        kept = np.log((1 - self.yes) / (1 - self.no)) * self.share
        odds = math.log(self.prior / (1 - self.prior)) + speaks @ told + (~speaks) @ kept
        return sigmoid(odds)


class Model:
    def __init__(self, lexicon: list[str], weights: np.ndarray, offset: float):
        self.voters, self.weights, self.offset = Voters(lexicon), weights, offset

    def score(self, text: str | None) -> float:
        return float(sigmoid(self.voters.votes(text)[1] @ self.weights + self.offset))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from the texts (doc_id, text) of about `sample` labels (doc_id, toxic), both classes
    alike if they suffice. The labels are sampled first, so only they meet the texts, by broadcast:
    their number is bounded by `sample`."""
    rows = labels.filter(F.col("toxic").isin(0, 1))
    few = bounded_sample(rows, "toxic", "doc_id", sample)
    chosen = stage(
        docs.join(F.broadcast(few), "doc_id").select(
            "text", F.col("toxic").cast("int").alias("toxic")
        ),
        "toxic-sample",
    )
    lexicon = learn_lexicon(chosen)
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(totals) < 2 or chosen.select("toxic").distinct().count() < 2:
        return None
    voters = Voters(lexicon)

    def vote(batches):
        for batch in batches:
            both = [voters.votes(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([np.packbits(v > 0).tobytes() for v, _ in both], pa.binary()),
                    pa.array([f.astype(np.float32).tobytes() for _, f in both], pa.binary()),
                    batch.column(1),
                ],
                ["votes", "features", "toxic"],
            )

    counted = (
        chosen.mapInArrow(vote, "votes binary, features binary, toxic int")
        .groupBy("votes", "features", "toxic")
        .count()
        .collect()
    )
    counted.sort(key=lambda r: (r.votes, r.features, r.toxic))
    repeat = [r["count"] for r in counted]
    votes = np.array([np.unpackbits(np.frombuffer(r.votes, np.uint8))[: voters.size] for r in counted])
    features = np.array([np.frombuffer(r.features, np.float32) for r in counted], np.float64)
    labels = np.repeat([r.toxic for r in counted], repeat)
    votes, features = np.repeat(votes, repeat, axis=0), np.repeat(features, repeat, axis=0)
    prior = labels.mean()
    posterior = LabelModel(votes, float(prior)).posterior(votes)
    weights, offset = fit_logistic(features, posterior)
    # The sample's classes may not stand as the labelled rows do; the offset sets that right.
    raw = features @ weights + offset
    return Model(lexicon, weights, offset + _shift(raw, labels, totals[1] / (totals[0] + totals[1])))


def _shift(raw: np.ndarray, labels: np.ndarray, share: float) -> float:
    """The shift with which the mean score is the toxic share of all labelled rows."""
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    weight /= weight.sum()
    low, high = -20.0, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if weight @ sigmoid(raw + middle) < share else (low, middle)
    return low


def score_texts(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """All rows and columns with `toxic_score`, or if a column has that name, the first free one of
    toxic_score_1, toxic_score_2 ..."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        model = shared.value
        return pd.Series([0.0 if model is None else model.score(t) for t in texts], dtype="float64")

    return docs.withColumn(common.free_name(docs, "toxic_score"), score(F.col(f"`{text_col}`")))


def op10_toxicity(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held_out = common.crc_of_id() % 5 == 0
    model = fit(docs, stage(labels.filter(~held_out), "toxic-labels"))
    scored = score_texts(docs.withColumn("held_out", held_out), model)
    return scored.select(
        "doc_id",
        "held_out",
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )
