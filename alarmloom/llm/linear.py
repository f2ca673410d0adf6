"""Small numeric helpers for the classifiers: linear models fitted on bounded samples."""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from alarmloom.llm import common
from alarmloom.session import stage


def hash_share(key: Column) -> Column:
    """A number in [0, 1) from the key's hash: the same rows fall below a bound in every run."""
    return F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 40)) / float(1 << 40)


def bounded_sample(rows: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """About `most` rows in all, the same number per label value where there are enough.

    Label values are counted first and each row meets its value's count in a join, so any number of
    values takes part. Rows without a label are left out.
    """
    counts = stage(
        rows.filter(F.col(f"`{label}`").isNotNull())
        .groupBy(F.col(f"`{label}`").alias("value")).agg(F.count("*").alias("rows")),
        "label-counts",
    )
    each = most / max(1, counts.count())
    met = common.free_name(rows, "met")
    found = counts.select(F.struct("value", "rows").alias(met))
    joined = rows.join(found, F.col(f"`{label}`") == F.col(f"{met}.value"))
    kept = joined.filter(hash_share(F.col(f"`{key}`")) * F.col(f"{met}.rows") < each)
    return kept.select(*[F.col(f"`{c}`") for c in rows.columns])


def fit_svm(x: np.ndarray, y: np.ndarray, rounds: int = 200, decay: float = 1e-4):
    """Weights and offset of a linear SVM (squared hinge, accelerated gradient descent).

    `x` has rows of length at most 1; `y` is 1 or -1; both classes weigh the same.
    """
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    weight, y = weight.astype(np.float32), y.astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.float32(0)
    old_w, old_b = w, b
    for step in range(rounds):
        pace = np.float32(step / (step + 3))
        at_w, at_b = w + pace * (w - old_w), b + pace * (b - old_b)
        short = np.maximum(0.0, 1 - y * (x @ at_w + at_b)) * y * weight
        old_w, old_b = w, b
        w = at_w - np.float32(0.24) * (np.float32(decay) * at_w - 2 * (short @ x))
        b = at_b + np.float32(0.48) * short.sum()
    return w.astype(np.float32), float(b)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, target: np.ndarray, rounds: int = 400, decay: float = 1e-4):
    """Weights and offset of a logistic regression on soft targets between 0 and 1."""
    w, b = np.zeros(x.shape[1]), 0.0
    old_w, old_b = w, b
    pace_of = 4 / (1 + (x**2).sum(axis=1).max(initial=1))
    for step in range(rounds):
        pace = step / (step + 3)
        at_w, at_b = w + pace * (w - old_w), b + pace * (b - old_b)
        gap = (target - sigmoid(x @ at_w + at_b)) / max(1, len(target))
        old_w, old_b = w, b
        w = at_w + pace_of * (gap @ x - decay * at_w)
        b = at_b + pace_of * gap.sum()
    return w, float(b)
