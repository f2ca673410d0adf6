"""Language identification in two steps: first the family, then the language within it.

Texts become counts of letter n-grams (1 to 3 letters) in hashed slots. Families are found from the
labelled sample: languages with similar mean profiles are joined until half as many groups remain.
One linear SVM per family picks the family; within it, one SVM per pair of languages votes.

The models are fitted on a bounded sample of labelled rows (`SAMPLE` texts in all, the same number
per language where there are enough); prediction reads every whole text.

Defined results: null texts and texts without a letter are `und` with score 0; if nothing is
labelled, every text is; repeated rows are predicted alike; an empty table gives an empty table;
extra columns pass through the operator.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from alarmloom.llm import common
from alarmloom.llm.linear import bounded_sample, fit_svm, sigmoid

SLOTS = 2048
SAMPLE = 4000
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point: is it a letter? Built once per Python worker."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTERS[0]


def profile(text: str | None) -> np.ndarray | None:
    """Unit vector of the text's n-gram counts (roots), or None if it has no letter."""
    points = np.frombuffer(
        (text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32
    ).astype(np.uint64)
    is_letter = letters()[points.astype(np.int64)]
    if not is_letter.any():
        return None
    blank = ~is_letter
    kept = is_letter.copy()
    kept[1:] |= blank[1:] & is_letter[:-1]
    own = np.where(is_letter, points, np.uint64(32))[kept]
    own = np.concatenate([[np.uint64(32)], own])
    mask = np.uint64(SLOTS - 1)
    first = own * np.uint64(0x9E3779B97F4A7C15)
    second = (first[:-1] ^ (own[1:] * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0xFF51AFD7ED558CCD)
    third = (second[:-1] ^ (own[2:] * np.uint64(0x165667B19E3779F9))) * np.uint64(0xC4CEB9FE1A85EC53)
    counts = np.zeros(SLOTS)
    for grams in (first, second, third):
        counts += np.bincount(
            ((grams >> np.uint64(40)) & mask).astype(np.int64), minlength=SLOTS
        )
    roots = np.sqrt(counts)
    return roots / np.linalg.norm(roots)


def families(centres: np.ndarray) -> list[list[int]]:
    """Languages grouped by similar mean profiles, down to half as many groups."""
    groups = [[i] for i in range(len(centres))]
    near = centres @ centres.T
    while len(groups) > max(1, -(-len(centres) // 2)):
        a, b = max(
            combinations(range(len(groups)), 2),
            key=lambda p: near[np.ix_(groups[p[0]], groups[p[1]])].mean(),
        )
        groups[a] += groups.pop(b)
    return groups


class Model:
    """Family SVMs and, per family, one SVM for each pair of its languages."""

    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray):
        self.languages = languages
        centres = np.array([x[y == i].mean(axis=0) for i in range(len(languages))])
        mean = centres.mean(axis=0) if len(languages) else 0
        centres = centres - mean
        centres /= np.maximum(1e-9, np.linalg.norm(centres, axis=1, keepdims=True))
        self.families = families(centres)
        self.of_family = [
            fit_svm(x, np.where(np.isin(y, group), 1.0, -1.0)) for group in self.families
        ]
        self.pairs = {}
        for group in self.families:
            for a, b in combinations(group, 2):
                own = np.isin(y, (a, b))
                self.pairs[a, b] = fit_svm(x[own], np.where(y[own] == a, 1.0, -1.0))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and a score between 0 and 1 for each row."""
        margins = np.array([x @ w + b for w, b in self.of_family]).reshape(len(self.families), -1)
        family = margins.argmax(axis=0)
        sure = sigmoid(3 * margins.max(axis=0)) if len(self.families) > 1 else np.ones(len(x))
        found = np.zeros(len(x), np.int64)
        for number, group in enumerate(self.families):
            rows = np.nonzero(family == number)[0]
            votes = np.zeros((len(rows), len(group)))
            least = np.full((len(rows), len(group)), np.inf)
            for i, j in combinations(range(len(group)), 2):
                w, b = self.pairs[group[i], group[j]]
                margin = x[rows] @ w + b
                votes[:, i] += (margin >= 0) + 1e-3 * np.tanh(margin)
                votes[:, j] += (margin < 0) - 1e-3 * np.tanh(margin)
                least[:, i] = np.minimum(least[:, i], margin)
                least[:, j] = np.minimum(least[:, j], -margin)
            best = votes.argmax(axis=1)
            found[rows] = np.array(group)[best]
            if len(group) > 1:
                sure[rows] *= sigmoid(3 * least[np.arange(len(rows)), best])
        return found, sure


def fit(labelled: DataFrame, lang_col="lang", text_col="text", id_col="doc_id", sample=SAMPLE):
    """A model from about `sample` labelled texts, or None without usable ones.

    Profiles are made by the executors; the driver fits on the bounded sample of them.
    """

    def profiles(batches):
        for batch in batches:
            rows = [(lang, profile(text)) for lang, text in zip(*[c.to_pylist() for c in batch.columns])]
            rows = [(lang, p.astype(np.float32).tobytes()) for lang, p in rows if p is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())],
                ["lang", "profile"],
            )

    rows = labelled.select(
        F.col(f"`{lang_col}`").alias("lang"),
        F.col(f"`{text_col}`").alias("text"),
        common.row_key(id_col, text_col).alias("row_key"),
    )
    chosen = bounded_sample(rows, "lang", "row_key", sample).select("lang", "text")
    found = chosen.mapInArrow(profiles, "lang string, profile binary").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.lang, r.profile))
    languages = sorted({r.lang for r in found})
    x = np.frombuffer(b"".join(r.profile for r in found), np.float32).reshape(-1, SLOTS)
    y = np.array([languages.index(r.lang) for r in found])
    return Model(languages, x, y)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """All rows and columns with `lang_pred` and `lang_score`; where a column has such a name already,
    the new one is called by the first free one of name_1, name_2 ..."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts):
        import pandas as pd

        model, names, scores = shared.value, [], []
        for at in range(0, len(texts), 256):
            profiles = [profile(t) for t in texts.iloc[at : at + 256]]
            usable = [i for i, p in enumerate(profiles) if p is not None and model is not None]
            own_names, own_scores = [UNKNOWN] * len(profiles), [0.0] * len(profiles)
            if usable:
                index, sure = model.predict(np.array([profiles[i] for i in usable], np.float32))
                for i, language, score in zip(usable, index, sure):
                    own_names[i], own_scores[i] = model.languages[language], float(score)
            names += own_names
            scores += own_scores
        return pd.DataFrame({"lang": names, "score": scores})

    own = common.free_name(docs, "lang_found")
    predicted = docs.withColumn(own, predict(F.col(f"`{text_col}`")))
    return predicted.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(f"{own}.lang").alias(common.free_name(docs, "lang_pred")),
        F.col(f"{own}.score").alias(common.free_name(docs, "lang_score")),
    )


def op8_language_id(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    held_out = common.crc_of_id() % 4 == 2
    model = fit(docs.filter(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return identify(rows, model).select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score")
    )
