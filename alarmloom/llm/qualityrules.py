"""Quality rules: word and line counts, and compression bands by zstandard.

A text's ratio is its compressed size over its size in bytes (level 3, one frame). Repetitive text
lies below the band of its length, incompressible text above it; short texts carry the frame's own
bytes, so every length has limits of its own (`BANDS`). Texts longer than a chunk are also cut into
fixed chunks, compressed one by one: if more than `CHUNK_SHARE` of the bytes lies in chunks outside
the band of their length, the text is rejected, though its other parts may keep the whole ratio in
the band. The limits are parameters; nothing is fitted.

Defined results: null and empty texts have no words and fail the base rules; repeated rows are
judged alike; a text of any length is read whole, chunk by chunk where it is long; an empty table
gives an empty table; extra columns pass, and the report takes a name that no column has.
"""

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from alarmloom.llm import common

LEVEL = 3
CHUNK = 4096
CHUNK_SHARE = 0.2
LEAST_WORDS = 10
MOST_REPEATED = 20
WINDOW = 5
# Bytes below which the limits hold, least and most ratio; the last entry holds for all other lengths.
BANDS = [
    (64, 0.55, 2.0),
    (128, 0.45, 1.3),
    (256, 0.40, 1.0),
    (512, 0.36, 0.9),
    (1024, 0.30, 0.85),
    (4096, 0.25, 0.75),
    (16384, 0.20, 0.7),
    (float("inf"), 0.18, 0.65),
]
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
REPORT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, outside double, kept boolean"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window of `window` words met twice or more in the text.

    Words are numbered, then pairs of numbers, and so on: equal numbers mean equal windows, without
    hashes, in arrays of the text's length.
    """
    count = len(words) - window + 1
    if count < 2:
        return 0
    numbers: dict[bytes, int] = {}
    each = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    at, span = each, 1
    while span < window:
        step = min(span, window - span)
        joined = at[: len(words) - span - step + 1] * (len(words) + 1) + at[step : len(words) - span + 1]
        _, at = np.unique(joined, return_inverse=True)
        span += step
    twice = np.bincount(at)[at] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:-1][: len(twice)] += twice
    edges[window:] -= twice
    return int((np.cumsum(edges) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    met, found = set(), 0
    if b"\n" not in text:
        return 0
    for line in text.split(b"\n"):
        if line in met:
            found += 1
        elif line.strip(BLANKS):
            met.add(line)
    return found


def _points(text: bytes) -> int:
    return len(text.translate(None, CONTINUATION))


class Bands:
    """Ratios of whole texts and chunks against the limits of their lengths."""

    def __init__(self, bands=BANDS, chunk: int = CHUNK, share: float = CHUNK_SHARE, level: int = LEVEL):
        self.bands, self.chunk, self.share, self.level = bands, chunk, share, level

    def opened(self) -> "Bands":
        """Ready for use in a worker; compressors cannot be sent to one."""
        self.compressor = zstandard.ZstdCompressor(level=self.level, write_content_size=False)
        return self

    def ratio(self, data) -> float:
        return len(self.compressor.compress(data)) / len(data)

    def outside(self, ratio: float, length: int) -> bool:
        least, most = next((low, high) for below, low, high in self.bands if length < below)
        return not least <= ratio <= most

    def verdict(self, text: bytes) -> tuple[float, float, bool]:
        """Ratio of the text, share of its bytes in chunks outside their band, and whether it stays."""
        if not text:
            return 0.0, 0.0, False
        ratio, bad = self.ratio(text), 0
        if len(text) > self.chunk:
            view = memoryview(text)
            for at in range(0, len(text), self.chunk):
                part = view[at : at + self.chunk]
                bad += len(part) * self.outside(self.ratio(part), len(part))
        share = bad / len(text)
        return ratio, share, not self.outside(ratio, len(text)) and share <= self.share


def report(text: bytes | None, bands: Bands) -> tuple:
    """The columns of `REPORT` for one text."""
    text = text or b""
    words = text.split()
    repeated = repeated_words(words)
    failed = len(words) < LEAST_WORDS or 100 * repeated > MOST_REPEATED * len(words)
    ratio, outside, stays = bands.verdict(text)
    return (
        len(words),
        _points(text) - (len(text) - len(text.translate(None, BLANKS))),
        len(text) - len(text.translate(None, SYMBOLS)),
        repeated_lines(text),
        repeated,
        failed,
        ratio,
        outside,
        stays and not failed,
    )


def with_report(
    docs: DataFrame, name: str = "quality", text_col: str = "text", bands: Bands | None = None
) -> DataFrame:
    """All rows and columns with one more, a struct of the columns of `REPORT`.

    It is called `name`, or if a column has that name, the first free one of `name`_1, `name`_2 ...
    """
    judge = bands or Bands()

    @F.pandas_udf(REPORT)
    def judged(texts):
        import pandas as pd

        own = judge.opened()
        rows = [report(t, own) for t in texts]
        columns = [c.strip().split()[0] for c in REPORT.split(",")]
        return pd.DataFrame(rows, columns=columns)

    return docs.withColumn(
        common.free_name(docs, name), judged(F.col(f"`{text_col}`").cast("binary"))
    )


def passing(docs: DataFrame, text_col: str = "text", bands: Bands | None = None) -> DataFrame:
    """The rows that stay, with the columns they came with."""
    judged = with_report(docs, text_col=text_col, bands=bands)
    return judged.filter(F.col(judged.columns[-1])["kept"]).drop(judged.columns[-1])


def op11_quality_compression_bands(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_report(docs).select("doc_id", "quality.*")
