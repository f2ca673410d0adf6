"""Packing token sequences into bins of a fixed length by best fit and swap-based local search.

Texts become ids by a public tokenizer, one separator id follows each, and only documents longer
than a bin are cut. Pieces are dealt at random into groups of about `GROUP` pieces; each group is
packed by itself (best fit, longest first), then improved: moving a piece, exchanging one for one
or two for one between any underfull bins raises the sum of squared fills until no bin can be
spared or no such step is left; no number of bins, pieces or steps is set.

The result has the ids of each piece with its place; `sequences` puts them together.

Defined results: null and empty texts are the separator alone; repeated rows are packed as often
as they occur; an empty table gives an empty table; extra columns are ignored.
"""

import gc
import math
import os
import re
from bisect import bisect_left, insort
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from alarmloom.llm import common
from alarmloom.session import stage

BIN = 4096
SEPARATOR = 1
GROUP = 4096
CELLS = 1 << 20
SLICE = 4 << 20
REMEMBERED = 800_000
# Of an encoder that is not kept for other tasks: its arrays and words are to take little memory.
SHORT_SLICE = 1 << 20
FEW_REMEMBERED = 400_000
TOGETHER = 4096
PIECES = "doc_id long, piece int, start long, length long, ids binary"
# How the tokenizer splits text of ASCII characters, in lower case.
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\r0-9a-z]+")
TAIL = re.compile(r"[!-/:-@\[-`{-~]+\Z")
SPECIAL = b"<|"

BLANK, LETTER, DIGIT, SIGN, QUOTE, WIDE = range(6)


def _kind(byte: int) -> int:
    if byte in b" \t\n\x0b\x0c\r":
        return BLANK
    if byte >= 0x80:
        return WIDE
    if byte == ord("'"):
        return QUOTE
    return LETTER if chr(byte).isalpha() else DIGIT if chr(byte).isdigit() else SIGN


KINDS = np.array([_kind(b) for b in range(256)], np.uint8)
LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _cut(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces that the tokenizer treats each by itself: (bytes without blanks, offsets into them, place
    of each piece's first byte in `data`).

    It never looks across white space. Within a word of ASCII characters it goes on from one piece to
    the next where letters, digits and signs meet, and at every digit. Words with a quote or with
    wider characters stay whole here.
    """
    kinds = KINDS[data]
    solid = kinds != BLANK
    before = np.concatenate([[False], solid[:-1]])
    first = np.flatnonzero(solid & ~before)
    if not len(first):
        return data[:0], np.zeros(1, np.int32), first
    plain = np.maximum.reduceat(kinds, first) < QUOTE
    spread = np.diff(np.append(first, len(data)))
    turn = np.concatenate([[True], kinds[1:] != kinds[:-1]]) | (kinds == DIGIT)
    turn &= solid & np.concatenate([np.zeros(first[0], bool), np.repeat(plain, spread)])
    turn[first] = True
    places = np.flatnonzero(turn)
    # Blanks are taken out, so a piece ends where the next begins.
    kept = data[solid]
    offsets = np.append(np.cumsum(solid, dtype=np.int32)[places] - 1, len(kept)).astype(np.int32)
    return kept, offsets, places


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes; remembers the ids of the words it has met.

    A slice of texts is cut into pieces in one array operation, and each different piece of the slice
    is looked up once. Texts that may hold a special token go to the tokenizer whole.
    """

    def __init__(self, path: str, most: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.older, self.most, self.parted = {}, {}, most, {}
        self.slice = SLICE

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        gc.disable()  # nothing here is cyclic, and each collection would walk all known words
        try:
            return self._encode_all(texts)
        finally:
            gc.enable()

    def _encode_all(self, texts):
        out, held, size = [b""] * len(texts), [], 0

        def settle():
            for number, ids in zip([n for n, _ in held], self._encode([t for _, t in held])):
                out[number] = out[number] + ids if out[number] else ids
            held.clear()

        for number, text in enumerate(texts):
            if not text:
                continue
            if SPECIAL in text:
                coded = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False)
                out[number] = np.array(coded.ids, np.uint32).tobytes()
                continue
            for part in self._parts(text):
                held.append((number, part))
                size += len(part)
                if size >= self.slice:
                    settle()
                    size = 0
        settle()
        return out

    def _parts(self, text: bytes):
        """A long text in parts of about a slice, cut at blanks."""
        at = 0
        while len(text) - at > self.slice:
            end = text.find(b" ", at + self.slice)
            if end < 0:
                break
            yield text[at:end]
            at = end
        yield text[at:] if at else text

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        data = LOWERED[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
        solid, offsets, places = _cut(data)
        pieces = pa.Array.from_buffers(
            pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(solid)]
        ).dictionary_encode()
        coded = self._ids(pieces.dictionary.to_pylist())
        each = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        flat, start = np.frombuffer(b"".join(coded), np.uint32), np.cumsum(each) - each
        own = pieces.indices.to_numpy(zero_copy_only=False)
        lengths = each[own]
        ends = np.cumsum(lengths)
        ids = flat[np.repeat(start[own] - (ends - lengths), lengths) + np.arange(lengths.sum())]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        first = np.searchsorted(places, np.cumsum(sizes))
        cuts = np.concatenate([[0], np.append(0, ends)[first]]).tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece. Two generations are remembered, so that frequent ones last."""
        if len(self.known) >= self.most // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        coded = list(map(known.get, pieces))
        missing = [n for n, ids in enumerate(coded) if ids is None]
        split = {}
        for piece in [pieces[n] for n in missing]:
            if piece in older:
                known[piece] = older[piece]
            else:
                split[piece] = self._split(piece)
        unknown = list({p for own in split.values() for p in own if p not in known})
        for at in range(0, len(unknown), TOGETHER):
            self._learn(unknown[at : at + TOGETHER])
        for piece, own in split.items():
            if len(own) != 1 or own[0] != piece:
                known[piece] = b"".join([known[p] for p in own])
        for n in missing:
            coded[n] = known[pieces[n]]
        return coded

    def _learn(self, pieces: list[bytes]) -> None:
        """One call for many pieces, which the tokenizer keeps apart and numbers."""
        words = [p.decode("utf-8", "replace") for p in pieces]
        coded = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        counts = np.bincount(np.array(coded.word_ids, np.int64), minlength=len(pieces))
        ids, ends = np.array(coded.ids, np.uint32), np.cumsum(counts).tolist()
        for piece, start, end in zip(pieces, [0, *ends], ends):
            self.known[piece] = ids[start:end].tobytes()

    def _split(self, piece: bytes) -> list[bytes]:
        """A word with a quote by the tokenizer's rule; signs behind a wider word come off it if the
        tokenizer parts them from its last letter."""
        if piece.isascii():
            if b"'" not in piece:
                return [piece]
            return [p.encode() for p in ASCII_PIECE.findall(piece.decode())]
        word = piece.decode("utf-8", "replace")
        tail = TAIL.search(word)
        if tail and "'" not in tail[0] and self._parts_from(word[tail.start() - 1]):
            return [word[: tail.start()].encode(), tail[0].encode()]
        return [piece]

    def _parts_from(self, letter: str) -> bool:
        """Does the tokenizer part a sign from this letter? Not if, normalised, it ends in a mark."""
        if letter not in self.parted:
            normal = self.tokenizer.normalizer.normalize_str(letter + ".")
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            self.parted[letter] = len(found) == 2 and found[1][0] == "." and letter.isalpha()
        return self.parted[letter]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker, so that its words last from task to task."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(
    docs: DataFrame, path: str, size: int = BIN, separator: int = SEPARATOR, remember: bool = True
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit).

    `docs`: id and text. Without `remember` a task works in shorter slices, holds fewer words, and forgets
    them when it ends, for jobs that go on in the same workers and need the memory.
    """
    slice_ = SLICE if remember else SHORT_SLICE

    def cut(batches):
        encode = encoder(path)
        if not remember:
            encode.slice, encode.most = SHORT_SLICE, FEW_REMEMBERED
        end = np.array([separator], np.uint32).tobytes()
        docs_held, texts, held = [], [], 0

        def settle():
            rows = []
            for doc, tokens in zip(docs_held, encode(texts)):
                tokens += end
                for piece, at in enumerate(range(0, len(tokens), size * 4)):
                    part = tokens[at : at + size * 4]
                    rows.append((doc, piece, at // 4, len(part) // 4, part))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            docs_held.clear()
            texts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                ["doc_id", "piece", "start", "length", "ids"],
            )

        for batch in batches:
            docs_held += batch.column(0).to_pylist()
            texts += batch.column(1).to_pylist()
            held += batch.column(1).nbytes
            if held >= slice_:
                yield settle()
                held = 0
        yield settle()
        if not remember:
            # Nothing may hold the words any more when memory is given back.
            encode = None
            _ENCODERS.clear()
        common.release()

    id_col, text_col = docs.columns
    binary = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("binary"))
    return binary.mapInArrow(cut, PIECES)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the fullest bin that still takes it."""
    bins, free = [], []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(free, (lengths[item],))
        room, own = free.pop(at) if at < len(free) else (size, len(bins))
        if own == len(bins):
            bins.append([])
        bins[own].append(item)
        if room > lengths[item]:
            insort(free, (room - lengths[item], own))
    return bins


def _parts(bin_, lengths):
    """Distinct sums of at most two pieces of a bin: single lengths, then 0 and the pairs' sums.

    Distinct lengths of a bin add up to at most its size, so there are few of them.
    """
    single, counts = np.unique([lengths[i] for i in bin_], return_counts=True)
    first, second = np.triu_indices(len(single), 1)
    pairs = np.concatenate([single[first] + single[second], 2 * single[counts > 1]])
    return single, np.concatenate([[0], np.unique(pairs)]).astype(np.int64)


def _taken(bin_, lengths, total, pair):
    """Pieces of a bin, none, one or (`pair`) two, whose lengths add up to `total`."""
    if not total:
        return []
    at = {}
    for i in bin_:
        if not pair and lengths[i] == total:
            return [i]
        if pair and total - lengths[i] in at:
            return [at[total - lengths[i]], i]
        at[lengths[i]] = i
    raise AssertionError("no such pieces")


class _Table:
    """Values of all bins in one array; a changed bin's values move to the end."""

    def __init__(self, own: list[np.ndarray]):
        self.start, self.count = [0] * len(own), [0] * len(own)
        self._fill(dict(enumerate(own)))

    def _fill(self, own):
        self.used = sum(map(len, own.values()))
        self.value = np.zeros(2 * self.used + 8192, np.int64)
        self.bin = np.full(len(self.value), -1, np.int64)
        at = 0
        for b, values in own.items():
            self.value[at : at + len(values)] = values
            self.bin[at : at + len(values)] = b
            self.start[b], self.count[b] = at, len(values)
            at += len(values)

    def of(self, b):
        return self.value[self.start[b] : self.start[b] + self.count[b]]

    def put(self, b, values):
        self.bin[self.start[b] : self.start[b] + self.count[b]] = -1
        self.count[b] = 0
        if self.used + len(values) > len(self.value):
            live = {i: self.of(i).copy() for i in range(len(self.count)) if self.count[i]}
            self._fill(live | {b: values})
            return
        at = self.used
        self.value[at : at + len(values)], self.bin[at : at + len(values)] = values, b
        self.start[b], self.count[b] = at, len(values)
        self.used += len(values)


def local_search(bins, lengths, size):
    """Empties underfull bins: pieces change bins as long as that raises the sum of squared fills.

    Between any two underfull bins a piece moves, or one piece changes places with one or with two.
    Full bins can take no part in a raise. A bin is looked at against all others at once; it
    comes back whenever it has changed, so the search ends when the pieces need all bins that are
    left, or when no such step between any two bins is left.
    """
    bins = [list(b) for b in bins if b]
    least = -(-sum(lengths) // size)
    number = len(bins)
    if number <= least:
        return bins
    fill = np.array([sum(lengths[i] for i in b) for b in bins] + [0], np.int64)
    # The last entry stands for values that have left: it takes and gives nothing.
    room = np.append(size - fill[:-1], -(1 << 40))
    parts = [_parts(b, lengths) for b in bins]
    ones, others = _Table([p[0] for p in parts]), _Table([p[1] for p in parts])
    for b in np.flatnonzero(room[:-1] == 0):
        ones.put(b, ones.value[:0])
        others.put(b, others.value[:0])

    def best(given, table, x):
        """The largest raise: (raise, given, bin, taken)."""
        of, taken = table.bin[: table.used], table.value[: table.used]
        found = (0,)
        slices = max(1, CELLS // max(1, len(taken)))  # bounds the memory of a look, not the look
        for start in range(0, len(given) if len(taken) else 0, slices):
            gain = given[start : start + slices, None] - taken
            raised = gain * (fill[of] - fill[x] + gain)
            raised[(gain > room[of]) | (gain < -room[x]) | (of == x)] = 0
            i, j = divmod(int(raised.argmax()), len(taken))
            if raised[i, j] > found[0]:
                found = int(raised[i, j]), int(given[start + i]), int(of[j]), int(taken[j])
        return found

    waiting = deque(sorted(np.flatnonzero(room[:-1] > 0).tolist(), key=lambda b: fill[b]))
    queued = set(waiting)
    while waiting and number > least:
        x = waiting.popleft()
        queued.discard(x)
        if not 0 < fill[x] < size:
            continue
        one, other = ones.of(x), others.of(x)
        steps = [
            (best(one, others, x), False, True),
            (best(one, ones, x), False, False),
            (best(other, ones, x), True, False),
        ]
        (raised, *step), pair_x, pair_y = max(steps, key=lambda s: s[0][0])
        if not raised:
            continue
        given, y, taken = step
        out = _taken(bins[x], lengths, given, pair_x)
        back = _taken(bins[y], lengths, taken, pair_y)
        bins[x] = [i for i in bins[x] if i not in out] + back
        bins[y] = [i for i in bins[y] if i not in back] + out
        for b, more in ((x, taken - given), (y, given - taken)):
            fill[b] += more
            room[b] -= more
            own = _parts(bins[b], lengths) if 0 < fill[b] < size else (ones.value[:0],) * 2
            ones.put(b, own[0])
            others.put(b, own[1])
            number -= not fill[b]
            if 0 < fill[b] < size and b not in queued:
                waiting.append(b)
                queued.add(b)
    return [b for b in bins if b]


def packed(parts: DataFrame, size: int = BIN) -> DataFrame:
    """Adds `sequence_id` and `offset` to staged pieces."""
    groups = max(1, math.ceil(parts.count() / GROUP))

    def pack(group):
        lengths = group.column("length").to_pylist()
        own = group.column("own")[0].as_py()
        bins = local_search(best_fit(lengths, size), lengths, size)
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for number, items in enumerate(bins):
            at = 0
            for item in items:
                sequence[item], offset[item] = (own << 24) + number, at
                at += lengths[item]
        return group.drop_columns(["own"]).append_column(
            "sequence_id", pa.array(sequence, pa.int64())
        ).append_column("offset", pa.array(offset, pa.int64()))

    # The number of a row in the written table: it spreads repeated rows, and stays on a retry.
    own = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    return (
        parts.withColumn("own", own)
        .groupBy("own")
        .applyInArrow(pack, f"{PIECES}, sequence_id long, offset long")
    )


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    remember: bool = True,
) -> DataFrame:
    """Pieces of all documents, each with its ids and its place in the packed sequences."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return packed(stage(pieces(rows, path or vocabulary(), remember=remember), "pieces"))


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, length and ids, its pieces' ids in order of offset."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(own, F.lit(b""), lambda ids, one: F.concat(ids, one["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def digests(placed: DataFrame) -> DataFrame:
    """The placed pieces with the crc32 of their ids instead of the ids."""
    crc = F.crc32("ids").alias("ids_crc32")
    return placed.select("doc_id", "piece", "start", "length", crc, "sequence_id", "offset")


def op6_best_fit_packing(spark, sf_dir):
    return digests(pack_documents(common.table(spark, sf_dir, "documents")))
