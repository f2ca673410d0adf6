"""Source divergence audit: how a source's words differ from those of its language's other sources.

Kept terms are found by iceberg prefix refinement. A term ends in a zero byte; its prefix of L
bytes is complete if it holds that end. Level by level, with L three times as long, Spark counts the
distinct documents of each language's prefixes, and discards those below the threshold: no term
under them can reach it. Only terms whose last prefix stayed are extended. The loop ends when every
prefix that stays is complete: these are the kept terms with their exact numbers of documents.

Each level is a pass over the texts. A task adds up its own documents first and drops, by a Bloom
filter of the prefixes that stayed, what has been discarded, before anything is shuffled. What the
filter lets pass by mistake is counted and falls below the threshold by itself.

For the occurrences in each group the texts are brought together by group first: a task that meets few
groups adds up most of their counts itself. Spark splits what is large and joins what is small by bytes.
Their counts are dealt out once, by term: they are added, met with the kept terms and summed over the
language where they lie. From there on a term goes by its number.

A task reads its texts in slices of about 1 MB and finds where terms start and end in all bytes of a slice
at once. The first 8 bytes of a term are one number; prefixes and terms up to that length are counted as
numbers, longer ones as bytes.

Divergences are exact integers. For a pair of sources only the terms that both have are met, in a
join by term; terms that one of them has, or none, are added from the histogram of its counts.

Defined results: null text, language and source count as ''; each row is a document, repeated rows
too; a language without kept terms has pairs of value 0 and no terms; an empty table gives an empty
table; extra columns are ignored.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from alarmloom.llm import common
from alarmloom.session import stage

LEAST_DOCS = 3
FIRST_LEVEL = 8
LONGER = 3
HELD = 400_000
SLICE = 1 << 20
WORD = 8
MOST_TERMS = 200
BLOCK = 256
END = b"\0"
# Bytes outside terms become blanks, A-Z lower case; bytes above 0x7F belong to terms.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
PREFIXES = "lang string, prefix binary, docs long"
COUNTS = "lang string, g long, term binary, n long"
# One product below stays a 64-bit integer up to this count.
MOST_PLAIN = 9_000_000_000


def slices(batches, columns: int) -> Iterator[list[list]]:
    """The columns of the batches as lists, some SLICE bytes of text (the last column, without nulls) at a time."""
    for batch in batches:
        lists = [batch.column(i).to_pylist() for i in range(columns)]
        lists[-1] = [text or b"" for text in lists[-1]]
        first, size = 0, 0
        for at, text in enumerate(lists[-1], 1):
            size += len(text)
            if size >= SLICE or at == batch.num_rows:
                yield [values[first:at] for values in lists]
                first, size = at, 0


def spans(texts: list[bytes], least: int = 1) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The terms of `least` bytes or more: all bytes, where each term starts and ends, and the place of its text."""
    data = b"".join([text + b" " for text in texts]).translate(TERM_BYTES)
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = np.zeros_like(ends)
    starts[1:] = ends[:-1] + 1
    found = ends - starts >= least
    starts, ends = starts[found], ends[found]
    behind = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    owners = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, behind), prepend=0))
    return data, starts, ends, owners


def words_at(data: bytes, starts: np.ndarray, ends: np.ndarray, length: int = WORD) -> np.ndarray:
    """The first `length` bytes (at most 8) of each term as a number, with zeros behind a shorter term."""
    at = np.ndarray(len(data), ">u8", data + bytes(WORD), strides=(1,))
    unused = (8 * (WORD - np.minimum(ends - starts, length))).astype(np.uint64)
    return at[starts].astype(np.uint64) >> unused << unused


def word_bytes(words: np.ndarray, ended_below: int = 0) -> pa.Array:
    """The words as bytes; those shorter than `ended_below` get the end of a term."""
    own = np.zeros((len(words), WORD + 1), np.uint8)
    own[:, :WORD] = words.astype(">u8").view(np.uint8).reshape(-1, WORD)
    lengths = (own != 0).sum(axis=1)
    lengths += lengths < ended_below
    offsets = np.zeros(len(words) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    data = own[np.arange(WORD + 1) < lengths[:, None]]
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values starts, and how long it is."""
    firsts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return firsts, np.diff(firsts, append=len(values))


class Tally:
    """Counts of words by unit: a language, or a group."""

    def __init__(self):
        self.held, self.size = defaultdict(list), 0

    def add(self, units: list, owners: np.ndarray, words: np.ndarray, once: bool) -> None:
        """Words of the texts `owners`, whose units are given by text. `once`: a text counts a word once."""
        if not len(words):
            return
        number = {unit: i for i, unit in enumerate(dict.fromkeys(units))}
        coded = pa.array(words).dictionary_encode()
        known, texts = coded.dictionary.to_numpy(), len(units)
        codes = np.array([number[u] for u in units])[owners] * len(known) + coded.indices.to_numpy()
        if once:
            codes = codes * texts + owners
            codes.sort()
            codes = codes[_runs(codes)[0]] // texts
        else:
            codes.sort()
        firsts, counts = _runs(codes)
        codes = codes[firsts]
        bounds = np.searchsorted(codes, np.arange(len(number) + 1) * len(known)).tolist()
        for unit, i in number.items():
            a, b = bounds[i], bounds[i + 1]
            if a < b:
                self.held[unit].append((known[codes[a:b] % len(known)], counts[a:b]))
        self.size += len(codes)

    def merge(self) -> None:
        """Adds up what is held of the same word."""
        self.size = 0
        for unit, parts in self.held.items():
            words, counts = (np.concatenate(column) for column in zip(*parts))
            order = np.argsort(words)
            words, counts = words[order], counts[order]
            firsts, _ = _runs(words)
            self.held[unit] = [(words[firsts], np.add.reduceat(counts, firsts))]
            self.size += len(firsts)

    def settle(self) -> Iterator[tuple]:
        """(unit, words, counts), each word once and in order, and holds nothing after."""
        self.merge()
        held, self.held, self.size = self.held, defaultdict(list), 0
        for unit, ((words, counts),) in held.items():
            yield unit, words, counts


class Filter:
    """A broadcast Bloom filter over (language, prefix)."""

    def __init__(self, shared, width: int):
        self.shared, self.width = shared, width

    def __call__(self, lang: str, keys: list[bytes]) -> np.ndarray:
        return common.passes(self.shared.value, _slots(lang, keys, self.width))


def _slots(lang: str, keys: list[bytes], width: int) -> np.ndarray:
    if not keys:
        return np.zeros((common.HASHES, 0), np.uint64)
    start = lang.encode("utf-8", "surrogatepass") + END
    both = b"".join([xxhash.xxh3_128_digest(start + key) for key in keys])
    halves = np.frombuffer(both, np.uint64).reshape(-1, 2)
    return common.bloom_slots(halves[:, 0], halves[:, 1], width)


def prefix_filter(prefixes: DataFrame, count: int) -> Filter:
    """Of staged prefixes (lang, prefix). At most 32 MB: beyond 16 million prefixes more pass it."""
    width = common.bloom_width(count)

    def slots_of(batch):
        by = defaultdict(list)
        for lang, key in zip(*[c.to_pylist() for c in batch.columns[:2]]):
            by[lang].append(key)
        for lang, keys in by.items():
            yield _slots(lang, keys, width).ravel()

    bits = common.bloom_bits(prefixes.select("lang", "prefix"), slots_of, width, least=1)
    return Filter(prefixes.sparkSession.sparkContext.broadcast(bits), width)


def prefix_documents(texts: DataFrame, length: int, before: int, alive: Filter | None) -> DataFrame:
    """(lang, prefix, docs): distinct documents of the prefixes of `length` bytes whose prefix of
    `before` bytes is alive. `texts`: lang, source, text."""

    def counts_of(lang, keys, docs):
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), keys, pa.array(docs, pa.int64())],
            ["lang", "prefix", "docs"],
        )

    def count_words(batches):
        held = Tally()

        def settle():
            for lang, words, docs in held.settle():
                yield counts_of(lang, word_bytes(words, length), docs)

        for langs, _, own in slices(batches, 3):
            data, starts, ends, owners = spans(own)
            held.add(langs, owners, words_at(data, starts, ends, length), once=True)
            if held.size >= HELD:
                held.merge()
                if held.size >= HELD // 2:
                    yield from settle()
        yield from settle()

    def count_bytes(batches):
        held, size = defaultdict(Counter), 0

        def settle():
            for lang, own in held.items():
                keys = list(own)
                if alive is not None:
                    stays = alive(lang, [k[:before] for k in keys])
                    keys = [k for k, s in zip(keys, stays.tolist()) if s]
                # What is shorter than the level is a whole term.
                ended = [k if len(k) == length else k + END for k in keys]
                yield counts_of(lang, pa.array(ended, pa.binary()), [own[k] for k in keys])
            held.clear()

        for langs, _, read in slices(batches, 3):
            # A term shorter than `before` was complete, and settled, a level ago.
            data, starts, ends, owners = spans(read, max(before, 1))
            until = np.minimum(ends, starts + length)
            cut = [data[a:b] for a, b in zip(starts.tolist(), until.tolist())]
            bounds = np.searchsorted(owners, np.arange(len(langs) + 1)).tolist()
            for lang, a, b in zip(langs, bounds, bounds[1:]):
                own, known = held[lang], len(held[lang])
                own.update(set(cut[a:b]))
                size += len(own) - known
                if size >= HELD:
                    yield from settle()
                    size = 0
        yield from settle()

    count = count_words if alive is None and length <= WORD else count_bytes
    return texts.mapInArrow(count, PREFIXES).groupBy("lang", "prefix").agg(F.sum("docs").alias("docs"))


def kept_terms(texts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, prefix, docs, t) of the terms, with their end, that `least` documents or more have; t numbers them."""
    kept, alive, before, length = None, None, 0, FIRST_LEVEL
    while True:
        found = prefix_documents(texts, length, before, alive).filter(F.col("docs") >= least)
        found = stage(found, "iceberg")
        complete = F.substring("prefix", -1, 1) == F.lit(END)
        done = found.filter(complete)
        kept = done if kept is None else kept.union(done)
        open_ = found.filter(~complete)
        left = open_.count()
        if not left:
            return stage(kept.withColumn("t", F.monotonically_increasing_id()), "iceberg-kept")
        alive, before, length = prefix_filter(open_, left), length, length * LONGER


def group_numbers(texts: DataFrame) -> DataFrame:
    """(lang, source, g): the groups, numbered."""
    groups = texts.select("lang", "source").distinct().withColumn("g", F.monotonically_increasing_id())
    return stage(groups, "audit-numbered")


def term_counts(texts: DataFrame, kept: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """(lang, source, g, t, term, n, lang_n, groups): occurrences of the kept terms in each group and in its
    language, and how many groups have the term. `numbered`: the groups of `texts` by number."""
    wanted = prefix_filter(kept, kept.count())
    numbered = group_numbers(texts) if numbered is None else numbered
    # Rebalanced, not partitioned, by group: a large group is read by many tasks.
    told = texts.join(numbered, ["lang", "source"]).select("lang", "g", "text").hint("rebalance", "g")

    def count(batches):
        # Terms of up to 8 bytes wait as numbers, longer ones as bytes.
        short, long, size = Tally(), defaultdict(Counter), 0

        def counts_of(unit, keys, n):
            lang, g = unit
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array([g] * len(keys), pa.int64()),
                 keys, pa.array(n, pa.int64())],
                ["lang", "g", "term", "n"],
            )

        def settle():
            # Each term of a language is looked up once, whatever number of its sources have it.
            by_lang = defaultdict(list)
            for unit, words, n in short.settle():
                by_lang[unit[0]].append((unit, words, n))
            for lang, groups in by_lang.items():
                words = np.unique(np.concatenate([own for _, own, _ in groups]))
                stays = wanted(lang, [k + END for k in word_bytes(words).to_pylist()])
                for unit, own, n in groups:
                    passed = stays[np.searchsorted(words, own)]
                    yield counts_of(unit, word_bytes(own[passed]), n[passed])
            by_lang = defaultdict(list)
            for unit in long:
                by_lang[unit[0]].append(unit)
            for lang, units in by_lang.items():
                keys = list(set().union(*[long[unit] for unit in units]))
                stays = wanted(lang, [k + END for k in keys])
                passed = {k for k, s in zip(keys, stays.tolist()) if s}
                for unit in units:
                    own = long[unit]
                    keys = [k for k in own if k in passed]
                    yield counts_of(unit, pa.array(keys, pa.binary()), [own[k] for k in keys])
            long.clear()

        for langs, groups, read in slices(batches, 3):
            units = list(zip(langs, groups))
            data, starts, ends, owners = spans(read)
            brief = ends - starts <= WORD
            short.add(units, owners[brief], words_at(data, starts[brief], ends[brief]), once=False)
            starts, ends, owners = starts[~brief], ends[~brief], owners[~brief]
            terms = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            bounds = np.searchsorted(owners, np.arange(len(units) + 1)).tolist()
            for unit, a, b in zip(units, bounds, bounds[1:]):
                own, known = long[unit], len(long[unit])
                own.update(terms[a:b])
                size += len(own) - known
            if short.size + size >= HELD:
                short.merge()
                if short.size + size >= HELD // 2:
                    yield from settle()
                    size = 0
        yield from settle()

    # The filter may let a term pass that is not kept; the join leaves it out. The term comes first: it
    # tells rows apart in a sort where the language seldom does.
    terms = kept.select(F.expr("substring(prefix, 1, octet_length(prefix) - 1)").alias("term"), "lang", "t")
    dealt = told.mapInArrow(count, COUNTS).repartition("term", "lang")
    added = dealt.groupBy("g", "term", "lang").agg(F.sum("n").alias("n"))
    of_term = Window.partitionBy("term", "lang")
    met = added.join(terms, ["term", "lang"]).select(
        "g", "t", F.col("term").cast("string").alias("term"), "n",
        F.sum("n").over(of_term).alias("lang_n"), F.count("*").over(of_term).alias("groups"),
    )
    return met.join(numbered, "g").select("lang", "source", "g", "t", "term", "n", "lang_n", "groups")


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + kept)), for large counts in decimals so that no product overflows."""
    plain = F.call_function("div", F.lit(1_000_000_000).cast("long") * (n + 1), total + kept)
    above = F.lit(1_000_000_000).cast("decimal(18,0)") * (n + 1).cast("decimal(19,0)")
    wide = F.call_function("div", above, (total + kept).cast("decimal(19,0)"))
    return F.when(n < MOST_PLAIN, plain).otherwise(wide) + 1


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) for p and q of at most 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("long"))


def audit(
    docs: DataFrame,
    least: int = LEAST_DOCS,
    most_terms: int = MOST_TERMS,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value, rank."""
    empty = F.lit("")
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), empty).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), empty).alias("source"),
        F.coalesce(F.col(text_col), empty).cast("binary").alias("text"),
    )
    kept = kept_terms(texts, least)
    numbered = group_numbers(texts)
    counts = stage(term_counts(texts, kept, numbered).drop("lang", "source"), "audit-counts")

    totals = counts.groupBy("g").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    zero = F.lit(0).cast("long")
    groups = (
        numbered.join(totals, "g", "left")
        .join(of_lang, "lang", "left")
        .select("lang", "source", "g", F.coalesce("total", zero).alias("total"),
                F.coalesce("own", zero).alias("own"), F.coalesce("kept", zero).alias("kept"))
        # The share of a term that the group does not have.
        .withColumn("p0", F.when(F.col("kept") > 0, _share(zero, F.col("total"), F.col("kept"))))
    )
    groups = stage(groups, "audit-groups")
    lang_totals = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    rated = counts.join(groups.join(lang_totals, "lang"), "g").select(
        "g", "t", "term", "p0",
        # A term that many groups have is met block by block.
        F.ceil(F.col("groups") / BLOCK).cast("int").alias("blocks"),
        _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    rated = stage(rated, "audit-rated")
    return _term_part(groups, rated, most_terms).unionByName(_pair_part(groups, rated))


def _ranked(rows: DataFrame, of: str) -> DataFrame:
    """`rank` among the rows of the same `of`, from 1."""
    order = Window.partitionBy(of).orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _part(rows: DataFrame, part: str) -> DataFrame:
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _term_part(groups: DataFrame, rated: DataFrame, most: int) -> DataFrame:
    above = rated.filter(F.col("p") > F.col("q")).select(
        "g", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value")
    )
    first = _ranked(above, "g").filter(F.col("rank") <= most)
    return _part(first.join(groups.select("lang", "source", "g"), "g"), "term")


def _pair_part(groups: DataFrame, rated: DataFrame) -> DataFrame:
    """For sources s and t: over the terms both have f(ps, pt) - f(ps, t0) - f(s0, pt) + f(s0, t0),
    plus the sums of f(ps, t0) and f(s0, pt) over each one's terms, plus f(s0, t0) for the terms that
    are in neither's; s0 and t0 are the shares of an absent term."""
    block = F.pmod(F.xxhash64("g"), F.col("blocks")).cast("int")
    x = rated.select(F.col("t").alias("number"), block.alias("block"), F.col("g").alias("s"),
                     F.col("p").alias("ps"), F.col("p0").alias("s0"))
    y = rated.select(F.col("t").alias("number"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                     F.col("g").alias("t"), F.col("p").alias("pt"), F.col("p0").alias("t0"))
    ps, s0, pt, t0 = (F.col(c) for c in ("ps", "s0", "pt", "t0"))
    met = (
        x.join(y, ["number", "block"])
        .filter("s < t")
        .groupBy("s", "t")
        .agg(
            F.sum(_apart(ps, pt) - _apart(ps, t0) - _apart(s0, pt)).alias("st"),
            F.sum(_apart(pt, ps) - _apart(pt, s0) - _apart(t0, ps)).alias("ts"),
            F.count("*").alias("both"),
        )
    )
    met = stage(met, "audit-met")
    both = met.select("s", "t", F.col("st").alias("shared"), "both").union(
        met.select(F.col("t").alias("s"), F.col("s").alias("t"), "ts", "both")
    )
    # How often each share occurs in a group: a few hundred values, whatever the number of terms.
    histogram = stage(rated.groupBy("g", "p", "p0").count(), "audit-histogram")
    other = groups.select("lang", F.col("g").alias("o"), F.col("p0").alias("o0"))
    alone = (
        histogram.join(groups.select("lang", "g"), "g")
        .join(other, "lang")
        .filter("g <> o")
        .groupBy("g", "o")
        .agg(
            F.sum(F.col("count") * _apart(F.col("p"), F.col("o0"))).alias("over"),
            F.sum(F.col("count") * _apart(F.col("o0"), F.col("p"))).alias("under"),
        )
    )
    alone = stage(alone, "audit-alone")
    first = groups.select("lang", "source", F.col("g").alias("s"), F.col("p0").alias("s0"),
                          F.col("own").alias("own_s"), "kept")
    second = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("t"),
                           F.col("p0").alias("t0"), F.col("own").alias("own_t"))
    zero = F.lit(0).cast("long")
    absent = F.col("kept") - F.col("own_s") - F.col("own_t") + F.coalesce("both", zero)
    value = (
        F.coalesce("shared", zero)
        + F.coalesce("over", zero)
        + F.coalesce("under", zero)
        + absent * _apart(s0, t0)
    )
    pairs = (
        first.join(second, "lang")
        .filter("s <> t")
        .join(both, ["s", "t"], "left")
        .join(alone.select(F.col("g").alias("s"), F.col("o").alias("t"), "over"), ["s", "t"], "left")
        .join(alone.select(F.col("g").alias("t"), F.col("o").alias("s"), "under"), ["s", "t"], "left")
        .select("lang", "source", "s", "item", F.when(F.col("kept") > 0, value).otherwise(zero).alias("value"))
    )
    return _part(_ranked(pairs, "s"), "pair")


def op12_source_divergence_audit(spark, sf_dir):
    return audit(common.table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs),
kept AS (
  SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1))
             // (sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) + s.v) AS p
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
lang_counts AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL),
lang_shares AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS q
  FROM lang_counts JOIN sizes USING (lang)),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value
  FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
