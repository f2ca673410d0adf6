"""Jaccard join on word shingles: rare-first prefixes with length, positional and suffix filters.

1. All shingles of all documents are counted in 2^22 slots. The order "slot count, then hash" is
   the same for every document and puts rare shingles first; any such order gives whole results.
2. Two sets with similarity t share a shingle among the first n - ceil(t n) + 1 of each. Documents
   with equal sets form one class, and only shingles met in two classes' prefixes are kept.
3. In each shingle's list the entry that stands earliest in its set is the pivot. Round one compares
   every entry with its pivot; linked entries get one component. Round two compares what is left:
   entries outside the pivot's component with all entries of other components, in lists of three
   entries or more (in a list of two the pivot has met the other). Pairs within a
   component need no look, so a group of near copies costs one pair each and loses no link between
   components. Conditions stand in the join, so only pairs that pass the filters leave it.
4. Each surviving pair is verified once on the whole sets.

`near_classes` is this form: it names the components, but does not list the links inside them.
`near_links` compares all entries of each list with each other and gives every link.

Defined results: null and empty texts have no shingles and link with nothing; a text with fewer
words than a shingle is one shingle; rows with equal sets always share a component; a null id never
names a component unless all its rows have null ids; repeated rows count as equal texts; an empty
table gives an empty table; extra columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from alarmloom.llm import common
from alarmloom.session import scratch, stage

SLOTS = 1 << 22
PARTS = 64
MOST_IN_PART = 127
SALTS = 8
SETS = "doc_id long, number long, n long, node binary, prefix array<long>, parts array<tinyint>"


def shingle_hashes(text: bytes | None, words: int, memo: common.Memo) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([common.hash64(b" ".join(found))], np.uint64)
    each = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
    count = len(each) - words + 1
    hashes = common.mixed(each[:count])
    for shift in range(1, words):
        hashes = common.mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + each[shift : shift + count])
    return np.unique(hashes)


def least_overlap(sizes: Column, percent: int) -> Column:
    """The smallest overlap two sets of `sizes` elements in all need for the similarity."""
    return F.ceil(sizes * percent / (100 + percent) - 1e-9)


class Shingles:
    """The join's two parameters, and the passes over the texts that depend on them."""

    def __init__(self, words: int = 5, percent: int = 80):
        self.words, self.percent = words, percent

    def slot_counts(self, texts: DataFrame) -> np.ndarray:
        words = self.words

        def slots_of(batch):
            memo = common.Memo(common.hash64)
            for text in batch.column(0).to_pylist():
                hashes = shingle_hashes(text, words, memo)
                if len(hashes):
                    yield hashes >> np.uint64(42)

        return common.slot_table(common.slot_counts(texts, slots_of, SLOTS), SLOTS)

    def sets(self, docs: DataFrame) -> DataFrame:
        """Per row of (doc_id, number, text): its set's size, its class (`node`), its prefix, and the
        set's parts.

        `parts` counts the set's shingles by the top six bits of their hash, up to 127 a part;
        counts cut off there differ by no more than the true ones, so bounds on them still hold.
        """
        words, percent = self.words, self.percent
        counts = self.slot_counts(docs.select("text"))
        shared = docs.sparkSession.sparkContext.broadcast(counts)

        def describe(batches):
            memo, counts = common.Memo(common.hash64), shared.value
            for batch in batches:
                out = {"n": [], "node": [], "prefix": [], "parts": []}
                for text in batch.column("text").to_pylist():
                    hashes = shingle_hashes(text, words, memo)
                    n = len(hashes)
                    order = np.lexsort((hashes, counts[hashes >> np.uint64(42)]))
                    length = n - (percent * n + 99) // 100 + 1 if n else 0
                    out["n"].append(n)
                    out["node"].append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                    out["prefix"].append(hashes[order[:length]].view(np.int64))
                    part = np.bincount((hashes >> np.uint64(58)).astype(np.int64), minlength=PARTS)
                    out["parts"].append(np.minimum(part, MOST_IN_PART))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("number"),
                        pa.array(out["n"], pa.int64()),
                        pa.array(out["node"], pa.binary()),
                        pa.array(out["prefix"], pa.list_(pa.int64())),
                        pa.array([p.astype(np.int8) for p in out["parts"]], pa.list_(pa.int8())),
                    ],
                    ["doc_id", "number", "n", "node", "prefix", "parts"],
                )
            memo.clear()
            common.release()

        return docs.mapInArrow(describe, SETS)

    def whole_sets(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the wanted rows, found by a Bloom filter on their numbers.

        A false alarm of the filter is one more set, which no pair asks for.
        """
        words = self.words
        width = common.bloom_width(wanted.count())

        def slots(keys):
            keys = common.mixed(np.asarray(keys).view(np.uint64) + np.uint64(1))
            return common.bloom_slots(keys, common.mixed(keys), width)

        def slots_of(batch):
            yield slots(batch.column(0).to_numpy(zero_copy_only=False)).ravel()

        bits = common.bloom_bits(wanted, slots_of, width, least=1)
        shared = docs.sparkSession.sparkContext.broadcast(bits)

        def make(batches):
            memo = common.Memo(common.hash64)
            for batch in batches:
                keys = batch.column("number").to_numpy(zero_copy_only=False)
                asked = np.flatnonzero(common.passes(shared.value, slots(keys)))
                texts = batch.column("text").take(pa.array(asked)).to_pylist()
                found = [shingle_hashes(t, words, memo) for t in texts]
                nodes = [hashlib.blake2b(h.tobytes(), digest_size=16).digest() for h in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes, pa.binary()),
                        pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64())),
                    ],
                    ["node", "shingles"],
                )
            memo.clear()
            common.release()

        # Filter and sets in one pass: a task has one Python worker, not two.
        made = docs.select("number", "text").mapInArrow(make, "node binary, shingles array<long>")
        return stage(made, "near-sets").dropDuplicates(["node"])

    def may_link(self, x: str, y: str) -> Column:
        """Length and positional filter on two entries of one shingle's list.

        Before the shingle the two can share only shingles that are in other lists too.
        """
        n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
        length = F.least(n, m) * 100 >= F.greatest(n, m) * self.percent
        behind = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
        before = F.least(f"{x}.rank", f"{y}.rank")
        return length & (behind + before >= least_overlap(n + m, self.percent))

    def may_overlap(self, n: Column, m: Column, x: Column, y: Column) -> Column:
        """Suffix filter: the sets differ at least by the sum of their parts' differences."""
        apart = F.aggregate(
            F.zip_with(x, y, lambda a, b: F.abs(a.cast("int") - b.cast("int"))),
            F.lit(0),
            lambda total, part: total + part,
        )
        return apart <= n + m - least_overlap(n + m, self.percent) * 2

    def links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole sets are similar enough."""
        first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
        second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
        joined = pairs.join(first, "a").join(second, "b")
        overlap = F.size(F.array_intersect("of_a", "of_b"))
        enough = overlap >= least_overlap(F.size("of_a") + F.size("of_b"), self.percent)
        return joined.filter(enough).select("a", "b")


def _entries(reps: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The lists of shared prefix shingles: one entry per shingle and class that has it.

    `pos`: place in the set's order; `rank`: place among its shingles that are in some list;
    `many`: the list has three entries or more, so its pivot does not meet all its pairs.
    """
    spread = prefixes.select("number", F.posexplode("prefix").alias("pos", "token"))
    shared = stage(
        spread.groupBy("token")
        .count()
        .filter("count > 1")
        .select("token", (F.col("count") > 2).alias("many")),
        "near-shared",
    )
    held = (
        spread.join(shared, "token")
        .groupBy("number")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "token", "many"))).alias("held"))
    )
    return (
        held.join(reps.select("number", "node", "n"), "number")
        .select("node", "n", F.posexplode("held").alias("rank", "one"))
        .select(
            "one.token",
            "one.many",
            F.struct(F.col("one.pos").alias("pos"), "n", "rank", "node").alias("entry"),
        )
    )


def _texts(docs: DataFrame, id_col: str, text_col: str, number: str | None) -> DataFrame:
    """(doc_id, number, text) of the rows, numbered here if they are not yet."""
    if number is None:
        docs, number = common.numbered(docs, "near-texts")
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(number).alias("number"),
        F.col(f"`{text_col}`").cast("binary").alias("text"),
    )


def _prepared(join: Shingles, docs: DataFrame):
    """The staged rows, the representatives of their classes, the classes' parts, and the lists."""
    rows = stage(join.sets(docs), "near-rows")
    reps = stage(
        rows.filter("n > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("number").alias("number")),
        "near-reps",
    )
    chosen = rows.select("number", "prefix", "parts").join(reps, "number")
    chosen = stage(chosen.select("number", "node", "n", "prefix", "parts"), "near-chosen")
    parts = chosen.select("node", "n", "parts")
    entries = stage(_entries(reps, chosen), "near-entries")
    return rows, reps, parts, entries


def _verified(join, docs, reps, pairs) -> DataFrame:
    """The links among the pairs."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stage(reps.join(nodes, "node").select("number"), "near-wanted")
    return stage(join.links(pairs, join.whole_sets(docs, wanted)), "near-links")


def _ordered(x, y):
    return F.least(f"{x}.node", f"{y}.node").alias("a"), F.greatest(
        f"{x}.node", f"{y}.node"
    ).alias("b")


def _overlapping(join: Shingles, parts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that pass the suffix filter."""
    first = parts.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("parts").alias("of_a"))
    second = parts.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("parts").alias("of_b"))
    fits = join.may_overlap(F.col("n_a"), F.col("n_b"), F.col("of_a"), F.col("of_b"))
    return pairs.join(first, "a").join(second, "b").filter(fits).select("a", "b")


def _named(rows: DataFrame, reps: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with the smallest id of their component."""
    of_class = stage(
        reps.select("node", "rep")
        .join(labels, "node", "left")
        .select("node", "rep", F.coalesce("label", "node").alias("label")),
        "near-of-class",
    )
    smallest = stage(of_class.groupBy("label").agg(F.min("rep").alias("component_id")), "near-ids")
    named = stage(of_class.join(smallest, "label").select("node", "label", "component_id"), "near-named")
    empty = rows.filter("n = 0").select(
        "doc_id", "number", "n", "node", F.lit(None).cast("binary").alias("label"),
        F.col("doc_id").alias("component_id"),
    )
    full = rows.filter("n > 0").select("doc_id", "number", "n", "node").join(named, "node")
    return full.select(empty.columns).union(empty)


def near_classes(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    number: str | None = None,
) -> DataFrame:
    """One row per document: `doc_id`, `number`, `n`, `node`, `label` (of its component; null without
    shingles) and `component_id`.

    The shortcut to components: most pairs within one are not verified. `near_links` has all links.
    `number`: a column that numbers the rows, as `common.numbered` gives it; else they are numbered here.
    """
    join, docs = Shingles(words, percent), _texts(docs, id_col, text_col, number)
    rows, reps, parts, entries = _prepared(join, docs)
    pivots = stage(entries.groupBy("token").agg(F.min("entry").alias("pivot")), "near-pivots")

    differ = F.col("entry.node") != F.col("pivot.node")
    met = (
        entries.join(pivots, "token")
        .filter(differ & join.may_link("entry", "pivot"))
        .select(*_ordered("entry", "pivot"))
        .distinct()
    )
    pairs = stage(_overlapping(join, parts, stage(met, "near-met")), "near-pairs")
    links = _verified(join, docs, reps, pairs)
    labels = common.components(links, "near-first")

    own = labels.withColumnRenamed("label", "component")
    labelled = stage(
        entries.filter("many")
        .withColumn("node", F.col("entry.node"))
        .join(own, "node", "left")
        .select("token", "entry", F.coalesce("component", "node").alias("component")),
        "near-labelled",
    )
    open_tokens = (
        labelled.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("token")
    )
    centre = stage(
        pivots.join(open_tokens, "token")
        .select("token", F.col("pivot.node").alias("node"))
        .join(own, "node", "left")
        .select("token", F.coalesce("component", "node").alias("centre")),
        "near-open",
    )
    open_ = stage(
        labelled.join(centre, "token")
        .withColumn("node", F.col("entry.node"))
        .join(parts.select("node", "parts"), "node"),
        "near-open-entries",
    )
    outside = open_.filter(F.col("component") != F.col("centre")).select(
        "token", F.col("entry").alias("x"), F.col("component").alias("of_x"), F.col("parts").alias("px")
    )
    inside = open_.select(
        "token", F.col("entry").alias("y"), F.col("component").alias("of_y"), "centre",
        F.col("parts").alias("py"),
    )
    once = (F.col("of_y") == F.col("centre")) | (F.col("x.node") < F.col("y.node"))
    fits = join.may_overlap(F.col("x.n"), F.col("y.n"), F.col("px"), F.col("py"))
    more = stage(
        outside.join(inside, "token")
        .filter((F.col("of_x") != F.col("of_y")) & once & join.may_link("x", "y") & fits)
        .select(*_ordered("x", "y"))
        .distinct()
        .join(pairs, ["a", "b"], "left_anti"),
        "near-more",
    )
    if not more.isEmpty():
        found = _verified(join, docs, reps, more)
        if not found.isEmpty():
            labels = common.components(links.union(found), "near-last")

    return _named(rows, reps, labels)


def near_links(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
) -> tuple[DataFrame, DataFrame]:
    """All links: `(members, links)`.

    `links` has one row (a, b), a < b, per pair of classes whose sets are similar enough; `members`
    the rows of `near_classes` and `links`, the number of other classes that the row's class links
    with. Every pair of classes that meets in a list and passes the filters is verified once on
    the whole sets. The pairs, like the links, grow with the square of a group of near copies.

    Each entry lies in one of `salts` blocks of its list and meets the entries of one pair of blocks
    per task, so a long list is spread over about salts^2 / 2 keys.
    """
    join, docs = Shingles(words, percent), _texts(docs, id_col, text_col, None)
    rows, reps, parts, entries = _prepared(join, docs)
    # A list of two has one block; a longer one is dealt by node.
    block = F.when(F.col("many"), F.pmod(F.xxhash64("entry.node"), F.lit(salts))).otherwise(0)
    dealt = entries.withColumn("block", block.cast("int"))
    dealt = dealt.withColumn("blocks", F.when(F.col("many"), F.lit(salts)).otherwise(1))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).select(
        "token",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "entry",
    )
    first = dealt.select("token", "low", "high", F.col("block").alias("bx"), F.col("entry").alias("x"))
    second = dealt.select("token", "low", "high", F.col("block").alias("by"), F.col("entry").alias("y"))
    # In a pair of two blocks the entries of one meet those of the other; in a pair of a block with
    # itself each pair is met once.
    once = ((F.col("bx") == F.col("low")) & (F.col("by") == F.col("high"))) & (
        (F.col("low") < F.col("high")) | (F.col("x.node") < F.col("y.node"))
    )
    met = (
        first.join(second, ["token", "low", "high"])
        .filter(once & join.may_link("x", "y"))
        .select(*_ordered("x", "y"))
        .distinct()
    )
    pairs = stage(_overlapping(join, parts, stage(met, "near-met")), "near-pairs")
    links = _verified(join, docs, reps, pairs)
    labels = common.components(links, "near-all")
    ends = links.select(F.explode(F.array("a", "b")).alias("node"))
    degrees = stage(ends.groupBy("node").agg(F.count("*").alias("links")), "near-degrees")
    members = _named(rows, reps, labels).join(degrees, "node", "left")
    return members.withColumn("links", F.coalesce("links", F.lit(0).cast("long"))), links


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all columns: that with the smallest id, of several rows with
    that id the first. Documents without shingles link with nothing and stay."""
    rows, number = common.numbered(docs, "near-docs")
    # All tables on the way go once it is known which rows stay.
    with scratch(docs.sparkSession) as kept:
        found = near_classes(rows, words, percent, number=number)
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "number")
        firsts = found.filter("n > 0").groupBy("label").agg(F.min_by("number", order).alias(number))
        empty = found.filter("n = 0").select(F.col("number").alias(number))
        keep = kept(firsts.select(number).union(empty), "near-keep")
    return rows.join(keep.hint("merge"), number, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_ngram_jaccard_join(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    return near_classes(docs, words=4, percent=85).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )
