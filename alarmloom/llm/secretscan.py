"""Secret scan with a trigram inverted index, in DataFrame functions only.

Each rule's regular expression yields a Boolean query over trigrams of the lower-cased text: an OR
of ANDs of trigrams that any match must hold. The index lists, for every trigram that some query
asks for, the rows that contain it; intersecting the lists gives the candidates of a rule, and only
those are searched for it. A rule without mandatory trigrams is searched for in every text. A false
candidate costs a search and changes nothing.

Defined results: null counts as empty and has no spans; repeated rows are scanned alike; an empty
table gives an empty table; extra columns are ignored. Spans are in code points, end exclusive.
"""

from re import _constants as sre
from re import _parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from alarmloom.llm import common
from alarmloom.session import stage

MOST_STRINGS = 64
MOST_BRANCHES = 64


class Rule(NamedTuple):
    """`pattern` as Java reads it; matches whose `group` is shorter than `least` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The patterns of the three kinds. For `access` and `hex` the least length stands in
# the pattern, since a run that is too short holds no longer one.
RULES = [
    Rule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]


def _strings(op, value) -> set[str] | None:
    """All lower-case strings the node can match, if they are few."""
    if op is sre.LITERAL:
        return {chr(value).lower()}
    if op is sre.IN:
        if len(value) <= 4 and all(kind is sre.LITERAL for kind, _ in value):
            return {chr(code).lower() for _, code in value}
    elif op is sre.SUBPATTERN:
        return _sequence_strings(value[-1])
    elif op is sre.BRANCH:
        options = [_sequence_strings(option) for option in value[1]]
        if all(o is not None for o in options):
            return set().union(*options)
    elif op is sre.MAX_REPEAT and value[1] == 1:
        inner = _sequence_strings(value[2])
        if inner is not None:
            return inner | {""} if value[0] == 0 else inner
    return None


def _sequence_strings(nodes) -> set[str] | None:
    found = {""}
    for op, value in nodes:
        own = _strings(op, value)
        if own is None or len(found) * len(own) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in own}
    return found


def _of_strings(strings: set[str]) -> list[frozenset[str]] | None:
    """OR over the strings of the AND of their trigrams; None if one of them is too short."""
    if any(len(s) < 3 for s in strings):
        return None
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)


def _both(x, y):
    if x is None or y is None:
        return x if y is None else y
    if len(x) * len(y) > MOST_BRANCHES:
        return min(x, y, key=len)
    return sorted({a | b for a in x for b in y}, key=sorted)


def _sequence_query(nodes):
    query, run = None, {""}
    for op, value in nodes:
        own = _strings(op, value)
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        query, run = _both(query, _of_strings(run)), own or {""}
        if own is None:
            if op is sre.SUBPATTERN:
                query = _both(query, _sequence_query(value[-1]))
            elif op is sre.MAX_REPEAT and value[0] >= 1:
                query = _both(query, _sequence_query(value[2]))
            elif op is sre.BRANCH:
                options = [_sequence_query(o) for o in value[1]]
                if all(o is not None for o in options):
                    query = _both(query, sorted(set().union(*options), key=sorted))
    return _both(query, _of_strings(run))


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The pattern's trigram query, or None if no trigram is mandatory."""
    return _sequence_query(parser.parse(pattern))


def postings(docs: DataFrame, grams: list[str], id_col: str, text_col: str) -> DataFrame:
    """The inverted index over the given trigrams: (gram, row_key) for each row that has it."""
    rows = docs.select(
        common.row_key(id_col, text_col).alias("row_key"),
        F.lower(common.text_or_empty(text_col)).alias("lowered"),
    )
    held = F.filter(
        F.array(*map(F.lit, grams)), lambda gram: F.contains(F.col("lowered"), gram)
    )
    return rows.select(F.explode(held).alias("gram"), "row_key")


def candidates(docs: DataFrame, rules: list[Rule], id_col: str, text_col: str) -> DataFrame:
    """(row_key, kinds): the rows whose posting lists meet each rule's query."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    queries = {k: q for k, q in queries.items() if q is not None}
    grams = sorted({g for q in queries.values() for branch in q for g in branch})
    index = stage(postings(docs, grams, id_col, text_col), "postings")
    met = index.groupBy("row_key").agg(F.collect_set("gram").alias("grams"))
    kinds = []
    for kind, query in queries.items():
        fits = F.lit(False)
        for branch in query:
            wanted = F.array(*map(F.lit, sorted(branch)))
            fits = fits | (F.size(F.array_intersect(wanted, "grams")) == len(branch))
        kinds.append(F.when(fits, F.lit(kind)))
    found = met.select("row_key", F.array_compact(F.array(*kinds)).alias("kinds"))
    return found.filter(F.size("kinds") > 0)


def spans_of(rule: Rule, place: int, text: Column) -> Column:
    """Array of (start, place, end) of the rule's leftmost non-overlapping matches.

    The pieces between matches come from the same regular expression, so their lengths and the
    matches' own give the positions.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.call_function("split", text, pattern, F.lit(-1))
    pairs = F.zip_with(
        matches,
        gaps,
        lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("size")),
    )
    if rule.group:
        groups = F.regexp_extract_all(text, pattern, F.lit(rule.group))
        pairs = F.zip_with(
            pairs,
            groups,
            lambda p, g: F.struct(
                p["gap"].alias("gap"), p["size"].alias("size"), F.length(g).alias("own")
            ),
        )
    pairs = F.filter(pairs, lambda p: p["size"].isNotNull())
    size = "own" if rule.group else "size"
    # Where each match ends is a running sum. It is taken in blocks of about the root of their number:
    # the ends of the blocks first, then each match from the start of its block.
    count = F.size(pairs)
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(count.cast("double"))).cast("int"))

    def covered(found: Column) -> Column:
        return F.aggregate(found, F.lit(0), lambda total, p: total + p["gap"] + p["size"])

    def spans(state: Column) -> Column:
        found, block, starts = state["pairs"], state["block"], state["starts"]

        def span(p, i):
            of = F.floor(i / block).cast("int")
            before = F.get(starts, of) + covered(F.slice(found, of * block + 1, i - of * block))
            start = before + p["gap"]
            return F.struct(
                start.alias("start"),
                F.lit(place).alias("place"),
                (start + p["size"]).alias("end"),
                p[size].alias("own"),
            )

        return F.filter(F.transform(found, span), lambda s: s["own"] >= rule.least)

    def with_starts(state: Column) -> Column:
        found, block = state["pairs"], state["block"]
        ends = F.aggregate(
            F.sequence(F.lit(0), F.ceil(F.size(found) / block).cast("int")),
            F.array(F.lit(0)),
            lambda starts, n: F.array_append(
                starts, F.get(starts, n) + covered(F.slice(found, n * block + 1, block))
            ),
        )
        return F.struct(found.alias("pairs"), block.alias("block"), ends.alias("starts"))

    # One-element lists bind a value once instead of repeating its expression.
    bound = F.transform(F.array(F.struct(pairs.alias("pairs"), block.alias("block"))), with_starts)
    return F.get(F.transform(bound, spans), F.lit(0))


def scan(
    docs: DataFrame,
    rules: list[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id and `found`, its spans (start, place of the kind, end, own)."""
    found = stage(candidates(docs, rules, id_col, text_col), "secret-candidates")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        common.text_or_empty(text_col).alias("text"),
        common.row_key(id_col, text_col).alias("row_key"),
    ).join(found, "row_key", "left")
    parts = []
    for place, rule in enumerate(rules):
        spans = spans_of(rule, place, F.col("text"))
        if trigram_query(rule.pattern) is not None:
            spans = F.when(F.array_contains("kinds", rule.kind), spans)
        parts.append(spans)
    nothing = F.array().cast("array<struct<start:int,place:int,end:int,own:int>>")
    merged = F.sort_array(F.concat(*[F.coalesce(p, nothing) for p in parts]))
    return rows.select("doc_id", merged.alias("found"))


def op2_secret_scan(spark, sf_dir):
    found = scan(common.table(spark, sf_dir, "documents"))
    kinds = F.array(*[F.lit(r.kind) for r in RULES])

    def count(place):
        held = F.filter("found", lambda s: s["place"] == place)
        return F.size(held).cast("long")

    joined = F.array_join(
        F.transform(
            "found",
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["place"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )
    listed = found.select(
        "doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(RULES)], joined.alias("spans")
    )
    return listed.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )
