"""Quality rules, source divergence and importance resampling against plain Python and SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard

from alarmloom.llm import catalog, common, divergence, importance, qualityrules
from compare import connect, differences
from test_corpus_queries import SF_DIR, docs, words  # noqa: F401

QUERIES = catalog.queries()


# --- Quality rules ------------------------------------------------------------------------------


def plain_report(text):
    text = text or ""
    own = words(text)
    places = defaultdict(list)
    for i in range(len(own) - 4):
        places[tuple(own[i : i + 5])].append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    lines, met = 0, set()
    for line in text.split("\n"):
        lines += bool(words(line)) and line in met
        met.add(line)
    failed = len(own) < 10 or 100 * len(covered) > 20 * len(own)
    data, stays = text.encode(), False
    if data:
        press = zstandard.ZstdCompressor(level=3, write_content_size=False).compress

        def inside(part):
            low, high = next((a, b) for below, a, b in qualityrules.BANDS if len(part) < below)
            return low <= len(press(part)) / len(part) <= high

        parts = [data[i : i + 4096] for i in range(0, len(data), 4096)] if len(data) > 4096 else []
        bad = sum(len(p) for p in parts if not inside(p))
        stays = inside(data) and bad <= 0.2 * len(data)
    return (
        len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered),
        failed, stays and not failed,
    )


def check_quality(rows, texts):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    expected = Counter((i, *plain_report(t)) for i, t in texts)
    assert Counter((r.doc_id, *[r[n] for n in names]) for r in rows) == expected


def test_quality_rules_equal_plain_python(spark, docs):  # noqa: F811
    rows = QUERIES["op11_quality_compression_bands"](spark, SF_DIR).collect()
    check_quality(rows, [(d.doc_id, d.text) for d in docs])
    sound = [r for r in rows if not r.base_failed]
    assert sum(r.kept for r in sound) >= 0.99 * len(sound)


def test_compression_bands_reject_both_ends(spark):
    rng = np.random.default_rng(5)
    chars = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"))
    noise = " ".join("".join(rng.choice(chars, 40)) for _ in range(400))
    prose = " ".join("".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(2000))
    # Every word differs, so no rule on words sees the repetition.
    dull = " ".join(f"item{i:06d}" for i in range(3000))
    half = prose + " " + " ".join(f"item{i:06d}" for i in range(2000))
    rows = [(1, noise), (2, prose), (3, dull), (4, half), (5, None), (6, ""), (7, "a b c d e f g h i j")]
    rows += [(8, prose * 40), (2, prose), (9, "x " * 40)]
    table = spark.createDataFrame(
        [(i, t, "mine", i) for i, t in rows], "doc_id long, text string, quality string, kept long"
    )
    found = qualityrules.with_report(table)
    assert found.columns == ["doc_id", "text", "quality", "kept", "quality_1"]
    own = found.select("doc_id", "quality_1.*").collect()
    check_quality(own, rows)
    assert {r.doc_id for r in own if r.kept} == {2, 7}
    assert {r.doc_id: r.outside for r in own}[4] > 0.2
    stay = qualityrules.passing(table)
    assert stay.columns == table.columns
    assert sorted(r.doc_id for r in stay.collect()) == [2, 2, 7]
    assert qualityrules.with_report(table.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["a b c d e", "a " * 6, "a b c d e a b c d e", "a a a b a a a b a a", ""])
def test_repeated_words(text):
    assert qualityrules.repeated_words(text.encode().split()) == plain_report(text)[4]


# --- Source divergence --------------------------------------------------------------------------


def plain_audit(rows, least=3, most=200):
    terms = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs_of, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        own = terms.findall((text or "").translate(lower))
        docs_of[lang].update(set(own))
        counts[lang, source].update(own)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = {t for t, n in docs_of[lang].items() if n >= least}

        def shares(own):
            total = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [
                (o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s
            ]
            own = [
                (t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]
            ]
            for part, found, top in (("pair", pairs, None), ("term", own, most)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (i, v) in enumerate(found[:top])]
    return Counter(out)


def test_audit_equals_plain_python(spark, docs):  # noqa: F811
    found = QUERIES["op12_source_divergence_audit"](spark, SF_DIR).collect()
    assert Counter(map(tuple, found)) == plain_audit([(d.text, d.lang, d.source) for d in docs])


def test_audit_of_odd_rows(spark, monkeypatch):
    long = "x" * 200
    rows = [
        (None, None, None), ("", "", ""), ("Word wOrd é É Éa", "en", "a"), ("word é", "en", "b"),
        ("word " + long, "en", "b"), (long, "en", None), (long + "y " + long, "en", "c"),
        ("only two", "de", "a"), ("only two", "de", "b"), ("123 _-", "fr", "z"), ("wordé\x00word", "en", "d"),
    ] + [("same same again wor words", "en", "hot")] * 5
    table = spark.createDataFrame(
        [(i, *r, 0) for i, r in enumerate(rows)],
        "term long, text string, lang string, source string, n int",
    )
    expected = plain_audit(rows)
    assert Counter(map(tuple, divergence.audit(table).collect())) == expected
    # Blocks of a term's groups, and tasks that settle often, change nothing.
    monkeypatch.setattr(divergence, "BLOCK", 2)
    monkeypatch.setattr(divergence, "HELD", 2)
    assert Counter(map(tuple, divergence.audit(table.repartition(5)).collect())) == expected
    assert divergence.audit(table.limit(0)).collect() == []


def test_prefixes_below_the_threshold_are_not_extended(spark):
    common.ship(spark)
    rows = [("en", "s", f"abcdef{'x' * i} rare{i} same".encode()) for i in range(4)]
    texts = spark.createDataFrame(rows, "lang string, source string, text binary")
    first = {bytes(r.prefix): r.docs for r in divergence.prefix_documents(texts, 4, 0, None).collect()}
    assert first == {b"abcd": 4, b"rare": 4, b"same": 4}
    alive = texts.sparkSession.createDataFrame([("en", b"abcd")], "lang string, prefix binary")
    kept = divergence.prefix_documents(texts, 6, 4, divergence.prefix_filter(alive, 1)).collect()
    assert {bytes(r.prefix): r.docs for r in kept} == {b"abcdef": 4}


# --- Importance resampling ----------------------------------------------------------------------


def plain_resampling(rows, target):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def features(text):
        own = split.findall((text or "").translate(lower))
        return len(own), [zlib.crc32(f.encode()) % 10000 for f in own + [" ".join(p) for p in zip(own, own[1:])]]

    s, t = Counter(), Counter()
    met = [(i, *features(text)) for i, text in rows]
    for _, _, own in met:
        s.update(own)
    for text in target:
        t.update(features(text)[1])
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000))))
        for b in s
    }
    out = []
    for i, n, own in met:
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = able[: 25 * len(able) // 100]
    result = Counter((r[0], *r[2:], k + 1) for k, r in enumerate(drawn))
    for r in drawn:
        out.remove(r)
    return result + Counter((r[0], *r[2:], None) for r in out)


def test_resampling_equals_plain_python(spark, docs):  # noqa: F811
    found = QUERIES["op13_importance_resampling"](spark, SF_DIR).collect()
    target = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert Counter(map(tuple, found)) == plain_resampling([(d.doc_id, d.text) for d in docs], target)


def test_resampling_of_odd_rows(spark):
    base = " ".join(f"Word{i % 7} é{i}" for i in range(30))
    rows = [(i, base + f" own{i}") for i in range(40)] + [(None, base), (None, base), (3, base), (3, base)]
    rows += [(50, None), (51, ""), (52, "a b"), (53, "--"), (54, "w " * 20000), (55, "W\x00w é_É")]
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, importance int, s int")
    for target in ([], [base, None, "w w w"]):
        wanted = spark.createDataFrame([(t,) for t in target], "text string")
        model = importance.fit(table, wanted, words=3, pairs=2)
        scored = importance.scored(table, model)
        assert scored.columns == [*table.columns, "importance_1"]
        found = importance.resampled(scored, "importance_1")
        assert found.columns == scored.columns
        own = found.select("doc_id", "importance_1.n_features", "importance_1.weight", "importance_1.score",
                           "importance_1.rank")
        assert Counter(map(tuple, own.collect())) == plain_resampling(rows, target)
    none = table.limit(0)
    assert importance.resampled(importance.scored(none, importance.fit(none, wanted)), "importance_1").collect() == []


def test_head_and_tail_give_the_same_buckets():
    own = "the cat sat on the mat the cat".encode().split()
    plain = [zlib.crc32(w) % 10000 for w in own]
    plain += [zlib.crc32(a + b" " + b) % 10000 for a, b in zip(own, own[1:])]
    for words_, pairs in (([], []), ([b"the", b"cat"], [(b"the", b"cat"), (b"on", b"the")])):
        assert importance.Head(words_, pairs).opened().buckets_of(own).tolist() == plain


@pytest.mark.parametrize("name", ["op12_source_divergence_audit", "op13_importance_resampling"])
def test_sql_of_odd_tables(spark, name, tmp_path):
    rows = [(1, "the Cat é sat", "en", "a"), (2, "the cat", None, None), (3, "the cat é", "en", "b"),
            (4, None, "en", "a"), (None, "the dog", "en", "c")] + [(5, "cat dog " * 12, "en", "c")] * 9
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "the cat"), (2, None)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    con = connect(SF_DIR)
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    assert differences(spark, con, QUERIES[name], catalog.oracle_sql()[name], str(tmp_path)) == []
