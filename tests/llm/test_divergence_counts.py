"""Counts of the divergence audit meet by the number of their group, not by its names."""

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from alarmloom.llm import divergence


def test_terms_are_counted_by_group_number(spark):
    rows = [("en", s, b"alpha alpha longerthaneight") for s in ("a", "b", "c")] + [("en", "", b"alpha rare")]
    texts = spark.createDataFrame(rows, "lang string, source string, text binary")
    kept = divergence.kept_terms(texts)
    counts = divergence.term_counts(texts, kept)
    assert "keys=[g#" in counts._jdf.queryExecution().executedPlan().toString()
    found = {(r.source, r.term): r.n for r in counts.collect()}
    assert found == {(s, "alpha"): 2 for s in "abc"} | {(s, "longerthaneight"): 1 for s in "abc"} | {("", "alpha"): 1}


def test_ends_of_terms_at_the_edges_of_a_level(spark):
    words = [b"a" * 7, b"a" * 8, b"a" * 9, b"a" * 23, b"a" * 24, b"a" * 25, b"a" * 72, b"a" * 73]
    texts = spark.createDataFrame([("en", "s", b" ".join(words))] * 3, "lang string, source string, text binary")
    kept = {(bytes(r.prefix), r.docs) for r in divergence.kept_terms(texts).collect()}
    assert kept == {(w + b"\0", 3) for w in words}


def test_texts_of_a_group_are_counted_together(spark):
    sources = [f"s{i}" for i in range(4)]
    rows = [("en", s, f"alpha beta {s}only alpha".encode()) for s in sources] * 8
    texts = spark.createDataFrame(rows, "lang string, source string, text binary").repartition(8)
    kept = divergence.kept_terms(texts)
    counts = divergence.term_counts(texts, kept)
    assert "REBALANCE" in counts._jdf.queryExecution().executedPlan().toString()
    found = {(r.source, r.term): r.n for r in counts.collect()}
    # Digits part terms: "s0only" has "s" and "only".
    each = {"alpha": 16, "beta": 8, "s": 8, "only": 8}
    assert found == {(s, t): n for s in sources for t, n in each.items()}


def test_counts_are_dealt_out_once_by_term(spark):
    rows = [("en", s, b"alpha beta longerthaneight") for s in ("a", "b", "c")]
    texts = spark.createDataFrame(rows, "lang string, source string, text binary")
    counts = divergence.term_counts(texts, divergence.kept_terms(texts))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([a-z]+)#\w+, ([a-z]+)#", plan)
    assert ("term", "lang") in dealt and not {("g", "term"), ("lang", "term")} & set(dealt)


def test_shares_are_exact_beside_large_counts(spark):
    counts = [0, 1, 10**9, divergence.MOST_PLAIN - 1, divergence.MOST_PLAIN, 10**15]
    rows = [(n, total, kept) for n in counts for total in (n, 3 * n + 7) for kept in (1, 10**6)]
    shares = spark.createDataFrame(rows, "n long, total long, kept long")
    shares = shares.select("n", "total", "kept", divergence._share(*(F.col(c) for c in ("n", "total", "kept"))).alias("p"))
    assert all(r.p == 1 + 10**9 * (r.n + 1) // (r.total + r.kept) for r in shares.collect())


TEXTS = [b"", b" ", b"Alpha alpha, a\xc3\xa9 12345678", b"abcdefgh abcdefghi abcdefghi ABCDEFGH x", b"..", b"abcdefg-y\x00z", b"q"]


def plain_terms(text):
    return re.findall(rb"[a-z\x80-\xff]+", text.lower())


def test_terms_of_a_slice_are_those_of_its_texts():
    for least in (1, 2, 8, 9):
        data, starts, ends, owners = divergence.spans(TEXTS, least)
        found = [(o, data[a:b]) for o, a, b in zip(owners.tolist(), starts.tolist(), ends.tolist())]
        assert found == [(i, t) for i, text in enumerate(TEXTS) for t in plain_terms(text) if len(t) >= least]
    data, starts, ends, _ = divergence.spans(TEXTS)
    terms = [t for text in TEXTS for t in plain_terms(text)]
    for length in (4, 8):
        words = divergence.words_at(data, starts, ends, length)
        assert divergence.word_bytes(words).to_pylist() == [t[:length] for t in terms]
        ended = divergence.word_bytes(words, length).to_pylist()
        assert ended == [t[:length] if len(t) >= length else t + b"\0" for t in terms]
    assert divergence.word_bytes(words[:0]).to_pylist() == []


def test_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 10)
    texts = pa.array([b"x" * n for n in (3, 9, 0, 40, 1)] + [None], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), texts], ["g", "text"])
    read = list(divergence.slices([batch, batch.slice(0, 0), batch], 2))
    assert [g for groups, _ in read for g in groups] == [*range(6)] * 2
    assert [t for _, own in read for t in own] == [t or b"" for t in texts.to_pylist()] * 2
    assert len(read) == 6


def test_words_are_counted_by_unit():
    units = ["b", "a", "b", "a", "c", "b", "a"]
    data, starts, ends, owners = divergence.spans(TEXTS)
    words = divergence.words_at(data, starts, ends)
    for once in (True, False):
        tally, expected = divergence.Tally(), Counter()
        for _ in range(3):
            tally.add(units, owners, words, once)
        tally.merge()
        tally.add(units, owners, words, once)
        for unit, text in zip(units, TEXTS):
            own = [t[:8] for t in plain_terms(text)]
            expected.update((unit, t) for t in (set(own) if once else own) for _ in range(4))
        found = [((u, t), n) for u, w, c in tally.settle() for t, n in zip(divergence.word_bytes(w).to_pylist(), c.tolist())]
        assert len(found) == len(expected) and dict(found) == expected
        assert tally.size == 0 and not list(tally.settle())
