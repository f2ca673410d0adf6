"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from alarmloom.llm import (
    catalog,
    common,
    exactdedup,
    langid,
    linededup,
    mixing,
    nearjoin,
    packing,
    secretscan,
    sharding,
    topk,
    toxicity,
)
from compare import connect, differences
from test_corpus_queries import brute_components, check_secrets

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, `count` int, "
    "`__digest` string, `row_key` string, `kept` string"
)
LONG = " ".join(f"word{i % 977} der{i}" for i in range(30_000))
COPY = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = [
    (1, COPY, "en", "a"),
    (2, COPY.upper(), "en", "a"),
    (3, COPY + " thirteen", None, None),
    (3, COPY + " thirteen", None, None),
    (None, COPY, "en", "a"),
    (5, None, "en", "b"),
    (6, "", None, None),
    (7, " \n\t ", "de", "b"),
    (8, LONG, "de", "b"),
    (9, "password = 'hunter22x' AKIA" + "Q1" * 10 + " é " + "0123456789abcdef" * 2, "fr", ""),
    (10, "token=short Token: abcdefg api_key=apikey:secretsecret", "fr", ""),
    (11, "same line\nnext line\nthird line\nown", "es", "c"),
    (12, "first\nsame line\n\nnext line\nthird line", "es", "c"),
    (13, "12345 !!!", "es", "c"),
    (14, "two words", "es", "c"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges"))
    docs = spark.createDataFrame(
        [(i, t, l, s, len(t or ""), 0, "x", "y", "z") for i, t, l, s in TEXTS], COLUMNS
    )
    docs.write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (9, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, COPY), (2, None), (3, "")], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    vectors = [
        (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, None, 0), (3, [1.0, None], 0),
        (4, [float("nan"), 1.0], 0), (5, [float("inf"), 1.0], 0), (None, [9.0, 9.0], 0),
        (50, [1.0], 0), (100, [], 0), (6, [-0.001, 0.5], 0), (7, [3.0], 0),
    ]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(
        f"{path}/embeddings.parquet"
    )
    return path


@pytest.fixture(scope="module")
def empty(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "embeddings", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("name", catalog.queries())
def test_odd_and_empty_tables_pass(spark, folder, empty, name):
    found = catalog.queries()[name](spark, folder).collect()
    several = ("pipeline", "op5_exact_top_k", "op6_best_fit_packing", "op12_source_divergence_audit")
    if name not in several:
        assert len(found) == len(TEXTS)
    assert catalog.queries()[name](spark, empty).collect() == []


def test_secrets(spark, folder):
    rows = [r for r in secretscan.op2_secret_scan(spark, folder).collect() if r.doc_id and r.doc_id >= 5]
    known = spark.createDataFrame([(i, t) for i, t, *_ in TEXTS if i and i >= 5], "doc_id long, text string")
    check_secrets(rows, known.collect())
    assert sum(r.n_assign + r.n_access + r.n_hex for r in rows) == 5


def test_near_join(spark, docs):
    known = docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text").cache()
    found = nearjoin.near_classes(known, 4, 85).collect()
    assert {r.doc_id: (r.n, r.component_id) for r in found} == brute_components(known.collect(), 4, 85)
    kept = nearjoin.one_of_each(docs, 4, 85)
    assert kept.columns == docs.columns
    assert {1, 5, 6, 7, 14} <= {r.doc_id for r in kept.collect()}
    assert {2, 3, None}.isdisjoint(r.doc_id for r in kept.collect())


def test_one_of_each_without_ids(spark):
    """Components whose rows all have null ids stay apart; of equal rows one stays."""
    other = COPY.replace("e", "ee")
    rows = [(None, COPY), (None, COPY + " more"), (None, other), (None, other), (None, ""), (4, None)]
    kept = nearjoin.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.text or "")[:3] for r in kept) == ["", "", "one", "onee"[:3]]
    assert sorted(r.text == other for r in kept).count(True) == 1


def test_exact_dedup_keeps_columns_and_one_of_each(docs):
    kept = exactdedup.deduplicated(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == [2, 3, 6, 7, 8, 9, 10, 11, 12, 13, 14]


def test_lines(docs):
    found = {r.doc_id: (r.removed, r.text) for r in linededup.deduplicated_lines(docs).collect()}
    assert found[11] == (0, TEXTS[11][1]) and found[12] == (3, "first\n")
    assert found[5] == (0, None)


def test_lines_of_a_long_text_and_repeated_rows(spark):
    """Every line of a long text removed or kept in one go; of equal rows the first keeps its lines."""
    long = "\n".join(f"line {i % 5000}" for i in range(20_000))
    table = spark.createDataFrame([(1, long), (2, "a\nb\nc"), (2, "a\nb\nc"), (None, "a\nb\nc")], "doc_id long, text string")
    found = sorted((r.doc_id or 9, r.removed, len(r.text)) for r in linededup.deduplicated_lines(table).collect())
    assert [f[:2] for f in found] == [(1, 15_000), (2, 0), (2, 3), (9, 3)]


def test_mixed_rows_keep_their_columns(docs):
    found = mixing.mixed(docs)
    assert found.columns == docs.columns
    assert found.groupBy("doc_id").count().filter(F.col("count") > 4).isEmpty()


def targets_of(spark, sizes, weights, share, cap):
    base = spark.createDataFrame([(f"s{i:02d}", n) for i, n in enumerate(sizes)], "dim0 string, size long")
    found = mixing.levels_of(base, "dim0", weights, share, cap).orderBy("level").collect()
    return [r.target for r in found]


def test_targets(spark):
    assert targets_of(spark, [100, 100, 100], [3, 1, 2], 1.5, 2.0) == [200.0, 250 / 3, 500 / 3]
    assert targets_of(spark, [10, 10, 10], [3, 1, 2], 9.0, 2.0) == [20.0, 20.0, 20.0]
    assert targets_of(spark, [0, 6], [1, 1], 1.0, 2.0) == [0.0, 6.0]
    assert targets_of(spark, [], [1, 1], 1.0, 2.0) == []


def test_long_text_is_cut_without_loss(spark, folder):
    rows = [r for r in packing.op6_best_fit_packing(spark, folder).collect() if r.doc_id == 8]
    rows.sort(key=lambda r: r.piece)
    assert len(rows) > 3 and all(r.length == 4096 for r in rows[:-1])
    assert [r.start for r in rows] == [4096 * i for i in range(len(rows))]


def test_stages_keep_what_they_should(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    named = corpus_pipeline.language_id(spark, rows, folder)
    assert named.columns == rows.columns
    assert {5, 6, 7, 13}.isdisjoint(r.doc_id for r in named.collect())
    assert named.count() == len(TEXTS) - 4
    assert len(corpus_pipeline.STAGES) == 5


def test_mixing_does_not_depend_on_partitions(spark):
    rows = [(i % 700, f"w{i % 700} " * (1 + i % 9), "ab"[i % 2]) for i in range(2100)]
    rows += [(None, None, None)] * 3 + [(5, "same words", None)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    columns = ["doc_id", "size", "target", "copies"]
    runs = [
        sorted(map(repr, mixing.mix(docs.repartition(n)).select(*columns).collect()))
        for n in (1, 7)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)


def test_a_level_for_each_of_many_sources(spark):
    """No number of sources is too many; the weights go round by code point."""
    rows = [(i, "w " * (1 + i % 3), f"{i:05d}") for i in range(30_000)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(found) == len(rows)
    size = {i: 1 + i % 3 for i in range(30_000)}
    weight = {i: (3, 1, 2)[i % 3] for i in size}
    fixed, left = {}, 1.5 * sum(size.values())
    while True:
        unit = left / sum(w for i, w in weight.items() if i not in fixed)
        over = [i for i in size if i not in fixed and unit * weight[i] > 2 * size[i]]
        if not over:
            break
        for i in over:
            fixed[i] = 2.0 * size[i]
            left -= fixed[i]
    for r in found:
        assert abs(r.target - fixed.get(r.doc_id, unit * weight[r.doc_id])) < 1e-9


def test_two_dimensions_meet_their_targets_together(spark):
    """Rates of cells are products of one factor per level, as a plain solver finds them."""
    import numpy as np

    sizes = np.array([[40, 10, 25], [5, 60, 20]])
    rows = []
    for s in range(2):
        for g in range(3):
            rows += [(f"w " * 10, f"s{s}", f"g{g}")] * (20 * sizes[s, g])
    docs = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, source string, lang string"
    )
    base = docs.select(F.col("source").alias("dim0"), F.col("lang").alias("dim1"), mixing.word_count().alias("size"))
    cells, _ = mixing._rated_cells(base, ["dim0", "dim1"], [[3.0, 2.0], [1.0, 1.0, 2.0]], 1.0, 4.0)
    found = {(r.dim0, r.dim1): r.rate for r in cells.collect()}
    mass = sizes * 200.0
    wanted = [mass.sum() * np.array([3, 2]) / 5, mass.sum() * np.array([1, 1, 2]) / 4]
    rate = np.ones_like(mass)
    for _ in range(500):
        rate *= (wanted[0] / (rate * mass).sum(axis=1))[:, None]
        rate *= wanted[1] / (rate * mass).sum(axis=0)
    for s in range(2):
        for g in range(3):
            assert abs(found[f"s{s}", f"g{g}"] - rate[s, g]) < 1e-6
    dealt = mixing.mix(docs, [[3.0, 2.0], [1.0, 1.0, 2.0]], 1.0, 4.0, ["source", "lang"])
    taken = dealt.join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("t")).collect()
    for r in taken:
        assert abs(r.t - wanted[0][int(r.source[1])]) <= 60


@pytest.mark.parametrize("parts", [1, 7])
def test_equal_documents_of_two_sources_are_mixed_by_source(spark, parts):
    """Rows equal in id and text but not in source keep their source's share, and all their columns."""
    rows = [(i, "same words here now " * 25, s, i) for i in range(40) for s in "ab"]
    rows += [(100, "other " * 50, "c", n) for n in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `number` int").repartition(parts)
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns
    got = {r.source: r.t for r in kept.groupBy("source").agg(F.sum(mixing.word_count()).alias("t")).collect()}
    by_target = mixing.levels_of(
        docs.select(F.col("source").alias("dim0"), mixing.word_count().alias("size")), "dim0", mixing.WEIGHTS, 1.5, 2.0
    ).collect()
    for r in by_target:
        assert abs(got.get(r.value, 0) - r.target) <= 100, (r, got)
    most = kept.groupBy("doc_id", "source", "number").count().agg(F.max("count")).first()[0]
    assert most <= 2


def test_names_that_clash_keep_their_values(spark):
    """Columns called as the operators' own keep their values in every operator that passes columns."""
    names = ["number", "digest", "copies", "maybe", "lang_pred", "lang_score", "toxic_score", "shard", "slot",
             "removed", "row_key", "curve", "place"]
    texts = [COPY, COPY, "one two", "a b c d e f g"]
    rows = [(i, t, "en", "s", *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    layout = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names)
    table = spark.createDataFrame(rows, layout)
    frames = {
        "dedup": exactdedup.deduplicated(table),
        "near": nearjoin.one_of_each(table),
        "mixed": mixing.mixed(table),
        "lang": langid.identify(table, langid.fit(table)),
        "toxic": toxicity.score_texts(table, None),
        "shards": sharding.hilbert_shards(table, ["source", "doc_id"], 2),
        "lines": linededup.deduplicated_lines(table),
    }
    for name, frame in frames.items():
        assert len(set(c.lower() for c in frame.columns)) == len(frame.columns), name
        found = frame.select("doc_id", *[f"`{n}`" for n in names]).collect()
        assert found, name
        for r in found:
            assert [r[n] for n in names] == [f"{n}{r.doc_id}" for n in names], name


def test_one_of_equal_rows_stays(spark, tmp_path):
    rows = [(5, "a"), (5, "a"), (3, "A"), (None, "b"), (None, "B"), (7, None), (8, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = exactdedup.copies(table).filter("kept").groupBy("keep_id").count().collect()
    assert sorted((r.keep_id or 0, r["count"]) for r in kept) == [(0, 1), (5, 1), (8, 1)]
    assert exactdedup.deduplicated(table).count() == 3
    table.write.parquet(f"{tmp_path}/documents.parquet")
    con = connect("/nowhere")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert differences(spark, con, exactdedup.op7_exact_dedup, exactdedup.OP7_SQL, str(tmp_path)) == []


def test_only_repeated_digests_pass_the_filter(spark, monkeypatch):
    """Right with a filter that is far too small, too: what passes by mistake is checked."""
    rows = [(i, f"text {i % 900}") for i in range(1000)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (1 << 16, common.MOST_BITS):
        monkeypatch.setattr(common, "MOST_BITS", most)
        keys = table.select(exactdedup.digest().alias("digest"))
        bits = exactdedup.repeat_filter(keys)
        maybe = exactdedup._prober(spark, bits)
        assert keys.filter(maybe("digest")).count() <= 200 + 20
        assert exactdedup.deduplicated(table).count() == 900
    monkeypatch.setattr(common, "bloom_width", lambda keys: 64)
    monkeypatch.setattr(common, "SEGMENT", 64)
    assert exactdedup.deduplicated(table).count() == 900


def test_letters_of_all_planes():
    from alarmloom.llm import langid as module

    text = chr(0x323B0 - 1) + chr(0x31350)
    assert (module.profile(text) is not None) == any(c.isalpha() for c in text)
    assert module.letters()[0x323AF] == chr(0x323AF).isalpha()


def test_more_label_values_than_any_limit(spark):
    from alarmloom.llm.linear import bounded_sample

    rows = spark.range(24_000).select("id", (F.col("id") % 12_000).cast("string").alias("label"))
    found = bounded_sample(rows, "label", "id", 24_000)
    assert found.count() == 24_000
    few = bounded_sample(rows, "label", "id", 6_000).count()
    assert 5_000 < few < 7_000


def plain_top(vectors, k=5):
    """Of (id, integers) rows, Python's integers, whole lists."""
    out = []
    for n, (q, x) in enumerate(vectors):
        if q % 50 == 0:
            scored = [
                (-min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(x, y)))), i)
                for m, (i, y) in enumerate(vectors) if m != n and len(y) == len(x)
            ]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("size", [1.0, 400.0, 4e3, 1e17])
@pytest.mark.parametrize("rows_in_block", [7, 4096])
def test_scores_are_exact_at_any_size(spark, size, rows_in_block):
    """Large components, repeated ids and vectors, ties, several lengths; blocks of few rows."""
    import random

    rng = random.Random(int(size) + rows_in_block)
    rows = []
    for i in range(300):
        width = 64 if i % 10 else 3
        rows.append((i % 240, [float(rng.randrange(-256, 257) * size) / 256 for _ in range(width)]))
    rows += [(50, rows[7][1]), (50, rows[7][1]), (1, rows[7][1]), (0, [0.0] * 64), (100, [0.0] * 64)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = topk.top_k(table, F.col("vec_id") % 50 == 0, block=4, rows_in_block=rows_in_block).collect()
    held = [(i, [max(-(2**63), min(2**63 - 1, int(256 * x))) for x in v]) for i, v in rows]
    assert sorted(map(tuple, found)) == plain_top(held)


def test_pairs_of_blocks_without_a_chance_do_not_meet(spark):
    near = [(i, [1.0, 1.0 + i / 1000]) for i in range(100)]
    far = [(1000 + i, [-1.0, -1.0 - i]) for i in range(100)]
    table = spark.createDataFrame(near + far, "vec_id long, embedding array<double>").coalesce(1)
    seen = []
    plain = topk._pairs

    def counted(q, r):
        found = plain(q, r)
        seen.append((q.count() * r.count(), found.count()))
        return found

    topk._pairs = counted
    try:
        found = topk.top_k(table, F.col("vec_id") == 50, block=8, rows_in_block=20).collect()
    finally:
        topk._pairs = plain
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank)] == [98, 99, 94, 95, 96]  # equal after rounding down
    assert seen == [(10, 3)]


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5, 17, 20_000])
def test_spans_of_a_text_with_many_matches(spark, count):
    text = "".join(f"é{'x' * (i % 3)} token={'abcdef' if i % 4 else 'ab'}{i} AKIA{'Z' * 16}é" for i in range(count))
    path = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = secretscan.scan(path).collect()
    from test_corpus_queries import secret_spans

    assert [(s.start, s.place, s.end) for s in rows[0].found] == secret_spans(text)


def test_rows_of_files_are_numbered_without_being_written(spark, tmp_path):
    rows = [(i, f"t{i}") for i in range(50)] * 2
    table = spark.createDataFrame(rows, "doc_id long, `number` string")
    table.repartition(7).write.parquet(f"{tmp_path}/t.parquet")
    read = spark.read.parquet(f"{tmp_path}/t.parquet")
    first, name = common.numbered(read, "rows")
    assert name == "number_1" and first.columns == ["doc_id", "number", name]
    assert all(str(tmp_path) in f for f in first.inputFiles())
    found = {r[name]: r.doc_id for r in first.collect()}
    assert len(found) == 100
    again = {r[name]: r.doc_id for r in common.numbered(read, "rows")[0].repartition(3).collect()}
    assert again == found
    other, name = common.numbered(table.repartition(3), "rows")
    assert other.select(name).distinct().count() == 100 and other.count() == 100
    assert common.numbered(read.filter("doc_id < 10"), "rows")[0].select(name).distinct().count() == 20
    none = common.numbered(read.limit(0), "rows")[0]
    assert none.collect() == []
    # Steps that repeat rows: these are staged, since a row of a file is no longer one row.
    for many in (
        read.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3)))), read.crossJoin(spark.range(3)),
        read.union(read), read.sample(True, 2.0, 3), read.selectExpr("stack(2, doc_id, doc_id) as x"),
    ):
        own, name = common.numbered(many, "rows")
        assert own.select(name).distinct().count() == own.count() > 100
