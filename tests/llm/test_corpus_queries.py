"""The corpus queries on whole test tables, against SQL or a brute-force version."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from alarmloom.llm import catalog, langid, packing, secretscan, sharding, toxicity
from compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


def rows_of(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", catalog.oracle_sql())
def test_query_equals_sql(spark, name):
    found = differences(spark, connect(SF_DIR), QUERIES[name], catalog.oracle_sql()[name], SF_DIR)
    assert found == []


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def test_mix_meets_its_targets(spark, docs):
    found = rows_of(spark, "op1_mixing_to_target_weights")
    assert Counter(r.doc_id for r in found) == Counter(d.doc_id for d in docs)
    size, source = {d.doc_id: len(words(d.text)) for d in docs}, {d.doc_id: d.source for d in docs}
    total = Counter()
    for d in docs:
        total[d.source] += size[d.doc_id]
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(names)}
    fixed, left = {}, 1.5 * sum(total.values())
    while True:
        unit = left / sum(w for s, w in weight.items() if s not in fixed)
        over = [s for s in names if s not in fixed and unit * weight[s] > 2 * total[s]]
        if not over:
            break
        for s in over:
            fixed[s] = 2.0 * total[s]
            left -= fixed[s]
    target = {s: fixed.get(s, unit * weight[s]) for s in names}
    taken = Counter()
    for r in found:
        assert (r.size, r.source_size) == (size[r.doc_id], total[source[r.doc_id]])
        assert math.isclose(r.target, target[source[r.doc_id]], rel_tol=1e-9)
        assert r.taken in {0, r.size, 2 * r.size}
        taken[source[r.doc_id]] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max(20, 0.02 * target[s])
    again = {(r.doc_id, r.taken) for r in rows_of(spark, "op1_mixing_to_target_weights")}
    assert again == {(r.doc_id, r.taken) for r in found}


ASSIGN = re.compile(
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
    r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def secret_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [
        (m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20
    ]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def check_secrets(rows, docs):
    texts = {d.doc_id: d.text for d in docs}
    assert len(rows) == len(docs)
    for r in rows:
        spans = secret_spans(texts[r.doc_id])
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
        assert r.spans == joined
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        counts = Counter(k for _, k, _ in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == (counts[0], counts[1], counts[2])


def test_secrets_equal_a_plain_scan(spark, docs):
    rows = rows_of(spark, "op2_secret_scan")
    check_secrets(rows, docs)


def test_trigram_queries():
    found = {r.kind: secretscan.trigram_query(r.pattern) for r in secretscan.RULES}
    assert found["hex"] is None
    assert found["access"] == [frozenset({"aki", "kia"})]
    assert len(found["assign"]) == 6 and frozenset({"tok", "oke", "ken"}) in found["assign"]


def brute_components(docs, size, percent):
    sets, by_shingle = {}, defaultdict(list)
    for d in docs:
        w = [x.encode().lower() for x in words(d.text)]
        own = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        sets[d.doc_id] = own
        for s in own:
            by_shingle[s].append(d.doc_id)
    parent = {d.doc_id: d.doc_id for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = Counter()
    for ids in by_shingle.values():
        for i, a in enumerate(ids):
            for b in ids[:i]:
                shared[min(a, b), max(a, b)] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_near_join_equals_all_pairs(spark, docs):
    expected = brute_components(docs, 4, 85)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows_of(spark, "op3_ngram_jaccard_join")}
    assert found == expected
    assert any(i != c for i, (_, c) in found.items())


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    found = rows_of(spark, "op6_best_fit_packing")
    pieces, bins = defaultdict(dict), defaultdict(list)
    for r in found:
        pieces[r.doc_id][r.piece] = r
        bins[r.sequence_id].append((r.offset, r.length))
    for d in docs:
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [1]
        own = pieces[d.doc_id]
        cuts = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        assert sorted(own) == list(range(len(cuts)))
        for i, cut in enumerate(cuts):
            assert (own[i].start, own[i].length) == (i * 4096, len(cut))
            assert own[i].ids_crc32 == zlib.crc32(np.array(cut, "<u4").tobytes())
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    least = -(-sum(r.length for r in found) // 4096)
    assert len(bins) <= least + 1


def test_language_on_held_out_rows(spark, docs):
    truth = {d.doc_id: d.lang for d in docs}
    found = rows_of(spark, "op8_language_id")
    assert len(found) == len(docs)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out and truth[r.doc_id] and r.lang_pred != "und"]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_shards_hold_the_law(spark, docs):
    found = rows_of(spark, "op9_hilbert_sharding")
    assert len(found) == len(docs)
    texts, slots = {d.doc_id: d.text or "" for d in docs}, defaultdict(list)
    for r in found:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "rows")
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[i]) for i in range(40)]
    assert max(counts) - min(counts) <= 1


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbouring_cells(spark, dims, bits):
    from pyspark.sql import functions as F

    cells = spark.range(1 << (dims * bits))
    steps = [F.expr(f"cast(shiftright(id, {bits * d}) & {(1 << bits) - 1} as int)") for d in range(dims)]
    rows = cells.select(*[s.alias(f"s{d}") for d, s in enumerate(steps)])
    rows = rows.select("*", sharding.hilbert_index([F.col(f"s{d}") for d in range(dims)], bits).alias("at"))
    path = sorted(rows.collect(), key=lambda r: r["at"])
    assert [r["at"] for r in path] == list(range(len(path)))
    for a, b in zip(path, path[1:]):
        assert sum(abs(a[f"s{d}"] - b[f"s{d}"]) for d in range(dims)) == 1


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else SF_DIR
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = QUERIES["op10_toxicity"](spark, folder).collect()
    hits = Counter()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.held_out and r.doc_id in truth:
            hits[truth[r.doc_id], r.predicted] += 1
    assert hits[1, 1] >= 0.85 * (hits[1, 0] + hits[1, 1])
    assert hits[0, 1] <= 0.02 * (hits[0, 0] + hits[0, 1])


def test_families_join_similar_profiles():
    centres = np.array([[1, 0], [0.9, 0.1], [0, 1], [0.1, 0.9]])
    assert sorted(map(sorted, langid.families(centres))) == [[0, 1], [2, 3]]


def test_local_search_empties_a_bin():
    lengths = [6, 5, 5, 4, 4, 3, 3]
    bins = [[0, 5], [1, 3], [2, 4], [6]]
    found = packing.local_search([list(b) for b in bins], lengths, 10)
    assert len(found) == 3 and sorted(i for b in found for i in b) == list(range(7))


def test_ids_of_random_strings_are_the_tokenizers():
    """Letters that change when normalised, quotes, special tokens, blanks of all kinds, in any order."""
    import random
    import unicodedata

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    rng = random.Random(11)
    wide = [chr(c) for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000]
    changed = [c for c in wide if unicodedata.normalize("NFC", c) != c or len(c.lower()) > 1]
    assert {"\u0130", "\u0958"} <= set(changed)
    pool = changed + list("abcIST.,!?-_'0129 ") + [
        "'s", "'LL", "\n", "\t", "\x0b", "\x85", "\xa0", "\u2028", "\u0301", "\u0345", "\u200b", "<|endoftext|>",
        "<|", "\x00", "\U0001F600", "\u4e2d", "\u1e9e", "\ufb01", "\u00bd",
    ]
    texts = ["".join(rng.choices(pool, k=rng.randrange(0, 9))) for _ in range(12_000)]
    texts += [a + c + "." + b for c in changed for a, b in (("", ""), ("x", ",y"))]
    encode = packing.Encoder(packing.vocabulary(), most=3000)
    for at in range(0, len(texts), 3000):
        own = texts[at : at + 3000]
        for text, ids in zip(own, encode([t.encode() for t in own])):
            expected = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, np.uint32).tolist() == expected, repr(text)


def test_a_long_text_is_encoded_in_parts(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "SLICE", 100)
    text = " ".join(f"Word{i}, it's \u00e9t\u00e9!" for i in range(300)) + "x" * 500
    encode = packing.Encoder(packing.vocabulary())
    found = encode([text.encode(), None, b"", b"a", text.encode()])
    expected = Tokenizer.from_file(packing.vocabulary()).encode(text, add_special_tokens=False).ids
    assert [np.frombuffer(f, np.uint32).tolist() for f in (found[0], found[4])] == [expected] * 2
    assert found[1] == found[2] == b""


# --- Predictions in plain Python ----------------------------------------------------------------


def plain_profile(text, slots=2048):
    """Letter n-grams of the padded words, hashed one by one."""
    mask, letters = (1 << 64) - 1, []
    for c in (text or "").lower():
        if c.isalpha():
            letters.append(ord(c))
        elif letters and letters[-1] != 32:
            letters.append(32)
    if not letters:
        return None
    own, counts = [32, *letters], np.zeros(slots)

    def met(value):
        counts[(value >> 40) & (slots - 1)] += 1

    for i, c in enumerate(own):
        one = (c * 0x9E3779B97F4A7C15) & mask
        met(one)
        if i + 1 < len(own):
            two = ((one ^ ((own[i + 1] * 0xC2B2AE3D27D4EB4F) & mask)) * 0xFF51AFD7ED558CCD) & mask
            met(two)
            if i + 2 < len(own):
                met(((two ^ ((own[i + 2] * 0x165667B19E3779F9) & mask)) * 0xC4CEB9FE1A85EC53) & mask)
    return np.sqrt(counts) / math.sqrt(counts.sum())


def plain_language(model, x):
    def margin(svm):
        return float(np.dot(x.astype(np.float64), svm[0].astype(np.float64)) + svm[1])

    def squash(m):
        return 1 / (1 + math.exp(-max(-30, min(30, 3 * m))))

    tops = [margin(svm) for svm in model.of_family]
    family = max(range(len(tops)), key=lambda f: tops[f])
    group = model.families[family]
    score = squash(tops[family]) if len(tops) > 1 else 1.0
    wins = {a: 0.0 for a in group}
    least = {a: math.inf for a in group}
    for n, a in enumerate(group):
        for b in group[n + 1 :]:
            m = margin(model.pairs[a, b])
            wins[a] += (m >= 0) + 1e-3 * math.tanh(m)
            wins[b] += (m < 0) - 1e-3 * math.tanh(m)
            least[a], least[b] = min(least[a], m), min(least[b], -m)
    best = max(group, key=lambda a: wins[a])
    return model.languages[best], score * (squash(least[best]) if len(group) > 1 else 1.0)


def test_language_predictions_equal_plain_python(spark, docs):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "12 !"), (-4, "É"), (-5, "a1b")], "doc_id long, text string")
    model = langid.fit(rows)
    assert sorted(i for f in model.families for i in f) == list(range(len(model.languages)))
    found = langid.identify(rows.select("doc_id", "text").union(odd), model).collect()
    for r in found:
        x = plain_profile(r.text)
        if x is None:
            assert (r.lang_pred, r.lang_score) == ("und", 0.0)
            continue
        lang, score = plain_language(model, x)
        assert r.lang_pred == lang and abs(r.lang_score - score) < 1e-3


def plain_toxic(model, text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    hits = [w for w in words if w in model.voters.index]
    counts = Counter(hits)
    value = model.offset
    for w, n in counts.items():
        value += math.log1p(n) * model.weights[model.voters.index[w]]
    base = len(model.voters.index)
    own = dict.fromkeys(("two", "four", "dense", "repeated", "early", "none"), 0.0)
    if hits:
        first = next(i for i, w in enumerate(words) if w in counts)
        own |= {
            "two": math.log(len(counts)), "four": len(counts) >= 4, "repeated": max(counts.values()) >= 2,
            "dense": min(1.0, 20 * len(hits) / len(words)), "early": first < 50,
        }
    else:
        own["none"] = 1.0
    for i, name in enumerate(model.voters.PATTERNS):
        value += own[name] * model.weights[base + i]
    return 1 / (1 + math.exp(-max(-30, min(30, value))))


def test_toxicity_scores_equal_plain_python(spark):
    folder = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else SF_DIR
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").groupBy("doc_id").agg({"toxic": "max"})
    model = toxicity.fit(rows, labels.toDF("doc_id", "toxic"))
    assert len(model.voters.index) >= 5
    found = toxicity.score_texts(rows, model).collect()
    for r in found:
        assert abs(r.toxic_score - plain_toxic(model, r.text)) < 1e-9


def test_correlated_voters_share_their_weight():
    """Planted voters: two by themselves, and two that always agree."""
    from alarmloom.llm.toxicity import LabelModel

    rng = np.random.default_rng(3)
    truth = rng.random(6000) < 0.3

    def voter(hit, slip):
        return np.where(truth, rng.random(6000) < hit, rng.random(6000) < slip)

    first, pair, third = voter(0.9, 0.005), voter(0.6, 0.004), voter(0.7, 0.005)
    votes = np.array([first, pair, pair, third, ~(first | pair | third)]).T.astype(float)
    model = LabelModel(votes, 0.3)
    assert model.share[1] < 0.75 < model.share[0]
    assert abs(model.share[1] - model.share[2]) < 1e-6
    assert model.yes[0] > model.yes[3] > model.yes[1]
    found = model.posterior(votes) >= 0.5
    assert (found == truth).mean() > 0.95
