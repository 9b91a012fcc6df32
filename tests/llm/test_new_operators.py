"""Whitening, spelling variants and token counts against plain Python on small tables."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyfield.llm import piececount, spelling, whitening
from tallyfield.llm.queries import piece_model_path

sentencepiece = pytest.importorskip("sentencepiece")
VECTORS = "embedding array<float>, vec_id long, n string, x int, w int, key string"


def _whiten_by_hand(vectors, k):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    white = centred @ axes[:, order] / np.sqrt(values[order])
    return n, ((n * x - total) ** 2).sum(axis=1), white, values[order] / values.sum()


def test_whitening_equals_numpy_with_repeated_vectors_and_bad_rows(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 0.2, (60, 6)).astype(np.float32)
    vectors[20:50] = vectors[3]
    rows = [([float(v) for v in vec], i, "a", 1, 2, "k") for i, vec in enumerate(vectors)]
    bad = [(None, 100, "", 0, 0, ""), ([], 101, "", 0, 0, ""), ([1.0, None, 1.0, 1.0, 1.0, 1.0], 102, "", 0, 0, ""),
           ([float("nan")] * 6, 103, "", 0, 0, ""), ([float("inf")] * 6, 104, "", 0, 0, "")]
    found = whitening.whiten(spark.createDataFrame(rows + bad, VECTORS).repartition(5), components=4).collect()
    n, deviation, white, explained = _whiten_by_hand(vectors, 4)
    assert len(found) == 60 * 4 and {r.n for r in found} == {n}
    signs = {}
    for r in found:
        assert r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        want = white[r.vec_id][r.component - 1]
        assert abs(r.whitened) == pytest.approx(abs(want), abs=1e-9)
        if abs(want) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(want) == np.sign(r.whitened))
        assert r.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_weights_of_one_and_salted_join(spark, monkeypatch):
    from tallyfield.operators import scale

    monkeypatch.setattr(whitening, "keyed_join", lambda *a: scale.keyed_join(*a, max_rows=0, hot_rows=4))
    base = [[0.1, 0.9], [0.4, 0.2], [0.8, 0.3]]
    rows = [(base[0], i) for i in range(30)] + [(base[1], 90), (base[2], None), (base[2], None)]
    df = spark.createDataFrame(rows, "embedding array<double>, vec_id long")
    found = whitening.whiten(df, weights="one").collect()
    n, deviation, white, _ = _whiten_by_hand(base, 2)
    assert len(found) == 66 and {r.n for r in found} == {3}
    of_first = {(r.component, r.deviation, round(abs(r.whitened), 9)) for r in found if r.vec_id is not None and r.vec_id < 30}
    assert of_first == {(c + 1, deviation[0], round(abs(white[0][c]), 9)) for c in range(2)}
    assert sum(r.vec_id is None for r in found) == 4


def test_whitening_of_deviations_beyond_64_bits(spark):
    # Few distinct vectors, so many rows: n times an entry's distance from the mean passes 2**31.5.
    rows = spark.range(1_200_000).selectExpr(
        "id AS vec_id", "CASE id % 3 WHEN 0 THEN array(0.9D, -0.8D) WHEN 1 THEN array(-0.7D, 5.1D) ELSE array(5.5D, 0.2D) END AS embedding")
    white = whitening.whiten(rows)
    assert dict(white.dtypes)["deviation"] == "decimal(38,0)"
    found = {(r.vec_id, r.component): r for r in white.filter("vec_id < 3").collect()}
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in ((0.9, -0.8), (-0.7, 5.1), (5.5, 0.2))]
    sums = [400_000 * sum(v[i] for v in x) for i in range(2)]
    want = [sum((1_200_000 * v[i] - sums[i]) ** 2 for i in range(2)) for v in x]
    assert max(want) > 1 << 63 and len(found) == 6
    assert all(int(r.deviation) == want[i] and r.identity_error < 1e-9 for (i, _), r in found.items())


def test_whitening_squares_of_any_size():
    rng = np.random.default_rng(2)
    for bits in (20, 30, 55, 61):
        d = rng.integers(-(1 << bits), 1 << bits, (7, 64))
        assert list(whitening._squares(d)) == [sum(int(v) ** 2 for v in row) for row in d]


def test_whitening_without_variation_ragged_large_and_empty(spark):
    kind = "vec_id long, embedding array<double>"
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 2.0])], kind)).collect()
    assert {(r.component, r.explained, r.whitened is None) for r in same} == {(1, 1.0, False), (2, 0.0, True)}
    one = whitening.whiten(spark.createDataFrame([(1, [0.5])], kind)).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, 0.0)]
    empty = whitening.whiten(spark.createDataFrame([(1, None)], kind))
    assert empty.collect() == [] and empty.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], kind))
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30])], kind)).collect()
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1.0])], kind), weights="some")


def variants_by_hand(docs, min_length=7, min_count=2, drop=31, factor=10):
    counts = Counter()
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop and h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_length:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= min_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    neighbours = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in neighbours.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= factor * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, counts[w], len(neighbours[w]), form[w], counts.get(form[w]), root(w)) for w in counts}


def _variants(df, **settings):
    rows = spelling.group_variants(df, **settings).collect()
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def test_variants_equal_brute_force_on_documents(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    found = _variants(df)
    assert len(found) > 50 and found == variants_by_hand(docs)


def test_variants_in_small_leaves_and_blocks(spark, monkeypatch):
    for name, value in (("LEAF", 20), ("BUCKET", 3), ("POINTS", 7), ("QUERIES", 5), ("STEP", 4)):
        monkeypatch.setattr(spelling, name, value)
    rng = np.random.default_rng(2)
    base = ["".join(rng.choice(list("abcdeé"), int(rng.integers(7, 10)))) for _ in range(120)]
    edited = []
    for w in base:
        i = int(rng.integers(len(w)))
        edited += [w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + "y" + w[i + 1 :]]
    docs = [(i, " ".join(rng.choice(base + edited, 300))) for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _variants(df, drop_every=0, min_count=1) == variants_by_hand(docs, drop=0, min_count=1)


def test_variants_follow_chains_and_break_ties(spark):
    text = " ".join(["straight"] * 1000 + ["straigth", "straighx"] + ["straighxy"] * 2 + ["straïght"] * 10 + ["straïghtt"]
                    + ["abcdefgh", "abcdefgk"] * 10 + ["abcdefgm"] + ["a" * 70, "a" * 71] + ["STRAIGHT"])
    docs = [(1, text), (None, None), (2, ""), (3, "12 Škodaauto 中")]
    df = spark.createDataFrame([(t, d, "w", 1) for d, t in docs], "text string, doc_id long, word string, n int")
    found = _variants(df, drop_every=0, min_count=1)
    assert found == variants_by_hand(docs, drop=0, min_count=1)
    assert {r[0]: r[3] for r in found}["abcdefgm"] == "abcdefgh"
    assert {r[0]: r[5] for r in found}["straïghtt"] == "straight"
    assert _variants(df.limit(0)) == set()
    assert _variants(df.unionByName(df), drop_every=0, min_count=2) == variants_by_hand(docs * 2, drop=0)


def test_letter_code_never_exceeds_the_true_distance():
    rng = np.random.default_rng(3)
    words = rng.choice(np.array([97, 98, 110, 120, 223, 233, 255], np.uint8), (300, 9))
    codes = spelling.letter_code(words)
    for i, j in rng.integers(0, 300, (400, 2)):
        a, b = Counter(words[i].tolist()), Counter(words[j].tolist())
        assert bin(int(codes[i] ^ codes[j])).count("1") <= sum(abs(a[c] - b[c]) for c in a | b)


TEXTS = [
    "", " ", "a", "a  b\t<s> x▁y <0x41> é​ ǅ\n\n", "a" * 3000, "ab" * 2000, " " * 3000 + "x", "abcabd" * 300,
    "\x00", "日本語の文章" * 200, "\U0001f600" * 10, "x" * 511 + "y", "</s> [INST] <unk>", "▁▁▁ ▁",
    "the quick brown fox. " * 500,
]


def _library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


def test_token_counts_equal_the_library(spark, folder):
    rng = np.random.default_rng(4)
    signs = list("ab  eirnst0123,.\n") + ["é", "日", "\U0001f600", "▁"]
    texts = TEXTS + ["".join(rng.choice(signs, int(rng.integers(1, 1500)))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, 7, 1) for i, t in enumerate(texts)] + [(None, None, 7, 1)],
                               "doc_id long, text string, n_tokens int, n_bytes int")
    rows = piececount.count_tokens(df, piece_model_path(), limit=100).collect()
    want = {(i, len(t.encode()), len(ids), len(ids) > 100) for i, (t, ids) in enumerate(zip(texts, _library().encode(texts)))}
    assert {tuple(r) for r in rows} == want | {(None, 0, 0, False)}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counted = {r.doc_id: r.n_tokens for r in piececount.count_tokens(docs, piece_model_path()).collect()}
    assert counted == {r.doc_id: len(_library().encode(r.text)) for r in docs.collect()}
    assert piececount.count_tokens(df.limit(0), piece_model_path()).collect() == []


def test_token_counts_in_stretches_and_for_long_runs(monkeypatch):
    with open(piece_model_path(), "rb") as file:
        table = piececount.PieceTable(file.read())
    monkeypatch.setattr(piececount, "STRETCH", 50)
    monkeypatch.setattr(piececount, "REMEMBERED", 10)
    monkeypatch.setattr(piececount, "LONG", 6)
    rng = np.random.default_rng(6)
    texts = TEXTS + ["".join(rng.choice(list("etaoinshrdlu  "), 700)) for _ in range(30)]
    assert piececount.PieceCounter(table).count(texts) == [len(x) for x in _library().encode(texts)]
