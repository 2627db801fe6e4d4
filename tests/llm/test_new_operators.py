"""Class-based language model, vector codes and fill-in-the-middle: brute force, exact
round trips and awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.llm import class_lm, fill_middle, vector_codes
from revlens.llm.registry import REGISTRY
from revlens.session import materialize

# --- class-based language model --------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _tokens(text):
    return [w.encode().lower() for w in WORD.findall(text or "")]


def _corpus(spark, n=240, seed=3):
    r = random.Random(seed)
    def sentence():
        a, b, c = (r.choice(x) for x in (["the", "A", "one"], ["dog", "cat", "Cow", "é"], ["runs", "eats", "sleeps"]))
        return f"{a} {b} {c}" + ("" if r.random() < .7 else f" on day{r.randrange(40)}")
    rows = [(i, ". ".join(sentence() for _ in range(r.randrange(1, 6))), "s", 1.0, 2) for i in range(n)]
    rows += [(900, None, "s", 1.0, 2), (901, "", "s", 1.0, 2), (902, " \n ", "s", 1.0, 2), (None, "the dog runs", "s", 1.0, 2),
             (903, "never seen words here", "s", 1.0, 2), (5, rows[5][1], "s", 1.0, 2), (None, None, "s", 1.0, 2),
             (904, "the\x85dog \x00 x", "s", 1.0, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, score double, n int"), rows


def _brute_score(model, text):
    """Token by token from the model's counts, classes and distributions."""
    w = model.words
    table = {r["word"]: r["n"] for r in w.table.collect()} if not hasattr(_brute_score, "t") else _brute_score.t
    step, emit = model.transitions(), model.emissions()
    place = {x: i for i, x in enumerate(w.known)}
    base = total = 0.0
    known, last = 0, 0
    tokens = _tokens(text) + [None]
    for t in tokens:
        c = w.texts if t is None else table.get(bytes(t), 0)
        known += c > 0
        base += math.log10((c + 1) / (w.tokens + w.distinct + 1))
        unit = 0 if t is None else (place[t] + 1 if place.get(t, 1 << 40) < w.n_units else
                                    1 + w.n_units + zlib.crc32(t[-3:]) % w.groups)
        total += step[model.classes[last], model.classes[unit]] + emit[unit]
        if unit > w.n_units:
            g = unit - 1 - w.n_units
            if w.group_tokens[g]:
                share = c - w.discount if c else w.discount * w.group_words[g]
                total += math.log10(share / w.group_tokens[g])
        last = unit
    return len(tokens), known, base, total


@pytest.mark.parametrize("max_known, max_units", [(1 << 18, 1 << 14), (8, 6), (6, 3), (0, 0)])
def test_class_lm_against_brute_force(spark, monkeypatch, max_known, max_units):
    df, rows = _corpus(spark)
    model = class_lm.fit(df.where("doc_id % 7 <> 2"), classes=6, max_known=max_known, max_units=max_units, groups=16)
    train = [_tokens(t) for i, t, *_ in rows if i is not None and i % 7 != 2]
    count = Counter(x for t in train for x in t)
    w = model.words
    assert (w.tokens, w.distinct, w.texts) == (sum(count.values()) + len(train), len(count) + 1, len(train))
    assert {bytes(r["word"]): r["n"] for r in w.table.collect()} == count
    # the class matrix counts every pair of the training texts
    assert model.matrix.sum() == w.tokens and model.matrix[0].sum() == w.texts
    got = class_lm.score(df.repartition(3), model).collect()
    assert len(got) == len(rows)
    by = {}
    for i, t, *_ in rows:
        by.setdefault(i, []).append(_brute_score(model, t))
    for r in got:
        near = [b for b in by[r["doc_id"]] if b[:2] == (r["n_tokens"], r["n_known"]) and abs(b[3] - r["score"]) < 1e-9]
        assert near and abs(near[0][2] - r["base_score"]) < 1e-9
        assert r["perplexity"] == pytest.approx(10 ** (-r["score"] / r["n_tokens"]))


def test_class_lm_reads_small_batches(spark, monkeypatch):
    """Texts and neighbour lists cross to Python a bounded number at a time, in training and scoring."""
    key, plain, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", class_lm.materialize, {}

    def noted(df, name, *more, **kw):
        rows[name] = int(df.sparkSession.conf.get(key))
        return plain(df, name, *more, **kw)

    monkeypatch.setattr(class_lm, "materialize", noted)
    before, (df, want) = spark.conf.get(key), _corpus(spark)
    got = class_lm.score(df, class_lm.fit(df, classes=6, groups=16)).count()
    assert got == len(want) and spark.conf.get(key) == before
    assert {"lm-words", "lm-neighbours", "lm-scores"} <= set(rows) and max(rows.values()) <= class_lm.BATCH <= 1000


def test_class_lm_distributions_sum_to_one(spark):
    df, _ = _corpus(spark)
    model = class_lm.fit(df, classes=6, max_known=8, max_units=6, groups=16)
    w = model.words
    assert np.allclose((10 ** model.transitions()).sum(axis=1), 1)
    share = 10 ** model.emissions()
    assert np.allclose(np.bincount(model.classes, share)[np.unique(model.classes)], 1)
    units = set(w.known[:w.n_units])
    for g in np.flatnonzero(w.group_tokens):
        mine = [r["n"] for r in w.table.collect() if bytes(r["word"]) not in units
                and class_lm.group_of(bytes(r["word"]), 16) == g]
        assert sum(n - w.discount for n in mine) + w.discount * len(mine) == pytest.approx(w.group_tokens[g])


@settings(deadline=None, max_examples=40)
@given(st.integers(0, 2 ** 32), st.integers(2, 7), st.integers(3, 12))
def test_gain_is_the_change_of_likelihood(seed, k, units):
    rng = np.random.default_rng(seed)
    pairs = rng.integers(0, 4, (units, units)) * rng.integers(0, 2, (units, units))
    cls = rng.integers(0, k, units)

    def matrix(c):
        m = np.zeros((k, k), np.int64)
        np.add.at(m, (c[:, None], c[None, :]), pairs)
        return m
    after, before = np.zeros((units, k)), np.zeros((units, k))
    for c in range(k):
        after[:, c], before[:, c] = pairs[:, cls == c].sum(axis=1), pairs[cls == c].sum(axis=0)
    got = class_lm.gains(matrix(cls), after, before, np.diag(pairs).astype(float), cls)
    for u in range(units):
        for c in range(k):
            moved = cls.copy()
            moved[u] = c
            want = class_lm.likelihood(matrix(moved)) - class_lm.likelihood(matrix(cls))
            assert got[u, c] - got[u, cls[u]] == pytest.approx(want, abs=1e-6)


def test_exchange_finds_the_generating_classes(spark):
    """Words drawn from a chain of five word classes: the likelihood reached is near that of
    those classes, and far from that of random ones."""
    rng = np.random.default_rng(4)
    jump = rng.dirichlet([0.15] * 5, 5)
    texts = []
    for _ in range(400):
        c, out = int(rng.integers(5)), []
        for _ in range(25):
            out.append(f"c{c}x{min(11, int(rng.geometric(0.25)))}")
            c = int(rng.choice(5, p=jump[c]))
        texts.append((" ".join(out),))
    df = spark.createDataFrame(texts, "text string")
    words = class_lm.count_words(df, groups=4)
    rows = class_lm.neighbours(df, words)
    n = len(words.unit_counts)
    cls, matrix = class_lm.exchange(rows, n, classes=6, sweeps=4)
    true = np.zeros(n, np.int64)
    true[1:words.n_units + 1] = [1 + int(w[1:2]) for w in words.known[:words.n_units]]
    value = lambda c: class_lm.likelihood(class_lm.class_matrix(rows, c, 7))
    best = max(value(np.r_[0, rng.integers(1, 6, n - 1)]) for _ in range(5))
    assert class_lm.likelihood(matrix) > value(true) - 0.25 * (value(true) - best)     # a local optimum


def test_class_lm_long_texts_in_pieces(spark, monkeypatch):
    text = " ".join(f"W{i % 997}" for i in range(3000))
    monkeypatch.setattr(class_lm, "PIECE", 64)
    assert [w for p in class_lm.pieces(text.encode()) for w in p] == _tokens(text)
    assert [w for p in class_lm.pieces(b"x" * 300 + b" y ") for w in p] == [b"x" * 300, b"y"]
    assert list(class_lm.pieces(b"")) == [[]]


def test_class_lm_without_training_rows(spark):
    df, rows = _corpus(spark, 8)
    model = class_lm.fit(df.where("false"), classes=4, groups=8)
    got = class_lm.score(df, model).collect()
    assert len(got) == len(rows) and all(r["n_known"] == 0 and r["base_score"] == 0 and r["score"] < 0 for r in got)
    full = class_lm.fit(df, classes=4, groups=8)
    assert class_lm.score(df.where("false"), full).count() == 0


def test_class_lm_beats_the_unigram_on_held_out_texts(spark):
    got = REGISTRY["op11_class_lm"](spark, "/root/testdata/sf0.001").where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got["s"] > 0.9 * got["b"]


# --- vector codes ---------------------------------------------------------------------


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 40), st.integers(1, 9), st.sampled_from([3, 2 ** 13, 2 ** 26 - 1, 2 ** 27]), st.integers(0, 2 ** 32))
def test_limb_products_are_exact(width, rows, peak, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-peak, peak + 1, (rows, width)), rng.integers(-peak, peak + 1, (5, width))
    want = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b] for r in a]
    assert vector_codes.dots(a, b).tolist() == want
    index, far = vector_codes.nearest(a, b)
    all_far = [[sum((int(x) - int(y)) ** 2 for x, y in zip(r, c)) for c in b] for r in a]
    assert index.tolist() == [d.index(min(d)) for d in all_far] and far.tolist() == [min(d) for d in all_far]
    bits = vector_codes.limb_bits(width)
    for m in vector_codes.limbs(a, bits, int(np.abs(a).max(initial=0))):
        assert width * np.abs(m).max() ** 2 < 2 ** 53


def _brute_codes(rows, parts, entries, rounds):
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])),
                  key=lambda r: (r[0] is None, r[0] or 0, [math.floor(1024 * x) for x in r[1]]))
    ints = [[math.floor(1024 * x) for x in r[1]] for r in kept]
    w = len(ints[0]) // parts
    cut = [[v[p * w:(p + 1) * w] for v in ints] for p in range(parts)]
    books = [[list(v) for v in cut[p][:entries]] for p in range(parts)]

    def best(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return far.index(min(far)), min(far)
    for _ in range(rounds):
        for p in range(parts):
            got = [best(x, books[p])[0] for x in cut[p]]
            for e in range(len(books[p])):
                mine = [x for x, g in zip(cut[p], got) if g == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for i, r in enumerate(kept):
        hit = [best(cut[p][i], books[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{e:02x}" for e, _ in hit), sum(f for _, f in hit)))
    flat = ",".join(str(c) for b in books for v in b for c in v)
    return sorted(out, key=repr), hashlib.sha256(flat.encode()).hexdigest()


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, v int, _row int"


def _vectors(n, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    data = np.round(rng.standard_normal((n, 8)) * scale, 3).astype(np.float32)
    return [(i, data[i].tolist(), None if i % 7 == 0 else i % 3, "c", 1, 2, 3) for i in range(n)]


def test_vector_codes_against_brute_force(spark):
    rows = _vectors(60, 1, 900.0)
    rows += [(7, rows[3][1], 5, None, None, None, None)] + [(100 + i, rows[0][1], 1, "", 0, 0, 0) for i in range(40)]
    rows += [(-1, None, 1, "", 0, 0, 0), (-2, [1.0, None] * 4, 1, "", 0, 0, 0), (-3, [float("nan")] * 8, 1, "", 0, 0, 0),
             (-4, [float("inf")] * 8, 1, "", 0, 0, 0), (None, rows[5][1], None, "", 0, 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = vector_codes.fit(df, entries=10, rounds=4)
    coded = materialize(vector_codes.encode(model), "codes")
    want, sha = _brute_codes(rows, 4, 10, 4)
    got = vector_codes.errors_by(coded).collect()
    assert sorted(((r["_row"]["vec_id"], r["code"], r["error"]) for r in got), key=repr) == want
    assert model.sha256 == sha
    by = {}
    for r in got:
        by[r["_row"]["label"]] = by.get(r["_row"]["label"], 0) + r["error"]
    assert all(r["label_error"] == by[r["_row"]["label"]] for r in got)
    # codes stand for the entries: the error is the distance to the decoded vector
    codes = np.array([[int(r["code"][2 * p:2 * p + 2], 16) for p in range(4)] for r in got])
    ints = {r["_row"]["vec_id"]: r["v"] for r in model.table.collect()}
    back = vector_codes.decode(model, codes)
    for r, v in zip(got, back):
        if r["_row"]["vec_id"] != 7:      # two vectors have that id
            assert int(((np.array(ints[r["_row"]["vec_id"]]) - v) ** 2).sum()) == r["error"]


def test_vector_codes_edge_cases(spark):
    empty = vector_codes.fit(spark.createDataFrame([], SCHEMA))
    coded = materialize(vector_codes.encode(empty), "codes")
    assert vector_codes.errors_by(coded).count() == 0
    assert empty.sha256 == hashlib.sha256(b"").hexdigest()
    one = vector_codes.fit(spark.createDataFrame(_vectors(1, 3), SCHEMA))
    assert [(r["code"], r["error"]) for r in vector_codes.encode(one).collect()] == [("00000000", 0)]
    with pytest.raises(ValueError):
        vector_codes.fit(spark.createDataFrame([(1, [1.0] * 8, 1, "", 0, 0, 0), (2, [1.0] * 4, 1, "", 0, 0, 0)], SCHEMA))
    with pytest.raises(ValueError):
        vector_codes.fit(spark.createDataFrame([(1, [1.0] * 6, 1, "", 0, 0, 0)], SCHEMA))
    with pytest.raises(ValueError):
        vector_codes.fit(spark.createDataFrame([(1, [3e38] * 8, 1, "", 0, 0, 0)], SCHEMA))


# --- fill in the middle ---------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def _brute_fim(key, text, percent=50, spm=80):
    text = text or ""
    u = UNIT.findall(text)
    sha = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(sha[8 * i:8 * i + 8], 16) for i in range(4)]
    lo, hi = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(u), "plain", None, None, text
    p, m, s = "".join(u[:lo]), "".join(u[lo:hi]), "".join(u[hi:])
    if h[3] % 100 < spm:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _fim_rows():
    base = ["", " ", " \t\n", "one", " one", "one ", "  two  words \n\n", "é ü 日本語 x 𝄞 end", "a <P> b", "a < P> b <S",
            "<M>", "x <P", "x <", "P> y", "\x00 nul \x00", "ÿ þ ÿÿ", "a b \x85 c", "tail \x0b\x0c\r", None,
            "w " * 5000, "long" * 40_000, " ".join(f"t{i}" for i in range(20_000)), "<S", "S> <", "a<S b<"]
    return [(None if i % 29 == 28 else i, base[i % len(base)], "o", "f", i) for i in range(400)]


def test_fill_middle_against_brute_force(spark, monkeypatch):
    rows = _fim_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, form string, n int").repartition(3)
    for percent, spm in ((50, 80), (100, 50)):
        got = fill_middle.transform(df, fim_percent=percent, spm_percent=spm).withColumn(
            "back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
        assert len(got) == len(rows)
        for r in got:
            want = _brute_fim(r["_row"]["doc_id"], r["_row"]["text"], percent, spm)
            assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
            assert r["back"] == (r["_row"]["text"] or "")
        assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.transform(df.where("false")).count() == 0


@settings(deadline=None, max_examples=150)
@given(st.lists(st.text(alphabet="ab <>PSM\n\té 𝄞", max_size=30), min_size=1, max_size=6))
def test_fill_middle_pieces(texts):
    import pyarrow as pa
    h = [np.array([hash((t, i)) % 2 ** 32 for t in texts]) for i in range(4)]
    n, form, p, m, out = (c.to_pylist() for c in fill_middle.cut(pa.array(texts, pa.large_string()), h, 101, 50))
    for i, t in enumerate(texts):
        u = UNIT.findall(t)
        assert n[i] == len(u)
        if form[i] == "plain":
            assert out[i] == t and p[i] is None
            continue
        lo, hi = sorted(int(x[i]) % (len(u) + 1) for x in h[:2])
        assert (p[i], m[i]) == (len("".join(u[:lo])), len("".join(u[lo:hi])))
        _, x, y, z = re.split("<[PSM]>", out[i])
        assert (x + z + y if form[i] == "psm" else y + z + x) == t


def test_fill_middle_slices():
    assert fill_middle.slices(np.array([5, 5, 20, 1, 1]), 10) == [(0, 2), (2, 3), (3, 5)]
    assert fill_middle.slices(np.array([], np.int64)) == []
    assert fill_middle.slices(np.array([0, 0, 0]), 1) == [(0, 3)]


def test_null_columns(spark):
    none = spark.createDataFrame([(None, None)], "doc_id long, text string")
    r = fill_middle.transform(none).first()
    assert (r["n"], r["form"], r["output"]) == (0, "plain", "")
