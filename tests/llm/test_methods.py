"""The operators against brute force, held-out labels, planted cases and DuckDB."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline as P
from revlens.llm import (decontamination, html_extract, language_id, line_dedup, mixing, ngram_join, quality_fm,
                         quality_rules, url_rules)
from revlens.llm.common import ascii_lower, connected_components, read
from revlens.llm.registry import ORACLE, REGISTRY
from revlens.session import materialize

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = REGISTRY[name](spark, SF001)
    res = con.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(map(repr, res.fetchall()))
    assert sorted(repr(tuple(r)) for r in got.select(*names).collect()) == want


def test_ascii_lower_changes_a_to_z_only(spark):
    points = [c for c in range(1, 0x1FFFF) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, f"x{chr(c)}Y") for c in points], "c long, t string")
    low = {r["c"]: r["l"] for r in df.select("c", ascii_lower(F.col("t")).alias("l")).collect()}
    for c in points:
        ch = chr(c)
        assert low[c] == "x" + (ch.lower() if "A" <= ch <= "Z" else ch) + "y"


def test_components_on_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000, 1000 + i) for i in range(1, 300)] \
        + [(2000 + i, 2001 + i) for i in range(60)]
    parent = {}
    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_language_accuracy_on_held_out(spark):
    got = REGISTRY["op1_language_id"](spark, SF01).join(read(spark, SF01, "documents").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got.collect())
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97
    assert np.mean([r["rejected"] for r in rows]) < 0.02


def test_language_sees_whole_long_text(spark):
    docs = read(spark, SF01, "documents").where("text is not null and lang is not null")
    model = language_id.fit(docs)
    enc = language_id._encoders(model)
    base = docs.where("lang = 'en'").orderBy("doc_id").limit(5).select(language_id.letter_words(F.col("text"))).collect()
    tail = docs.where("lang = 'de'").orderBy("doc_id").limit(60).select(language_id.letter_words(F.col("text"))).collect()
    mixed = base[0][0] + " " + " ".join(r[0] for r in tail)
    assert language_id.decide(mixed, enc, model.languages)[0] == "de"


def test_quality_held_out(spark):
    got = REGISTRY["op4_quality_fm"](spark, SF01).join(read(spark, SF01, "labels").select("doc_id", "quality"), "doc_id")
    rows = got.where("held_out").collect()
    pos = [r["score"] for r in rows if r["quality"] == 1]
    neg = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([a > b for a in pos for b in neg]) > 0.93


def test_factor_identity():
    rng = np.random.default_rng(1)
    size = (1 << quality_fm.BITS) + quality_fm.STAT_SLOTS
    fm = quality_fm.FactorMachine(0.3, rng.standard_normal(size), rng.standard_normal((size, 4)))
    ids = [np.array([3, 99, 1 << 16]), np.array([5, (1 << 16) + 7])]
    flat, x, starts = quality_fm.batch(ids)
    z, _ = fm.margin(flat, x, starts)
    at = 0
    for k, row in enumerate(ids):
        xs = x[at:at + len(row)].astype(float)
        pairs = sum(fm.factors[row[i]] @ fm.factors[row[j]] * xs[i] * xs[j]
                    for i in range(len(row)) for j in range(i + 1, len(row)))
        assert z[k] == pytest.approx(0.3 + (fm.linear[row] * xs).sum() + pairs, abs=1e-4)
        at += len(row)


def test_ablation_counts(spark):
    rows = quality_rules.ledger(read(spark, SF001, "documents"))
    masks = [r["failed"] for r in rows.select("failed").collect()]
    for r in quality_rules.ablation(rows, "v2").collect():
        bit = quality_rules.BIT[r["rule"]]
        assert r["n_failed"] == sum(bool(m & bit) for m in masks)
        assert r["n_failed_alone"] == sum(m == bit for m in masks)
        assert r["n_kept_without"] == sum(not (m & ~bit) for m in masks)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_common_lines_is_a_longest_common_subsequence(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    got = html_extract.common_lines(a, b)
    assert len(got) == best[-1][-1] and got == sorted(set(got))
    it = iter(b)
    assert all(any(a[i] == y for y in it) for i in got)


def test_page_differencing_deletes_the_template(spark):
    def page(own):
        return ("<html><body><div>Site name</div><p>About us</p>" + "".join(f"<p>{x}</p>" for x in own)
                + "<div>Contact</div><p>Imprint</p></body></html>")
    rows = [(i, f"https://h.com/a/{i}", page([f"own {i} one", f"own {i} two"])) for i in range(40)]
    rows += [(100, "https://lone.com/", page(["only"])), (101, "https://h.com/a/0", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    got = {r["_row"]["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert all(got[i] == f"own {i} one\nown {i} two" for i in range(40))
    assert got[101] == got[0] and got[100] == "Site name\nAbout us\nonly\nContact\nImprint"


def test_pages_are_compared_in_small_batches(spark, monkeypatch):
    """Both steps that hold the lines of many pages in Python at once run on small batches."""
    key, plain, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", html_extract.materialize, {}

    def noted(df, name, *more, **kw):
        rows[name] = int(df.sparkSession.conf.get(key))
        return plain(df, name, *more, **kw)

    monkeypatch.setattr(html_extract, "materialize", noted)
    before = spark.conf.get(key)
    pages = [(i, f"https://h.com/{i}", f"<div>Site</div><p>own {i}</p>") for i in range(6)]
    got = html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert sorted(r["text"] for r in got) == [f"own {i}" for i in range(6)]
    assert max(rows["page-lines"], rows["class-lines"]) <= html_extract.BATCH <= 256 and spark.conf.get(key) == before


def test_page_chrome_and_blocks():
    page = """<!doctype html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body class="has-sidebar">
      <header><h1>Site</h1></header><nav><ul><li>Home</ul></nav><div class="cookie-notice">We use cookies</div>
      <article><h1>A &lt;b&gt; title</h1><p>One <b>two<br>three</b> <span class="ad">buy</span> four&nbsp;five
      <p>Second&#33;<form><input><button>Go</button></form><table><tr><td>x<td>y</table>
      <section class="comments"><p>First!</p></section></article>
      <aside>Side</aside><footer>&copy;</footer></body></html>"""
    assert html_extract.main_text(html_extract.page_lines(page)) == "A <b> title\nOne two three four five\nSecond!\nx\ny"


def _texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    return {r["_row"]["page_id"]: r["text"] for r in html_extract.extract(df).collect()}


def test_copies_meet_the_nearest_different_page(spark):
    def page(own):
        return f"<body><div>Site name</div><p>{own}</p><p>Imprint</p></body>"
    rows = [(i, f"https://h.com/copies/{i:02}", page("copied")) for i in range(20)]
    rows += [(50, "https://h.com/other", page("other")), (60, "https://k.com/x", page("copied"))]
    rows += [(51, "https://h.com/copies/99", "<body><article><div>Site name</div><p>copied</p><p>Imprint</p></article></body>")]
    got = _texts(spark, rows)
    assert all(got[i] == "copied" for i in range(20)) and got[50] == "other"
    assert got[60] == got[51] == "Site name\ncopied\nImprint"


def test_differencing_of_declared_lines(spark):
    def host(name, body, n=8):
        return [(name * 100 + i, f"https://h{name}.com/a/{i}", f"<body><div>Site</div>{body(i)}<p>Imprint</p></body>")
                for i in range(n)]
    words = ["w" + chr(97 + k) for k in range(20)]
    rows = host(1, lambda i: f"<article><div class=x>Read our rules</div><p>Own text {i} of this page</p><p>Team</p></article>")
    rows += host(2, lambda i: f"<main><div><div>Home</div><div>Shop</div></div><h1>T{i}</h1><p>Own text {i} here</p></main>")
    rows += host(3, lambda i: f"<div>Body one of page {i}</div><article><p>Card {i}</p></article><div>Body two of {i}</div>")
    # near copies keep what they share; so does a line that one other page quotes
    rows += host(4, lambda i: "<article>" + "".join(f"<p>{w} line{i if k == i else ''}</p>" for k, w in enumerate(words))
                 + "</article>")
    rows += host(5, lambda i: f"<article><p>Quote {i // 2}</p><p>Own text {i} of this page</p></article>")
    got = _texts(spark, rows)
    for i in range(8):
        assert got[100 + i] == f"Own text {i} of this page"
        assert got[200 + i] == f"T{i}\nOwn text {i} here"
        assert got[300 + i] == f"Body one of page {i}\nCard {i}\nBody two of {i}"
        assert got[400 + i].count("\n") == 19
        assert got[500 + i] == f"Quote {i // 2}\nOwn text {i} of this page"


@pytest.mark.parametrize("page, want", [
    ("<div><p>Body text half one short</p></div><article><p>Body text half two, which is the longer half</p></article>",
     "Body text half one short\nBody text half two, which is the longer half"),
    ("<article><p>One</p><section id=share-prices><p>Prices</p></section><div class=related-work><p>Work</p></div>"
     "<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.</p><div class='notice-period'>Three months</div></article>",
     "One\nPrices\nWork\nSo x=2.\nThree months"),
    ("<article><p>One</p><div class=share>Share</div><div class='social'>x</div><div class=sidebar-left>y</div>"
     "<div id=cookie-bar>z</div><p>Two</article>", "One\nTwo"),
])
def test_open_lines_and_content_names_stay(page, want):
    assert html_extract.main_text(html_extract.page_lines(page)) == want


@pytest.mark.parametrize("page, want", [
    ("<article><p class=notice>Cookies<p>Real one</p><p>Real two</p></article>", "Real one\nReal two"),
    ("<article><p class=ad>Buy <b>now<h2>Title</h2><p>Real</article>", "Title\nReal"),
    ("<main><ul><li class=share>Share<li>One<ul><li class=promo>x<li>Two</ul><li>Three</ul></main>", "One\nTwo\nThree"),
    ("<main><ul><li>One<div class=menu><ul><li>x</ul></div><li>Two</ul></main>", "One\nTwo"),
    ("<main><dl><dt class=ad>Buy<dd>Real<dt>Name<dd class=promo>x<dt>Last</dl></main>", "Real\nName\nLast"),
    ("<article><table><tr class=ad><td>Buy<td>now<tr><td class=promo>x<td>Real</table><p>After</article>",
     "Real\nAfter"),
    ("<article><table><thead class=banner><tr><th>x<tbody><tr><td>Real</table></article>", "Real"),
    ("<!doctype html><head><title>T</title><meta charset=utf-8><body><article><p>Real</article>", "Real"),
    ("<head><title>T</title><p>Open", "Open"),
    ("<article><p class=notice>x<table><tr><td><p>y</table>z<p>Real</article>", "y\nz\nReal"),
])
def test_omitted_end_tags(page, want):
    assert html_extract.main_text(html_extract.page_lines(page)) == want


def test_mix_reaches_targets(spark):
    rows = mixing.mix(read(spark, SF01, "documents"), carry=["doc_id", "source"]).collect()
    own, taken, goal = Counter(), Counter(), {}
    for r in rows:
        s = r["_row"]["source"]
        own[s] += r["size"]
        taken[s] += r["size"] * r["copies"]
        goal[s] = r["target"]
        assert r["source_size"] is not None and r["copies"] in (0, 1, 2)
    total, weight = 1.5 * sum(own.values()), {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(own))}
    want, free = {}, set(own)
    while True:   # weights share what capped sources leave
        left = total - sum(want.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * own[s]}
        if not over:
            want |= share
            break
        want |= {s: 2.0 * own[s] for s in over}
        free -= over
    for s in own:
        assert goal[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= max(60, 0.01 * want[s])


def test_dual_says_so_when_it_is_not_solved(spark):
    hist = spark.createDataFrame([("a", z, n) for z, n in ((1, 50), (5, 40), (20, 10), (300, 2))], "source string, size long, n long")
    goal = spark.createDataFrame([("a", 700.0)], "source string, target double")
    with pytest.raises(mixing.NotConverged):
        mixing.multipliers(hist, goal, steps=1)


def test_dual_is_an_exponential_tilt(spark):
    hist = spark.createDataFrame([("a", z, n) for z, n in ((1, 50), (5, 40), (20, 10), (300, 2))], "source string, size long, n long")
    own = sum(z * n for z, n in ((1, 50), (5, 40), (20, 10), (300, 2)))
    for share in (0.3, 0.9, 1.0, 1.4, 1.97, 2.0):
        goal = spark.createDataFrame([("a", float(own * share))], "source string, target double")
        r = mixing.multipliers(hist, goal).first()
        rate = {z: min(2.0, np.exp(min(r["lam"] * z / r["scale"], 30))) for z in (1, 5, 20, 300)}
        got = 50 * rate[1] + 200 * rate[5] + 200 * rate[20] + 600 * rate[300]
        assert got == pytest.approx(own * share, rel=1e-6)


def test_mined_rules_match_by_index(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        host, lang = rng.choice(["good.com", "farm.net", "c.org"]), rng.choice(["en", "de"])
        rows.append((f"https://{host}/{lang}/{i}", host == "farm.net" and lang == "de"))
    df = spark.createDataFrame(rows, "url string, bad boolean")
    rules = url_rules.mine(df, min_support=0.02)
    sets = [set(r["rule_tokens"]) for r in rules.collect()]
    assert sets and all("seg=de" in s for s in sets) and all(not (a < b) for a in sets for b in sets)
    got = url_rules.judge(df, rules, rules=()).select("_row.url", "_row.bad", "verdict").collect()
    assert all((r["verdict"] == "block") == r["bad"] for r in got)


def test_mined_rules_equal_brute_force(spark):
    """Every token combination counted: those with support, pages, confidence and lift, none inside another."""
    from itertools import combinations
    r = random.Random(11)
    rows = []
    for i in range(150):
        host, seg, sub = r.choice("ab"), r.choice(["x", "y", "z"]), r.choice(["p", "q"])
        bad = (r.random() < 0.95) if (host, seg) == ("a", "x") or sub == "q" and seg == "z" else r.random() < 0.1
        rows.append((f"http://{host}.com/{seg}/{sub}", bad))
    df = spark.createDataFrame(rows, "url string, bad boolean")
    sets = [(frozenset(t["t"]), t["bad"]) for t in df.select(url_rules.tokens(F.col("url")).alias("t"), "bad").collect()]
    for min_support, min_pages in ((0.02, 5), (0.02, 14), (0.2, 3), (0.02, 151)):
        count, blocked = Counter(), Counter()
        for tokens, bad in sets:
            for k in range(1, len(tokens) + 1):
                for c in combinations(sorted(tokens), k):
                    count[frozenset(c)] += 1
                    blocked[frozenset(c)] += bad
        share = sum(bad for _, bad in sets) / len(sets)
        good = {c for c, n in blocked.items() if n >= min_pages and n / len(sets) >= min_support
                and n / count[c] >= 0.8 and n / count[c] > share}
        want = {c: blocked[c] for c in good if not any(o < c for o in good)}
        got = {frozenset(x["rule_tokens"]): x["pages"] for x in
               url_rules.mine(df, min_support=min_support, min_pages=min_pages).collect()}
        assert got == want and (bool(got) or min_support > 0.1 or min_pages > 150)


def test_few_labels_give_no_rule(spark):
    rows = [(f"http://h{i}.com/a{i}/b{i}", True) for i in range(19)] + [("http://ok.com/", False)] * 60
    assert url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean")).count() == 0


def _shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_join_loses_no_link(spark, n, percent):
    """Families of near copies around the threshold, one of them large."""
    rng = random.Random(n)
    vocab = [f"t{i}" for i in range(400)]
    rows, k = [], 0
    for size in [2] * 25 + [5] * 8 + [120]:
        base = [rng.choice(vocab) for _ in range(rng.randrange(20, 120))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((k, " ".join(w)))
            k += 1
    rng.shuffle(rows)
    sets = {i: _shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    got = ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), n=n, percent=percent).collect()
    assert {r["doc"]: (r["n_shingles"], r["component"]) for r in got} == {i: (len(sets[i]), find(i)) for i in ids}


def test_link_drops_tables_that_are_no_longer_read(spark):
    """Texts, postings and the rounds of the components go as soon as their successors are written."""
    import os
    from revlens import session
    before = len(session._WRITTEN)
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(i, base + f" {i % 3}") for i in range(30)] + [(i, f"{i} own words only") for i in range(30, 40)]
    got = ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), n=3, percent=80)
    left = {os.path.basename(p).rsplit("-", 1)[0] for _, p in session._WRITTEN[before:]}
    assert {r["component"] for r in got.collect()} == {0, *range(30, 40)}
    assert not left & {"sets", "centres", "postings", "grouped", "rest", "pair-ids", "pair-texts", "components-low", "components-large"}


def test_proximity(spark):
    texts = {1: "alpha beta gamma delta", 2: "gamma x beta y alpha z delta", 3: "alpha " + "x " * 40 + "beta gamma delta",
             4: "alpha beta gamma"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = decontamination.benchmark_items(spark.createDataFrame([(7, "alpha beta gamma delta")], "item_id long, text string"))
    rare = decontamination.rare_terms(items, decontamination.document_frequency(docs, items), k=4)
    index = decontamination.postings(docs, rare)
    got = {(r["doc"], r["first"], r["last"]) for r in decontamination.proximity_hits(index, rare, slop=8).collect()}
    assert got == {(1, 0, 3), (2, 0, 6)}


def test_proximity_against_brute_force(spark):
    """Every window's three rarest terms in every span of fewer than 6 words, random texts over few words."""
    r = random.Random(3)
    words = [f"w{i}" for i in range(9)]
    docs = {i: [r.choices(words, weights=range(1, 10))[0] for _ in range(r.randrange(0, 60))] for i in range(60)}
    texts = [(i, " ".join(t)) for i, t in docs.items()] + [(None, " ".join(docs[1])), (61, None)]
    items = {10: docs[3][:20], 11: ["w0", "w1"], 12: ["w0", "zz", "w1"], 13: ["w2"], 14: [], 15: r.choices(words, k=15)}
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    got = {x["_row"]["doc_id"]: x["n_near"] for x in decontamination.report(df, bench, window=5, slop=6).collect()}
    count = Counter(w for _, t in texts if t for w in t.split())
    want = Counter()
    for t in items.values():
        z = min(5, len(t))
        sets = set()
        for i in range(len(t) - z + 1) if t else ():
            window = t[i:i + z]
            if all(count[w] for w in window):
                sets.add(frozenset(sorted(set(window), key=lambda w: (count[w], window.index(w)))[:3]))
        for d, doc in docs.items():
            want[d] += any(s <= set(doc[p:p + 6]) for s in sets for p in range(len(doc)))
    assert got.pop(None) == 0 and got.pop(61) == 0
    assert got == {d: want[d] for d in docs} and len(set(got.values())) > 2


def test_pipeline_against_stages_by_hand(spark):
    docs = {r["doc_id"]: r for r in read(spark, SF001, "documents").collect()}
    out = docs
    frame = read(spark, SF001, "documents")
    for name, stage in P.STAGES[:-1]:
        frame = materialize(stage(spark, frame, SF001), "stage")
        kept = {r["doc_id"]: r for r in frame.collect()}
        assert set(kept) <= set(out)
        if name == "language_id":
            assert len(kept) >= 0.97 * len(docs)
        if name == "line_dedup":
            assert set(kept) == set(out) and all(kept[i]["n_chars"] == len(kept[i]["text"]) for i in kept)
        if name == "ngram_join":
            groups = defaultdict(set)
            for i, r in out.items():
                groups[frozenset(_shingles(r["text"], 5)) or i].add(i)
            assert all(len(g & set(kept)) <= 1 for g in groups.values())
        out = kept
    mixed = P.run(spark, SF001).collect()
    assert {r["doc_id"] for r in mixed} <= set(out) and all(r["copy"] in (1, 2) for r in mixed)
    assert all(r["text"] == out[r["doc_id"]]["text"] for r in mixed)


def test_line_ratio_brute_force(spark):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in read(spark, SF01, "documents").collect()]
    pages = defaultdict(set)
    for _, s, t in rows:
        pages[s].add(t)
    count = Counter((s, x) for s in pages for t in pages[s] for x in set(t.split("\n")) if x.strip(" \t\n\x0b\x0c\r"))
    got = {r["_row"]["doc_id"]: r["text"] for r in line_dedup.dedup_lines(read(spark, SF01, "documents")).collect()}
    for i, s, t in rows:
        keep = [x for x in t.split("\n") if not (len(pages[s]) >= 10 and count[s, x] > 0.1 * len(pages[s]))]
        assert got[i] == "\n".join(keep)
