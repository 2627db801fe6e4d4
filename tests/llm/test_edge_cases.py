"""Every operator and pipeline stage on awkward rows: nulls in any column, empty and
very long texts, ties, repeated rows, clashing extra columns, and empty tables."""

import textwrap

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from revlens.llm import (decontamination, html_extract, language_id, license_scan, line_dedup, mixing, ngram_join,
                         quality_fm, quality_rules, url_rules)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, _t string, host string, failed long, h long, size long, text_2 string")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def _row(i, text, lang="en", source="a"):
    return (i, text, lang, source, len(text) if text is not None else None, 1.0, "t", "h", 9, 5, 7, "z")


@pytest.fixture(scope="module")
def hard(spark):
    body = "the quick brown fox jumps over the lazy dog and runs far away from here " * 3
    rows = [_row(1, body), _row(2, body), _row(2, body), _row(3, None), _row(4, ""), _row(5, " \t\n "),
            _row(6, LONG), _row(7, "ein kurzer satz mit wenigen worten", "de", None), _row(8, "un deux", "fr", "b"),
            _row(9, "X", None, "b"), _row(None, "a row without any id at all", None, None),
            _row(None, None, None, None), _row(10, "\n\n\n", "en", ""), _row(11, "*** ### !!!", "en", "a"),
            _row(12, "日本語 の 文章 です", "ja", "b"), _row(13, "a a a a a a a a", "en", "a")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("bench")
    spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and runs far away from"),
                           (2, "un deux"), (3, ""), (4, None), (None, "wenigen worten"), (1, "un deux")],
                          "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def test_language_id(spark, hard, none):
    model = language_id.fit(hard)
    assert set(model.languages) <= {"en", "de", "fr", "ja"}
    assert language_id.fit(hard, max_langs=2).languages == ("en", "de")
    marks = hard.limit(1).withColumn("text", F.lit("\u0301\u0302 \u0301")).withColumn("language", F.lit("mine"))
    marks = marks.withColumn("_row", F.lit(1))
    r = language_id.predict(marks, model).first()
    assert r["language"]["lang"] == "und" and r["language"]["rejected"] and r["_row"]["language"] == "mine"
    got = language_id.predict(hard, model).collect()
    assert len(got) == 16
    for r in got:
        letters = any(c.isalpha() for c in (r["_row"]["text"] or ""))
        assert (r["language"]["lang"] == "und") == (not letters)
        assert 0 <= r["language"]["score"] <= 1
    empty = language_id.fit(none)
    assert empty.languages == ()
    assert {r["language"]["lang"] for r in language_id.predict(hard, empty).collect()} == {"und"}
    assert language_id.predict(none, model).count() == 0


def test_quality_rules(hard, none):
    got = {r["_row"]["doc_id"]: r for r in quality_rules.ledger(hard).collect()}
    assert (got[3]["n_words"], got[4]["n_words"], got[5]["n_words"]) == (0, 0, 0)
    assert got[1]["n_repeat_words"] == 45 and got[13]["n_repeat_words"] == 8
    assert got[6]["n_words"] == 30_000 and got[6]["n_repeat_words"] == 0
    assert got[11]["n_symbols"] == 6 and got[10]["n_dup_lines"] == 0
    assert quality_rules.ledger(none).count() == 0
    ablated = {r["rule"]: r for r in quality_rules.ablation(quality_rules.ledger(hard)).collect()}
    assert set(ablated) == set(quality_rules.RULES)
    assert quality_rules.ablation(quality_rules.ledger(none)).count() == 0


def test_license_scan(spark, hard, none):
    assert all(r["found"] == [] for r in license_scan.scan(hard).collect())
    assert license_scan.scan(none).count() == 0
    texts = ["Intro. Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.",
             "Licensed under CC BY-SA 4.0. And more.", "We took no licence from anyone.", LONG + " All rights reserved."]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["_row"]["doc_id"]: set(r["found"]) for r in license_scan.scan(rows).collect()}
    assert got == {0: {"Apache-2.0", "MIT"}, 1: {"CC-BY-SA-4.0"}, 2: set(), 3: set()} or got[3] == {"all-rights-reserved"}
    assert got[0] == {"Apache-2.0", "MIT"} and got[1] == {"CC-BY-SA-4.0"} and got[2] == set()


def test_license_notices_wrapped(spark):
    """Every template on one line, wrapped at 72 columns, and wrapped in a comment."""
    rows, want = [], {}
    for name, notice in license_scan.TEMPLATES:
        lines = textwrap.wrap(notice, 72)
        for text in (notice, "\n".join(lines), "Some title\n\n" + "\r\n".join(textwrap.wrap(notice, 30)) + "\r\n\r\nMore.",
                     "/*\n" + "\n".join(" * " + x for x in lines) + "\n */", "\n".join("# " + x for x in lines)):
            want[len(rows)] = [name]
            rows.append((len(rows), text))
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["_row"]["doc_id"]: r["found"] for r in got} == want


@pytest.mark.parametrize("text, want", [
    ("Licensed under the MIT License and the Apache License, Version 2.0.", {"MIT", "Apache-2.0"}),
    ("Released under the MIT License by X", {"MIT"}),
    ("Released under the MIT License, or licensed under CC BY 4.0 and CC BY-SA 4.0, all rights reserved by 3 owners.",
     {"MIT", "CC-BY-4.0", "CC-BY-SA-4.0", "all-rights-reserved"}),
    ("Licensed under CC BY-SA 4.0 and CC BY 4.0", {"CC-BY-SA-4.0", "CC-BY-4.0"}),
    ("Licensed under CC-BY-NC 4.0", {"CC-BY-NC-4.0"}), ("Licensed under CC BY-NC-SA 4.0", set()),
    ("Licensed under CC BY 4.0 NC", set()), ("Licensed under CC BY 3.0", set()),
    ("Licensed under the Apache License, Version 1.1, see 2.0", set()),
    ("This work is licensed under the GNU General Public License, version 2 or version 3.", {"GPL-2.0", "GPL-3.0"}),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", {"LGPL-3.0"}),
    ("SPDX-License-Identifier: MIT", {"MIT"}), ("SPDX-License-Identifier: (MIT OR Apache-2.0)", {"MIT", "Apache-2.0"}),
    ("SPDX-License-Identifier: GPL-3.0-or-later", {"GPL-3.0"}), ("SPDX-License-Identifier: LGPL-2.1-only", {"LGPL-2.1"}),
    ("The MIT License (MIT)", {"MIT"}), ("Licensed under the Apache-2.0 license", {"Apache-2.0"}),
    ("Released under the BSD 3-Clause License", {"BSD-3-Clause"}), ("under the terms of the GNU GPL v3", {"GPL-3.0"}),
    ("This work is not licensed under the MIT License.", set()), ("It isn't released under the MIT License.", set()),
    ("This is no fork, it is licensed under the MIT License.", {"MIT"}),
    ("Never released under the ISC License, but licensed under CC BY 4.0", {"CC-BY-4.0"}),
    ("This project is not licensed under the Apache License, Version 2.0, it is licensed under the MIT License.", {"MIT"}),
    ("Licensed under the GNU AGPL v3", {"AGPL-3.0"}), ("Licensed under the GNU LGPL v2.1 or the GNU GPL v2", {"LGPL-2.1", "GPL-2.0"}),
    ("This work is licensed under the GNU General Public License, version 2, or under the Mozilla Public License. "
     "This Source Code Form is subject to the terms of the Mozilla Public License, v2.0.", {"GPL-2.0", "MPL-2.0"}),
    ("All contributors think some rights are reserved", set()), ("Released under the MIT-0 License", set()),
])
def test_every_license_of_a_block(text, want):
    scanner = license_scan.Scanner()
    every = license_scan.Scanner(min_saved=-(1 << 20))
    for block in (text, "word " * 300 + text + " word" * 300):
        best, sure = scanner.scan(block)
        # the reduction cuts off no template that the wording confirms
        assert {m[0] for m in every.scan(block)[1]} == want
        assert {m[0] for m in sure} == want and best[5] == bool(want)
    assert all(name in {m[0] for m in scanner.scan(notice)[1]} for name, notice in license_scan.TEMPLATES)


def test_license_order_is_by_reduction(spark):
    """Compression decides what is compared: no reduction, no match; and the block's own template saves most."""
    assert license_scan.Scanner(min_saved=1 << 20).scan("Released under the MIT License.")[1] == []
    scanner = license_scan.Scanner()
    import random
    r = random.Random(5)
    for i, (name, notice) in enumerate(license_scan.TEMPLATES):
        noise = lambda: " ".join("".join(r.choices("abcdefghijklmnop", k=r.randrange(2, 9))) for _ in range(300))
        for block in (notice, f"{noise()} {notice} {noise()}", f"{noise()} {noise()}, {notice}"):
            saved = {-t: s for s, _, t in scanner.ranked(block, license_scan._spans(block))}
            assert saved[i] >= 2 * license_scan.MIN_SAVED
        best = scanner.ranked(notice, license_scan._spans(notice))
        assert -best[0][2] == i or best[0][0] == {-t: s for s, _, t in best}[i]


def test_quality_fm(hard, none):
    rows = hard.select("doc_id", quality_fm.features(F.col("text"), {"n": F.col("n_chars")}).alias("features"),
                       (F.col("doc_id") % 2).alias("label"))
    model = quality_fm.fit(rows)
    scores = [r["score"] for r in quality_fm.score(rows, model).collect()]
    assert len(scores) == 16 and all(0 <= s <= 1 for s in scores)
    clash = quality_fm.score(rows.withColumn("score", F.lit("mine")), model).first()
    assert clash["_row"]["score"] == "mine" and 0 <= clash["score"] <= 1
    one_kind = quality_fm.fit(rows.withColumn("label", F.lit(1)))
    assert all(r["score"] > 0.99 for r in quality_fm.score(rows, one_kind).collect())
    nothing = quality_fm.fit(rows.where("false"))
    assert {round(r["score"], 6) for r in quality_fm.score(rows, nothing).collect()} == {0.5}
    assert quality_fm.score(rows.where("false"), model).count() == 0


def test_html_extract(spark):
    page = "<html><body><article><p>Kept &amp; read.</p></article></body></html>"
    rows = [(1, "https://a.b/x", page), (1, "https://a.b/x", page), (2, None, None), (None, "nourl", ""),
            (3, "https://a.b/y", "<p>open &lt;tag"), (4, "https://a.b/z", "<p>" + "word " * 50_000),
            (5, "https://a.b/q", "<!-- never closed <p>x"), (6, "https://c.d/", "text only")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    clash = df.select("*", *[F.lit("mine").alias(c) for c in ("text", "page", "host", "path", "deleted", "same", "part", "i", "_row")])
    assert sorted(r["text"] for r in html_extract.extract(clash).collect()) == sorted(
        r["text"] for r in html_extract.extract(df).collect())
    got = [(r["_row"]["page_id"], r["text"]) for r in html_extract.extract(df).collect()]
    assert len(got) == len(rows) and got.count((1, "Kept & read.")) == 2
    texts = dict(got)
    assert texts[2] == "" and texts[None] == "" and texts[5] == "" and texts[6] == "text only"
    assert texts[3] == "open <tag" and len(texts[4]) == 5 * 50_000 - 1
    assert html_extract.extract(df.where("false")).count() == 0


def test_mixing(hard, none):
    got = mixing.mix(hard).collect()
    assert len(got) == 16
    for r in got:
        assert 0 <= r["copies"] <= 2 and (r["size"] > 0 or r["copies"] == 0)
    assert {r["_row"]["source"] for r in got} == {"a", "b", "", None}
    assert all(r["target"] is not None and r["target"] <= 2 * r["source_size"] for r in got)
    assert mixing.mix(none).count() == 0
    again = mixing.mix(hard.repartition(5)).collect()
    def key(rows):
        return sorted((str(r["_row"]["doc_id"]), r["size"], r["copies"]) for r in rows)
    assert key(got) == key(again)


def test_line_dedup(spark, hard, none):
    assert line_dedup.dedup_lines(none).count() == 0
    kept = {r["_row"]["doc_id"]: r for r in line_dedup.dedup_lines(hard).collect()}
    assert kept[3]["text"] is None and kept[4]["text"] == "" and kept[6]["text"] == LONG
    rows = [(i, "s", f"menu\nown line {i}\n\nmenu") for i in range(12)] + [(i, None, f"menu\nx {i}") for i in range(12, 30)] \
        + [(99, "s", "menu\nmenu"), (100, "s", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r["_row"]["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[0]["text"] == "own line 0\n" and got[0]["n_dropped"] == 2 and got[0]["n_lines"] == 4
    assert got[99]["text"] == "" and got[100]["text"] is None and got[12]["text"] == "menu\nx 12"


def test_copies_are_no_boilerplate(spark):
    rows = [(i, "s", "one text\nof many copies") for i in range(60)] + [(i, "s", f"other {i}") for i in range(60, 75)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert line_dedup.dedup_lines(df).agg(F.sum("n_dropped")).first()[0] == 0


def test_url_rules(spark):
    urls = [None, "", "no scheme", "https://", "HTTP://ORG", "https://a.org/x", "https://example.org/es/1",
            "http://sub.example.org/en/12?x#y", "https://z.com/fr/", "https://z.com/de/9", "https://org/",
            "https://example.org/es/1", "https://q.net/a//b/%zz?&;=#"]
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    mined = url_rules.mine(df.select("url", F.lit(True).alias("bad")).where("false"))
    long = spark.createDataFrame([(1, "https://example.org/en/1" + "/seg" * 50_000 + "?" + "q=1&" * 20_000, "h", "v")], df.schema)
    r = url_rules.judge(long, mined).first()
    assert (r["verdict"], r["rule"], len(r["path"])) == ("block", "example.org/en/1", 200_005)
    assert mined.count() == 0
    got = {r["_row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(df, mined).collect()}
    assert got[0] == ("", "", None, "allow") and got[2] == ("", "", None, "allow") and got[4] == ("org", "", None, "allow")
    assert got[5] == ("a.org", "/x", "org/", "allow") and got[6][2:] == ("example.org/es/", "block")
    assert got[7] == ("sub.example.org", "/en/12", "example.org/en/1", "block")
    assert got[8][2:] == ("com/fr/", "allow") and got[9][2:] == ("com/de/", "block") and got[10][2:] == ("org/", "allow")
    assert got[11] == got[6]
    assert url_rules.judge(df.where("false"), mined).count() == 0


def test_ngram_join(hard, none):
    got = sorted(((r["doc"], r["n_shingles"], r["component"]) for r in ngram_join.link(hard, n=3, percent=90).collect()),
                 key=str)
    by_id = {d: (n, c) for d, n, c in got}
    assert len(got) == 16
    assert by_id[1][1] == 1 and by_id[2][1] == 1
    assert by_id[3] == (0, 3) and by_id[4] == (0, 4) and by_id[5] == (0, 5) and by_id[8] == (1, 8) and by_id[13] == (1, 13)
    assert ngram_join.link(none).count() == 0


def test_decontamination(spark, hard, none, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {r["_row"]["doc_id"]: r for r in decontamination.report(hard, bench).collect()}
    assert got[1]["contaminated"] and got[1]["n_hit"] > 13 and got[1]["items"] == ["1"]
    assert got[8]["items"] == ["1", "2"] and got[8]["contaminated"]
    assert got[7]["items"] == [""] and got[3]["n_words"] == 0 and not got[3]["contaminated"]
    assert decontamination.report(none, bench).count() == 0
    clean = decontamination.report(hard, bench.where("false")).collect()
    assert len(clean) == 16 and not any(r["contaminated"] for r in clean)


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stage(spark, hard, none, sf, name):
    stage = dict(P.STAGES)[name]
    for docs in (hard, none):
        out = stage(spark, docs, sf)
        extra = ["copy"] if name == "mixing" else []
        assert out.columns == docs.columns + extra
        assert [t for t in out.dtypes if t[0] != "copy"] == docs.dtypes
        rows = out.collect()
        assert docs is hard or not rows
    if name == "ngram_join":
        ids = [r["doc_id"] for r in stage(spark, hard, sf).collect()]
        assert 1 in ids and 2 not in ids and {3, 4, 5, 6, 7, 8}.issubset(ids)


def test_near_duplicate_stage_keeps_one_row_of_a_group(spark, sf):
    a, b, c = ("one two three four five six seven", "red green blue black white grey pink", "just some other words here")
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "y"), (2, a, "x"), (None, a, "x"),      # one group
            (None, b, "x"), (None, b, "x"), (None, b, "y"),                          # null ids only
            (7, c, "x"), (7, c + " and more", "x"), (7, "nothing like the former ones", "x"),
            (9, "", "x"), (9, "", "x"), (None, None, "x"), (None, None, "y"), (10, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = [tuple(r) for r in dict(P.STAGES)["ngram_join"](spark, docs, sf).collect()]
    assert sorted((t or "")[:3] for _, t, _ in got) == ["", "", "", "", "jus", "jus", "not", "one", "red"]
    assert [i for i, t, _ in got if t == a] == [1]
    assert sorted((str(i), t, s) for i, t, s in got if not t) == [
        ("10", "", "x"), ("9", "", "x"), ("None", None, "x"), ("None", None, "y")]
