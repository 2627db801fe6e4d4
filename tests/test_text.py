"""F1-F8: cleaners against expected strings written by hand."""
import re

from pyspark.sql import functions as F

from revlens.functions import text as T

# raw, light, heavy, words, blank
CASES = [
    ("Don't <br />like", "Don't like", "don t like", 3, False),
    ("tag <b\nspanning> lines", "tag lines", "tag lines", 4, False),
    ("5<6 and 7>2", "5 2", "5 2", 3, False),
    ("!!!???", "!!!???", "", 1, False),
    ("", "", "", 0, True),
    ("   ", "", "", 0, True),
    ("a\u2003b\u0085c\x1cd\u3000e", "a b c d e", "b c d e", 5, False),
    ("<P>THE Cat IS <I>here</I>", "THE Cat IS here", "cat here", 4, False),
    ("Caf\u00e9 na\u00efve", "Caf\u00e9 na\u00efve", "caf na ve", 2, False),
    ("tabs\tand\nnewlines\r\n", "tabs and newlines", "tabs newlines", 3, False),
    ("x\u200by", "x\u200by", "x y", 1, False),
    ("trailing <open", "trailing <open", "trailing open", 2, False),
]


def test_cleaners_on_expected_strings(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, t string")
    rows = df.select("i", T.light_clean("t").alias("l"), T.heavy_clean("t").alias("h"),
                     T.word_count("t").alias("wc"), T.is_blank("t").alias("b")).collect()
    for r in rows:
        assert (r["l"], r["h"], r["wc"], r["b"]) == CASES[r["i"]][1:], CASES[r["i"]]


def test_word_count_null_is_zero(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(T.word_count("t")).first()[0] == 0


def test_has_alnum_ascii_only(spark):
    df = spark.createDataFrame([("Привет",), ("5",), ("!!",)], "t string")
    assert [r[0] for r in df.select(T.has_alnum("t")).collect()] == [False, True, False]


def test_bigrams_short_arrays(spark):
    df = spark.createDataFrame([("",), ("ab",), ("ab cd ef",)], "t string")
    out = [r[0] for r in df.select(T.ngrams(T.tfidf_tokens("t"), 2)).collect()]
    assert out == [[], ["ab"], ["ab", "cd", "ef", "ab cd", "cd ef"]]


def test_sql_functions(spark):
    T.register_sql_functions(spark)
    r = spark.sql("SELECT light_clean('<br />The packaging   was   fine.<br /> Tastes great!') AS l, "
                  "heavy_clean('The <b>Cat</b> is here') AS h").first()
    assert r["l"] == "The packaging was fine. Tastes great!"
    assert r["h"] == "cat here"
    df = spark.createDataFrame([(c[0],) for c in CASES], "t string")
    got = [r[0] for r in df.select(F.expr("heavy_clean(t)")).collect()]
    assert got == [c[2] for c in CASES]


def test_whitespace_class_equals_python_everywhere(spark):
    s = "".join(chr(c) for c in range(1, 0x110000) if not (0xD800 <= c <= 0xDFFF))
    df = spark.createDataFrame([(s,)], "t string")
    got = df.select(F.regexp_replace("t", T.WS_RUN, "#")).first()[0]
    assert got == re.sub(r"\s+", "#", s)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_ALPHABET = st.sampled_from(list("abcXYZ09 <>/!?'.,\t\n") + [" ", " ", "\u0085", "\x1c",
                                                             "　", "é", "Ж", "​", "ß"])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=_ALPHABET, max_size=40), min_size=1, max_size=8))
def test_cleaners_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", T.light_clean("t").alias("l"), T.heavy_clean("t").alias("h"),
                       T.word_count("t").alias("wc")).collect():
        s = texts[r["i"]]
        assert r["wc"] == len(s.split()) and r["l"] == " ".join(r["l"].split())
        assert not re.search("<[^>]+>", r["l"]) or "<" in re.sub("<[^>]+>", " ", s)
        tokens = r["h"].split(" ") if r["h"] else []
        assert all(re.fullmatch("[a-z0-9]+", w) and w not in T.STOPWORDS for w in tokens)
        assert [w for w in re.findall("[a-z0-9]+", r["l"].lower()) if w not in T.STOPWORDS] == tokens


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from([*T.STOPWORDS, "The", "ab", "i9", "a1", "thea"]), st.text(alphabet=_ALPHABET, max_size=6)),
                         max_size=7).map(lambda parts: " ".join(parts)), min_size=1, max_size=8))
def test_has_heavy_token_is_heavy_text_not_empty(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(r["a"] == (r["h"] != "") for r in df.select(T.has_heavy_token("t").alias("a"), T.heavy_clean("t").alias("h")).collect())


def test_trigrams(spark):
    df = spark.createDataFrame([("ab cd ef gh",), ("ab",)], "t string")
    out = [r[0] for r in df.select(T.ngrams(T.tfidf_tokens("t"), 3)).collect()]
    assert out == [["ab", "cd", "ef", "gh", "ab cd", "cd ef", "ef gh", "ab cd ef", "cd ef gh"], ["ab"]]


def test_decode_label(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "c int")
    assert [r[0] for r in df.select(T.decode_label("c")).collect()] == ["negative", "positive", None]
