"""P1-P9, A1-A8 on hand-made rows."""
import pytest

from revlens.operators import quality as Q

SCHEMA = "review_key long, review_text string, rating double"


def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_label_rule_fractional_and_neutral(spark):
    rows = [(i, f"text number {i}", r) for i, r in
            enumerate([0.0, 1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 7.0, None])]
    out = {r["rating"]: r["label"] for r in Q.clean_and_label(df(spark, rows)).collect()}
    assert 3 not in out and None not in out
    assert out[2.5] == 0 and out[3.5] == 0 and out[4] == 1 and out[7] == 1 and out[0] == 0


def test_order_trap_first_copy_neutral_removes_all(spark):
    rows = [(1, "same words here", 3.0), (2, "same words here", 5.0), (3, "other words", 5.0)]
    out = Q.clean_and_label(df(spark, rows)).collect()
    assert [r["review_key"] for r in out] == [3]


def test_blank_and_emptied_rows(spark):
    rows = [(1, "   ", 5.0), (2, None, 5.0), (3, "!!!???", 5.0), (4, "the and of", 1.0),
            (5, "Good <b>stuff</b>", 5.0), (6, " ", 1.0)]
    out = Q.clean_and_label(df(spark, rows)).collect()
    assert [(r["review_key"], r["text_heavy_clean"]) for r in out] == [(5, "good stuff")]
    led = {r["step"]: r["rows_removed"] for r in Q.attrition_ledger(df(spark, rows)).collect()}
    assert led == {"input": 0, "null_text_or_rating": 1, "blank_text": 2, "duplicate_text": 0,
                   "neutral_rating": 0, "empty_after_clean": 2}


def test_validation_report_semantics(spark):
    rows = [(1, None, 5.0), (2, None, None), (3, "a b c", 3.0), (4, "a b c", 7.0),
            (5, " ", 1.0), (6, "x", 2.0)]
    r = Q.validation_report(df(spark, rows)).first().asDict()
    assert r["total_rows"] == 6 and r["null_text_rows"] == 2 and r["null_rating_rows"] == 1
    # groups: NULL, "a b c", " ", "x" -> 4 groups, 2 duplicates
    assert r["duplicate_rows"] == 2
    assert r["empty_text_rows"] == 1          # NULL text is not "empty"
    assert r["invalid_rating_values"] == 1     # 7
    assert (r["positive"], r["negative"], r["neutral_dropped"]) == (2, 2, 2)
    assert (r["length_min"], r["length_max"]) == (0, 3)
    assert abs(r["length_mean"] - (0 + 0 + 3 + 3 + 0 + 1) / 6) < 1e-6   # rounded to 6


def test_gates(spark):
    d = df(spark, [(1, "a", 1.0)])
    with pytest.raises(Q.DataValidationError):
        Q.require_min_rows(d, 2)
    Q.require_min_rows(d, 1)
    with pytest.raises(Q.DataValidationError, match="rating"):
        Q.require_columns(d.drop("rating"))


def test_attrition_golden_arithmetic():
    # 568,454 -> 393,579 -> 363,825 as ledger arithmetic
    before, after_dedup, after_neutral = 568_454, 393_579, 363_825
    assert before - 174_875 == after_dedup
    assert after_dedup - 29_754 == after_neutral


def test_class_shares(spark):
    rows = [(i, f"good text {i}", 5.0 if i % 4 else 1.0) for i in range(40)]
    out = {r["label"]: r for r in Q.class_shares(Q.clean_and_label(df(spark, rows))).collect()}
    assert out[1]["n"] == 30 and out[0]["n"] == 10
    assert out[1]["imbalance_ratio"] == 3.0 and out[1]["majority_accuracy"] == 0.75


def test_extend_training_keeps_first(spark):
    base = Q.clean_and_label(df(spark, [(1, "good tasty snack", 5.0)]))
    new = df(spark, [(2, "good tasty snack", 1.0), (3, "stale and awful", 1.0)])
    out = sorted((r["review_key"], r["label"]) for r in Q.extend_training(base, new).collect())
    assert out == [(1, 1), (3, 0)]


def test_ledger_ends_at_cleaned_count(spark):
    from revlens.sources.tables import dirty_reviews
    from .conftest import SF001
    d = dirty_reviews(spark, SF001)
    led = sorted(Q.attrition_ledger(d).collect(), key=lambda r: r["step_no"])
    assert led[0]["rows_before"] == d.count()
    assert led[-1]["rows_remaining"] == Q.clean_and_label(d).count()
    for a, b in zip(led, led[1:]):
        assert a["rows_remaining"] == b["rows_before"]
