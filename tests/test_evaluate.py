"""Golden arithmetic, brute-force AUC, edge cases."""
import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import evaluate as EV


def scored_from_counts(spark, caught, missed, false_alarms, true_pos):
    """Rows whose prob_neg > 0.5 exactly where the model flags."""
    parts = [(caught, 0.9, 0), (missed, 0.1, 0), (false_alarms, 0.9, 1), (true_pos, 0.1, 1)]
    df = None
    for n, p, lab in parts:
        d = spark.range(n).select(F.lit("m").alias("model"), F.lit(p).alias("prob_neg"),
                                  F.lit(lab).alias("label"))
        df = d if df is None else df.unionByName(d)
    return df


def test_golden_arithmetic(spark):
    # published: 9,499 caught, 1,914 missed, 1,654 false alarms of 72,765 test rows
    tp = 72_765 - 9_499 - 1_914 - 1_654
    m = EV.metric_bundle(scored_from_counts(spark, 9_499, 1_914, 1_654, tp)).first()
    assert round(m["negative_precision"], 4) == 0.8517
    assert round(m["negative_recall"], 4) == 0.8323
    assert round(m["accuracy"], 4) == 0.9510


def brute_auc(rows):
    pos = [1 - p for p, y in rows if y == 1]
    neg = [1 - p for p, y in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_auc_equals_pair_count(spark, seed):
    rnd = random.Random(seed)
    rows = [(round(rnd.random(), 1), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame([("m", p, y) for p, y in rows], "model string, prob_neg double, label int")
    got = EV.roc_auc(df).first()["roc_auc"]
    assert abs(got - brute_auc(rows)) < 1e-12


def test_curve_and_matched_recall(spark):
    rows = [("m", 0.9, 0), ("m", 0.9, 1), ("m", 0.8, 0), ("m", 0.5, 0), ("m", 0.2, 1)]
    df = spark.createDataFrame(rows, "model string, prob_neg double, label int")
    curve = {r["threshold"]: r for r in EV.pr_curve(df).collect()}
    assert (curve[0.9]["flagged"], curve[0.9]["hits"]) == (2, 1)
    assert (curve[0.5]["flagged"], curve[0.5]["hits"]) == (4, 3)
    at = {r["target"]: r for r in EV.at_recall(EV.pr_curve(df), targets=("0.5", "0.9", "1.0")).collect()}
    assert at[0.5]["threshold"] == 0.8 and at[0.5]["false_alarms"] == 1
    assert at[1.0]["threshold"] == 0.5 and at[1.0]["caught"] == 3


def test_unreachable_target_and_no_negatives(spark):
    df = spark.createDataFrame([("m", 0.7, 1), ("m", 0.1, 1)], "model string, prob_neg double, label int")
    assert EV.at_recall(EV.pr_curve(df)).count() == 0
    m = EV.metric_bundle(df).first()
    assert m["roc_auc"] is None and m["negative_recall"] == 0.0


def test_all_tied_and_perfect(spark):
    tied = spark.createDataFrame([("m", 0.5, 0), ("m", 0.5, 1)], "model string, prob_neg double, label int")
    assert EV.roc_auc(tied).first()["roc_auc"] == 0.5
    perfect = spark.createDataFrame([("m", 0.9, 0), ("m", 0.1, 1)], "model string, prob_neg double, label int")
    m = EV.metric_bundle(perfect).first()
    assert m["roc_auc"] == 1.0 and m["macro_f1"] == 1.0


def test_classification_report_rows(spark):
    df = scored_from_counts(spark, 8, 2, 1, 9)
    r = {x["row_name"]: x for x in EV.classification_report(df).collect()}
    assert r["negative"]["support"] == 10 and r["positive"]["support"] == 10
    assert r["accuracy"]["f1"] == 17 / 20
