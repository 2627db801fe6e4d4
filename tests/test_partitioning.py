"""SURVEY 5(g): the same answer with 1, 4 and 17 input partitions."""
import pytest

from revlens.operators import evaluate as EV
from revlens.operators import quality as Q
from revlens.sources import fingerprint as FP
from revlens.sources import tables as V

from .conftest import SF001

OPS = {
    "validation_report": lambda d: Q.validation_report(d),
    "attrition_ledger": lambda d: Q.attrition_ledger(d),
    "clean_and_label": lambda d: Q.clean_and_label(d),
}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", sorted(OPS))
def test_quality_ops_partition_independent(spark, name):
    base = V.dirty_reviews(spark, SF001)
    outs = [rows(OPS[name](base.repartition(n))) for n in (1, 4, 17)]
    assert outs[0] == outs[1] == outs[2]


def test_curve_and_auc_partition_independent(spark):
    base = V.scored(spark, SF001)
    outs = []
    for n in (1, 4, 17):
        d = base.repartition(n)
        outs.append((rows(EV.pr_curve(d)), rows(EV.roc_auc(d))))
    assert outs[0] == outs[1] == outs[2]


def test_fingerprint_order_insensitive_and_file_bytes(spark):
    docs = V.table(spark, SF001, "documents")
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    a = FP.content_hash(docs, cols).first()
    b = FP.content_hash(docs.repartition(17).orderBy("text"), cols).first()
    assert a == b and a["n_rows"] == docs.count()
    import os
    size = os.path.getsize(f"{SF001}/documents.parquet")
    fb = FP.file_bytes(docs).first()
    assert fb["n_bytes"] == size and fb["n_files"] == 1
