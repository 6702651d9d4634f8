import zlib

import numpy as np
import pytest

from farelake.llm import quality
from farelake.llm.common import table

LABELS = "doc_id long, quality int, toxic int, score double, id string, y int"


def labels(spark, rows):
    return spark.createDataFrame([(i, q, 0, 0.1, "x", 7) for i, q in rows], LABELS)


def held(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 0


def auc(score, y):
    order = np.argsort(np.argsort(score))
    pos = y == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    docs, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = quality.quality_scores(docs, lab).join(lab, "doc_id").where("held_out").select(
        "score", "predicted", "quality").toPandas()
    assert len(rows) > 100 and auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.97
    assert (rows.predicted == rows.quality).mean() > 0.95
    assert rows[rows.quality == 1].predicted.mean() > 0.99


def test_only_the_training_fold_is_learned_from(spark, docs):
    d = docs([(i, "good words in lines. " * 5 if i % 2 else "BAD!! " * 30) for i in range(400)])
    right = labels(spark, [(i, i % 2) for i in range(400)])
    lied = labels(spark, [(i, (1 - i % 2) if held(i) else i % 2) for i in range(400)])
    a, b = (sorted(map(tuple, quality.quality_scores(d, x).collect())) for x in (right, lied))
    assert a == b and all(h == held(i) and p == i % 2 and p == (s >= 0.3) for i, h, s, p in a)


def test_sample_bound(spark, docs):
    d = docs([(i, f"text {i}") for i in range(500)])
    _, y = quality.training_sample(d, labels(spark, [(i, i % 2) for i in range(500)]), quality.F.lit(True), sample=100)
    assert 50 < len(y) <= 100


def test_interaction_is_learned():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = quality.AdditiveModel(x, y)
    assert (2, 5) in {tuple(sorted(p[:2])) for p in model.pairs}
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


def test_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.random((500, len(quality.FEATURES)))
    m = quality.AdditiveModel(x, (x[:, 0] > 0.3).astype(float))
    for row, s in zip(x[:20], m.score(x[:20])):
        z = m.intercept + sum(t[sum(v >= e for e in edges)] for v, edges, t in zip(row, m.edges, m.tables))
        z += sum(t[sum(row[i] >= e for e in m.coarse[i]), sum(row[j] >= e for e in m.coarse[j])] for i, j, t in m.pairs)
        assert np.isclose(s, 1 / (1 + np.exp(-z)))


@pytest.mark.parametrize("lab", [[], [(4, 1), (5, 1)], [(None, 1), (4, None), (99, 0)]])
def test_odd_rows(spark, docs, odd, lab):
    rows = quality.quality_scores(docs(odd), labels(spark, lab)).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    if not lab or lab[0][0] is None:
        assert {r.score for r in rows} == {0.5}
    assert quality.quality_scores(docs([]), labels(spark, lab)).count() == 0


def test_several_labels_of_a_document_are_averaged(spark, docs):
    _, y = quality.training_sample(docs([(1, "a"), (2, "b")]), labels(spark, [(1, 1), (1, 0), (2, 0), (2, 0), (2, 1)]),
                                   quality.F.lit(True))
    assert sorted(y) == [0, 1]


def test_keep_good_returns_the_columns(spark, docs):
    d = docs([(i, "good words in lines. " * 5 if i % 2 else "BAD!! " * 30) for i in range(200)])
    out = quality.keep_good(d, labels(spark, [(i, i % 2) for i in range(200)]))
    assert out.columns == d.columns and {r.doc_id % 2 for r in out.collect()} == {1}
