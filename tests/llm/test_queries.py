"""The registered queries on the given tables, against their SQL or brute force."""

import math
import re
import sys
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
import corpus_pipeline
from farelake.llm import align, mixing, quality, registry

from . import test_decontam, test_langid, test_linededup, test_lm, test_secrets

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def rows(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()


def run(spark, name):
    return E.queries()[name](spark, SF)


def same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)


def test_one_query_per_operator():
    names = [re.match(r"op(\d+)_", n)[1] for n in registry.QUERIES if n != "pipeline"]
    assert sorted(map(int, names)) == list(range(1, 14)) and "pipeline" in registry.QUERIES


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_queries_equal_their_sql(spark, duck, name):
    got, want = run(spark, name), duck.execute(registry.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert same(got.select(*columns).collect(), want.fetchall())


def near_duplicates(rows):
    """Smallest id of each component of the pairs with edit similarity 0.8 of all pairs."""
    ids = sorted(i for i, _ in rows)
    seen: dict[str, int] = {}
    words = {i: np.array([seen.setdefault(w, len(seen)) for w in re.findall(r"[^\W_]+", (t or "").lower())], np.uint32)
             for i, t in rows}
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[:k]]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), link in zip(pairs, align.similar([(words[a], words[b]) for a, b in pairs], 0.8)):
        if link:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_op1_equals_brute_force(spark, rows):
    assert {r.doc_id: r.class_id for r in run(spark, "op1_neardup").collect()} == near_duplicates(rows)


def test_op2_base_is_exact_and_the_model_beats_it(spark, rows):
    out = run(spark, "op2_lm")
    test_lm.close(test_lm.base(out), test_lm.brute_base(rows))
    held = out.where("held_out").selectExpr("sum(score) AS s", "sum(base_score) AS b").first()
    assert held.s > held.b


def test_op3_scores_every_row(spark, rows):
    out = run(spark, "op3_quality").collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in out)


def plain_features(text):
    """The sixteen numbers of a text, counted one by one."""
    words, lines = text.split(), [x for x in text.split("\n") if x]
    n, raw = len(words), text.encode()
    if n == 0:
        return [math.log1p(len(text))] + [0.0] * 15
    share = lambda kind: sum(map(kind, raw)) / len(raw)
    upper, digit = (lambda c: 65 <= c <= 90), (lambda c: 48 <= c <= 57)
    symbol = lambda c: 33 <= c <= 126 and not chr(c).isalnum()
    pairs = [(words[i], words[i + 1]) for i in range(n - 1)]
    count = lambda test: sum(1 for w in words if test(w)) / n
    return [math.log1p(len(text)), math.log1p(n), len(text) / n, len(set(words)) / n, len(set(pairs)) / n,
            max(words.count(w) for w in set(words)) / n, sum(a == b for a, b in pairs) / n, share(upper), share(digit),
            share(symbol), count(lambda w: not w[0].isalnum() and not w[-1].isalnum()), count(lambda w: w[-1] in "!#$%&*|~^"),
            count(lambda w: w[0].isupper()), count(lambda w: w[-1] in ".?!"), len(set(lines)) / len(lines), n / len(lines)]


def test_op3_equals_a_rescored_model(spark, duck, rows):
    """Features counted independently; the model fitted on the labelled training rows and added up entry by entry."""
    x = {i: plain_features(t or "") for i, t in rows}
    marks = duck.execute("SELECT doc_id, avg(quality) FROM labels WHERE quality IS NOT NULL GROUP BY 1 ORDER BY 1").fetchall()
    train = [(x[i], q >= 0.5) for i, q in marks if i in x and zlib.crc32(str(i).encode()) % 5]
    m = quality.AdditiveModel(np.array([f for f, _ in train]), np.array([float(y) for _, y in train]))
    out = {r.doc_id: r.score for r in run(spark, "op3_quality").collect()}
    for i, f in x.items():
        at = lambda edges, v: sum(v >= e for e in edges)
        z = m.intercept + sum(t[at(e, v)] for v, e, t in zip(f, m.edges, m.tables, strict=True))
        z += sum(t[at(m.coarse[a], f[a]), at(m.coarse[b], f[b])] for a, b, t in m.pairs)
        assert abs(out[i] - 1 / (1 + math.exp(-z))) < 1e-6, i


def test_op4_equals_brute_force(spark, rows):
    base = {"assign", "access", "hex"}
    out = {r.doc_id: r for r in run(spark, "op4_secrets").collect()}
    assert len(out) == len(rows)
    for i, t in rows:
        want = test_secrets.brute(t)
        assert [*out[i][1:5]] == want[:4]
        assert ",".join(s for s in out[i].spans.split(",") if s.split(":")[0] in base) == want[4]


def test_op11_equals_brute_force(spark, duck):
    rows = duck.execute("SELECT doc_id, text, lang FROM documents").fetchall()
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    brute = test_langid.brute_profiles([(t, x) for i, t, x in rows if i not in held])
    out = {r.doc_id: r for r in run(spark, "op11_langid").collect()}
    assert len(out) == len(rows)
    for i, t, x in rows:
        assert out[i].held_out == (i in held)
        assert (out[i].lang_pred, round(out[i].score, 12)) == test_langid.brute_predict(brute, t)[:2]
    assert sum(out[i].lang_pred == x for i, _, x in rows if i in held) >= 0.95 * len(held)


def test_pipeline_equals_brute_force(spark, duck, rows):
    good = {r.doc_id for r in run(spark, "op3_quality").where("predicted = 1").collect()}
    kept = [r for r in rows if r[0] in good]
    lines = dict(test_linededup.brute(kept, 50))
    classes = near_duplicates(list(lines.items()))
    kept = [(i, t) for i, t in lines.items() if classes[i] == i]
    bench = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    leaks = {i for i, _, _ in test_decontam.brute(kept, bench)}
    kept = {i: t for i, t in kept if i not in leaks}
    docs = duck.execute("SELECT * FROM documents").df()
    docs = docs[docs.doc_id.isin(list(kept))].copy()
    docs["text"] = [kept[i] for i in docs.doc_id]
    docs["n_chars"] = [len(t) for t in docs.text]
    duck.register("kept_documents", pd.DataFrame(docs))
    want = duck.execute(mixing.mix_sql("SELECT * FROM kept_documents"))
    columns = [d[0] for d in want.description]
    out = run(spark, "pipeline")
    assert 0 < len(kept) < len(rows) and leaks and same(out.select(*columns).collect(), want.fetchall())


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_odd_rows(spark, docs, odd, empty):
    """Null ids and texts, repeated rows, a very long text, further columns; and an empty table."""
    from farelake.session import scratch_path
    sf = scratch_path(spark, "test", f"odd-pipeline-{empty}")
    full = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    d = docs([] if empty else odd)
    if not empty:
        d = d.unionByName(full, allowMissingColumns=True)
    d.write.mode("overwrite").parquet(f"{sf}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.mode("overwrite").parquet(f"{sf}/{t}.parquet")
    out = corpus_pipeline.run(spark, sf)
    assert set(d.columns) <= set(out.columns) and {"mix_copy", "mix_order"} <= set(out.columns)
    got = out.collect()
    assert (got == []) == empty and {r.doc_id for r in got} <= {r.doc_id for r in d.select("doc_id").collect()}


def test_the_rest_works_without_the_subpackage(monkeypatch):
    from farelake.plans.registry import QUERIES
    monkeypatch.setitem(sys.modules, "farelake.llm", None)
    assert set(E.queries()) == set(QUERIES) and not any(n.startswith("op") for n in E.oracle_sql())
