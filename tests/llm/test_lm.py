import math
import zlib
from collections import Counter

import numpy as np
import pytest

from farelake.llm import lm


def words(t):
    return [w for w in (t or "").encode().lower().split()] + [b""]


def held(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2


def brute_base(rows):
    train = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        ws = words(t)
        out.append((str(i), held(i), len(ws), sum(train[w] > 0 for w in ws), n,
                    sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws)))
    return sorted(out)


def brute_model(rows):
    """The interpolated score on exact, quantised counts."""
    uni, bi = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            ws = words(t)
            uni.update(ws)
            bi.update(zip([b"", *ws], ws))
    n, v = sum(uni.values()), len(uni)
    q = lambda c: float(lm.level_count(lm.levels(np.array([c])))[0]) if c else 0.0
    out = {}
    for i, t in rows:
        ws = words(t)
        out[i] = sum(math.log10((min(q(bi[a, b]), q(uni[a])) + lm.MU * (q(uni[b]) + 1) / (n + v + 1)) / (q(uni[a]) + lm.MU))
                     for a, b in zip([b"", *ws], ws))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(1)
    vocab = [f"W{i}" for i in range(400)]
    p = 1 / np.arange(1, 401)
    rows = [(i, " ".join(rng.choice(vocab, int(rng.integers(1, 60)), p=p / p.sum()))) for i in range(300)]
    rows += [(1000 + i, rows[5][1] + " copies of one text\t\x0b shared") for i in range(80)]
    return rows + [(2000, "É éA b\x1cc"), (2001, None), (2002, "")]


def close(got, want):
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))


def base(df):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in df.collect())


def test_base_score_is_exact(spark, docs, corpus):
    close(base(lm.lm_scores(spark, docs(corpus))), brute_base(corpus))


def test_small_tables_and_segments_give_the_same(spark, docs, corpus, monkeypatch):
    whole = lm.lm_scores(spark, docs(corpus)).collect()
    # A table of 40 tokens leaves the rest to the join; small segments make several passes.
    cut = lm.lm_scores(spark, docs(corpus), table_max=40, segment_bytes=2000)
    close(base(cut), brute_base(corpus))
    a, b = ({r.doc_id: r.score for r in rows} for rows in (whole, cut.collect()))
    assert a.keys() == b.keys() and all(math.isclose(a[i], b[i], rel_tol=1e-9) for i in a)


def test_score_is_near_the_model_on_true_counts(spark, docs, corpus):
    want = brute_model(corpus)
    rows = lm.lm_scores(spark, docs(corpus)).collect()
    off = [abs(r.score - want[r.doc_id]) / r.n_tokens for r in rows]
    assert np.mean(off) < 0.02 and max(off) < 0.3
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_filter_never_misses_and_seldom_invents():
    rng = np.random.default_rng(2)
    h, n = rng.integers(0, 1 << 63, 20_000).astype(np.uint64), rng.integers(1, 50, 20_000)
    import pandas as pd
    page = lm._build_page((0,), pd.DataFrame({"uh": [h.tobytes()], "un": [n.astype(np.int64).tobytes()],
                                              "bh": [b""], "bn": [b""]}))
    f = lm.Filter(1, [(0, int(page.nbits[0]), page.bits[0])])
    got, want = f.level(h, lm.UNI).astype(int), lm.levels(n)
    assert (got >= want).all() and (got > want).mean() < 0.05
    other = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert (f.level(other, lm.UNI) > 0).mean() < 0.05 and (f.level(h, lm.BI) > 0).mean() < 0.05


def test_odd_rows(spark, docs, odd, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 50)
    monkeypatch.setattr(lm, "PAGE_TOKENS", 1000)
    close(base(lm.lm_scores(spark, docs(odd))), brute_base(odd))
    assert lm.lm_scores(spark, docs([])).count() == 0


def test_nothing_to_learn_from(spark, docs):
    only = next(i for i in range(100) if held(i))
    r = lm.lm_scores(spark, docs([(only, "a b")])).collect()
    assert [(x.held_out, x.n_tokens, x.n_known, x.train_tokens, x.base_score) for x in r] == [(True, 3, 0, 0, 0.0)]


def test_levels():
    n = np.array([1, 2, 3, 4, 7, 8, 1023, 1024])
    assert lm.levels(n).tolist() == [1, 2, 2, 3, 3, 4, 10, 11]
    assert lm.level_count(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2.5, 5.5]
