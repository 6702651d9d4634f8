import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelake.llm import topk

DDL = "vec_id long, embedding array<float>, label int, id string, v int, part int, g int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", 7, 7, 7)
                                  for i, v in rows], DDL)


def brute(rows, every, k):
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v
           and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in use if i % every == 0}):
        qv = min(v for i, v in use if i == q)
        best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in use if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def search(spark, rows, every, k=5):
    got = topk.top_k(spark, frame(spark, rows), F.pmod("id", F.lit(every)) == 0, k)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("spread", [1.0, 0.02])
def test_equals_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 150)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=12) * spread).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one vector that many rows share: ties
    assert search(spark, rows, 20) == brute(rows, 20, 5)


def test_pivots_eliminate(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16)) * 300
    x = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16))).astype(np.int64)
    q, ids = x[:5], np.arange(4000)
    seen: list[int] = []
    start = np.full(5, -np.inf)
    out = list(topk.search_block(ids[:5], q, topk._distances(q.astype(float), centres), ids, x,
                                 topk._distances(x.astype(float), centres), start, 5, 2000.0, seen))
    for i, p, s in out:
        full = (x @ q[i]).astype(float)
        full[i] = -np.inf
        assert np.array_equal(np.sort(s), np.sort(full)[-5:])
    assert sum(seen) < 0.5 * 5 * 4000


@pytest.mark.parametrize("size", [2.0 ** 15, 2.0 ** 20, 2.0 ** 22, 2.0 ** 22.5])
def test_large_components_are_exact(spark, size):
    """Components of 2^23 to 2^30.5: scores pass 2^53 and reach 2^61; neighbours differ in the last place."""
    rng = np.random.default_rng(9)
    signs = rng.choice([-1.0, 1.0, 0.5], size=(40, 2))
    rows = [(i, (np.float32(size) * s).tolist()) for i, s in enumerate(signs)]
    rows += [(100 + i, [float(np.float32(size * (1 - i / 2 ** 20))), 1 / 256 * i]) for i in range(30)]
    rows += [(200 + i, rng.normal(size=2).tolist()) for i in range(30)]
    assert search(spark, rows, 5) == brute(rows, 5, 5)


def test_opposite_large_vectors_and_scores_beyond_a_long(spark):
    rows = [(0, [1e7, 0.0]), (1, [1e7, 0.0]), (2, [-1e7, 0.0])]
    s = math.floor(256 * 1e7) ** 2
    assert search(spark, rows, 50) == [(0, 1, 1, s), (0, 2, 2, -s)]
    with pytest.raises(Exception, match="(?i)too large|overflow"):
        search(spark, [(0, [1e12, 1.0]), (1, [1e12, 1.0])], 50)
    with pytest.raises(Exception, match="too large"):
        search(spark, [(0, [1e30, 1.0]), (1, [1.0, 1.0])], 50)


def test_exact_scores_at_every_size():
    rng = np.random.default_rng(11)
    for bits in (10, 26, 28, 30, 31, 40):
        x, q = rng.integers(-(1 << bits), 1 << bits, (50, 6)), rng.integers(-(1 << bits), 1 << bits, 6)
        size = float(np.sqrt((x.astype(float) ** 2).sum(1).max() * (q.astype(float) ** 2).sum())) * 1.01
        want = [sum(int(a) * int(b) for a, b in zip(r, q, strict=True)) for r in x]
        assert [int(v) for v in topk.exact_scores(x, q, size)] == want


def test_odd_rows(spark):
    rows = [(None, [1, 2]), (0, [1, 2]), (0, [0, 2]), (1, None), (2, []), (3, [1, None]), (4, [1, float("nan")]),
            (5, [float("inf"), 0]), (6, [1, 1]), (7, [1, 1]), (7, [1, 1]), (8, [-1, 0.5]), (9, [1, 2, 3])]
    want = brute([r for r in rows if r[0] != 9], 4, 5)
    assert search(spark, rows, 4) == want and {r[0] for r in want} == {0, 8}
    assert search(spark, [], 4) == [] and search(spark, [(1, [1, 2])], 4) == []
    assert search(spark, [(0, [1, 2])], 4) == []


def blocks_equal_full(rng, x, ids, q, qid, k):
    piv = x[rng.integers(0, len(x), 4)].astype(float)
    got = {i: (p, s) for i, p, s in topk.search_block(
        qid, q, topk._distances(q.astype(float), piv), ids, x, topk._distances(x.astype(float), piv), np.full(len(q), -np.inf), k,
        float(np.sqrt((piv * piv).sum(1).max())))}
    for i in range(len(q)):
        want = sorted((-sum(int(a) * int(b) for a, b in zip(q[i], r, strict=True)), int(j)) for j, r in zip(ids, x, strict=True)
                      if j != qid[i])[:k]
        p, s = got.get(i, ([], []))
        assert [(-int(v), int(ids[j])) for j, v in zip(p, s, strict=True)] == want


@pytest.mark.parametrize("bits", [1, 4, 27, 29])
@pytest.mark.parametrize("run_rows", [3, 64])
def test_a_block_gives_the_best_of_all_its_rows(bits, run_rows, monkeypatch):
    """Ties, repeated ids, own rows, fewer rows than k, scores beyond doubles, query chunks and runs of every size."""
    monkeypatch.setattr(topk, "RUN_ROWS", run_rows)
    monkeypatch.setattr(topk, "QUERY_ROWS", 5)
    rng = np.random.default_rng(bits)
    for n, k in ((1, 3), (4, 5), (90, 5), (300, 2)):
        x = rng.integers(-(1 << bits), 1 << bits, (n, 3))
        x[: n // 4] //= 1 << (bits // 2)   # norms of several sizes: products in doubles and beyond
        ids = rng.integers(0, max(2, n - n // 5), n)
        qid, at = np.unique(ids, return_index=True)
        blocks_equal_full(rng, x, ids, x[at][:12], qid[:12], k)


def test_pivots_are_all_different(spark):
    """One far row and copies of another: a pivot that counted twice would bound the k-th best too high."""
    rows = [(0, [1.0, 0.0]), (1, [9.0, 0.0])] + [(2 + i, [-1.0, 0.0]) for i in range(60)]
    assert search(spark, rows, 100) == brute(rows, 100, 5)


def test_segments_groups_and_widths(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 20)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "SEGMENT_ROWS", 8)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", 2)
    rng = np.random.default_rng(13)
    rows = [(i, (rng.normal(size=4) * 10.0 ** rng.integers(-1, 6)).tolist()) for i in range(400)]
    assert search(spark, rows, 9, 3) == brute(rows, 9, 3)


def test_the_driver_gets_a_bounded_sample_and_no_blocks(spark, monkeypatch):
    """Rows of the pivot sample sent to the driver do not grow with the partitions, and no join may broadcast the
    copied query blocks."""
    rows = spark.range(40_000, numPartitions=40).select(F.col("id").alias("vec_id"), F.array(
        *[((F.col("id") * 7919 * j) % 1009 / 100).cast("float") for j in range(1, 5)]).alias("embedding"))
    read = []
    monkeypatch.setattr(topk, "integer_vectors", lambda df, *a, real=topk.integer_vectors: read.append(df.count()) or real(df, *a))
    sample = topk.pivot_sample(rows, "vec_id", "embedding", 256)
    monkeypatch.undo()
    want = topk.integer_vectors(rows, "vec_id", "embedding").orderBy(F.xxhash64("id"), "id").limit(topk.PIVOT_SAMPLE).collect()
    assert [(r.id, r.v) for r in sample] == [(r.id, r.v) for r in want] and sum(r.rows for r in sample) == topk.PIVOT_SAMPLE
    assert len(read) == 1 and topk.PIVOT_SAMPLE <= read[0] <= 6 * topk.PIVOT_SAMPLE
    plan = topk.top_k(spark, rows, F.col("id") < 40)._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.split("\n") if "Join" in x]
    assert joins and all("[part" in x and "[g" not in x for x in joins)
    assert "BroadcastNestedLoopJoin" not in plan and "Cartesian" not in plan
