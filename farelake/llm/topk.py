"""Exact top-k search by inner product with a pivot table.

The distances from a vector to a fixed set of pivots bound its distance to
every other vector: for a query q and candidates x whose distances to a pivot p
lie in [low, high], ``max(low - d(q, p), d(q, p) - high)`` is a lower bound of
``d(q, x)``, and with the norms an upper bound of the inner product:
``(|q|^2 + |x|^2 - bound^2) / 2``. The candidates of a block are taken in runs of
rows with the same nearest pivot, in the order of their bounds; a run that cannot
hold one of a query's k best is left out for it, and the scores of the others come
from one matrix product. The result is exact. The pivots themselves are candidates,
which gives each query a first k-th best score before any block is read.

Components are 64-bit integers and scores exact integers: products are added
in doubles while |q| |x| stays under 2^53, in 64-bit integers up to 2^62, and as
Python integers beyond. Bounds are doubles, widened by what their rounding can
take. A component of 2^62 or more in size, and a score that does not fit a
long, raises.

Queries and candidates meet in tasks: candidate blocks are dealt evenly to a few
groups for each core (more, if a group would hold over ``GROUP_BLOCKS``), queries to segments of about ``SEGMENT_ROWS``, and each pair of a
group and a segment is a task, which reads the segment first and then one block
after another. It keeps the k best of each query, and returns them. Blocks go from
executor to executor only: nothing is broadcast, and the one thing of the vectors
that the driver holds is a sample of ``PIVOT_SAMPLE`` rows, cut down where they are
read, from which the pivots are chosen.

Results on odd input: vectors that are null, empty, or hold a null or
non-finite component take no part, nor do rows without id or whose length
differs from the pivots' (the most frequent length of the pivot sample).
Rows that repeat an id are candidates each (equal scores and ids rank in any
order, with equal rows); as a query such an id answers once, with its
smallest vector, and none of its rows is a candidate. An empty table or no
query gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import stored

PIVOTS = 32
PIVOT_SAMPLE = 2048
BLOCK_ROWS = 4096
QUERY_ROWS = 512
#: Most rows of a block that share one bound.
RUN_ROWS = 512
#: Most blocks of a task, and about how many queries: a task holds its queries, and its blocks may come at once.
GROUP_BLOCKS = 64
GROUPS_PER_CORE = 4
SEGMENT_ROWS = 32768
SLACK = 1e-3
#: Relative widening of bounds: of distances (a root of a difference of squares) and of products.
DISTANCE_ERROR, PRODUCT_ERROR = 1e-6, 1e-12
LARGEST = 1 << 62

BLOCK = "part int, block int, rows int, width int, ids binary, vecs binary"


def integer_vectors(df: DataFrame, key: str, vec: str, scale: int = 256) -> DataFrame:
    """(id, v): usable vectors with components floor(scale * x), x as double; one that is too large raises."""
    v = F.col(vec)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (df.where(v.isNotNull() & (F.size(v) > 0) & F.col(key).isNotNull() & ~F.exists(v, bad))
            .select(F.col(key).cast("long").alias("id"),
                    F.transform(v, lambda x: _component(x.cast("double") * scale)).alias("v")))


def _component(x: Column) -> Column:
    large = F.raise_error(F.lit("a component is too large for exact scores")).cast("long")
    return F.when(F.abs(x) < float(LARGEST), F.floor(x).cast("long")).otherwise(large)


def pivot_sample(df: DataFrame, key: str, vec: str, scale: int) -> list:
    """(id, v, rows): the usable vectors with the smallest hashed ids, ``PIVOT_SAMPLE`` rows; rows that share
    an id and a length come as one. They are cut down by a share of the hashes before the driver sees any:
    the largest rows of every partition, as a plain limit would send, grow with the partitions."""
    named = df.where(F.col(key).isNotNull())
    wanted = 4 * PIVOT_SAMPLE
    share = wanted / max(1, named.agg(F.approx_count_distinct(F.col(key))).first()[0])
    while True:
        h = F.xxhash64(F.col(key).cast("long"))
        cut = named if share >= 1 else named.where(h < int(-(2.0 ** 63) + share * 2.0 ** 64))
        rows = (integer_vectors(cut, key, vec, scale).groupBy("id", F.size("v").alias("n"))
                .agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("rows"))
                .orderBy(F.xxhash64("id"), "id", "n").limit(PIVOT_SAMPLE).collect())
        if share >= 1 or sum(r.rows for r in rows) >= PIVOT_SAMPLE:
            return rows
        share *= 8   # unusable rows were counted too


def choose_pivots(sample: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of farthest-first pivots, all different, from a bounded sample."""
    if not sample:
        return np.zeros(0, np.int64), np.zeros((0, 0))
    lengths, left = Counter(), PIVOT_SAMPLE
    for r in sample:
        lengths[len(r.v)] += min(r.rows, left)
        left -= min(r.rows, left)
    dim = max(sorted(lengths), key=lengths.get)
    rows = [r for r in sample if len(r.v) == dim]
    ids, m = np.array([r.id for r in rows]), np.array([r.v for r in rows], np.float64)
    chosen, gap = [0], np.linalg.norm(m - m[0], axis=1)
    while len(chosen) < PIVOTS and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(m - m[chosen[-1]], axis=1))
    return ids[chosen], m[chosen]


def _distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    sq = (m * m).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (m @ pivots.T)
    return np.sqrt(np.maximum(sq, 0))


def _packer(dim: int, rows: int):
    """Blocks of vectors, in the narrowest integers that hold them."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part, n = TaskContext.get().partitionId(), 0
        for pdf in batches:
            pdf = pdf[[len(v) == dim for v in pdf["v"]]]
            for at in range(0, len(pdf), rows):
                cut = pdf.iloc[at:at + rows]
                whole = np.stack(cut["v"].to_numpy()).astype(np.int64)
                kind = next(t for t in (np.int16, np.int32, np.int64)
                            if np.iinfo(t).min <= whole.min() and whole.max() <= np.iinfo(t).max)
                yield pd.DataFrame({"part": [part], "block": [n], "rows": [len(cut)], "width": [np.dtype(kind).itemsize],
                                    "ids": [cut["id"].to_numpy(np.int64).tobytes()],
                                    "vecs": [whole.astype(kind).tobytes()]})
                n += 1
    return pack


def _unpack(r) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(r.ids, np.int64)
    return ids, np.frombuffer(r.vecs, f"i{r.width}").reshape(len(ids), -1).astype(np.int64)


def exact_scores(x: np.ndarray, q: np.ndarray, size: float) -> np.ndarray:
    """Inner products of integer rows with an integer vector, or with the columns of a matrix; ``size`` is
    at least every |x| |q|."""
    if size < 2 ** 53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if size < 2 ** 62:
        return x @ q
    return x.astype(object) @ q.astype(object)


def _best(i: np.ndarray, ids: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each i, by score and then smaller id, in order of i."""
    if s.dtype == object:
        order = np.array(sorted(range(len(s)), key=lambda j: (i[j], -s[j], ids[j])), np.int64)
    else:
        order = np.lexsort((ids, -s, i))
    own = i[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
    return order[rank < k]


def _reached(s: np.ndarray) -> np.ndarray:
    """Integer scores as doubles that are not above them."""
    f = s.astype(np.float64)
    return np.where(np.abs(f) < 2.0 ** 53, f, np.nextafter(f, -np.inf))


def search_block(qid, q, qd, xid, x, xd, start, k: int, reach: float = 0.0, count: list[int] | None = None
                 ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: (its index, candidate positions, scores) of at least its k best of the block that reach
    ``start``; nothing for a query of which no row does.

    ``start`` is a score that the query's k-th best reaches for certain, ``reach``
    the largest norm of a pivot. ``count`` gets the number of pairs that were evaluated.
    """
    xn = (x.astype(np.float64) ** 2).sum(1)
    near = xd.argmin(axis=1)
    order = np.lexsort((xn, near))
    xid, x, xd, xn, near = xid[order], x[order], xd[order], xn[order], near[order]
    xf, xs = x.astype(np.float64), np.sqrt(xn)
    heads = np.flatnonzero(np.r_[True, near[1:] != near[:-1]])
    cuts = np.concatenate([np.arange(a, b, RUN_ROWS) for a, b in zip(heads, [*heads[1:], len(x)])])
    ends = np.r_[cuts[1:], len(x)]
    lows, highs = np.minimum.reduceat(xd, cuts, axis=0), np.maximum.reduceat(xd, cuts, axis=0)
    top_n, top_s = np.maximum.reduceat(xn, cuts), np.maximum.reduceat(xs, cuts)
    by_id = np.argsort(xid, kind="stable")
    own_a, own_b = (np.searchsorted(xid[by_id], qid, side) for side in ("left", "right"))
    for at in range(0, len(q), QUERY_ROWS):
        c = slice(at, at + QUERY_ROWS)
        qf = q[c].astype(np.float64)
        qn = (qf * qf).sum(1)
        qs, m = np.sqrt(qn), len(qf)
        low = np.stack([np.maximum(a - qd[c], qd[c] - b).max(axis=1) for a, b in zip(lows, highs)], axis=1)
        low -= SLACK + DISTANCE_ERROR * (qs[:, None] + top_s + reach)
        both = qn[:, None] + top_n
        bound = (both - np.maximum(low, 0) ** 2) / 2 + SLACK + PRODUCT_ERROR * both
        # Rows of the query's own id: no candidates.
        own_n = (own_b - own_a)[c]
        own_q = np.repeat(np.arange(m), own_n)
        own_x = by_id[np.repeat(own_a[c], own_n) + np.arange(len(own_q)) - np.repeat(np.cumsum(own_n) - own_n, own_n)]
        # kth: a score that the k-th best reaches; worst and last: score and id of the last of k rows that are kept.
        kth, worst, last = start[c].astype(np.float64), np.full(m, -np.inf), np.full(m, np.iinfo(np.int64).max)
        gi, gp, gs = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for r in np.argsort(-bound.max(axis=0), kind="stable"):
            rows, a, b = np.flatnonzero(bound[:, r] >= kth), cuts[r], ends[r]
            size = qs[rows] * top_s[r] * 1.01
            own = np.flatnonzero((own_x >= a) & (own_x < b))
            for mine, doubles in ((rows[size < 2 ** 53], True), (rows[size >= 2 ** 53], False)):
                if not len(mine):
                    continue
                s = qf[mine] @ xf[a:b].T if doubles else exact_scores(q[c][mine], x[a:b].T, float(size.max()))
                if count is not None:
                    count.append(s.size)
                if len(own):
                    row = np.full(m, -1)
                    row[mine] = np.arange(len(mine))
                    cell = own[row[own_q[own]] >= 0]
                    cell = (row[own_q[cell]], own_x[cell] - a)
                else:
                    cell = None
                hits = s >= kth[mine][:, None]
                if doubles and k <= b - a and np.count_nonzero(hits) > 8 * k * len(mine):
                    if cell:
                        s[cell] = -np.inf
                    kth[mine] = np.maximum(kth[mine], np.partition(s, b - a - k, axis=1)[:, b - a - k])
                    hits = s >= kth[mine][:, None]
                if cell:
                    hits[cell] = False
                i, p = np.nonzero(hits)
                s = s[i, p]
                i, p = mine[i], p + a
                use = (s > worst[i]) | (xid[p] < last[i])   # of a tie, the smaller id
                i, p, s = i[use], p[use], s[use]
                if not len(i):
                    continue
                s = s.astype(np.int64) if doubles else s
                hit = np.zeros(m, bool)
                hit[i] = True
                old = hit[gi]
                ji, jp, js = np.r_[gi[old], i], np.r_[gp[old], p], np.r_[gs[old], s]
                best = _best(ji, xid[jp], js, k)
                ji, jp, js = ji[best], jp[best], js[best]
                gi, gp, gs = np.r_[gi[~old], ji], np.r_[gp[~old], jp], np.r_[gs[~old], js]
                tail = np.flatnonzero(np.r_[ji[1:] != ji[:-1], True])
                tail = tail[np.diff(np.r_[-1, tail]) == k]
                worst[ji[tail]], last[ji[tail]] = _reached(js[tail]), xid[jp[tail]]
                kth = np.maximum(kth, worst)
        if len(gi):
            sort = np.argsort(gi, kind="stable")
            gi, gp, gs = gi[sort], gp[sort], gs[sort]
            heads = np.flatnonzero(np.r_[True, gi[1:] != gi[:-1]])
            for u, v in zip(heads, [*heads[1:], len(gi)]):
                yield at + int(gi[u]), order[gp[u:v]], gs[u:v]


class _Search:
    """The queries of a task with the k best candidates of each so far."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray]], pivot_ids: np.ndarray, pivots: np.ndarray, k: int):
        self.ids, self.q = (np.concatenate(v) for v in zip(*blocks))
        self.pivots, self.k, n = pivots, k, len(self.ids)
        self.reach = float(np.sqrt((pivots * pivots).sum(1).max()))
        qf = self.q.astype(np.float64)
        self.dists = _distances(qf, pivots)
        seen = qf @ pivots.T
        # What rounding can add is taken off: the scores are reached for certain.
        seen -= SLACK + PRODUCT_ERROR * ((qf * qf).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :])
        seen[self.ids[:, None] == pivot_ids[None, :]] = -np.inf
        self.kth = np.sort(seen, axis=1)[:, -k] if len(pivots) >= k else np.full(n, -np.inf)
        # The results: query index, candidate, score; in order of the first, at most k of each.
        self.i, self.x, self.s = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, xid: np.ndarray, x: np.ndarray) -> None:
        found = list(search_block(self.ids, self.q, self.dists, xid, x, _distances(x.astype(np.float64), self.pivots),
                                  self.kth, self.k, self.reach))
        if not found:
            return
        i = np.r_[self.i, np.repeat([i for i, _, _ in found], [len(p) for _, p, _ in found])]
        ids = np.r_[self.x, *[xid[p] for _, p, _ in found]]
        s = np.r_[self.s, *[s.astype(np.int64) for _, _, s in found]]
        best = _best(i, ids, s, self.k)
        self.i, self.x, self.s = i[best], ids[best], s[best]
        last = np.flatnonzero(np.r_[self.i[1:] != self.i[:-1], True])
        last = last[np.diff(np.r_[-1, last]) == self.k]
        at = self.i[last]
        self.kth[at] = np.maximum(self.kth[at], _reached(self.s[last]))


def _searcher(pivot_ids: np.ndarray, pivots: np.ndarray, k: int):
    """The rows of a task: its query blocks (kind 0), and after them its candidate blocks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, search = [], None
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.kind == 0:
                    queries.append(_unpack(r))
                elif queries:
                    search = search or _Search(queries, pivot_ids, pivots, k)
                    search.add(*_unpack(r))
        if search is not None:
            yield pd.DataFrame({"query_id": search.ids[search.i], "vec_id": search.x, "score": search.s})
    return run


def _numbered(blocks: DataFrame) -> tuple[DataFrame, int, int]:
    """Blocks with a number ``n`` from 0, how many there are, and their rows."""
    parts = blocks.groupBy("part").agg(F.count(F.lit(1)).alias("blocks"), F.sum("rows").alias("rows")).collect()
    first, n = [], 0
    for r in sorted(parts, key=lambda r: r.part):
        first.append((r.part, n))
        n += r.blocks
    starts = blocks.sparkSession.createDataFrame(first, "part int, first long")
    return (blocks.join(F.broadcast(starts), "part").withColumn("n", F.col("first") + F.col("block")), n,
            sum(r.rows for r in parts))


def top_k(spark: SparkSession, df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id",
          vec: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of all other rows.

    ``is_query`` is a condition on the columns ``id`` and ``v``. Ties go to the smaller id.
    """
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivot_ids, pivots = choose_pivots(pivot_sample(df, key, vec, scale))
    if not len(pivots):
        return empty
    vectors, dim = integer_vectors(df, key, vec, scale), pivots.shape[1]
    data = stored(spark, vectors.mapInPandas(_packer(dim, BLOCK_ROWS), BLOCK), "topk-blocks")
    queries = (vectors.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
               .mapInPandas(_packer(dim, QUERY_ROWS), BLOCK))
    queries = stored(spark, queries, "topk-queries")
    (data, blocks, _), (queries, _, asked) = _numbered(data), _numbered(queries)
    if not asked:
        return empty
    # Queries are copied to every group and each group finds k rows for them, so groups are no more than the
    # cores can share evenly, unless they grow too large.
    groups = max(min(blocks, GROUPS_PER_CORE * spark.sparkContext.defaultParallelism), -(-blocks // GROUP_BLOCKS))
    segments = -(-asked // SEGMENT_ROWS)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    row = ["width", "ids", "vecs"]
    data = (data.withColumn("g", F.col("n") % groups).withColumn("segment", each(segments))
            .select("g", "segment", F.lit(1).alias("kind"), *row))
    queries = (queries.withColumn("segment", F.col("n") % segments).withColumn("g", each(groups))
               .select("g", "segment", F.lit(0).alias("kind"), *row))
    task = (F.col("g") * segments + F.col("segment")).cast("int")
    found = (data.unionByName(queries).repartitionById(groups * segments, task).select("kind", *row)
             .sortWithinPartitions("kind")
             .mapInPandas(_searcher(pivot_ids, pivots, k), "query_id long, vec_id long, score long"))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    # Two levels, so that no group holds more than the salted share of a query's block winners.
    part = found.groupBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(16)).alias("salt")).agg(best.alias("b"))
    full = part.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("b"))), 1, k).alias("b"))
    return full.select("query_id", F.posexplode("b").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
        (-F.col("x.s")).alias("score"))


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5"""
