"""Centroid clustering whose nearest-centroid search is a threshold algorithm.

For every dimension the centroids are listed in order of their component. A
vector walks each list outward from its own value, nearest entry first. The
entries at one depth name centroids, whose exact squared distances are
computed when they are first seen; the squares of the distances at the
frontier, added over the dimensions, bound every centroid not yet seen from
below. The walk of a vector stops when that sum strictly exceeds its best
exact distance, so a tie is never missed and the result is exact; ties go to
the smaller number.

A round is one pass: tasks assign their rows in blocks and hand on, per
cluster and dimension, an exact sum and a count; Spark adds them, and the
driver gets clusters x dimensions sums. Centroids (a parameter's number of
integer vectors) travel with the tasks. Rows are read from a stored table of
the kept vectors, never gathered, never shuffled.

Components are exact integers: in 64 bits while they stay within 2^26 in
size (a squared distance then stays under 2^63), as Python integers beyond. A squared
distance, or a sum of them, that does not fit a long raises.

Results on odd input: vectors that are null, of another length, or hold a null or
non-finite component are left out. A row without id is clustered but starts
no centroid; rows that repeat an id are rows of their own (equal hashes start
centroids in order of their components). Fewer rows than clusters start fewer
centroids; without a centroid there are no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import stored

SMALL = 1 << 26
BLOCK_ROWS = 2048


def usable(df: DataFrame, key: str, vec: str, dim: int) -> DataFrame:
    """(id, v): rows whose vector has ``dim`` components, all finite, as doubles."""
    v = F.col(vec).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (df.select(F.col(key).alias("id"), v.alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") == dim) & ~F.exists("v", bad)))


def integers(rows, scale: int) -> np.ndarray:
    """floor(scale * x) of a list of vectors: int64 where every size is under SMALL, else Python integers."""
    x = np.floor(np.stack(rows).astype(np.float64) * scale)
    if not np.isfinite(x).all():
        raise OverflowError("a component is too large to be scaled")
    if np.abs(x).max(initial=0) < SMALL:
        return x.astype(np.int64)
    return np.array([[int(c) for c in row] for row in x], object)


class Walk:
    """Sorted centroid lists per dimension, and the search over them."""

    def __init__(self, centroids: list[list[int]]):
        small = max((abs(c) for row in centroids for c in row), default=0) < SMALL
        self.small = small
        self.c = np.array(centroids, np.int64 if small else object)
        order = np.argsort(self.c, axis=0, kind="stable")
        self.ids = order.T                                              # per dimension: centroids by component
        self.values = np.take_along_axis(self.c, order, axis=0).T

    def nearest(self, x: np.ndarray, seen_pairs: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of every row of a block of vectors."""
        if x.dtype != object and not self.small:
            x = x.astype(object)
        kind = np.int64 if x.dtype != object and self.small else object
        c, values = self.c.astype(kind), self.values.astype(kind)
        (n, dim), k = x.shape, len(c)
        far = (1 << 62) if kind is np.int64 else 1 << 4200
        gap = (1 << 28) if kind is np.int64 else 1 << 2100              # beyond the ends of a list
        dist = np.full((n, k), far, kind)
        hi = np.stack([np.searchsorted(values[d], x[:, d]) for d in range(dim)], axis=1)
        lo, rows, each = hi - 1, np.arange(n), np.arange(dim)
        seen = np.zeros((n, k), bool)
        for _ in range(k):                                              # after k steps every list is used up
            a, h, w = x[rows], hi[rows], lo[rows]
            down = np.where(w >= 0, a - values[each, np.maximum(w, 0)], gap)
            up = np.where(h < k, values[each, np.minimum(h, k - 1)] - a, gap)
            right = up < down
            named = self.ids[each, np.where(right, np.minimum(h, k - 1), np.maximum(w, 0))]
            new = np.zeros((len(rows), k), bool)
            new[np.arange(len(rows))[:, None], named] = True
            new &= ~seen[rows]
            seen[rows] |= new
            for j in range(k):                                          # exact distances of first sights
                at = rows[new[:, j]]
                if len(at):
                    diff = x[at] - c[j]
                    dist[at, j] = (diff * diff).sum(axis=1)
            if seen_pairs is not None:
                seen_pairs.append(int(new.sum()))
            hi[rows], lo[rows] = h + right, w - ~right
            frontier = np.where(right, up, down)
            bound = (frontier * frontier).sum(axis=1)
            rows = rows[~((bound > dist[rows].min(axis=1)) | seen[rows].all(axis=1))]
            if not len(rows):
                break
        best = np.argmin(dist, axis=1)                                  # the first of equals
        return best, dist[np.arange(n), best]


def _blocks(batches: Iterator[pd.DataFrame], scale: int) -> Iterator[np.ndarray]:
    for pdf in batches:
        for at in range(0, len(pdf), BLOCK_ROWS):
            yield integers(pdf["v"].iloc[at:at + BLOCK_ROWS].to_list(), scale)


def _summer(centroids: list[list[int]], scale: int):
    """Per task: (cluster, dim, s, n), the exact sum of a component over the task's rows of a cluster."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk = Walk(centroids)
        k, dim = walk.c.shape
        sums, counts = np.zeros((k, dim), object), [0] * k
        for x in _blocks(batches, scale):
            cluster, _ = walk.nearest(x)
            for j in np.unique(cluster):
                mine = x[cluster == j]
                sums[j] += mine.sum(axis=0).astype(object)
                counts[j] += len(mine)
        for j in range(k):
            if counts[j]:
                yield pd.DataFrame({"cluster": j, "dim": range(dim), "s": [Decimal(int(s)) for s in sums[j]],
                                    "n": counts[j]})
    return run


def first_centroids(vectors: DataFrame, k: int, salt: str, scale: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of salt and id, in that order."""
    start = (vectors.where("id IS NOT NULL").orderBy(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256), "v")
             .limit(k).collect())
    return [[int(c) for c in integers([np.array(r.v)], scale)[0]] for r in start]


def moved(vectors: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """The centroids after a round: floor of the mean of their vectors; those without vectors stay."""
    sums = (vectors.select("v").mapInPandas(_summer(centroids, scale), "cluster int, dim int, s decimal(38,0), n long")
            .groupBy("cluster", "dim").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())
    out = [list(c) for c in centroids]
    for r in sums:
        out[r.cluster][r.dim] = int(r.s) // r.n
    return out


def cluster_vectors(spark: SparkSession, df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256,
                    salt: str = "2:", key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per kept vector."""
    vectors = stored(spark, usable(df, key, vec, dim), "kept-vectors")
    centroids = first_centroids(vectors, k, salt, scale)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(vectors, centroids, scale)

    @F.pandas_udf("cluster int, distance long")
    def nearest(v: pd.Series) -> pd.DataFrame:
        walk, out = Walk(centroids), []
        for at in range(0, len(v), BLOCK_ROWS):
            c, d = walk.nearest(integers(v.iloc[at:at + BLOCK_ROWS].to_list(), scale))
            out.append(pd.DataFrame({"cluster": c.astype(np.int32), "distance": d.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"cluster": [], "distance": []})

    last = vectors.select(F.col("id").alias("vec_id"), nearest("v").alias("a")).select("vec_id", "a.*")
    last = stored(spark, last, "clusters")
    sums = {r.cluster: int(r.s) for r in
            last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(sums.values())
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    facts = spark.createDataFrame([(j, s, total, digest(centroids[j])) for j, s in sorted(sums.items())],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (last.join(F.broadcast(facts), "cluster")  # at most k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def cluster_sql(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, salt: str = "2:") -> str:
    """The same in DuckDB, brute force, the rounds written out."""
    nearest = """a{0} AS (SELECT row, cluster, d FROM (SELECT x.row, c.cluster, x.d, row_number() OVER (PARTITION BY x.row
    ORDER BY x.d, c.cluster) AS r FROM (SELECT k.row, c.cluster, CAST(list_sum(list_transform(list_zip(k.v, c.v),
    lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM kept k, c{0} c) x JOIN c{0} c USING (cluster))
  WHERE r = 1)"""
    move = """s{0} AS (SELECT cluster, g AS dim, sum(CAST(v[g] AS HUGEINT)) AS s, count(*) AS n
  FROM a{0} JOIN kept USING (row), unnest(range(1, {1})) AS u(g) GROUP BY ALL),
m{0} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS v FROM s{0} GROUP BY cluster),
c{2} AS (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{0} c LEFT JOIN m{0} m USING (cluster))"""
    parts = [f"""kept AS (SELECT row_number() OVER () AS row, vec_id,
  list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{salt}' || vec_id), v) - 1 AS INTEGER) AS cluster, v FROM kept
  WHERE vec_id IS NOT NULL QUALIFY cluster < {k})"""]
    for r in range(rounds):
        parts += [nearest.format(r), move.format(r, dim + 1, r + 1)]
    parts.append(nearest.format(rounds))
    return "WITH " + ",\n".join(p.replace(" AS (", " AS MATERIALIZED (", 1) for p in parts) + f"""
SELECT vec_id, cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (row) JOIN c{rounds} c USING (cluster)"""
