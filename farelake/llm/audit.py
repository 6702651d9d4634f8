"""Filter interaction audit: what each filter removes in every order.

Each filter has one stored table of the ids that fail it (an id table). For
every set of filters applied before (a prefix), a left-anti join with the id
tables gives the survivors, a left-semi join of the survivors with the next
filter's table what it removes, and a left-semi join of that with a label's
ids what is lost. Orders that share a prefix share its joins: n filters have
2^n prefixes and n 2^(n-1) steps, from which the n! orders are put together
at the end, on one row per part and step.

The survivors of all prefixes come from one anti join: only rows that fail
some filter are spread over the prefixes, after they have been dealt by key,
so the exploded rows are not shuffled again; rows that fail none are counted
once. Rows are keyed by id and text and counted per key and part before any
join, so repeated rows are one. Repeated texts are found by a grouped minimum
(combined before the shuffle) and joined back over ``SALTS`` salts, so that a
text that a third of the rows share is no hot key. Everything is a DataFrame
operation; nothing is gathered.

Results on odd input: a null text is the empty text; a null part is ''; a
null id fails the repeat filter never and has no label; rows that repeat an
id with other texts are rows of their own, and labels of the id hold for all
of them; a label row with null id or value says nothing; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import discard, stored

SALTS = 32
BLANKS = r"[\x20\x09-\x0D]+"


def text_conditions(t: Column) -> dict[str, Column]:
    """Failure conditions on one text: A short, B repetitive, C upper case, D symbols."""
    words = F.array_remove(F.split(t, BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(t) - F.length(F.regexp_replace(t, "[A-Z]+", ""))
    return {"A": n < 200, "B": 100 * distinct < 50 * n, "C": 100 * upper > 2 * F.length(t), "D": t.rlike("[#$%&*|]")}


def audit_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(k, id, part, digest, n, A..D): each distinct row of id, part and text, its count, and the conditions it fails."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(t, 256)).alias("digest"), *[c.alias(x) for x, c in text_conditions(t).items()])
    # A key that is never null: decimal digits or nothing, and the digest.
    k = F.unhex(F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"), F.col("digest"))))
    return (rows.groupBy("id", "part", "digest", *"ABCD").agg(F.count(F.lit(1)).alias("n"))
            .select(k.alias("k"), "id", "part", "digest", "n", *"ABCD"))


def repeats(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows whose text a smaller id has too."""
    first = (rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
             .select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    return dealt.join(first, ["digest", "salt"]).where("id > first")


def steps(filters: str) -> list[tuple[str, int, int, int]]:
    """(order, step, filter's number, set of the filters before as a bit mask) for every permutation."""
    out = []
    for order in itertools.permutations(range(len(filters))):
        for i, f in enumerate(order):
            out.append(("".join(filters[x] for x in order), i + 1, f, sum(1 << x for x in order[:i])))
    return out


def interaction_audit(spark: SparkSession, rows: DataFrame, fails: dict[str, DataFrame],
                      labels: dict[str, DataFrame], scratch: list[str] | None = None) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, <label>_lost..., shapley).

    ``rows``: stored (k, id, part, n); ``fails``: per filter (one letter each) the distinct
    keys ``k`` that fail it; ``labels``: per label its distinct ids. The survivors and what
    the filters remove are stored (and added to ``scratch``); the result reads them.
    """
    names = "".join(fails)
    n, full = len(names), (1 << len(names)) - 1
    failing = None
    for f, letter in enumerate(names):
        one = fails[letter].select("k", F.lit(1 << f).alias("bit"))
        failing = one if failing is None else failing.union(one)
    any_fail = failing.select("k").distinct()
    dirty, clean = rows.join(any_fail, "k", "left_semi"), rows.join(any_fail, "k", "left_anti")

    # Survivors of every prefix: rows that fail something, over all prefixes, less those a prefix's filter fails.
    spread = (dirty.select("k", "id", "part", "n").repartition("k")
              .withColumn("prefix", F.explode(F.sequence(F.lit(0), F.lit(full)))))
    marks = failing.withColumnRenamed("k", "fk")
    survivors = spread.join(marks, (F.col("k") == F.col("fk")) & (F.col("prefix").bitwiseAND(F.col("bit")) != 0),
                            "left_anti")
    survivors = stored(spark, survivors, "audit-survivors", scratch)

    removed = None
    for f, letter in enumerate(names):
        gone = (survivors.where(F.col("prefix").bitwiseAND(F.lit(1 << f)) == 0)
                .join(fails[letter], "k", "left_semi").select("id", "part", "n", "prefix", F.lit(f).alias("f")))
        removed = gone if removed is None else removed.union(gone)
    removed = stored(spark, removed, "audit-removed", scratch)

    measures = ["kept", "removed", "failing", *[f"{x}_lost" for x in labels]]

    def measured(df: DataFrame, name: str) -> DataFrame:
        """Rows (part, f, prefix, n) as values of one measure, zero in the others."""
        return df.select("part", F.col("f").cast("int").alias("f"), F.col("prefix").cast("int").alias("prefix"),
                         *[(F.col("n") if m == name else F.lit(0)).cast("long").alias(m) for m in measures])

    pairs = [(f, p) for f in range(n) for p in range(full + 1) if not p >> f & 1]
    every = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(p).alias("prefix")) for f, p in pairs])).alias("at")

    def per_part(df: DataFrame, where: Column | None = None) -> DataFrame:
        """(part, n) summed, for every step, or those ``where`` holds of (f, prefix)."""
        out = df.groupBy("part").agg(F.sum("n").alias("n")).select("part", "n", every).select("part", "n", "at.*")
        return out if where is None else out.where(where)

    after = (survivors.groupBy("part", "prefix").agg(F.sum("n").alias("n"))
             .withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
             .where(F.expr("shiftright(prefix, f) & 1 = 1"))
             .withColumn("prefix", F.expr("prefix - shiftleft(1, f)")))
    by_step = ["part", "f", "prefix"]
    parts = [measured(per_part(clean), "kept"), measured(after, "kept"),
             measured(per_part(rows).withColumn("n", F.lit(0)), "kept"),
             measured(removed.groupBy(*by_step).agg(F.sum("n").alias("n")), "removed")]
    for f, letter in enumerate(names):
        parts.append(measured(per_part(rows.join(fails[letter], "k", "left_semi"), F.col("f") == f), "failing"))
    for x, ids in labels.items():
        lost = removed.join(ids.select("id"), "id", "left_semi")
        parts.append(measured(lost.groupBy(*by_step).agg(F.sum("n").alias("n")), f"{x}_lost"))
    table = parts[0]
    for p in parts[1:]:
        table = table.union(p)
    table = table.groupBy(*by_step).agg(*[F.sum(m).alias(m) for m in measures])

    # A prefix of size s stands before the filter in s! (n - 1 - s)! orders.
    weight = F.lit(0)
    for s in range(n):
        weight = F.when(F.bit_count("prefix") == s, math.factorial(s) * math.factorial(n - 1 - s)).otherwise(weight)
    others = F.col("prefix") + F.expr("shiftleft(1, f)") == full
    whole = table.groupBy("part", "f").agg(
        F.sum(F.when(others, F.col("removed")).otherwise(0)).alias("unique_fails"),
        F.sum(F.col("removed") * weight).alias("shapley"))
    orders = F.broadcast(spark.createDataFrame(steps(names), "filter_order string, step int, f int, prefix int"))
    return (table.join(whole, ["part", "f"]).join(orders, ["f", "prefix"])
            .select("part", "filter_order", "step", "kept", "removed",
                    (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails",
                    *[f"{x}_lost" for x in labels], "shapley"))


def filter_audit(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                 part: str = "source") -> DataFrame:
    """The audit of the five filters A to E per part, with the losses of good and of toxic documents."""
    scratch: list[str] = []
    rows = stored(spark, audit_rows(docs, key, text, part), "audit-rows", scratch)
    fails = {x: stored(spark, rows.where(x).select("k").distinct(), f"audit-fails-{x}", scratch) for x in "ABCD"}
    fails["E"] = stored(spark, repeats(rows).select("k").distinct(), "audit-fails-E", scratch)

    def ids(label: str) -> DataFrame:
        return labels.where(F.col(label) == 1).select(F.col(key).alias("id")).where("id IS NOT NULL").distinct()

    marked = {"good": stored(spark, ids("quality"), "audit-good", scratch),
              "toxic": stored(spark, ids("toxic"), "audit-toxic", scratch)}
    out = stored(spark, interaction_audit(spark, rows, fails, marked, scratch), "audit")
    discard(spark, scratch)
    return out


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
fails AS (SELECT w.doc_id, part,
    CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) THEN 16 ELSE 0 END AS mask
  FROM w),
counted AS (SELECT part, mask, count(*) AS n,
    count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL)) AS good,
    count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)) AS toxic
  FROM fails GROUP BY ALL),
f AS (SELECT unnest([0, 1, 2, 3, 4]) AS i, unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS o
  FROM f a JOIN f b ON a.i <> b.i JOIN f c ON c.i NOT IN (a.i, b.i) JOIN f d ON d.i NOT IN (a.i, b.i, c.i)
  JOIN f e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, o[s] AS i,
    CAST(coalesce(list_sum(list_transform(o[1:s - 1], lambda x: 1 << x)), 0) AS INTEGER) AS before
  FROM orders, unnest([1, 2, 3, 4, 5]) AS u(s)),
keys AS (SELECT DISTINCT i, before FROM steps),
cells AS (SELECT part, i, before,
    sum(n) FILTER (WHERE mask & (before + (1 << i)) = 0) AS kept,
    sum(n) FILTER (WHERE mask & before = 0 AND mask & (1 << i) <> 0) AS removed,
    sum(n) FILTER (WHERE mask & before <> 0 AND mask & (1 << i) <> 0) AS redundant,
    sum(n) FILTER (WHERE mask = 1 << i) AS unique_fails,
    sum(good) FILTER (WHERE mask & before = 0 AND mask & (1 << i) <> 0) AS good_lost,
    sum(toxic) FILTER (WHERE mask & before = 0 AND mask & (1 << i) <> 0) AS toxic_lost
  FROM counted, keys GROUP BY ALL),
shapley AS (SELECT part, i, sum(removed) AS shapley FROM steps JOIN cells USING (i, before) GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(shapley, 0) AS BIGINT) AS shapley
FROM steps JOIN cells USING (i, before) JOIN shapley USING (part, i)"""
