"""Benchmark decontamination with spaced seeds (DataFrame functions only).

Texts become arrays of word hashes. A spaced seed is a fixed mask over
``SPAN`` positions; only the words at its care positions are hashed, so a
seed survives substitutions elsewhere. Seeds of all document positions are
joined with those of the benchmark. A hit puts a benchmark item on a diagonal
of the document; the aligned words around it are compared, and the pair is an
overlap when ``NEED`` of ``WINDOW`` consecutive aligned words are equal (for
items shorter than a window: four fifths of their words). Each of the masks
hits every window of 13 with up to two substitutions. Items of 8 to 12 words
have masks of their own (``MID_MASKS``, 4 words over 6 positions), which
together hit every tolerated pattern. Items of less than 8 words must occur
whole, so their seed is all of their words, hashed with their number; the
documents have one such seed a position for each size that occurs among the
short items (7 sizes at most). The tests check every pattern of every
size, so the result is exact for that definition.

The benchmark's seeds are broadcast when a count shows they are within
``SEEDS_MAX``: then the texts are read once and only verified overlaps are
shuffled. Beyond it the seeds are joined by shuffle and hits fetch their
document by id.

Results on odd input: null and empty texts and items without words overlap
nothing; words are compared lower-case, punctuation is not part of a word;
rows that repeat an id and text count as one; null ids are carried; other
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.functions.joins import fits
from farelake.llm.common import text_hash

MASKS = [(0, 1, 3, 6, 7), (0, 1, 4, 6, 7)]
SPAN = 8
#: For items of SPAN to WINDOW - 1 words.
MID_MASKS = [(0, 1, 2, 5), (0, 1, 3, 5)]
WINDOW = 13
NEED = 11
SEEDS_MAX = 4_000_000


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(h: Column, at: Column, masks: list[tuple[int, ...]]) -> Column:
    return F.array(*[F.xxhash64(F.lit(m), *[F.get(h, at + o) for o in mask]) for m, mask in enumerate(masks)])


def _need(size: Column) -> Column:
    return F.when(size < SPAN, size).otherwise(F.least(F.lit(NEED), F.ceil(size * 0.8))).cast("int")


def _of_size(kind: str) -> Column:
    size = F.col("size")
    return {"short": (size > 0) & (size < SPAN), "mid": (size >= SPAN) & (size < WINDOW), "long": size >= WINDOW}[kind]


def _hits(docs: DataFrame, items: DataFrame, kind: str, sizes: list[int]) -> tuple[DataFrame, DataFrame]:
    """Seeds of the documents (doc_id, th, h, p, seed) and of the items of a kind (seed, item_id, q).

    ``sizes``: the sizes of the short items.
    """
    items = items.where(_of_size(kind))
    if kind == "short":
        whole = F.array(*[F.when(F.col("p") + n <= F.size("h"), F.xxhash64(F.lit(n), F.slice("h", F.col("p") + 1, F.lit(n))))
                          for n in sizes])
        d = (docs.where(F.size("h") > 0).select("doc_id", "th", "h", F.explode(F.sequence(F.lit(0), F.size("h") - 1)).alias("p"))
             .select("doc_id", "th", "h", "p", F.explode(whole).alias("seed")).where("seed IS NOT NULL"))
        return d, items.select(F.xxhash64(F.col("size"), F.col("words")).alias("seed"), "item_id", F.lit(0).alias("q"))
    masks = MASKS if kind == "long" else MID_MASKS
    span = max(masks[0]) + 1
    d = (docs.where(F.size("h") >= span)
         .select("doc_id", "th", "h", F.explode(F.sequence(F.lit(0), F.size("h") - span)).alias("p"))
         .select("doc_id", "th", "h", "p", F.explode(_seeds(F.col("h"), F.col("p"), masks)).alias("seed")))
    b = (items.select("item_id", "words", F.explode(F.sequence(F.lit(0), F.col("size") - span)).alias("q"))
         .select(F.explode(_seeds(F.col("words"), F.col("q"), masks)).alias("seed"), "item_id", "q"))
    return d, b


def overlaps(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text",
             item: str = "item_id", item_text: str = "text", seeds_max: int = SEEDS_MAX) -> DataFrame:
    """(doc_id, th, item_id, n_words, matched): overlapping pairs, with the most equal words on a diagonal.

    ``th`` is the hash of the document's text; with doc_id it names the row.
    """
    docs = docs.select(F.col(key).alias("doc_id"), text_hash(text).alias("th"), word_hashes(F.col(text)).alias("h"))
    items = bench.select(F.col(item).alias("item_id"), word_hashes(F.col(item_text)).alias("words")).distinct()
    items = items.withColumn("size", F.size("words"))
    kinds = items.agg(*[F.sum(F.when(_of_size(k), 1).otherwise(0)).alias(k) for k in ("short", "mid")],
                      F.sum("size").alias("words"), F.collect_set(F.when(_of_size("short"), F.col("size"))).alias("sizes")).first()
    small = (kinds["words"] or 0) * len(MASKS) <= seeds_max and fits(items, seeds_max)
    hint = F.broadcast if small else (lambda df: df)
    found = None
    for kind in ["long"] + [k for k in ("mid", "short") if kinds[k]]:
        d, b = _hits(docs, items, kind, sorted(kinds["sizes"]))
        if small:
            hit = d.join(F.broadcast(b), "seed").select("doc_id", "th", "h", "item_id",
                                                        (F.col("p") - F.col("q")).alias("diag"))
        else:
            hit = (d.select("doc_id", "th", "p", "seed").join(b, "seed")
                   .select("doc_id", "th", "item_id", (F.col("p") - F.col("q")).alias("diag")).distinct())
            whole = docs.dropDuplicates(["doc_id", "th"]).select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "h")
            hit = hit.join(whole, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))).drop("_d", "_t")
        found = hit if found is None else found.unionByName(hit)
    from_item = F.greatest(F.lit(0), -F.col("diag"))
    count = F.least(F.col("size") - from_item, F.size("h") - F.col("diag") - from_item)
    same = F.zip_with(F.slice("h", F.col("diag") + from_item + 1, count), F.slice("words", from_item + 1, count),
                      lambda a, b: (a == b).cast("int"))
    # Only the aligned part of the document goes on from the hits.
    aligned = found.join(hint(items.withColumnRenamed("item_id", "_i")), F.col("item_id").eqNullSafe(F.col("_i"))).select(
        "doc_id", "th", "item_id", F.col("size").alias("n_words"), same.alias("same"))
    total = F.aggregate("same", F.lit(0), lambda a, x: a + x)
    window = F.exists(F.sequence(F.lit(1), F.size("same")), lambda i: F.aggregate(
        F.slice(F.col("same"), i, F.lit(WINDOW)), F.lit(0), lambda a, x: a + x) >= _need(F.col("n_words")))
    return (aligned.withColumn("matched", total).where(F.col("matched") >= _need(F.col("n_words"))).where(window)
            .groupBy("doc_id", "th", "item_id").agg(F.max("n_words").alias("n_words"), F.max("matched").alias("matched")))


def decontaminate(docs: DataFrame, bench: DataFrame, **names) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item."""
    key, text = names.get("key", "doc_id"), names.get("text", "text")
    bad = overlaps(docs, bench, **names).select(F.col("doc_id").alias("__llm_d"), F.col("th").alias("__llm_t")).distinct()
    return docs.withColumn("__llm_th", text_hash(text)).join(
        bad, F.col(key).eqNullSafe(F.col("__llm_d")) & (F.col("__llm_th") == F.col("__llm_t")), "left_anti").drop("__llm_th")


def overlap_sql(docs: str) -> str:
    """DuckDB SQL for the pairs (doc_id, item_id, n_words, matched)."""
    words = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    return f"""
WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS t, {words} AS ws FROM ({docs})),
dw AS (SELECT DISTINCT doc_id, t, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
b AS (SELECT DISTINCT item_id, {words} AS ws FROM benchmark),
bw AS (SELECT item_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS q FROM b),
m AS (SELECT doc_id, t, item_id, n, q, p - q AS diag,
  CASE WHEN n < {SPAN} THEN n ELSE least({NEED}, CAST(ceil(n * 0.8) AS INTEGER)) END AS need
  FROM dw JOIN bw ON dw.w = bw.w),
c AS (SELECT *, count(*) OVER (PARTITION BY doc_id, t, item_id, diag) AS matched,
  count(*) OVER (PARTITION BY doc_id, t, item_id, diag ORDER BY q
  RANGE BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS near FROM m)
SELECT doc_id, item_id, CAST(max(n) AS INTEGER) AS n_words, CAST(max(matched) AS INTEGER) AS matched FROM c
WHERE near >= need GROUP BY doc_id, t, item_id"""
