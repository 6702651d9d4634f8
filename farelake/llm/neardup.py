"""Near-duplicate documents by Order MinHash and banded alignment.

A text is its words, lower-case, without punctuation. Its k-mers (``K``
words) are labelled with their occurrence number, so repeats count. Each of
``SKETCHES`` hash orders picks the ``ELL`` smallest labelled k-mers, and
their order in the text is kept: two texts share a sketch when they have the
same minima in the same order, which falls with edit distance and with moved
blocks, not just with the set of words. Texts that share a sketch are
candidates; a pair is a link when banded alignment finds an edit similarity
of at least ``SIMILARITY`` (1 - word edits / longer length). Classes are the
components of the links.

An edit takes at most ``K`` k-mers, so with ``K`` 2 any pair at edit
similarity 0.8 keeps 3/5 of them (Jaccard similarity 0.43) wherever its edits
are, and shares one of 64 sketches of 3 with probability 0.995 (0.999 at the
Jaccard similarity of 0.47 that random edits leave, above 0.99999 at edit
similarity 0.85).

Pairs of texts of at most ``SHORT`` words are found for certain beside that:
what their labelled k-mers must have in common is known from the lengths, so
if every short text lists its k-mers in one order, the common ones are among
the first few of both (prefix filter). The order is rarest first, by a count
of the k-mers of all short texts, so a phrase that many texts share is no key
unless a text has little else. Each pair of those first few is one key.

Equal texts are one vertex from the start. A bucket (texts that share a
sketch or key) is never expanded into all its pairs. First, by ``LEADS`` of the
sketches alone, every text is aligned with one text: the leader, random per
bucket, that it shares most of them with. That connects groups of copies of
any size. Then all sketches and keys are looked at, but only in buckets that
hold more than one component, as links inside one cannot change a class:
again with the leader of another component that a text shares most with, then
with its other leaders, and last, in buckets where some texts are still not
connected to the leader, texts of different components are compared with each
other, in blocks of bounded size. Pairs whose word counts rule out a link are
not aligned; the last step looks at finer counts.

Results on odd input: null and empty texts, and those without a word, are
equal; texts of fewer than K words are one k-mer; a class id is the smallest
doc_id in the class; rows without id get the class of their text, negative
where no row of the class has an id; repeated rows are in the same class; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.joins import bounded
from farelake.llm.align import similar
from farelake.llm.common import discard, stored, text_hash
from farelake.llm.graph import components

K = 2
ELL = 3
SKETCHES = 64
#: Sketches that the first merge uses.
LEADS = 8
SIMILARITY = 0.8
#: Pairs of texts of at most SHORT words are candidates for certain.
SHORT = 25
CHUNK = 1 << 12
NODES_MAX = 2_000_000
#: Short k-mers in at least FREQUENT texts are ordered by their count, rarer ones come before them.
FREQUENT = 16
FREQUENT_MAX = 1_000_000
#: Buckets up to FEW texts are paired by a join, larger ones in blocks of about BLOCK texts.
FEW = 12
BLOCK = 512
#: Counts of the bags of the last step, whose texts have much in common.
FINE = 1 << 12

U64 = np.uint64
_WORD = re.compile(r"[^\W_]+")
_ORDERS = np.array([xxhash.xxh64_intdigest(b"order", seed=i) | 1 for i in range(256)], U64)
_POWERS = np.array([xxhash.xxh64_intdigest(b"power", seed=i) | 1 for i in range(64)], U64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class Words:
    """Hashes words; remembers those seen, up to a bound."""

    def __init__(self, most: int = 1 << 17):
        self.seen: dict[str, int] = {}
        self.most = most

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.seen) > self.most:
            self.seen.clear()
        get, put, out = self.seen.get, self.seen.__setitem__, []
        for w in _WORD.findall((text or "").lower()):
            h = get(w)
            if h is None:
                h = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
                put(w, h)
            out.append(h)
        return np.array(out, U64)


def labelled_kmers(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k-mer with its occurrence number, in text order."""
    size = min(k, len(words))
    if not size:
        return np.zeros(0, U64)
    n = len(words) - size + 1
    kmer = np.zeros(n, U64)
    for j in range(size):
        kmer += mix(words[j:j + n] + U64(j)) * _POWERS[j]
    order = np.argsort(kmer, kind="stable")
    new = np.r_[True, kmer[order][1:] != kmer[order][:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    nth = np.empty(n, U64)
    nth[order] = (np.arange(n) - first).astype(U64)
    return mix(kmer + nth * U64(0x9E3779B97F4A7C15))


def order_sketches(kmers: np.ndarray, ell: int, sketches: int) -> np.ndarray:
    """One hash per order: its ell smallest labelled k-mers, in text order."""
    if not len(kmers):
        return np.zeros(0, np.int64)
    ell, best = min(ell, len(kmers)), []
    for at in range(0, len(kmers), CHUNK):
        value = _ORDERS[:sketches, None] * kmers[None, at:at + CHUNK]
        for _ in range(min(ell, value.shape[1])):
            pick = value.argmin(axis=1)[:, None]
            np.put_along_axis(value, pick, ~U64(0), axis=1)
            best.append(pick + at)
    best = np.concatenate(best, axis=1)
    if best.shape[1] > ell:
        value = _ORDERS[:sketches, None] * kmers[best]
        best = np.take_along_axis(best, np.argpartition(value, ell - 1, axis=1)[:, :ell], axis=1)
    best = np.sort(best, axis=1)
    out = np.arange(sketches).astype(U64)
    for j in range(ell):
        out = mix(out * _POWERS[j + 8] + kmers[best[:, j]])
    return out.view(np.int64)


def edits_allowed(size: int, least: float) -> int:
    """Most word edits of a link whose longer text has ``size`` words."""
    return int((1 - least) * size + 1e-9)


@cache
def short_plan(least: float, most: int) -> tuple[int, int, dict[int, int]]:
    """(k, t, need by length) of texts of at most ``most`` words: linked texts share at least ``need`` >= t k-mers."""
    longer = [m for m in range(1, most + 1) if edits_allowed(m, least)]
    for k, t in ((2, 2), (1, 2), (1, 1)):
        # Each edit takes at most k of the longer text's m - k + 1 k-mers.
        left = {m: m - k + 1 - k * edits_allowed(m, least) for m in longer}
        if min(left.values(), default=t) >= t:
            break
    need = {}
    for m in longer:
        for n in range(max(1, m - edits_allowed(m, least)), m + 1):
            need[n] = max(t, min(need.get(n, m), left[m]))
    return k, t, need


def short_kmers(words: np.ndarray, least: float) -> np.ndarray:
    """The labelled k-mers that a short text is keyed by; none where equal texts alone could link."""
    k, _, need = short_plan(least, SHORT)
    return labelled_kmers(words, k).view(np.int64) if len(words) in need else np.zeros(0, np.int64)


def short_keys(short: DataFrame, least: float) -> DataFrame:
    """(node, n_words, b): keys of short texts (node, n_words, kmers); any two that could link share one.

    A text's k-mers are distinct and at most SHORT, so its group is small; the counts
    of frequent k-mers are broadcast when they are within a bound.
    """
    _, t, need = short_plan(least, SHORT)
    each = short.select("node", "n_words", F.explode("kmers").alias("kmer")).distinct()   # repeated rows count once
    counts = each.groupBy("kmer").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT)
    ranked = each.join(bounded(counts, max_rows=FREQUENT_MAX), "kmer", "left").groupBy("node", "n_words").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "kmer"))).alias("s"))
    needed = F.element_at(F.array(*[F.lit(need.get(i, 0)) for i in range(1, SHORT + 1)]), F.col("n_words"))
    first = ranked.select("node", "n_words", F.transform(
        F.slice("s", F.lit(1), F.greatest(F.size("s") - needed + t, F.lit(0))), lambda x: x["kmer"]).alias("f"))
    if t == 1:
        keys = F.transform("f", lambda x: F.xxhash64(F.lit(1), x))
    else:
        keys = F.flatten(F.transform("f", lambda x, i: F.transform(
            F.slice("f", i + 2, F.size("f")), lambda y: F.xxhash64(F.lit(2), x, y))))
    return first.select("node", "n_words", F.explode(keys).alias("b"))


SIGNATURE = "doc_id long, th long, digest binary, n_words int, words binary, bag binary, " \
            "sketches array<long>, kmers array<long>"
#: What the last step knows of a text.
WORDS = "node long, n_words int, words binary, bag binary, sketches array<long>, fine binary"


def word_bag(words: np.ndarray, width: int = 256) -> np.ndarray:
    """Word counts by the last bits of the hash (``width``: a power of two), at most 255."""
    at = words & words.dtype.type(width - 1)
    return np.minimum(np.bincount(at.astype(np.int64), minlength=width), 255).astype(np.uint8)


def _fine_bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(fine=[word_bag(np.frombuffer(w, np.uint32), FINE).tobytes() for w in pdf["words"]])


def _signer(k: int, ell: int, sketches: int, least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Words()
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                cut = pdf.iloc[at:at + 1000]
                words = [hashes(t) for t in cut["text"]]
                drawn = [order_sketches(labelled_kmers(w, k), ell, sketches) for w in words]
                yield pd.DataFrame({
                    "doc_id": cut["doc_id"].astype("Int64"), "th": cut["th"],
                    "digest": [xxhash.xxh128_digest(w.tobytes()) for w in words], "n_words": [len(w) for w in words],
                    "words": [w.astype(np.uint32).tobytes() for w in words],
                    "bag": [word_bag(w).tobytes() for w in words],
                    "sketches": drawn,
                    "kmers": [short_kmers(w, least) for w in words]})
    return run


def _aligner(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 2000):
                cut = pdf.iloc[at:at + 2000]
                pairs = [(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32))
                         for x, y in zip(cut["wa"], cut["wb"], strict=True)]
                yield cut[["a", "b"]][similar(pairs, least)]
    return run


def _rows(bags: pd.Series, width: int = 256) -> np.ndarray:
    return np.frombuffer(b"".join(bags), np.uint8).reshape(-1, width)


def few_edits(bag_a: np.ndarray, bag_b: np.ndarray, longer: np.ndarray, least: float) -> np.ndarray:
    """Whether the word counts allow a link.

    Every word that one text has and the other lacks takes an edit, and the
    bags can only show fewer of them, so no link is left out.
    """
    gap = bag_b.astype(np.int16) - bag_a.astype(np.int16)
    edits = np.maximum(np.maximum(gap, 0).sum(1), np.maximum(-gap, 0).sum(1))
    return edits <= (1 - least) * longer + 1e-6


def _bag_filter(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 10_000):
                cut = pdf.iloc[at:at + 10_000]
                longer = np.maximum(cut["na"].to_numpy(), cut["nb"].to_numpy())
                yield cut[["a", "b"]][few_edits(_rows(cut["ba"]), _rows(cut["bb"]), longer, least)]
    return run


def close_pairs(root: np.ndarray, size: np.ndarray, bags: np.ndarray, left: np.ndarray, right: np.ndarray,
                least: float, fine: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs (from left, from right) of texts that are not connected and whose bags, and ``fine`` ones if given, do
    not rule out a link."""
    out = []
    for x in left:
        y = right[(root[right] != root[x]) & ((right > x) if left is right else True)]
        longer = np.maximum(size[y], size[x])
        y = y[np.abs(size[y] - size[x]) <= (1 - least) * longer + 1e-6]
        y = y[few_edits(bags[x], bags[y], np.maximum(size[y], size[x]), least)]
        if fine is not None:
            y = y[few_edits(fine[x], fine[y], np.maximum(size[y], size[x]), least)]
        out += [(x, k) for k in y]
    return out


def _tile(least: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        b, i, j = key
        bags = _rows(pdf["bag"])
        block, node = pdf["block"].to_numpy(), pdf["node"].to_numpy()
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        pairs = close_pairs(pdf["r"].to_numpy(), pdf["n_words"].to_numpy(), bags, left, right, least,
                            _rows(pdf["fine"], FINE))
        # A pair that shares several sketches comes out of the bucket of the smallest.
        before = [frozenset(s[s < b].tolist()) for s in pdf["sketches"]]
        pairs = [(x, y) for x, y in pairs if before[x].isdisjoint(before[y])]
        ends = node[np.array(pairs, np.int64).reshape(-1, 2)]
        return pd.DataFrame({"a": ends.min(axis=1, initial=np.iinfo(np.int64).max), "b": ends.max(
            axis=1, initial=np.iinfo(np.int64).min)})
    return run


def _pairs_beside(stars: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) to align in buckets that are not one component.

    ``stars``: b, node, n_words, r (root) and g (number of texts of the bucket), all texts of buckets that are open
    but their leaders, with which all were aligned before. ``words``: node,
    bag, fine, sketches. Buckets of at most FEW texts are paired by a join, which
    yields at most FEW pairs a row. Larger ones are cut into blocks by hash, and
    a pair of blocks is one group of at most about 2 * BLOCK texts, of which only
    pairs with enough common words come out.
    """
    few = stars.where(F.col("g") <= FEW)
    x = few.select("b", *[F.col(c).alias(f"x_{c}") for c in ("node", "r", "n_words")])
    fits = F.abs(F.col("x_n_words") - F.col("n_words")) <= F.greatest("x_n_words", "n_words") * (1 - least) + 1e-6
    joined = (few.join(x, "b").where((F.col("node") < F.col("x_node")) & (F.col("r") != F.col("x_r")) & fits)
              .select(F.col("node").alias("a"), F.col("x_node").alias("b")))
    many = stars.where(F.col("g") > FEW).join(words.select("node", "bag", "fine", "sketches"), "node")
    many = many.withColumn("blocks", F.ceil(F.col("g") / BLOCK).cast("int"))
    many = many.withColumn("block", F.pmod(F.xxhash64("node", "b"), F.col("blocks")).cast("int"))
    many = many.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    many = many.select("b", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"),
                       "block", "node", "r", "n_words", "bag", "fine", "sketches")
    tiles = many.groupBy("b", "i", "j").applyInPandas(_tile(least), "a long, b long")
    return joined.union(tiles).distinct()


def _links(spark: SparkSession, pairs: DataFrame, words: DataFrame, least: float, scratch: list[str]) -> DataFrame:
    """The pairs (a, b) that alignment confirms."""
    bag = lambda c: words.select(F.col("node").alias(c), F.col("n_words").alias(f"n{c}"), F.col("bag").alias(f"b{c}"))
    side = lambda c: words.select(F.col("node").alias(c), F.col("words").alias(f"w{c}"))
    fit = pairs.select("a", "b").join(bag("a"), "a").join(bag("b"), "b").mapInPandas(_bag_filter(least), "a long, b long")
    met = stored(spark, fit, "fit", scratch).join(side("a"), "a").join(side("b"), "b")
    return stored(spark, met.mapInPandas(_aligner(least), "a long, b long"), "links", scratch)


def _roots(df: DataFrame, roots: DataFrame | None, col: str, out: str) -> DataFrame:
    """``df`` with the root of ``col`` as ``out``; a vertex without links is its own root."""
    if roots is None:
        return df.withColumn(out, F.col(col))
    r = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    return df.join(r, df[col] == r["_n"], "left").withColumn(out, F.coalesce("_r", col)).drop("_n", "_r")


def _merge(spark: SparkSession, roots: DataFrame | None, links: DataFrame, scratch: list[str]) -> DataFrame | None:
    """Roots after joining the components that ``links`` connect."""
    if links.isEmpty():
        return roots
    if roots is None:
        return components(spark, links, scratch)
    ends = _roots(_roots(links, roots, "a", "ra"), roots, "b", "rb")
    up = components(spark, ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")), scratch)
    up = up.select(F.col("node").alias("_u"), F.col("root").alias("_up"))
    moved = roots.join(up, roots["root"] == up["_u"], "left").select("node", F.coalesce("_up", "root").alias("root"))
    new = up.join(roots, up["_u"] == roots["node"], "left_anti").select(
        F.col("_u").alias("node"), F.col("_up").alias("root"))
    return stored(spark, moved.union(new), "roots", scratch)


def _apart(members: DataFrame) -> DataFrame:
    """(b, node, n_words, lead, ln, g): members (node, n_words, r, size, b) that are not of the root of their bucket's
    leader. The leader is of the largest component that the bucket meets (``size``), at random among its texts; ``g``
    is the number of members."""
    lead = F.min(F.struct((-F.col("size")).alias("s"), F.xxhash64("node", "b").alias("o"), F.col("node").alias("lead"),
                          F.col("n_words").alias("ln"), F.col("r").alias("lr")))
    buckets = members.groupBy("b").agg(lead.alias("l"), F.count(F.lit(1)).cast("int").alias("g")).select(
        F.col("b").alias("_b"), "l.lead", "l.ln", "l.lr", "g")
    return (members.join(buckets, (F.col("b") == F.col("_b")) & (F.col("r") != F.col("lr")))
            .select("b", "node", "n_words", "lead", "ln", "g").distinct())


def _shared(stars: DataFrame, least: float) -> DataFrame:
    """(node, lead, c): the leaders of a text of a length that allows a link, and how many sketches it shares with them."""
    near = F.least("n_words", "ln") >= F.greatest("n_words", "ln") * least - 1e-6
    return stars.where(near).groupBy("node", "lead").agg(F.count(F.lit(1)).alias("c"))


def _best(shared: DataFrame) -> DataFrame:
    """Per text the leader that it shares most sketches with, as (a, b)."""
    return shared.groupBy("node").agg(F.max(F.struct("c", "lead")).alias("m")).select(
        F.col("node").alias("a"), F.col("m.lead").alias("b"))


def _words(spark: SparkSession, sig: DataFrame, of: DataFrame, stars: DataFrame, scratch: list[str],
           *more: str) -> DataFrame:
    """What is known of the texts that take part, one row each. They are met by their
    digests, so the words of all other texts stay where they are."""
    nodes = stars.select("node").union(stars.select("lead")).distinct()
    nodes = bounded(stored(spark, of.join(nodes, "node", "left_semi"), "omh-involved", scratch), max_rows=NODES_MAX)
    words = sig.join(nodes, sig["digest"] == nodes["_g"]).where(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("node")))
    return stored(spark, words.select("node", "n_words", "words", "bag", *more).dropDuplicates(["node"]), "omh-words", scratch)


def near_classes(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K,
                 ell: int = ELL, sketches: int = SKETCHES, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, th, class_id): one row per row of ``docs``; th is the hash of its text."""
    scratch: list[str] = []
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_hash(text).alias("th"), F.col(text).alias("text"))
    sig = stored(spark, rows.mapInPandas(_signer(k, ell, sketches, least), SIGNATURE), "omh", scratch)
    nameless = F.xxhash64("digest").bitwiseOR(F.lit(-(1 << 63)))
    of = stored(spark, sig.groupBy("digest").agg(F.min("doc_id").alias("id")).select(
        F.col("digest").alias("_g"), F.coalesce("id", nameless).alias("node")), "omh-nodes", scratch)
    own = (sig.join(of, sig["digest"] == of["_g"]).drop("_g")
           .where(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("node"))))
    # 1. By a few sketches: each text with the leader it shares most of them with, then one pair of texts for any
    # two components that a text and a leader are of.
    members = own.select("node", "n_words", F.col("node").alias("r"), F.lit(1).alias("size"),
                         F.explode(F.slice("sketches", 1, LEADS)).alias("b"))
    stars = stored(spark, _apart(members), "omh-first", scratch)
    words = _words(spark, sig, of, stars, scratch)
    shared = stored(spark, _shared(stars, least), "omh-shared", scratch)
    roots = _merge(spark, None, _links(spark, _best(shared), words, least, scratch), scratch)
    apart = _roots(_roots(shared, roots, "node", "ra"), roots, "lead", "rb").where("ra <> rb")
    apart = apart.groupBy(F.least("ra", "rb"), F.greatest("ra", "rb")).agg(F.max(F.struct("c", "node", "lead")).alias("m"))
    apart = stored(spark, apart.select(F.col("m.node").alias("a"), F.col("m.lead").alias("b")), "omh-apart", scratch)
    roots = _merge(spark, roots, _links(spark, apart, words, least, scratch), scratch)
    # 2. By all sketches and keys: texts that are not of their bucket leader's component, with the leader that they
    # share most with, then with their other leaders.
    rooted = _roots(own.select("node", "n_words", "sketches"), roots, "node", "r")
    if roots is not None:
        sizes = roots.groupBy(F.col("root").alias("_r")).agg(F.count(F.lit(1)).cast("int").alias("size"))
        rooted = rooted.join(bounded(sizes, max_rows=NODES_MAX), F.col("r") == F.col("_r"), "left").drop("_r")
    else:
        rooted = rooted.withColumn("size", F.lit(1))
    rooted = stored(spark, rooted.withColumn("size", F.coalesce("size", F.lit(1))), "omh-rooted", scratch)
    keys = short_keys(own.where(F.size("kmers") > 0).select("node", "n_words", "kmers"), least)
    keys = stored(spark, keys, "omh-keys", scratch)
    of_root = rooted.select("node", "r", "size")
    members = rooted.select("node", "n_words", "r", "size", F.explode("sketches").alias("b")).union(
        keys.join(of_root, "node").select("node", "n_words", "r", "size", "b"))
    stars = stored(spark, _apart(members), "omh-stars", scratch)
    words = _words(spark, sig, of, stars, scratch)
    shared = _shared(stars, least)
    best = stored(spark, _best(shared), "omh-best", scratch)
    roots = _merge(spark, roots, _links(spark, best, words, least, scratch), scratch)
    rest = shared.select(F.col("node").alias("a"), F.col("lead").alias("b")).join(best, ["a", "b"], "left_anti")
    rest = _roots(_roots(rest, roots, "a", "ra"), roots, "b", "rb").where("ra <> rb")
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    roots = _merge(spark, roots, _links(spark, stored(spark, rest, "omh-rest", scratch), words, least, scratch), scratch)
    # 3. In buckets that are not one component: texts apart from their leader with the others, of which a bucket of
    # two has none.
    still = stars.where("g > 2").select("b", "node", "lead", "g")
    still = _roots(_roots(still, roots, "node", "r"), roots, "lead", "lr").where("r <> lr")
    still = bounded(stored(spark, still.select("b", "lead", "g").distinct(), "omh-open", scratch), max_rows=NODES_MAX)
    plain = rooted.select("node", "n_words", F.explode("sketches").alias("b")).union(keys.select("node", "n_words", "b"))
    star = plain.join(still, "b").where("node <> lead").select("b", "node", "n_words", "g")   # the leader is done
    star = stored(spark, _roots(star, roots, "node", "r").distinct(), "omh-last-stars", scratch)
    words = _words(spark, sig, of, star.select("node", F.col("node").alias("lead")), scratch, "sketches")
    words = stored(spark, words.mapInPandas(_fine_bags, WORDS), "omh-fine", scratch)
    last = _pairs_beside(star, words, least)
    roots = _merge(spark, roots, _links(spark, stored(spark, last, "omh-last", scratch), words, least, scratch), scratch)
    out = sig.select("doc_id", "th", "digest").join(of, F.col("digest") == F.col("_g")).select("doc_id", "th", "node")
    out = stored(spark, _roots(out, roots, "node", "class_id").select("doc_id", "th", "class_id"), "omh-classes")
    discard(spark, scratch)
    return out


def keep_one(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """One row of each class: that with the smallest doc_id (of repeated rows, any one).

    A class without ids keeps the rows of its smallest text hash, once.
    """
    classes = near_classes(spark, docs, key, text, **params)
    first = classes.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("f"))
    first = first.select(F.col("f.doc_id").alias("__llm_d"), F.col("f.th").alias("__llm_t"))
    return (docs.withColumn("__llm_th", text_hash(text))
            .join(first, F.col(key).eqNullSafe(F.col("__llm_d")) & (F.col("__llm_th") == F.col("__llm_t")), "left_semi")
            .dropDuplicates([key, "__llm_th"]).drop("__llm_th"))
