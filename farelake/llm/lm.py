"""Language-model scoring with a log-frequency Bloom filter.

Training counts unigrams and bigrams of all training texts. Tokens are
hashed, counted per block of text with array operations, and the partial
counts dealt to pages by hash; each page is summed by one task, so a page has
a bounded number of entries whatever the corpus, and a frequent n-gram sends
one entry per block. A page's n-grams go into its own stretch of a Bloom
filter: a count c is quantised to ``1 + floor(log2 c)``, and an n-gram enters
once for each level up to its own. A lookup probes level after level until
one is missing, which gives the quantised count (false positives can only
raise it). No count is pruned or capped; the filter grows with the corpus.

Workers get the filter by broadcast, a segment of at most ``SEGMENT_BYTES``
at a time. When the filter has several segments, passes over the texts fill
in the levels of each token, one segment a pass, with the texts and levels
stored in the shared folder between passes. At one segment there is one pass.

The score interpolates: ``p(w | v) = (c(v w) + MU * p(w)) / (c(v) + MU)`` with
``p(w) = (c(w) + 1) / (N + V + 1)`` on the filter's counts. The base score
uses exact unigram counts: those of the most frequent tokens (at most
``TABLE_MAX`` of them) are broadcast, the others joined by token hash.

Results on odd input: null and empty texts have one token, the end; null ids
count as the id ''; rows that repeat an id are scored (and counted) each;
an empty table gives no rows; with nothing to learn from, every count is 0;
other columns are ignored. Token identity is a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import crc_mod, discard, stored

BLOCK_BYTES = 4 << 20
#: Scoring holds the filter as well, so its blocks are smaller.
SCORE_BLOCK_BYTES = 2 << 20
PAGE_TOKENS = 400_000
BITS = 8
PROBES = 4
SEGMENT_BYTES = 128 << 20
TABLE_MAX = 2_000_000
MU = 300.0
LEVELS = 48

U64 = np.uint64
UNI, BI = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
STEP = U64(0xD6E8FEB86659FD93)
PROBE = [U64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2127599BF4325C37, 0x880355F21E6D1965)]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").lower().split()


class Block:
    """The tokens of some texts: word numbers, hashes, and bigrams with the end before each text."""

    def __init__(self, texts: list[str]):
        vocab: dict[bytes, int] = {b"": 0}
        ids: list[int] = []
        ends = []
        number = vocab.setdefault
        for t in texts:
            ids += [number(w, len(vocab)) for w in tokens(t)]
            ids.append(0)
            ends.append(len(ids))
        self.ids, self.ends = np.array(ids, np.int64), np.array(ends, np.int64)
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in vocab), U64, len(vocab))
        self.prev = np.r_[0, self.ids[:-1]] if len(self.ids) else self.ids
        left, right = self.hashes[self.prev], self.hashes[self.ids]
        self.bigrams = mix(left * STEP ^ (right << U64(29) | right >> U64(35)))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        total = np.r_[0.0, np.cumsum(values)]
        return total[self.ends] - total[np.r_[0, self.ends[:-1]]]


def blocks(pdf: pd.DataFrame, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` characters of text."""
    at, size = 0, 0
    for i, t in enumerate(pdf["text"]):
        if size and size + len(t or "") > most:
            yield at, i
            at, size = i, 0
        size += len(t or "")
    if at < len(pdf):
        yield at, len(pdf)


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(h, return_inverse=True)
    return keys, np.bincount(where, weights=n, minlength=len(keys)).astype(np.int64)


PART = "page int, uh binary, un binary, bh binary, bn binary"


def _counter(pages: int):
    def by_page(h, n):
        page = (h % U64(pages)).astype(np.int64)
        order = np.argsort(page, kind="stable")
        cuts = np.searchsorted(page[order], np.arange(pages + 1))
        return h[order], n[order].astype(np.int64), cuts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b in blocks(pdf, BLOCK_BYTES):
                block = Block(pdf["text"].iloc[a:b].tolist())
                uh, un, uc = by_page(block.hashes, np.bincount(block.ids, minlength=len(block.hashes)))
                bh, bn, bc = by_page(*np.unique(block.bigrams, return_counts=True))
                some = np.flatnonzero((np.diff(uc) > 0) | (np.diff(bc) > 0))
                cut = lambda x, c: [x[c[p]:c[p + 1]].tobytes() for p in some]
                yield pd.DataFrame({"page": some, "uh": cut(uh, uc), "un": cut(un, uc),
                                    "bh": cut(bh, bc), "bn": cut(bn, bc)})
    return run


def levels(n: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 + floor(log2 n) for n >= 1."""
    return np.frexp(n.astype(np.float64))[1].astype(np.int64)


def level_count(level: np.ndarray) -> np.ndarray:
    """The middle of a level's counts; 0 for level 0."""
    low = np.exp2(level.astype(np.float64) - 1)
    return np.where(level == 0, 0.0, (3 * low - 1) / 2)


def _spots(h: np.ndarray, level, salt: np.uint64, bits) -> list[np.ndarray]:
    key = mix(h * salt + np.asarray(level).astype(U64) * STEP)
    return [(mix(key * p) % bits).astype(np.int64) for p in PROBE[:PROBES]]


MODEL = "page int, uh binary, un binary, n long, types long, sizes array<long>, nbits long, bits binary"


def _build_page(key, pdf: pd.DataFrame) -> pd.DataFrame:
    cat = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in pdf[c]])
    uh, un = _summed(cat("uh", U64), cat("un", np.int64))
    bh, bn = _summed(cat("bh", U64), cat("bn", np.int64))
    ul, bl = levels(un), levels(bn)
    nbits = max(64, int(BITS * (ul.sum() + bl.sum())))
    filled = np.zeros(nbits, bool)
    for h, l, salt in ((uh, ul, UNI), (bh, bl, BI)):
        for j in range(1, int(l.max(initial=0)) + 1):
            for at in _spots(h[l >= j], j, salt, U64(nbits)):
                filled[at] = True
    return pd.DataFrame({"page": [key[0]], "uh": [uh.tobytes()], "un": [un.tobytes()], "n": [int(un.sum())],
                         "types": [len(uh)], "sizes": [np.bincount(ul, minlength=LEVELS).tolist()],
                         "nbits": [nbits], "bits": [np.packbits(filled, bitorder="little").tobytes()]})


def train(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, int]:
    """The stored pages of counts and filter, and the number of pages, of ``docs`` (text)."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    pages = max(16, math.ceil(chars / 6 / PAGE_TOKENS))
    parts = docs.select("text").mapInPandas(_counter(pages), PART)
    return stored(spark, parts.groupBy("page").applyInPandas(_build_page, MODEL), "lm-model"), pages


class Filter:
    """One segment of the filter, as workers hold it."""

    def __init__(self, pages: int, rows):
        self.pages = pages
        self.nbits = np.zeros(pages, U64)
        self.start = np.zeros(pages, np.int64)
        at = 0
        for page, nbits, bits in rows:
            self.nbits[page], self.start[page] = nbits, at
            at += len(bits)
        self.bits = np.frombuffer(b"".join(b for _, _, b in rows), np.uint8)

    def level(self, h: np.ndarray, salt: np.uint64) -> np.ndarray:
        """Quantised counts of n-gram hashes; 0 for those of other segments."""
        page = (h % U64(self.pages)).astype(np.int64)
        out = np.zeros(len(h), np.uint8)
        alive = np.flatnonzero(self.nbits[page] > 0)
        for j in range(1, LEVELS):
            if not len(alive):
                break
            p = page[alive]
            ok = np.ones(len(alive), bool)
            for at in _spots(h[alive], j, salt, self.nbits[p]):
                ok &= (self.bits[self.start[p] + (at >> 3)] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            alive = alive[ok]
            out[alive] = j
        return out


PASS = "row long, doc_id long, held_out boolean, text string, levels binary"
SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
          "score double, rest_h array<long>, rest_n array<int>")


def _pass(held, table, total: int, types: int, first: bool, last: bool, exact: bool):
    """One pass over the texts with one segment of the filter. ``held``: the broadcast Filter."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        seg: Filter = held.value
        th, tn = table.value
        row = TaskContext.get().partitionId() << 40
        for pdf in batches:
            for a, b in blocks(pdf, SCORE_BLOCK_BYTES):
                cut = pdf.iloc[a:b]
                block = Block(cut["text"].tolist())
                grams, where = np.unique(block.bigrams, return_inverse=True)
                uni, bi = seg.level(block.hashes, UNI)[block.ids], seg.level(grams, BI)[where]
                if first:
                    rows = np.arange(row, row + len(cut))
                    row += len(cut)
                else:
                    rows = cut["row"].to_numpy()
                    before = np.frombuffer(b"".join(cut["levels"]), np.uint8).reshape(-1, 2)
                    uni, bi = np.maximum(uni, before[:, 0]), np.maximum(bi, before[:, 1])
                head = {"row": rows, "doc_id": cut["doc_id"].astype("Int64"), "held_out": cut["held_out"]}
                if not last:
                    both = np.stack([uni, bi], axis=1)
                    yield pd.DataFrame(head | {"text": cut["text"], "levels": [
                        x.tobytes() for x in np.split(both, block.ends[:-1])]})
                    continue
                yield pd.DataFrame(head | _scores(block, uni, bi, th, tn, total, types, exact))
    return run


def _scores(block: Block, uni, bi, th, tn, total: int, types: int, exact: bool) -> dict:
    cw = level_count(uni)
    prev = np.r_[0, np.arange(len(uni) - 1)]
    end = level_count(uni[block.ends[0] - 1:block.ends[0]])[0]
    cv = cw[prev]
    cv[np.r_[0, block.ends[:-1]]] = end
    p = (np.minimum(level_count(bi), cv) + MU * (cw + 1) / (total + types + 1)) / (cv + MU)
    at = np.minimum(np.searchsorted(th, block.hashes), max(len(th) - 1, 0))
    known = th[at] == block.hashes if len(th) else np.zeros(len(block.hashes), bool)
    c = np.where(known, tn[at] if len(th) else 0, 0)
    n = np.diff(np.r_[0, block.ends])
    rest_h, rest_n = [], []
    if exact:
        rest_h = rest_n = [np.zeros(0, np.int64)] * len(n)
    else:
        for ids in np.split(block.ids, block.ends[:-1]):
            u, k = np.unique(ids[~known[ids]], return_counts=True)
            rest_h.append(block.hashes[u].view(np.int64))
            rest_n.append(k.astype(np.int32))
    return {"n_tokens": n, "n_known": block.per_text(known[block.ids]).round().astype(np.int64),
            "base_score": block.per_text(np.log10(c + 1.0)[block.ids]) - n * math.log10(total + types + 1),
            "score": block.per_text(np.log10(p)), "rest_h": rest_h, "rest_n": rest_n}


def _frequent(least: int):
    def run(batches):
        for pdf in batches:
            for uh, un in zip(pdf["uh"], pdf["un"], strict=True):
                h, n = np.frombuffer(uh, U64), np.frombuffer(un, np.int64)
                yield pd.DataFrame({"h": [h[n >= least].tobytes()], "n": [n[n >= least].tobytes()]})
    return run


def _rare(least: int):
    def run(batches):
        for pdf in batches:
            for uh, un in zip(pdf["uh"], pdf["un"], strict=True):
                h, n = np.frombuffer(uh, np.int64), np.frombuffer(un, np.int64)
                yield pd.DataFrame({"h": h[n < least], "c": n[n < least]})
    return run


def score(spark: SparkSession, docs: DataFrame, model: DataFrame, pages: int,
          table_max: int = TABLE_MAX, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Scores of ``docs`` (doc_id, held_out, text) with the stored model."""
    sums = model.agg(F.sum("n"), F.sum("types"), F.sum(F.length("bits")),
                     *[F.sum(F.col("sizes")[i]) for i in range(LEVELS)]).first()
    total, types, size = (int(x or 0) for x in sums[:3])
    sizes = [int(x or 0) for x in sums[3:]]
    # The lowest count from which on the table of exact counts stays within its bound.
    least = next(2 ** (g - 1) for g in range(1, LEVELS + 1) if sum(sizes[g:]) <= table_max)
    exact = least <= 1
    rows = model.select("uh", "un").mapInPandas(_frequent(least), "h binary, n binary").toArrow()
    th = np.frombuffer(b"".join(x.as_py() for x in rows["h"]), U64)
    tn = np.frombuffer(b"".join(x.as_py() for x in rows["n"]), np.int64)
    order = np.argsort(th)
    sc = spark.sparkContext
    table = sc.broadcast((th[order], tn[order]))
    segments = max(1, math.ceil(size / segment_bytes))
    df = docs.select("doc_id", "held_out", "text")
    before: list[str] = []
    for s in range(segments):
        mine = model.where(F.col("page") % segments == s).select("page", "nbits", "bits").toArrow()
        held = sc.broadcast(Filter(pages, list(zip(mine["page"].to_pylist(), mine["nbits"].to_pylist(),
                                                   mine["bits"].to_pylist(), strict=True))))
        del mine
        last = s == segments - 1
        after: list[str] = []
        df = stored(spark, df.mapInPandas(_pass(held, table, total, types, s == 0, last, exact),
                                          SCORED if last else PASS), "lm-scores" if last else "lm-levels", after)
        discard(spark, before)
        before = after
        held.destroy()
    table.destroy()
    if not exact:
        rare = model.select("uh", "un").mapInPandas(_rare(least), "h long, c long")
        rest = df.select("row", F.explode(F.arrays_zip("rest_h", "rest_n")).alias("r")).select(
            "row", F.col("r.rest_h").alias("h"), F.col("r.rest_n").alias("k"))
        more = rest.join(rare, "h").groupBy("row").agg(
            F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("more"), F.sum("k").alias("more_known"))
        df = df.join(more, "row", "left").withColumns({
            "base_score": F.col("base_score") + F.coalesce("more", F.lit(0.0)),
            "n_known": F.col("n_known") + F.coalesce("more_known", F.lit(0))})
    return df.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                     "base_score", "score")


def lm_scores(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
              folds: int = 7, held: int = 2, **limits) -> DataFrame:
    """Learn from the documents outside the held-out fold and score all of them."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       (crc_mod(key, folds) == held).alias("held_out"))
    model, pages = train(spark, docs.where(~F.col("held_out")))
    return score(spark, docs, model, pages, **limits)
