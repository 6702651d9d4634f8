"""Language identification by rank-order profiles.

A text is lower-cased and cut into runs of letters, each padded with one blank
on both sides; its n-grams are the 1 to 3 character windows of the padded runs
(no window starts in one run and ends in another; a blank alone is none). A
language's profile is the ``PROFILE`` most frequent n-grams of all its
training texts, in order (ties: smaller n-gram). A document's own most
frequent ``PROFILE`` n-grams are ranked the same way, and its distance to a
profile is the sum of how far each n-gram is out of place; an n-gram that the
profile lacks counts ``PROFILE``. The nearest language wins (ties: the name
that sorts first). ``score`` is (second - best) / second for the two smallest
distances, between 0 and 1 (the second is the worst possible distance when
there is one language); ``distance`` is the best as a share of the worst.

An n-gram is one integer, its code points packed in 21 bits each, so a text is
counted by one sort of an array, in pieces of ``PIECE`` characters however
long it is. Profiles come from all training rows: tasks count their batches
and hand on sums, one row per language and n-gram, which are added in a
shuffle; a rank limit inside each task leaves at most ``PROFILE`` rows a
language for the last one. The profiles (PROFILE x languages rows, at most
``LANGUAGES`` languages, which is counted) are what the driver holds and
broadcasts. Predicting shuffles nothing.

Results on odd input: a null text, or one without a letter, is ``und`` with
score 0 and a null distance, as is every text when nothing was learned; a text
none of whose n-grams any profile has is the first language, score 0. Rows
with null lang or text only do not train; '' is a language like any other; a
null id counts as the text '' (held out). Repeated rows train and are
predicted each. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.common import crc_mod

PROFILE = 400
LANGUAGES = 10_000
PIECE = 1 << 20          # characters counted at once
BATCH_CHARS = 1 << 21    # texts of a language joined before they are counted
HELD_GRAMS = 1 << 20     # n-gram sums a task holds before it hands them on
BITS = 21
BLANK = 32


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def letter_runs(text: str) -> np.ndarray:
    """Code points of the lower-cased letter runs, one blank before, between and after them."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cp]
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter | np.r_[False, letter[:-1]]
    s = np.where(letter, cp, BLANK)[keep].astype(np.int64)
    return np.r_[BLANK, s, BLANK] if s[-1] != BLANK else np.r_[BLANK, s]


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and the sums of their counts."""
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(codes) == 1:
        return codes[0], counts[0]
    allc, alln = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(allc, kind="stable")
    allc, alln = allc[order], alln[order]
    first = np.flatnonzero(np.r_[True, allc[1:] != allc[:-1]])
    return allc[first], np.add.reduceat(alln, first)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text, as sorted packed integers, and their counts."""
    s = letter_runs(text)
    codes, counts = [], []
    for at in range(0, max(len(s) - 2, 0), PIECE):
        w = s[at:at + PIECE + 2]                      # windows that start in this piece
        one, two = w[1:-1], (w[:-2] << BITS) | w[1:-1]
        three = (two << BITS) | w[2:]
        mid = one != BLANK
        last = at + PIECE + 2 >= len(s)
        tail = [(w[-2:-1] << BITS) | w[-1:]] if last else []
        c, n = np.unique(np.concatenate([one[mid], two, three[mid], *tail]), return_counts=True)
        codes.append(c)
        counts.append(n)
    return merged(codes, counts)


def _train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows():
        for lang, (codes, counts) in held.items():
            yield pd.DataFrame({"lang": lang, "gram": codes, "n": counts})
        held.clear()

    for pdf in batches:
        for lang, texts in pdf.groupby("lang", sort=False)["text"]:
            part, size = [], 0
            pieces = []
            for t in texts:
                part.append(t)
                size += len(t)
                if size >= BATCH_CHARS:
                    pieces.append(gram_counts(" ".join(part)))
                    part, size = [], 0
            pieces.append(gram_counts(" ".join(part)))
            pieces += [held[lang]] if lang in held else []
            held[lang] = merged([c for c, _ in pieces], [n for _, n in pieces])
        if sum(len(c) for c, _ in held.values()) > HELD_GRAMS:
            yield from rows()
    yield from rows()


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """(lang, rank from 0, gram): the ``size`` most frequent n-grams of each language."""
    counts = (docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
              .where("lang IS NOT NULL AND text IS NOT NULL")
              .mapInPandas(_train, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    return (counts.withColumn("r", rank).where(F.col("r") <= size)
            .select("lang", (F.col("r") - 1).alias("rank"), "gram"))


class Profiles:
    """The profiles of all languages as one table sorted by n-gram."""

    def __init__(self, langs: list[str], lang_of: np.ndarray, rank: np.ndarray, gram: np.ndarray,
                 size: int = PROFILE):
        order = np.lexsort((lang_of, gram))
        self.langs, self.size = langs, size
        self.gram, self.lang_of, self.rank = gram[order], lang_of[order].astype(np.int32), rank[order].astype(np.int32)

    def distances(self, text: str) -> tuple[np.ndarray, int] | None:
        """(distance per language, worst possible distance); None for a text without letter."""
        codes, counts = gram_counts(text)
        if not len(codes):
            return None
        # Codes are sorted, so a stable sort by count ranks ties by n-gram.
        top = codes[np.argsort(-counts, kind="stable")[:self.size]]
        lo, hi = np.searchsorted(self.gram, top, "left"), np.searchsorted(self.gram, top, "right")
        n = hi - lo
        rank = np.repeat(np.arange(len(top)), n)
        at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        near = self.size - np.abs(rank - self.rank[at])
        worst = len(top) * self.size
        return worst - np.bincount(self.lang_of[at], near, len(self.langs)).astype(np.int64), worst

    def predict(self, text: str | None) -> tuple[str, float, float | None]:
        """(language, score, distance) of a text."""
        found = self.distances(text) if text is not None and self.langs else None
        if found is None:
            return "und", 0.0, None
        d, worst = found
        best = int(d.argmin())
        second = int(np.delete(d, best).min()) if len(d) > 1 else worst
        return self.langs[best], (second - int(d[best])) / second if second else 0.0, int(d[best]) / worst


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles of the languages of ``docs``, gathered on the driver behind a bound."""
    rows = profiles(docs, text, lang, size).limit(LANGUAGES * size + 1).toArrow()
    if rows.num_rows > LANGUAGES * size:
        raise ValueError(f"more than {LANGUAGES} values of {lang}: this is no language column")
    names = rows["lang"].to_pylist()
    langs = sorted(set(names))
    number = {name: i for i, name in enumerate(langs)}
    return Profiles(langs, np.array([number[x] for x in names], np.int64), rows["rank"].to_numpy(),
                    rows["gram"].to_numpy(), size)


def identify(spark: SparkSession, docs: DataFrame, model: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with a column ``lang_id``: struct (lang_pred, score, distance)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, distance double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        return pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score", "distance"])

    return docs.withColumn("lang_id", predict(F.col(text)))


def language_ids(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                 folds: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, distance) per row; learns from the rows that are not held out."""
    out = crc_mod(key, folds) == held
    model = learn(docs.where(~out), text, lang)
    rows = docs.select(F.col(key).alias("doc_id"), out.alias("held_out"), F.col(text).alias("text"))
    return identify(spark, rows, model).select("doc_id", "held_out", "lang_id.*")
