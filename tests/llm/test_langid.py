import re
from collections import Counter

import numpy as np
import pytest

from farelake.llm import langid
from farelake.llm.common import table


def brute_grams(text):
    """N-grams of 1 to 3 characters of the blank-padded letter runs, with their counts."""
    out = Counter()
    for run in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text.lower())):
        padded = f" {run} "
        for n in (1, 2, 3):
            out.update(padded[i:i + n] for i in range(len(padded) - n + 1) if padded[i:i + n] != " ")
    return out


def ranked(counts, size=langid.PROFILE):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:size]


def brute_profiles(rows, size=langid.PROFILE):
    sums = {}
    for t, lang in rows:
        if t is not None and lang is not None:
            sums.setdefault(lang, Counter()).update(brute_grams(t))
    return {lang: ranked(c, size) for lang, c in sorted(sums.items()) if c}


def brute_predict(profiles, text, size=langid.PROFILE):
    top = ranked(brute_grams(text or ""), size)
    if not top or not profiles:
        return "und", 0.0, None
    d = []
    for lang, grams in profiles.items():
        at = {g: i for i, g in enumerate(grams)}
        d.append((sum(abs(i - at[g]) if g in at else size for i, g in enumerate(top)), lang))
    best, lang = min(d)
    second = sorted(x for x, _ in d)[1] if len(d) > 1 else len(top) * size
    return lang, round((second - best) / second if second else 0.0, 12), best / (len(top) * size)


def unpack(code):
    out = ""
    while code:
        out = chr(code & 0x1FFFFF) + out
        code >>= langid.BITS
    return out


@pytest.mark.parametrize("text", ["", " \n", "123 _ ?", "a", "Hello, hello World", "x1y  z", "ÄÖ straße İstanbul", "日本語 текст αβγ",
                                  "one\x00two", "\ud800 lone", " lead and trail ", "a b c " * 50])
@pytest.mark.parametrize("piece", [1, 2, 5, 1 << 20])
def test_counts_equal_brute_force_in_any_piece(text, piece, monkeypatch):
    monkeypatch.setattr(langid, "PIECE", piece)
    codes, counts = langid.gram_counts(text)
    assert {unpack(int(c)): int(n) for c, n in zip(codes, counts, strict=True)} == dict(brute_grams(text))
    assert np.all(np.diff(codes) > 0)


def test_training_in_small_batches(monkeypatch):
    import pandas as pd
    texts, langs = ["ab cd", "ab", "zz zz é"] * 4, ["x", "y", "x"] * 4
    want = Counter()
    for t, lang in zip(texts, langs, strict=True):
        want.update({(lang, g): n for g, n in brute_grams(t).items()})
    monkeypatch.setattr(langid, "BATCH_CHARS", 3)
    monkeypatch.setattr(langid, "HELD_GRAMS", 2)
    got = Counter()
    for part in langid._train(iter([pd.DataFrame({"lang": langs, "text": texts})] * 2)):
        got.update({(r.lang, unpack(r.gram)): r.n for r in part.itertuples()})
    assert got == Counter({k: 2 * n for k, n in want.items()})


def make(spark, rows):
    """Documents with further columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, t, x, 7, "x", 0.5) for i, t, x in rows],
                                 "doc_id long, text string, lang string, gram long, lang_pred string, score double")


def results(df):
    return sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 12)) for r in df.collect()), key=str)


def test_odd_rows_equal_brute_force(spark):
    import zlib
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0
    en, fr = "the cat and the dog of the house", "le chat et les chiens de la maison"
    rows = [(i, en if i % 2 else fr, "en" if i % 2 else "fr") for i in range(20)]
    rows += [(30, None, "en"), (31, "", "fr"), (32, "12 34", "fr"), (33, en, None), (34, "слово", "fr"), (35, "漢字漢字", None),
             (36, "die Katze", ""), (36, "die Katze", ""), (36, "andere Worte", "de"), (None, en, "en"), (None, None, None),
             (40, "a", "en"), (41, "the " * 50_000 + "x" * 40_000, "en"), (42, "İ ß", "fr")]
    profiles = brute_profiles([(t, x) for i, t, x in rows if not held(i)])
    want = sorted(((i, held(i), *brute_predict(profiles, t)[:2]) for i, t, _ in rows), key=str)
    assert results(langid.language_ids(spark, make(spark, rows))) == want
    assert results(langid.language_ids(spark, make(spark, []))) == []
    only = make(spark, [(1, en, None), (2, None, "en")])
    assert {r[2] for r in results(langid.language_ids(spark, only))} == {"und"}
    one = langid.language_ids(spark, make(spark, [(1, en, "en"), (2, en, "en"), (3, en, "en")])).collect()
    assert {r.lang_pred for r in one} == {"en"} and all(0 < r.score <= 1 for r in one)


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    with pytest.raises(ValueError, match="no language column"):
        langid.learn(make(spark, [(i, "abcdefghi", f"l{i}") for i in range(300)]), size=10)


def test_rank_limit_is_taken_inside_the_tasks(spark):
    plan = langid.profiles(make(spark, [(1, "a b", "en")]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = langid.language_ids(spark, docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) > 150 and sum(r.lang_pred == r.lang for r in out) >= 0.98 * len(out)
