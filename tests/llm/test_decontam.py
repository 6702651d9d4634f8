import itertools
import random
import re

import pytest

from farelake.llm import decontam


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def brute(rows, bench):
    out = set()
    for (i, t), (b, u) in itertools.product(set(rows), set(bench)):
        d, x = words(t), words(u)
        if not x:
            continue
        need = len(x) if len(x) < 8 else min(11, -(-len(x) * 4 // 5))
        best = 0
        for diag in range(-len(x) + 1, len(d)):
            same = [0 <= diag + q < len(d) and d[diag + q] == w for q, w in enumerate(x)]
            if any(sum(same[s:s + 13]) >= need for s in range(len(x))):
                best = max(best, sum(same))
        if best:
            out.add((i, t, b, best))
    return sorted(((i, b, m) for i, _, b, m in out), key=str)


def bench_frame(spark, bench):
    return spark.createDataFrame([(b, u, "x", 7) for b, u in bench], "item_id long, text string, words string, size int")


def run(spark, d, bench, **kw):
    got = decontam.overlaps(d, bench_frame(spark, bench), **kw).collect()
    return sorted(((r.doc_id, r.item_id, r.matched) for r in got), key=str)


@pytest.mark.parametrize("mask", decontam.MASKS)
def test_each_mask_hits_every_tolerated_window(mask):
    assert max(mask) + 1 == decontam.SPAN
    for size, errors in ((13, 2), (12, 1), (11, 0)):
        for wrong in itertools.combinations(range(size), errors):
            assert any(all(s + o not in wrong for o in mask) for s in range(size - max(mask)))


@pytest.mark.parametrize("seeds_max", [decontam.SEEDS_MAX, 0])
def test_equals_brute_force(spark, docs, seeds_max):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    bench = [(b, " ".join(rnd.choices(vocab, k=rnd.randrange(13, 30)))) for b in range(12)]
    rows = []
    for i in range(80):
        t = rnd.choices(vocab, k=rnd.randrange(0, 40))
        if i % 2:
            item = words(rnd.choice(bench)[1])
            a = rnd.randrange(0, 4)
            piece = item[a:a + rnd.randrange(9, 30)]
            for _ in range(rnd.randrange(0, 4)):
                piece[rnd.randrange(len(piece))] = rnd.choice(vocab)
            at = rnd.randrange(len(t) + 1)
            t[at:at] = piece
        rows.append((i, "!, ".join(t).upper()))
    want = brute(rows, bench)
    assert len(want) > 15 and run(spark, docs(rows), bench, seeds_max=seeds_max) == want


@pytest.mark.parametrize("seeds_max", [decontam.SEEDS_MAX, 0])
def test_short_items_and_odd_rows(spark, docs, odd, seeds_max):
    rows = odd + [(30, "so alpha, Beta!"), (31, "one two three four five six seven"), (32, "one two three four five six")]
    bench = [(1, "alpha beta"), (2, None), (3, ""), (4, "one two three four five six seven"), (4, "one two three four five six seven"),
             (None, "other words"), (5, "...")]
    got = run(spark, docs(rows), bench, seeds_max=seeds_max)
    assert got == brute(rows, bench)
    assert (None, 1, 2) in got and (5, None, 2) in got and (31, 4, 7) in got and not any(i == 32 for i, _, _ in got)
    assert run(spark, docs([]), bench, seeds_max=seeds_max) == [] == run(spark, docs(rows), [], seeds_max=seeds_max)


def test_decontaminate_drops_rows_not_ids(spark, docs):
    item = " ".join(f"q{i}" for i in range(20))
    d = docs([(1, "clean"), (2, f"x {item} y"), (2, "clean too"), (None, item), (None, None), (1, "clean")])
    out = decontam.decontaminate(d, bench_frame(spark, [(1, item)]))
    assert out.columns == d.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == [
        ("1", "clean"), ("1", "clean"), ("2", "clean too"), ("None", "None")]


def test_texts_are_read_once_and_no_python(spark, docs):
    d = docs([(1, "a b c")])
    plan = decontam.overlaps(d, bench_frame(spark, [(1, " ".join("abcdefghijklmnop"))]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_mid_masks_hit_every_tolerated_pattern():
    """Words that lie outside the document count as wrong ones at the ends."""
    assert {max(m) for m in decontam.MID_MASKS} == {5}
    for size in range(decontam.SPAN, decontam.WINDOW):
        for errors in range(size - -(-size * 4 // 5) + 1):
            for wrong in itertools.combinations(range(size), errors):
                assert any(all(s + o not in wrong for o in mask) for mask in decontam.MID_MASKS for s in range(size - 5))


@pytest.mark.parametrize("seeds_max", [decontam.SEEDS_MAX, 0])
def test_items_of_8_to_12_words_equal_brute_force(spark, docs, seeds_max):
    bench = [(n, " ".join(f"i{n}x{j}" for j in range(n))) for n in range(8, 13)]
    rows = [(1, "one two three")]
    for n, text in bench:
        for errors in (1, 2, 3):
            for k, wrong in enumerate(itertools.combinations(range(n), errors)):
                if errors < 3 or k % 20 == 0:
                    words_ = [f"no{j}" if j in wrong else w for j, w in enumerate(text.split())]
                    rows.append((len(rows) + 1, " ".join(["before"] * (k % 3) + words_ + ["after"] * (k % 2))))
        rows += [(len(rows) + 1 + j, " ".join(text.split()[j:j + n - 1])) for j in range(2)]  # a word lies outside
    want = brute(rows, bench)
    assert len(want) > 200 and run(spark, docs(rows), bench, seeds_max=seeds_max) == want


@pytest.mark.parametrize("seeds_max", [decontam.SEEDS_MAX, 0])
def test_short_items_that_start_alike_meet_only_their_own_texts(spark, docs, seeds_max):
    """1,000 items of 1 to 7 words that start with one common word: the seeds are of all their words."""
    rnd = random.Random(21)
    vocab = [f"w{i}" for i in range(40)]
    bench = [(b, " ".join(["the", *rnd.choices(vocab, k=b % 7)])) for b in range(1000)]
    rows = [(i, " ".join(rnd.choices([*vocab, "the", "the"], k=rnd.randrange(0, 30)))) for i in range(40)]
    d = docs(rows)
    assert run(spark, d, bench, seeds_max=seeds_max) == brute(rows, bench)
    items = bench_frame(spark, bench[:700]).select("item_id", decontam.word_hashes(decontam.F.col("text")).alias("words"))
    items = items.withColumn("size", decontam.F.size("words")).where("size > 1")
    h = d.select("doc_id", decontam.text_hash("text").alias("th"), decontam.word_hashes(decontam.F.col("text")).alias("h"))
    left, right = decontam._hits(h, items, "short", list(range(2, 8)))
    # Every hit of a seed is an occurrence of the whole item, not of its first word.
    hits = left.join(right, "seed").select("doc_id", "item_id").distinct().collect()
    assert {tuple(r) for r in hits} == {(i, b) for i, b, _ in brute(rows, [x for x in bench[:700] if " " in x[1]])}
