import random

import numpy as np
import pytest

from farelake.llm import align, graph, neardup


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def edited(rnd, words, n, vocab):
    out = list(words)
    for _ in range(n):
        at = rnd.randrange(len(out) or 1)
        out[at:at + 1] = [rnd.choice(vocab)] if not out else rnd.choice([[], [rnd.choice(vocab)], [out[at], rnd.choice(vocab)]])
    return out


@pytest.mark.parametrize("least", [0.8, 0.5, 1.0])
def test_alignment_equals_edit_distance(least):
    rnd = random.Random(2)
    pairs = []
    for _ in range(400):
        a = [rnd.randrange(5) for _ in range(rnd.randrange(0, 45))]
        b = edited(rnd, a, rnd.randrange(0, 14), range(5)) if a and rnd.random() < 0.8 else [
            rnd.randrange(5) for _ in range(rnd.randrange(0, 45))]
        pairs.append((np.array(a, np.uint32), np.array(b, np.uint32)))
    want = [lev(a, b) <= int((1 - least) * max(len(a), len(b)) + 1e-9) for a, b in pairs]
    assert align.similar(pairs, least).tolist() == want and 0 < sum(want) < 400


def test_kmers_are_labelled_by_occurrence():
    words = np.array([1, 2, 1, 2, 1, 2], np.uint64)
    k = neardup.labelled_kmers(words, 2)
    assert len(k) == len(set(k.tolist())) == 5
    assert k[0] == neardup.labelled_kmers(words[:2], 2)[0]
    assert len(neardup.labelled_kmers(words[:0], 5)) == 0 and len(neardup.labelled_kmers(words[:3], 5)) == 1


def test_sketches_keep_the_order(monkeypatch):
    a = neardup.mix(np.arange(1, 60, dtype=np.uint64))
    s = neardup.order_sketches(a, 3, 32)
    assert len(s) == 32 and np.array_equal(s, neardup.order_sketches(a.copy(), 3, 32))
    turned = neardup.order_sketches(a[::-1].copy(), 3, 32)
    assert not (s == turned).any()  # the same k-mers in another order
    monkeypatch.setattr(neardup, "CHUNK", 7)
    assert np.array_equal(s, neardup.order_sketches(a, 3, 32))


def classes(spark, df, **kw):
    return {}, sorted(((r.doc_id, r.class_id) for r in neardup.near_classes(spark, df, **kw).collect()), key=str)


def test_classes_equal_brute_force_on_links(spark, docs):
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(500)]
    passage = rnd.choices(vocab, k=40)
    rows, n = [], 0
    for _ in range(25):
        base = rnd.choices(vocab, k=rnd.randrange(60, 160))
        for _ in range(rnd.randrange(1, 6)):
            rows.append((n, " ".join(edited(rnd, base, rnd.randrange(0, 4), vocab))))
            n += 1
    for _ in range(30):  # different texts that share a passage
        rows.append((n, " ".join(rnd.choices(vocab, k=45) + passage)))
        n += 1
    words = [t.split() for _, t in rows]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = [(a, b) for a in range(n) for b in range(a)]
    ok = align.similar([(np.array([int(w[1:]) for w in words[a]]), np.array([int(w[1:]) for w in words[b]]))
                        for a, b in pairs], 0.8)
    for (a, b), link in zip(pairs, ok):
        if link:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = classes(spark, docs(rows))[1]
    assert got == sorted(((i, find(i)) for i in range(n)), key=str)
    assert len({c for _, c in got}) < n - 20


def test_large_group_is_one_class(spark, docs):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    base = rnd.choices(vocab, k=120)
    rows = [(i, " ".join(edited(rnd, base, 2, vocab))) for i in range(200)] + [(i, " ".join(base)) for i in range(200, 400)]
    assert {c for _, c in classes(spark, docs(rows))[1]} == {0}


def test_last_step_finds_links_beside_the_leader(spark, docs):
    """A chain: its ends are not similar, so a star alone would not connect it."""
    rnd = random.Random(6)
    vocab = [f"w{i}" for i in range(4000)]
    chain, rows = rnd.sample(vocab, 100), []
    for i in range(12):
        rows.append((i, " ".join(chain)))
        chain = chain[:i * 8] + [f"n{i}x{j}" for j in range(8)] + chain[i * 8 + 8:]
    got = classes(spark, docs(rows), ell=1, sketches=64)[1]
    assert {c for _, c in got} == {0}


def test_odd_rows(spark, docs, odd):
    rows = odd + [(40, "ALPHA, beta"), (None, "no id here"), (None, "no id here")]
    got = classes(spark, docs(rows))[1]
    by = {}
    for i, c in got:
        by.setdefault(i, []).append(c)
    assert len(got) == len(rows) and by[1] == by[2] == by[3] == [1] and by[4] == [4] and by[6] == [6]
    assert sorted(by[5]) == [5, 5, 5] and by[40] == [5]
    none = sorted(by[None])
    assert none[0] == none[1] < 0 and none[2:] == [1, 1, 5]
    assert classes(spark, docs([]))[1] == []


def test_keep_one(spark, docs):
    d = docs([(3, "a b c d e f"), (1, "A b c d e f!"), (2, "x y z"), (2, "x y z"), (None, "q r"), (None, "q r"), (None, "x y z")])
    out = neardup.keep_one(spark, d)
    assert out.columns == d.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == [("1", "A b c d e f!"), ("2", "x y z"), ("None", "q r")]
    assert neardup.keep_one(spark, docs([])).count() == 0


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5, 5), (None, 3), (2000, 40)]
    rnd.shuffle(edges)
    got = dict(map(tuple, graph.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 0 for i in range(41)} | {2000: 0, 1000: 1000} | {1000 + i: 1000 for i in range(1, 60)}
    assert got == want
    assert graph.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    n, rounds = 3000, []
    real = graph.stored

    def counted(session, df, name, *args):
        rounds.append(name)
        return real(session, df, name, *args)

    monkeypatch.setattr(graph, "stored", counted)
    edges = spark.range(n).selectExpr("id AS a", "id + 1 AS b")
    got = graph.components(spark, edges)
    assert got.count() == n + 1 and [r.root for r in got.select("root").distinct().collect()] == [0]
    assert rounds.count("pointers") <= 25


def test_word_counts_never_rule_out_a_link():
    rnd = random.Random(9)
    texts = [[f"w{rnd.randrange(300)}" for _ in range(60)] for _ in range(12)]
    texts += [edited(rnd, t, rnd.randrange(0, 16), [f"w{i}" for i in range(300)]) for t in texts * 6]
    words = [neardup.Words()(" ".join(t)) for t in texts]
    bags = np.stack([neardup.word_bag(w) for w in words])
    at = np.arange(len(words))
    got = set(neardup.close_pairs(at, np.array([len(w) for w in words]), bags, at, at, 0.8))
    pairs = [(a, b) for a in range(len(words)) for b in range(a + 1, len(words))]
    links = {p for p, ok in zip(pairs, align.similar([(words[a].astype(np.uint32), words[b].astype(np.uint32))
                                                      for a, b in pairs], 0.8)) if ok}
    assert links and links <= got and len(got) < len(pairs) / 3


def test_fine_counts_tell_texts_of_many_common_words_apart():
    """Texts with three quarters in common pass the small bags; the fine ones leave the links."""
    rnd = random.Random(12)
    common, texts = [f"c{rnd.randrange(60)}" for _ in range(600)], []
    for _ in range(12):
        own = common + [f"w{rnd.randrange(5000)}" for _ in range(185)]
        texts += [own, edited(rnd, own, 60, [f"w{i}" for i in range(5000)])]
    words = [neardup.Words()(" ".join(t)) for t in texts]
    at, size = np.arange(len(words)), np.array([len(w) for w in words])
    bags = np.stack([neardup.word_bag(w) for w in words])
    fine = np.stack([neardup.word_bag(w.astype(np.uint32), neardup.FINE) for w in words])
    got = set(neardup.close_pairs(at, size, bags, at, at, 0.8, fine))
    pairs = [(a, b) for a in range(len(words)) for b in range(a + 1, len(words))]
    links = {p for p, ok in zip(pairs, align.similar([(words[a].astype(np.uint32), words[b].astype(np.uint32))
                                                      for a, b in pairs], 0.8)) if ok}
    plain = neardup.close_pairs(at, size, bags, at, at, 0.8)
    assert len(links) >= 12 and links <= got and len(got) < len(plain) / 4


def test_last_step_makes_few_pairs_of_texts_with_a_common_part(spark, docs, monkeypatch):
    """Unlike texts that share most of their words keep their buckets open; few of their pairs are made rows."""
    made, stored = [], neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda s, df, name, *a: (
        made.append(out.count()) if name == "omh-last" else None, out)[1] if (out := stored(s, df, name, *a)) else None)
    rnd = random.Random(13)
    common, rows = [f"c{rnd.randrange(60)}" for _ in range(600)], []
    for i in range(60):
        rows.append((i, " ".join(common + [f"w{rnd.randrange(5000)}" for _ in range(185)])))
    assert classes(spark, docs(rows))[1] == sorted(((i, i) for i in range(60)), key=str)
    assert made and max(made) < 60 * 59 / 2 / 4


def test_large_buckets_go_in_blocks(spark, docs, monkeypatch):
    """Texts that share a passage but are no copies, among them pairs that are."""
    monkeypatch.setattr(neardup, "FEW", 3)
    monkeypatch.setattr(neardup, "BLOCK", 10)
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    passage, rows = rnd.sample(vocab, 60), []
    for i in range(60):
        own = rnd.sample(vocab, 40)
        rows.append((2 * i, " ".join(passage + own)))
        rows.append((2 * i + 1, " ".join(passage + edited(rnd, own, 6, vocab))))
    got = classes(spark, docs(rows))[1]
    assert got == sorted(((i, i - i % 2) for i in range(120)), key=str)


def brute_links(rows):
    """Pairs of positions in ``rows`` with edit similarity 0.8."""
    words = [neardup.Words()(t).astype(np.uint32) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a)]
    return [p for p, ok in zip(pairs, align.similar([(words[a], words[b]) for a, b in pairs], 0.8)) if ok]


@pytest.mark.parametrize("spread", ["random", "even"])
def test_pairs_with_spread_edits_are_found(spark, docs, spread):
    """Pairs at edit similarity 0.80 to 0.90, by one-word edits all over the text."""
    rnd = random.Random(12)
    rows = []
    for i in range(240):
        n = rnd.randrange(30, 300)
        base = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
        other, d = list(base), int((0.20, 0.15, 0.10)[i % 3] * n)
        for at in sorted(rnd.sample(range(n), d) if spread == "random" else [(2 * j + 1) * n // (2 * d) for j in range(d)]):
            other[at] = f"x{rnd.randrange(10**6)}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    assert brute_links(rows) == [(2 * i + 1, 2 * i) for i in range(240)]
    got = dict(classes(spark, docs(rows))[1])
    assert sum(got[2 * i + 1] == 2 * i for i in range(240)) >= 237


def keys_of(spark, texts, least):
    """Keys by position of short texts."""
    hashes = neardup.Words()
    words = [hashes(t) for t in texts]
    rows = [(i, len(w), neardup.short_kmers(w, least).tolist()) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "node long, n_words int, kmers array<long>")
    out = {}
    for r in neardup.short_keys(df.union(df.limit(50)), least).collect():
        out.setdefault(r.node, set()).add(r.b)
    return words, out


@pytest.mark.parametrize("least", [0.8, 0.9, 0.6])
def test_short_pairs_share_a_key_for_certain(spark, least):
    rnd, texts = random.Random(4), []
    for i in range(6000):
        words = 5 if i % 2 else 1000
        a = [f"w{rnd.randrange(words)}" for _ in range(rnd.randrange(1, neardup.SHORT + 1))]
        texts += [" ".join(a), " ".join(edited(rnd, a, rnd.randrange(1, 8), [f"w{j}" for j in range(words)]))]
    words, keys = keys_of(spark, texts, least)
    met = 0
    for i in range(0, len(texts), 2):
        x, y = words[i], words[i + 1]
        if texts[i] != texts[i + 1] and max(len(x), len(y)) <= neardup.SHORT and align.similar([(x, y)], least)[0]:
            met += 1
            assert keys[i] & keys[i + 1], texts[i:i + 2]
    assert met > 500


def test_a_common_opening_is_no_hot_key(spark):
    """Unlike short texts that start alike: without the order by rarity most would share a key."""
    from collections import Counter
    rnd = random.Random(5)
    texts = ["please click here to " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(8)) for _ in range(20_000)]
    sizes = Counter(b for keys in keys_of(spark, texts, 0.8)[1].values() for b in keys)
    assert max(sizes.values()) < 20


def test_every_text_has_order_sketches(spark, docs):
    import pandas as pd
    texts = ["one", "one two", "a b c", "w " * 10, " ".join(f"w{i}" for i in range(40))]
    pdf = pd.DataFrame({"doc_id": range(5), "th": range(5), "text": texts})
    out = next(neardup._signer(2, 3, 64, 0.8)(iter([pdf])))
    assert [len(s) for s in out["sketches"]] == [64] * 5


def test_a_group_of_copies_is_not_joined_once_a_sketch(spark, docs):
    """Near copies of one text meet their leader by the first few sketches; the others are closed by then."""
    rnd = random.Random(6)
    vocab = [f"w{i}" for i in range(300)]
    base = rnd.choices(vocab, k=120)
    rows = [(i, " ".join(edited(rnd, base, 1, vocab))) for i in range(300)]
    seen = []
    real = neardup._apart

    def counted(members):
        out = real(members)
        seen.append(out.count())
        return out

    neardup._apart = counted
    try:
        assert {c for _, c in classes(spark, docs(rows))[1]} == {0}
    finally:
        neardup._apart = real
    assert seen[0] <= 8 * 300 and seen[1] < 300


def test_short_texts_equal_brute_force(spark, docs):
    """Texts of 3 to 28 words, over the bound of what is certain, with up to a fifth of the words edited."""
    rnd = random.Random(14)
    vocab = [f"w{i}" for i in range(3000)]
    rows = [(0, "a b c d e f g"), (1, "a b c d e f x"), (2, "k l m n o"), (3, "k l m n"), (4, "p q r s t u v y z j"), (5, "p q r s x u v y z j")]
    for _ in range(300):
        base = rnd.choices(vocab, k=rnd.randrange(3, 29))
        rows.append((len(rows), " ".join(base)))
        rows.append((len(rows), " ".join(edited(rnd, base, rnd.randrange(1, len(base) // 5 + 2), vocab))))
    got = dict(classes(spark, docs(rows))[1])
    links = brute_links(rows)
    assert len(links) > 150 and [(a, b) for a, b in links if got[a] != got[b]] == []
    assert got[1] == 0 and got[3] == 2 and got[5] == 4
    root = {frozenset(p) for p in links}
    assert all(frozenset((i, c)) in root for i, c in got.items() if i != c)
