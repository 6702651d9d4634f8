import random

import pytest

from farelake.llm import linededup


def brute(rows, least):
    """Lines that lie in a run of at least ``least`` words that occurred earlier."""
    seq = []
    for i, t in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = t.split("\n")
        full = [(p, x.strip(" \t\r")) for p, x in enumerate(lines) if x.strip(" \t\r")]
        seq.append((i, t, lines, full))
    seen, gone = {}, {}
    for n, (_, _, _, full) in enumerate(seq):
        for a in range(len(full)):
            words, content = 0, []
            for b in range(a, len(full)):
                content.append(full[b][1])
                words += len(full[b][1].split())
                if words >= least:
                    seen.setdefault(tuple(content), (n, a))
    for n, (_, _, _, full) in enumerate(seq):
        for a in range(len(full)):
            words, content = 0, []
            for b in range(a, len(full)):
                content.append(full[b][1])
                words += len(full[b][1].split())
                if words >= least and seen[tuple(content)] < (n, a):
                    gone.setdefault(n, set()).update(range(full[a][0], full[b][0] + 1))
    clean = {(i, t): "\n".join(x for p, x in enumerate(lines) if p not in gone.get(n, ()))
             for n, (i, t, lines, _) in enumerate(seq)}
    return sorted(((r[0], clean.get(r)) for r in rows), key=str)


def run(df, least):
    return sorted(((r.doc_id, r.text) for r in linededup.dedup_lines(df, min_words=least).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, docs, seed):
    rnd = random.Random(seed)
    lines = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 6))) for _ in range(25)] + ["", "  "]
    passages = [[rnd.choice(lines) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(60):
        t = [rnd.choice(lines) for _ in range(rnd.randrange(0, 10))]
        for _ in range(rnd.randrange(0, 3)):
            at = rnd.randrange(len(t) + 1)
            t[at:at] = rnd.choice(passages)
        rows.append((i, "\n".join(t)))
    assert run(docs(rows), 8) == brute(rows, 8)


def test_a_long_line_repeats_across_documents(spark, docs):
    passage = " ".join(f"w{i}" for i in range(50))
    short = " ".join(f"v{i}" for i in range(49))
    rows = [(i, f"start {i}\n{passage}\nend {i}\n{short}") for i in range(40)]
    got = dict(run(docs(rows), 50))
    assert got[0] == rows[0][1] and all(got[i] == f"start {i}\nend {i}\n{short}" for i in range(1, 40))


def test_odd_rows(spark, docs, odd):
    rows = odd + [(20, "a b c\r\nd e f"), (21, " a b c\nd e f\t"), (22, "a b c d e f"), (23, "x\n\n\na b c\n\nd e f\n\ny"),
                  (None, "a b c\nd e f"), (24, "a b c\nd e f"), (24, "a b c\nd e f")]
    out = run(docs(rows), 6)
    small = [r for r in rows if r[0] != 6]
    assert [r for r in out if r[0] != 6] == brute(small, 6)
    assert (21, "") in out and (23, "x\n\n\n\ny") in out and (None, "") in out and out.count((24, "")) == 2
    assert run(docs([]), 6) == []


def test_counts_and_columns(spark, docs):
    d = docs([(1, "a b c\nd"), (2, "a b c\ne")])
    out = linededup.dedup_lines(d, min_words=3)
    assert out.columns == [*d.columns, "n_lines", "n_removed"]
    assert sorted((r.doc_id, r.n_lines, r.n_removed) for r in out.collect()) == [(1, 2, 0), (2, 2, 1)]
    assert linededup.dedup_lines(d, min_words=3, counts=False).columns == d.columns


def test_no_python_in_the_plan(spark, docs):
    plan = linededup.dedup_lines(docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
