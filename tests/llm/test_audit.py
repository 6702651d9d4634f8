import itertools
import re
from collections import Counter

from farelake.llm import audit


def brute(rows, labels):
    """Rows (part, order, step, ...) by applying every order to the rows, one filter after the other."""
    first = {}
    for i, t, _ in rows:
        t = t or ""
        if i is not None:
            first[t] = min(first.get(t, i), i)

    def fails(i, t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        return {x for x, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            re.search(r"[#$%&*|]", t) is not None, i is not None and i > first[t])) if bad}

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failed = [(i, p or "", fails(i, t)) for i, t, p in rows]
    out, shapley = [], Counter()
    for part in {p for _, p, _ in failed}:
        mine = [(i, f) for i, p, f in failed if p == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone, left = [(i, f) for i, f in left if x in f], [(i, f) for i, f in left if x not in f]
                shapley[part, x] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), sum(x in f for _, f in mine) - len(gone),
                            sum(f == {x} for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def run(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, 7, "x", 1, True) for i, t, p in rows],
                                 "doc_id long, text string, source string, k long, part string, n int, A boolean")
    marks = spark.createDataFrame([(*r, "x", 7) for r in labels], "doc_id long, quality int, toxic int, id string, n int")
    out = audit.filter_audit(spark, docs, marks)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    return sorted(map(tuple, out.collect()))


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


def test_odd_rows_equal_brute_force(spark):
    long = words(250)
    rows = [(i, t, p) for i, (t, p) in enumerate([
        (long, "a"), (words(199), "a"), (words(200), "b"), (long + " #", "a"), ("A" * 40 + " " + long, None), (long, "b"),
        ("same " * 300, "a"), (None, "a"), ("", "a"), (" \n\t", ""), ("x\x0by\x0cz q", None), ("UPPER | lower", "b"),
        (words(30_000), "a"), ("É" * 300, "b"), ("Ab " * 200, "a"), (long.upper(), "a")], 10)]
    rows += [(None, long, "a"), (None, None, None), (3, long, "a"), (3, long, "a"), (3, long, "b"), (3, "other", "a"), (-5, long, "c")]
    rows += [(1000 + i, "one text of many", "hot") for i in range(300)]
    labels = [(10, 1, 0), (10, 1, 1), (11, 1, 0), (13, 1, None), (14, 0, 1), (15, None, 1), (None, 1, 1), (1005, 1, 1), (3, 1, 0)]
    got = run(spark, rows, labels)
    assert got == brute(rows, labels)
    assert len(got) == 600 * 5 and any(r[-1] == 0 for r in got)


def test_no_failing_row_no_labels_and_no_rows(spark):
    rows = [(1, words(300), "a"), (2, words(300, 1000), "b")]
    got = run(spark, rows, [])
    assert got == brute(rows, []) and len(got) == 1200 and {r[3] for r in got} == {1}
    assert run(spark, [], [(1, 1, 1)]) == []


def test_prefix_weights_count_every_order():
    at = audit.steps("ABC")
    assert len(at) == 18 and len({(f, p) for _, _, f, p in at}) == 12
    assert Counter(f for _, _, f, p in at if p == 0) == {0: 2, 1: 2, 2: 2}


def test_repeats_do_not_meet_in_one_task(spark):
    rows = spark.range(20_000).selectExpr("id", "unhex('00') AS digest")
    found = audit.repeats(rows).groupBy("salt").count().collect()
    assert len(found) == audit.SALTS and sum(r["count"] for r in found) == 19_999
    assert max(r["count"] for r in found) < 3 * 20_000 / audit.SALTS
