import math

import pytest
from pyspark.sql import functions as F

from farelake.llm import mixing


def test_poisson_counts_follow_the_rate(spark, docs):
    d = docs([(i, "t", "big" if i % 3 else "small") for i in range(6000)])
    targets = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    out = mixing.poisson_mix(spark, d, targets, total=8000).persist()
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["big"] - 2000) < 4 * math.sqrt(2000) and abs(n["small"] - 6000) < 4 * math.sqrt(6000)
    per = out.where("source = 'small'").groupBy("doc_id").count().groupBy("count").count().collect()
    share = {r[0]: r[1] / 2000 for r in per}
    for k in (1, 2, 3, 4):
        assert abs(share[k] - math.exp(-3) * 3 ** k / math.factorial(k)) < 0.05
    again = mixing.poisson_mix(spark, d.repartition(7), targets, total=8000)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_large_rates_are_split(spark, docs):
    out = mixing.poisson_mix(spark, docs([(i, "t") for i in range(50)]), total=50 * 500)
    n = [r["count"] for r in out.groupBy("doc_id").count().collect()]
    assert len(n) == 50 and abs(sum(n) / 50 - 500) < 4 * math.sqrt(500 / 50)


def test_order_is_global(spark, docs):
    order = [r.mix_order for r in mixing.poisson_mix(spark, docs([(i, "t") for i in range(300)])).collect()]
    assert order == sorted(order)


def test_odd_rows(spark, docs, odd):
    d = docs([(*r, None if i % 2 else "s") for i, r in enumerate(odd)])
    out = mixing.poisson_mix(spark, d, total=200)
    assert out.columns == [*d.columns, "mix_copy", "mix_order"]
    assert {r.source for r in out.select("source").distinct().collect()} == {None, "s"}
    twins = out.where("doc_id = 5 AND text = 'alpha beta'").groupBy("mix_copy", "source").count().collect()
    assert twins and len({r["count"] for r in twins}) == 1
    assert mixing.poisson_mix(spark, docs([])).count() == 0


def test_zero_weights_give_nothing(spark, docs):
    targets = spark.createDataFrame([("other", 1.0)], "source string, weight double")
    assert mixing.poisson_mix(spark, docs([(1, "a")]), targets).count() == 0


def test_replaces_its_own_columns(spark, docs):
    d = docs([(1, "a")]).withColumn("mix_copy", F.lit("old"))
    assert dict(mixing.poisson_mix(spark, d, total=5).dtypes)["mix_copy"] == "int"


@pytest.mark.parametrize("rate", [0.1, 1.0, 7.5, 31.9])
def test_distribution_terms_reach_one(rate):
    p = s = math.exp(-rate)
    for j in range(1, mixing.TERMS + 1):
        p *= rate / j
        s += p
    assert 1 - s < 1e-12
