import re

import __spark_entry__ as E


def test_entry_daily_trips_on_smoke_scale(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "trips"]
    rows = df.collect()
    assert len(rows) == 829                              # pickup days of the cleaned sf0.001 trips
    assert sum(r.trips for r in rows) == 2203            # cleaned rows at sf0.001


def test_registry_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90
    rows_only = {k for k in set(q) - set(o) if k != "pipeline" and not re.match(r"op\d+_", k)}
    assert rows_only == {"largest_file", "model_train", "model_train_20_rounds", "score_batch", "score_scenarios", "score_requests"}


def test_star_counts_match_fixture(spark):
    from farelake.plans.star import warehouse
    wh = warehouse(spark, "/root/testdata/sf0.001")
    assert wh.fact_trip.count() == 2203
    assert wh.dim_datetime.count() == 3241
