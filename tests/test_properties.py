"""Properties: long-form lags equal wide windows, windows tile the range,
dedupe is order independent, entry contract holds."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tslake.operators.dedupe import latest_per_key
from tslake.operators.features import Feature, lag_long, wide_features
from tslake.operators.gold import to_wide
from tslake.operators.state import request_windows

D = dt.date


def test_long_lag_equals_wide_window(spark):
    rnd = random.Random(7)
    months = [D(2000 + i // 12, i % 12 + 1, 1) for i in range(40)]
    rows = [(s, m, float(rnd.randint(1, 99))) for s in ("a", "b", "c") for m in months if rnd.random() > 0.2]
    long = spark.createDataFrame(rows, "series_name string, reference_month date, valor double")
    wide = to_wide(long, ["a", "b", "c"])
    w = Window.orderBy("reference_month")
    expect = wide.select("reference_month", *[F.lag(s, k).over(w).alias(f"{s}_{k}") for s in "abc" for k in (1, 3, 12)])
    got = wide_features(long, [Feature(f"{s}_{k}", "lag", (s,), k) for s in "abc" for k in (1, 3, 12)])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.collect()))
    # the long form pivots back to the same cells
    ll = {(r.series_name, r.reference_month): r.lag_3 for r in lag_long(long, [3]).collect()}
    for r in expect.collect():
        for s in "abc":
            assert ll.get((s, r.reference_month)) == getattr(r, f"{s}_3")


@settings(max_examples=15, deadline=None)
@given(start=st.dates(D(1980, 1, 1), D(2020, 1, 1)), days=st.integers(0, 9000), freq=st.sampled_from(["daily", "monthly"]))
def test_request_windows_tile_the_range(spark, start, days, freq):
    end = start + dt.timedelta(days=days)
    spans = spark.createDataFrame([("s", freq, start, end)], "series_name string, frequency string, start_date date, end_date date")
    wins = sorted((r.window_start, r.window_end) for r in request_windows(spans).collect())
    assert wins[0][0] == start and wins[-1][1] == end
    n = 1826 if freq == "monthly" else 731
    for (a, b), (c, _) in zip(wins, wins[1:]):
        assert (b - a).days == n - 1 and c == b + dt.timedelta(days=1)


def test_dedupe_is_order_independent(spark):
    rows = [("s", D(2020, 1, i % 5 + 1), float(i), i) for i in range(200)]
    a = spark.createDataFrame(rows, "series_name string, data date, valor double, k int")
    b = spark.createDataFrame(list(reversed(rows)), a.schema).repartition(7)
    ra = sorted(map(tuple, latest_per_key(a, ["series_name", "data"], ["k"]).collect()))
    rb = sorted(map(tuple, latest_per_key(b, ["series_name", "data"], ["k"]).collect()))
    assert ra == rb and len(ra) == 5


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and df.columns[0] == "reference_month"
    from tslake.plans.registry import QUERIES

    # every query of the library has its SQL; some of the optional ones cannot be stated in SQL
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())


def test_unknown_frequency_is_an_error(spark):
    import pytest

    spans = spark.createDataFrame([("s", "weekly", D(2020, 1, 1), D(2020, 3, 1))],
                                  "series_name string, frequency string, start_date date, end_date date")
    with pytest.raises(Exception, match="Frequency not supported: weekly"):
        request_windows(spans).collect()
