"""Operators against plain-Python brute force on random data with a hot
series (a third of all rows), duplicate keys, NULL values and missing months."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from tslake.operators.dedupe import latest_per_key
from tslake.operators.features import calendar_lag, lag_long
from tslake.operators.gold import monthly

D = dt.date


def _rows(seed=11, n=3000):
    rnd = random.Random(seed)
    series = [f"s{i}" for i in range(12)]
    out = []
    for i in range(n):
        s = "hot" if i % 3 == 0 else rnd.choice(series)
        month = rnd.choice([m for m in range(1, 25) if m not in (7, 8)])  # two months nobody has
        d = D(2020 + (month - 1) // 12, (month - 1) % 12 + 1, rnd.randint(1, 28))
        v = None if rnd.random() < 0.05 else round(rnd.uniform(1, 100), 2)
        out.append((s, d, v, i))
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "series_name string, data date, valor double, k long").repartition(7)
    return rows, df


def _latest(rows):
    best = {}
    for s, d, v, k in rows:
        if (s, d) not in best or k > best[(s, d)][1]:
            best[(s, d)] = (v, k)
    return {key: v for key, (v, _) in best.items()}


def test_dedupe_matches_brute_force(spark, data):
    rows, df = data
    got = {(r.series_name, r.data): r.valor for r in latest_per_key(df, ["series_name", "data"], ["k"]).collect()}
    assert got == _latest(rows)


@pytest.mark.parametrize("order", [["data"], ["data", "k"], ["data", "a", "b"], ["data", "a", "b", "valor"], ["a", "valor", "data"], ["data", "a", "b", "c", "k"]])
def test_first_values_match_the_order_of_structs(spark, order):
    """Few distinct values in every column of the order, NULL among them."""
    from pyspark.sql import functions as F

    from tslake.operators.gold import first_values

    rnd = random.Random(17)
    some = lambda *values: rnd.choice([None, *values])
    rows = [(rnd.choice(["hot", "hot", "x", "y", None]), some(D(2020, 1, 1), D(2020, 1, 2), D(2020, 1, 31)), float(rnd.randint(-3, 3)), some(1, 2), some(0.5, float("nan")), some(7, 8), i) for i in range(400)]
    rows += [("one", None, 5.0, None, None, None, 400), ("one", None, 4.0, None, 0.0, 1, 401)]
    df = spark.createDataFrame(rows, "series_name string, data date, valor double, a int, b double, c long, k long").repartition(5)
    got = first_values(df, ["series_name"], order, "valor").collect()
    want = df.groupBy("series_name").agg(F.min(F.struct(*dict.fromkeys([*order, "valor"])))["valor"].alias("v"))
    assert len(got) == 5 and {r.series_name: r.valor for r in got} == {r.series_name: r.v for r in want.collect()}


def test_monthly_first_matches_brute_force(spark):
    """Earliest date, then the keys, of the rows with a value; a month without one has NULL."""
    rnd = random.Random(5)
    rows = [(f"s{i % 4}", D(2020, 1 + i % 5, rnd.randint(1, 3)), None if rnd.random() < 0.2 or i % 20 == 7 else float(rnd.randint(1, 50)), rnd.randint(1, 3), rnd.randint(1, 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "series_name string, data date, valor double, k1 long, k2 int").repartition(5)
    freq = spark.createDataFrame([("s0", "monthly"), ("s1", "monthly"), ("s3", "monthly"), ("s3", "monthly"), ("s9", "daily")], "series_name string, frequency string")
    want = {}
    for s, d, v, k1, k2 in rows:
        cell = want.setdefault((s, D(d.year, d.month, 1)), [])
        if v is not None:
            cell.append((d, k1, k2, v))
    want = {cell: min(found)[3] if found else None for cell, found in want.items() if cell[0] != "s2"}
    got = monthly(df, freq, tiebreak=["k1", "k2", "valor"]).collect()
    assert None in want.values() and len(got) == len(want)
    assert {(r.series_name, r.reference_month): r.valor for r in got} == want


def _monthly_mean(silver):
    acc = defaultdict(list)
    for (s, d), v in silver.items():
        acc[(s, D(d.year, d.month, 1))].append(v)
    return {k: (sum(x for x in vs if x is not None) / len([x for x in vs if x is not None]))
            if any(x is not None for x in vs) else None for k, vs in acc.items()}


def test_monthly_and_lags_match_brute_force(spark, data):
    rows, df = data
    silver = _latest(rows)
    silver_df = latest_per_key(df, ["series_name", "data"], ["k"]).select("series_name", "data", "valor")
    long = monthly(silver_df, "daily")
    got = {(r.series_name, r.reference_month): r.valor for r in long.collect()}
    expect = _monthly_mean(silver)
    assert got.keys() == expect.keys()
    assert all((got[k] is None and expect[k] is None) or got[k] == pytest.approx(expect[k], rel=1e-12) for k in got)

    months = sorted({m for _, m in expect})  # the axis: months present in Gold
    idx = {m: i for i, m in enumerate(months)}
    lagged = {(r.series_name, r.reference_month): r for r in lag_long(long, [1, 3, 12]).collect()}
    for s in {s for s, _ in expect}:
        for m in months:
            for k in (1, 3, 12):
                prev = months[idx[m] - k] if idx[m] - k >= 0 else None
                want = expect.get((s, prev)) if prev else None
                row = lagged.get((s, m))
                have = getattr(row, f"lag_{k}") if row else None
                assert (have is None and want is None) or have == pytest.approx(want, rel=1e-12), (s, m, k)

    cal = {(r.series_name, r.reference_month): r.lag_12 for r in calendar_lag(long, 12).collect()}
    for (s, m), _ in expect.items():
        want = expect.get((s, D(m.year - 1, m.month, 1)))
        have = cal[(s, m)]
        assert (have is None and want is None) or have == pytest.approx(want, rel=1e-12)
