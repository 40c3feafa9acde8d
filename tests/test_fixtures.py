"""Golden fixtures F1-F6 (FIXTURES.md), worked by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslake.operators import gate as gate_ops
from tslake.operators.features import Feature, calendar_lag, lag_long, wide_features
from tslake.operators.gold import monthly, to_wide
from tslake.operators.normalize import error_report, normalize, parse_raw
from tslake.operators.publish import ParquetTarget, publish
from tslake.operators.state import after_watermark, classify
from tslake.operators.upsert import upsert_table
from tslake.plans.marts import build_mart
from tslake.sources import versioned
from tslake.sources.catalog import SERIES_NAMES, catalog_frame
from tslake.sources.schemas import SILVER

D = dt.date


def test_f1_normalise_and_quarantine(spark):
    raw = spark.createDataFrame(
        [("selic", "02/01/2020", "4.02"), ("selic", "03/01/2020", ""), ("selic", "06/01/2020", "1,5"),
         ("selic", "31/02/2020", "9.9"), ("selic", "2020-01-07", "9.9")],
        "series_name string, data string, valor string",
    )
    clean, quarantine = normalize(raw)
    got = sorted((r.data, r.valor) for r in clean.collect())
    assert got == [(D(2020, 1, 2), 4.02), (D(2020, 1, 3), None), (D(2020, 1, 6), None)]
    assert sorted(r.data_text for r in quarantine.collect()) == ["2020-01-07", "31/02/2020"]
    rep = error_report(parse_raw(raw)).collect()[0]
    assert (rep.n_rows, rep.n_quarantined, rep.n_null_valor) == (5, 2, 2)


def _silver_rows(spark, rows):
    plain = T.StructType([f for f in SILVER.fields if f.name != "ingestion_timestamp"])
    return spark.createDataFrame(rows, plain).withColumn("ingestion_timestamp", F.current_timestamp())


def test_f2_upsert_latest_wins_idempotent(spark, tmp_root):
    from tslake.operators.dedupe import latest_per_key

    path = tmp_root + "/silver"
    keys, parts = ["series_name", "data"], ["series_name", "year"]
    target = _silver_rows(spark, [
        (D(2020, 1, 2), 4.0, D(2020, 1, 5), "t1", "selic", 2020, 1),
        (D(2020, 2, 3), 4.5, D(2020, 2, 5), "t1", "selic", 2020, 2),
        (D(2020, 1, 1), 0.21, D(2020, 2, 5), "t1", "ipca", 2020, 1),
    ])
    upsert_table(spark, target, path, keys, parts, SILVER)
    live = lambda: versioned.load(spark, path)["partitions"]
    before = live()
    source = _silver_rows(spark, [
        (D(2020, 2, 3), 4.4, D(2020, 3, 1), "b1", "selic", 2020, 2),
        (D(2020, 2, 3), 4.3, D(2020, 3, 2), "b2", "selic", 2020, 2),
        (D(2020, 2, 4), 4.2, D(2020, 3, 2), "b2", "selic", 2020, 2),
    ])
    source = latest_per_key(source, keys, ["ingestion_date", "batch_id", "valor"])
    for _ in range(2):
        upsert_table(spark, source, path, keys, parts, SILVER)
        out = versioned.read_partitioned(spark, path, SILVER).where("series_name = 'selic'")
        assert sorted((r.data, r.valor) for r in out.collect()) == [
            (D(2020, 1, 2), 4.0), (D(2020, 2, 3), 4.3), (D(2020, 2, 4), 4.2)
        ]
    assert live()["ipca\x1f2020"] == before["ipca\x1f2020"]  # other series' partition untouched


def _f3_gold_long(spark):
    silver = spark.createDataFrame(
        [("dolar_compra", D(2020, 1, 2), 4.00), ("dolar_compra", D(2020, 1, 3), 4.10), ("dolar_compra", D(2020, 2, 3), 4.20),
         ("dolar_venda", D(2020, 1, 2), 4.02), ("dolar_venda", D(2020, 1, 3), 4.12), ("dolar_venda", D(2020, 2, 3), 4.24),
         ("ipca", D(2020, 1, 1), 0.21), ("ipca", D(2020, 3, 1), 0.07)],
        "series_name string, data date, valor double",
    )
    return monthly(silver, catalog_frame(spark))


def test_f3_gold_and_exchange_mart(spark):
    long = _f3_gold_long(spark)
    wide = {r.reference_month: r for r in to_wide(long, SERIES_NAMES).collect()}
    assert set(wide) == {D(2020, 1, 1), D(2020, 2, 1), D(2020, 3, 1)}
    assert wide[D(2020, 1, 1)].dolar_compra == pytest.approx(4.05)
    assert wide[D(2020, 3, 1)].dolar_compra is None and wide[D(2020, 3, 1)].ipca == pytest.approx(0.07)
    mart = {r.reference_month: r for r in build_mart(long, "fct_exchange_rate").collect()}
    jan, feb, mar = mart[D(2020, 1, 1)], mart[D(2020, 2, 1)], mart[D(2020, 3, 1)]
    assert (round(jan.dolar_medio, 6), round(jan.spread_cambio, 6)) == (4.06, 0.02)
    assert jan.cambio_change is None and jan.cambio_mom is None
    assert round(feb.dolar_medio, 6) == 4.22 and round(feb.spread_cambio, 6) == 0.04
    assert round(feb.cambio_change, 6) == 0.17 and round(feb.cambio_mom, 6) == 4.176904
    assert all(getattr(mar, c) is None for c in ("dolar_medio", "spread_cambio", "cambio_change", "cambio_mom"))
    assert all(r.cambio_yoy is None for r in mart.values())


def test_f4_gate_reconcile_pending(spark):
    manifests = spark.createDataFrame(
        [("b1", D(2020, 1, 1), {"selic": "success", "ipca": "no_data"}, "committed"),
         ("b2", D(2020, 1, 2), {"selic": "failed"}, "failed"),
         ("b3", D(2020, 1, 3), {"selic": "new_data"}, "committed")],
        "batch_id string, ingestion_date date, series map<string,string>, status string",
    )
    entries = gate_ops.manifest_entries(manifests)
    landed = spark.createDataFrame(
        [(D(2020, 1, 1), "b1", "selic", "02/01/2020", "1"), (D(2020, 1, 1), "b1", "ipca", "01/01/2020", "2"),
         (D(2020, 1, 2), "b2", "selic", "03/01/2020", "3")],
        "ingestion_date date, batch_id string, series_name string, data string, valor string",
    )
    admitted = gate_ops.gate(landed, entries).select("batch_id", "series_name").collect()
    assert [tuple(r) for r in admitted] == [("b1", "selic")]
    issues = sorted(tuple(r)[1:] for r in gate_ops.reconcile(entries, landed).collect())
    assert issues == [("b2", "selic", "orphan_object"), ("b3", "selic", "missing_object")]
    applied = spark.createDataFrame([(D(2020, 1, 1), "b1")], "ingestion_date date, batch_id string")
    assert [r.batch_id for r in gate_ops.pending_batches(manifests, applied).collect()] == ["b3"]


def test_f5_watermark_and_status(spark):
    wm = spark.createDataFrame(
        [("selic", D(2020, 1, 3)), ("ipca", D(2020, 1, 1))], "series_name string, last_reference_date date"
    )
    landed = spark.createDataFrame(
        [("selic", D(2020, 1, 3)), ("selic", D(2020, 1, 6)), ("ipca", D(2020, 1, 1)), ("dolar_venda", D(2020, 1, 2))],
        "series_name string, data date",
    )
    excl = sorted(tuple(r) for r in after_watermark(landed, wm).collect())
    assert excl == [("dolar_venda", D(2020, 1, 2)), ("selic", D(2020, 1, 6))]
    incl = sorted(tuple(r) for r in after_watermark(landed, wm, inclusive=True).collect())
    assert incl == sorted(excl + [("selic", D(2020, 1, 3)), ("ipca", D(2020, 1, 1))])
    cat = catalog_frame(spark).where(F.col("series_name").isin("selic", "ipca", "dolar_venda"))
    status = classify(cat, after_watermark(landed, wm), wm, F.lit("2020-01-10").cast("date"))
    assert {r.series_name: r.series_status for r in status.collect()} == {
        "selic": "new_data", "ipca": "no_data", "dolar_venda": "new_data"
    }
    # a series whose start lies after "today" is up to date; no history and no rows fails
    late = spark.createDataFrame([("x", 1, "monthly", D(2030, 1, 1), "INDEX", "")], cat.schema)
    none = spark.createDataFrame([("y", 2, "monthly", D(2000, 1, 1), "INDEX", "")], cat.schema)
    st = classify(late.unionByName(none), landed.limit(0), wm, F.lit("2020-01-10").cast("date"))
    assert {r.series_name: r.series_status for r in st.collect()} == {"x": "up_to_date", "y": "failed"}


def _f6_long(spark):
    months = [D(2020, m, 1) for m in range(1, 13) if m != 6] + [D(2021, 1, 1), D(2021, 2, 1)]
    return spark.createDataFrame(
        [("s", m, float(i + 1)) for i, m in enumerate(months)], "series_name string, reference_month date, valor double"
    )


def test_f6_positional_vs_calendar_lag(spark):
    long = _f6_long(spark)
    pos = wide_features(long, [Feature("s_yoy", "pct_change", ("s",), 12)])
    assert round(pos.where("reference_month = date'2021-02-01'").first().s_yoy, 6) == 1200.0
    cal = calendar_lag(long, 12).where("reference_month = date'2021-02-01'").first()
    assert cal.lag_12 == 2.0 and (cal.valor / cal.lag_12 - 1) * 100 == 550.0
    lagged = {r.reference_month: r for r in lag_long(long, [12]).collect()}
    assert lagged[D(2021, 2, 1)].lag_12 == 1.0


def test_f6_publish_modes(spark, tmp_root):
    gold = to_wide(_f6_long(spark), ["s"])
    for mode, dec in (("append_new", 0.0), ("upsert", 11.0)):
        target = ParquetTarget(f"{tmp_root}/{mode}")
        stale = F.when(F.col("reference_month") == F.lit("2020-12-01").cast("date"), F.lit(0.0)).otherwise(F.col("s"))
        versioned.replace(gold.where("reference_month <= date'2020-12-01'").withColumn("s", stale), target.path)
        publish(spark, gold, target, mode=mode)
        out = {r.reference_month: r.s for r in versioned.read(spark, target.path).collect()}
        assert len(out) == 13 and out[D(2021, 2, 1)] == 13.0 and out[D(2020, 12, 1)] == dec


def test_f6_calendar_mode_in_wide_features(spark):
    long = _f6_long(spark)
    both = wide_features(long, [
        Feature("pos", "pct_change", ("s",), 12),
        Feature("cal", "pct_change", ("s",), 12, calendar=True),
        Feature("cal_lag", "lag", ("s",), 12, calendar=True),
    ]).where("reference_month = date'2021-02-01'").first()
    assert round(both.pos, 6) == 1200.0 and round(both.cal, 6) == 550.0 and both.cal_lag == 2.0
    # 2021-06 is absent from Gold, so a calendar lag of 2021-07 would be NULL; 2021-01 reads 2020-01
    jan = wide_features(long, [Feature("c", "lag", ("s",), 12, calendar=True)]).where("reference_month = date'2021-01-01'").first()
    assert jan.c == 1.0


def test_mart_calendar_mode(spark):
    long = _f3_gold_long(spark)
    pos = {r.reference_month: r for r in build_mart(long, "fct_exchange_rate").collect()}
    cal = {r.reference_month: r for r in build_mart(long, "fct_exchange_rate", calendar=True).collect()}
    # Feb follows Jan in both senses; Mar's calendar predecessor (Feb) exists too
    assert round(cal[D(2020, 2, 1)].cambio_mom, 6) == round(pos[D(2020, 2, 1)].cambio_mom, 6) == 4.176904
    assert cal[D(2020, 3, 1)].cambio_change is None  # March has no dolar_venda
