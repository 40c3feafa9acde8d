"""End-to-end incremental runs: landing -> Silver -> Gold -> warehouse -> marts."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tslake.plans import pipeline
from tslake.sources import bronze, versioned
from tslake.sources.catalog import SERIES_NAMES, catalog_frame
from tslake.sources.silver import read_silver, silver_path
from tslake.streaming.stream import run_silver_stream

D = dt.date


def _fetched(spark, rows):
    return spark.createDataFrame(rows, "series_name string, data string, valor string")


def _catalog(spark):
    return catalog_frame(spark).where(F.col("series_name").isin("selic", "ipca", "dolar_venda", "dolar_compra"))


def test_incremental_batches_end_to_end(spark, tmp_root):
    cat = _catalog(spark)
    b1 = _fetched(spark, [
        ("selic", "02/01/2020", "4.0"), ("selic", "03/01/2020", "4.2"), ("ipca", "01/01/2020", "0.21"),
        ("dolar_venda", "02/01/2020", "4.02"), ("dolar_compra", "02/01/2020", "4.00"), ("selic", "xx/01/2020", "1"),
    ])
    m1 = pipeline.ingest(spark, tmp_root, b1, "b1", "2020-01-05", catalog=cat)
    assert m1.first().status == "committed"
    assert [r.batch_id for r in pipeline.bronze_to_silver(spark, tmp_root).collect()] == ["b1"]
    # second batch: old rows are re-fetched but only rows past the watermark land
    b2 = _fetched(spark, [
        ("selic", "02/01/2020", "9.9"), ("selic", "03/02/2020", "4.5"), ("ipca", "01/01/2020", "0.21"),
        ("dolar_venda", "03/02/2020", "4.24"), ("dolar_compra", "03/02/2020", "4.20"),
    ])
    m2 = pipeline.ingest(spark, tmp_root, b2, "b2", "2020-02-05", catalog=cat)
    statuses = m2.select(F.explode("series")).collect()
    assert dict((r.key, r.value) for r in statuses) == {
        "selic": "new_data", "ipca": "no_data", "dolar_venda": "new_data", "dolar_compra": "new_data"
    }
    # re-committing the same batch is a no-op that says so (committed batches are immutable)
    with pytest.warns(UserWarning, match="already committed"):
        assert pipeline.ingest(spark, tmp_root, b2, "b2", "2020-02-05", catalog=cat).isEmpty()
    assert [r.batch_id for r in pipeline.bronze_to_silver(spark, tmp_root).collect()] == ["b2"]
    assert pipeline.bronze_to_silver(spark, tmp_root).isEmpty()  # nothing pending
    silver = {(r.series_name, r.data): r.valor for r in read_silver(spark, silver_path(tmp_root)).collect()}
    assert silver[("selic", D(2020, 1, 2))] == 4.0  # the re-fetched old value did not land
    assert silver[("selic", D(2020, 2, 3))] == 4.5 and len(silver) == 8
    quarantine = spark.read.parquet(tmp_root + "/quarantine").collect()
    assert [r.data_text for r in quarantine] == ["xx/01/2020"]
    long, wide = pipeline.silver_to_gold(spark, tmp_root)
    assert wide.count() == 2 and len(wide.columns) == 33
    pipeline.gold_to_warehouse(spark, tmp_root)
    pipeline.gold_to_warehouse(spark, tmp_root)  # second load appends nothing
    assert versioned.read(spark, tmp_root + "/warehouse/macro_monthly").count() == 2
    marts = pipeline.marts(spark, tmp_root)
    ex = {r.reference_month: r for r in marts["fct_exchange_rate"].collect()}
    assert round(ex[D(2020, 2, 1)].cambio_change, 6) == 0.22


def test_failed_batch_is_invisible(spark, tmp_root):
    landed = spark.createDataFrame(
        [("02/01/2020", "1.0", "selic", D(2020, 1, 5), "f1")],
        "data string, valor string, series_name string, ingestion_date date, batch_id string",
    )
    bronze.land(landed, tmp_root)
    manifest = spark.createDataFrame(
        [("f1", D(2020, 1, 5), {"selic": "failed"}, "failed")],
        "batch_id string, ingestion_date date, series map<string,string>, status string",
    )
    bronze.write_manifests(manifest, tmp_root)
    assert pipeline.bronze_to_silver(spark, tmp_root).isEmpty()


def test_reference_layout_reader(spark, tmp_path):
    root = tmp_path / "raw"
    d = root / "selic" / "ingestion_date=2020-01-05" / "batch_id=20200105"
    d.mkdir(parents=True)
    (d / "response.json").write_text(json.dumps([{"data": "02/01/2020", "valor": "4.0"}, {"data": "03/01/2020", "valor": "4.1"}]))
    ctl = root / "_control" / "batches" / "ingestion_date=2020-01-05"
    ctl.mkdir(parents=True)
    (ctl / "batch_id=20200105.json").write_text(json.dumps(
        {"batch_id": "20200105", "ingestion_date": "2020-01-05", "series": {"selic": "success"}, "status": "committed"}, indent=2
    ))
    rows = bronze.read_reference_layout(spark, str(root)).collect()
    assert sorted((r.series_name, r.batch_id, r.ingestion_date, r.data) for r in rows) == [
        ("selic", "20200105", D(2020, 1, 5), "02/01/2020"), ("selic", "20200105", D(2020, 1, 5), "03/01/2020")
    ]
    m = bronze.read_reference_manifests(spark, str(root / "_control" / "batches")).collect()
    assert m[0].status == "committed" and m[0].series == {"selic": "success"}


def test_stream_applies_each_committed_batch_once(spark, tmp_root, tmp_path):
    def land(batch, day, rows, status):
        df = spark.createDataFrame(
            [(d, v, s, day, batch) for s, d, v in rows],
            "data string, valor string, series_name string, ingestion_date date, batch_id string",
        )
        bronze.land(df, tmp_root)
        series = {s: ("new_data" if status == "committed" else "failed") for s, _, _ in rows}
        bronze.write_manifests(
            spark.createDataFrame([(batch, day, series, status)],
                                  "batch_id string, ingestion_date date, series map<string,string>, status string"),
            tmp_root,
        )

    ckpt = str(tmp_path / "ckpt")
    land("s1", D(2020, 1, 5), [("selic", "02/01/2020", "4.0")], "committed")
    land("s2", D(2020, 1, 6), [("selic", "03/01/2020", "9.9")], "failed")
    run_silver_stream(spark, tmp_root, ckpt)
    out = read_silver(spark, silver_path(tmp_root)).collect()
    assert [(r.data, r.valor) for r in out] == [(D(2020, 1, 2), 4.0)]
    land("s3", D(2020, 1, 7), [("selic", "02/01/2020", "4.1"), ("selic", "06/01/2020", "4.3")], "committed")
    run_silver_stream(spark, tmp_root, ckpt)
    run_silver_stream(spark, tmp_root, ckpt)  # nothing new: no change
    out = sorted((r.data, r.valor, r.batch_id) for r in read_silver(spark, silver_path(tmp_root)).collect())
    assert out == [(D(2020, 1, 2), 4.1, "s3"), (D(2020, 1, 6), 4.3, "s3")]
    assert os.path.isdir(ckpt)


def test_batches_in_one_or_several_applications(spark, tmp_path):
    """Applying two committed batches together equals applying them one by one,
    and the snapshot view equals incremental Silver."""
    from tslake.operators.state import snapshot_as_of
    from tslake.operators.normalize import clean_rows, parse_raw
    from tslake.operators import gate as gate_ops

    def land(root, batch, day, rows):
        df = spark.createDataFrame(
            [(d, v, s, day, batch) for s, d, v in rows],
            "data string, valor string, series_name string, ingestion_date date, batch_id string",
        )
        bronze.land(df, root)
        bronze.write_manifests(spark.createDataFrame(
            [(batch, day, {s: "new_data" for s, _, _ in rows}, "committed")],
            "batch_id string, ingestion_date date, series map<string,string>, status string"), root)

    b1 = [("selic", "02/01/2020", "4.0"), ("ipca", "01/01/2020", "0.2")]
    b2 = [("selic", "02/01/2020", "4.1"), ("selic", "03/01/2020", "4.2")]
    together, apart = str(tmp_path / "a"), str(tmp_path / "b")
    land(together, "b1", D(2020, 1, 5), b1)
    land(together, "b2", D(2020, 1, 6), b2)
    pipeline.bronze_to_silver(spark, together)
    land(apart, "b1", D(2020, 1, 5), b1)
    pipeline.bronze_to_silver(spark, apart)
    land(apart, "b2", D(2020, 1, 6), b2)
    pipeline.bronze_to_silver(spark, apart)
    rows = lambda root: sorted((r.series_name, r.data, r.valor, r.batch_id) for r in read_silver(spark, silver_path(root)).collect())
    assert rows(together) == rows(apart)
    entries = gate_ops.manifest_entries(bronze.read_manifests(spark, together))
    committed = clean_rows(parse_raw(gate_ops.gate(bronze.read_landed(spark, together), entries)))
    snap = snapshot_as_of(committed, F.lit("2020-01-31").cast("date"))
    assert sorted((r.series_name, r.data, r.valor, r.batch_id) for r in snap.collect()) == rows(together)


def test_watermark_counts_committed_but_unapplied_batches(spark, tmp_root):
    cat = catalog_frame(spark).where("series_name = 'selic'")
    b1 = _fetched(spark, [("selic", "02/01/2020", "4.0")])
    pipeline.ingest(spark, tmp_root, b1, "b1", "2020-01-05", catalog=cat)
    # b1 is committed but Silver has not run: its rows must not land again
    b2 = _fetched(spark, [("selic", "02/01/2020", "4.0"), ("selic", "03/01/2020", "4.1")])
    m2 = pipeline.ingest(spark, tmp_root, b2, "b2", "2020-01-06", catalog=cat)
    assert m2.select(F.col("series")["selic"]).first()[0] == "new_data"
    landed = bronze.read_landed(spark, tmp_root).where("batch_id = 'b2'").collect()
    assert [r.data for r in landed] == ["03/01/2020"]
    applied = sorted(r.batch_id for r in pipeline.bronze_to_silver(spark, tmp_root).collect())
    assert applied == ["b1", "b2"]


def test_sql_views_and_observed_counts(spark, tmp_root):
    cat = _catalog(spark)
    rows = [("selic", "02/01/2020", "4.0"), ("ipca", "01/01/2020", "0.2"), ("dolar_venda", "02/01/2020", "4.02"),
            ("dolar_compra", "02/01/2020", "4.00"), ("dolar_venda", "03/02/2020", "4.24"),
            ("dolar_compra", "03/02/2020", "4.20"), ("selic", "bad", "1"), ("selic", "03/02/2020", "")]
    pipeline.ingest(spark, tmp_root, _fetched(spark, rows), "v1", "2020-02-05", catalog=cat)
    metrics = {}
    pipeline.bronze_to_silver(spark, tmp_root, metrics)
    assert metrics == {"rows_landed": 8, "rows_quarantined": 1, "rows_null_valor": 1}
    pipeline.silver_to_gold(spark, tmp_root)
    assert "stg_macro_monthly" in pipeline.register_views(spark, tmp_root)
    sql = spark.sql("""
        SELECT reference_month, dolar_venda - dolar_compra AS spread_cambio,
               (dolar_venda / lag(dolar_venda) OVER (ORDER BY reference_month) - 1) * 100 AS cambio_mom
        FROM stg_macro_monthly""")
    view = spark.table("fct_exchange_rate").select("reference_month", "spread_cambio", "cambio_mom")
    norm = lambda df: sorted((r[0], None if r[1] is None else round(r[1], 9), None if r[2] is None else round(r[2], 9)) for r in df.collect())
    assert norm(sql) == norm(view)


def test_fetch_start(spark):
    from tslake.operators.state import fetch_start

    cat = _catalog(spark)
    wm = spark.createDataFrame([("selic", D(2020, 1, 3))], "series_name string, last_reference_date date")
    got = {r.series_name: r.start_date for r in fetch_start(cat, wm).collect()}
    assert got["selic"] == D(2020, 1, 3) and got["ipca"] == D(1980, 1, 1) and got["dolar_venda"] == D(1984, 11, 28)


def test_adopt_reference_landing_then_silver(spark, tmp_path, tmp_root):
    src = tmp_path / "landing"
    for series, rows in (("selic", [("02/01/2020", "4.0"), ("03/01/2020", "4.1")]), ("ipca", [("01/01/2020", "0.2")])):
        d = src / series / "ingestion_date=2020-01-05" / "batch_id=20200105"
        d.mkdir(parents=True)
        (d / "response.json").write_text(json.dumps([{"data": a, "valor": b} for a, b in rows]))
    d = src / "selic" / "ingestion_date=2020-01-06" / "batch_id=20200106"
    d.mkdir(parents=True)
    (d / "response.json").write_text(json.dumps([{"data": "06/01/2020", "valor": "9.9"}]))
    ctl = src / "_control" / "batches" / "ingestion_date=2020-01-05"
    ctl.mkdir(parents=True)
    (ctl / "batch_id=20200105.json").write_text(json.dumps(
        {"batch_id": "20200105", "ingestion_date": "2020-01-05",
         "series": {"selic": "success", "ipca": "success"}, "status": "committed"}, indent=2))
    ctl2 = src / "_control" / "batches" / "ingestion_date=2020-01-06"
    ctl2.mkdir(parents=True)
    (ctl2 / "batch_id=20200106.json").write_text(json.dumps(
        {"batch_id": "20200106", "ingestion_date": "2020-01-06", "series": {"selic": "failed"}, "status": "failed"}, indent=2))
    pipeline.adopt_reference_landing(spark, str(src), tmp_root)
    assert sorted(r.batch_id for r in pipeline.bronze_to_silver(spark, tmp_root).collect()) == ["20200105"]
    got = sorted((r.series_name, r.data, r.valor) for r in read_silver(spark, silver_path(tmp_root)).collect())
    assert got == [("ipca", D(2020, 1, 1), 0.2), ("selic", D(2020, 1, 2), 4.0), ("selic", D(2020, 1, 3), 4.1)]


def test_cli_sanitize(capsys):
    from tslake.__main__ import main

    main(["sanitize-batch-id", "--batch-id", "manual__2024-01-01T00:00:00+00:00"])
    assert capsys.readouterr().out.strip() == "manual__2024-01-01T00_00_00_00_00"


def test_monthly_silver_layout_rewrites_only_touched_month(spark, tmp_root):
    from tslake.sources.schemas import SILVER_PARTITIONS_MONTHLY

    def land(batch, day, rows):
        df = spark.createDataFrame(
            [(d, v, s, day, batch) for s, d, v in rows],
            "data string, valor string, series_name string, ingestion_date date, batch_id string",
        )
        bronze.land(df, tmp_root)
        bronze.write_manifests(spark.createDataFrame(
            [(batch, day, {s: "new_data" for s, _, _ in rows}, "committed")],
            "batch_id string, ingestion_date date, series map<string,string>, status string"), tmp_root)

    land("m1", D(2020, 3, 1), [("selic", "02/01/2020", "4.0"), ("selic", "03/02/2020", "4.1")])
    pipeline.bronze_to_silver(spark, tmp_root, partitions=SILVER_PARTITIONS_MONTHLY)
    month = lambda: versioned.load(spark, silver_path(tmp_root))["partitions"]
    before = month()
    land("m2", D(2020, 3, 2), [("selic", "04/02/2020", "4.2")])
    pipeline.bronze_to_silver(spark, tmp_root, partitions=SILVER_PARTITIONS_MONTHLY)
    jan, feb = ("\x1f".join(["selic", "2020", m]) for m in "12")
    assert month()[jan] == before[jan] and month()[feb] != before[feb]  # January untouched by a February batch
    out = sorted((r.data, r.valor, r.month) for r in read_silver(spark, silver_path(tmp_root)).collect())
    assert out == [(D(2020, 1, 2), 4.0, 1), (D(2020, 2, 3), 4.1, 2), (D(2020, 2, 4), 4.2, 2)]


def test_empty_response_reads_as_zero_rows(spark, tmp_path):
    d = tmp_path / "raw" / "selic" / "ingestion_date=2020-01-05" / "batch_id=e1"
    d.mkdir(parents=True)
    (d / "response.json").write_text("[]")
    df = bronze.read_reference_layout(spark, str(tmp_path / "raw"))
    assert df.columns == ["data", "valor", "series_name", "ingestion_date", "batch_id"] and df.count() == 0


def test_new_catalogue_series_gets_a_gold_column(spark):
    from tslake.operators.gold import monthly, to_wide
    from tslake.sources.catalog import SERIES, SERIES_NAMES

    extra = ("pib_mensal", 4380, "monthly", "1990-01-01", "BRL_MILLION", "new series")
    cat = catalog_frame(spark, SERIES + [extra])
    silver = spark.createDataFrame(
        [("pib_mensal", D(2020, 1, 1), 10.0), ("selic", D(2020, 1, 2), 4.0)], "series_name string, data date, valor double"
    )
    wide = to_wide(monthly(silver, cat), SERIES_NAMES + ["pib_mensal"]).first()
    assert wide.pib_mensal == 10.0 and wide.selic == 4.0
    assert cat.where("series_name = 'pib_mensal'").first().unit == "BRL_MILLIONS"  # spelling normalised


def test_incremental_gold_equals_full_rebuild(spark, tmp_root):
    def land(batch, day, rows):
        df = spark.createDataFrame(
            [(d, v, s, day, batch) for s, d, v in rows],
            "data string, valor string, series_name string, ingestion_date date, batch_id string",
        )
        bronze.land(df, tmp_root)
        bronze.write_manifests(spark.createDataFrame(
            [(batch, day, {s: "new_data" for s, _, _ in rows}, "committed")],
            "batch_id string, ingestion_date date, series map<string,string>, status string"), tmp_root)

    land("g1", D(2020, 3, 1), [("selic", "02/01/2020", "4.0"), ("selic", "03/02/2020", "4.1"), ("ipca", "01/01/2020", "0.2"),
                              ("dolar_venda", "02/01/2020", "4.02")])
    pipeline.bronze_to_silver(spark, tmp_root)
    pipeline.silver_to_gold(spark, tmp_root)
    # a correction of January, a new February day and a new series-month
    land("g2", D(2020, 3, 2), [("selic", "02/01/2020", "5.0"), ("selic", "04/02/2020", "4.3"),
                              ("ipca", "01/02/2020", "0.3")])
    pipeline.bronze_to_silver(spark, tmp_root)
    inc_long, inc_wide = pipeline.silver_to_gold(spark, tmp_root)
    inc = sorted(map(tuple, inc_long.collect()))
    wide = {r.reference_month: r for r in inc_wide.collect()}
    full_long, _ = pipeline.silver_to_gold(spark, tmp_root, incremental=False)
    assert inc == sorted(map(tuple, full_long.collect()))
    assert wide[D(2020, 1, 1)].selic == 5.0 and round(wide[D(2020, 2, 1)].selic, 6) == 4.2
    assert wide[D(2020, 2, 1)].ipca == 0.3 and wide[D(2020, 1, 1)].dolar_venda == 4.02
    # nothing new: Gold is returned as is
    again, _ = pipeline.silver_to_gold(spark, tmp_root)
    assert sorted(map(tuple, again.collect())) == inc


def test_read_landed_names_only_the_requested_batches(spark, tmp_root):
    rows = [("02/01/2020", "1.0", "selic", D(2020, 1, 5), "manual__2020-01-05T00:00:00+00:00"),
            ("03/01/2020", "2.0", "selic", D(2020, 1, 6), "b,2{x}"),
            ("04/01/2020", "3.0", "ipca", D(2020, 1, 7), "b3")]
    df = spark.createDataFrame(rows, "data string, valor string, series_name string, ingestion_date date, batch_id string")
    bronze.land(df, tmp_root)
    got = bronze.read_landed(spark, tmp_root, batches=[(D(2020, 1, 5), "manual__2020-01-05T00:00:00+00:00"),
                                                       (D(2020, 1, 6), "b,2{x}"), (D(2020, 1, 9), "missing")])
    assert sorted((r.batch_id, r.valor) for r in got.collect()) == [
        ("b,2{x}", "2.0"), ("manual__2020-01-05T00:00:00+00:00", "1.0")
    ]
    assert bronze.read_landed(spark, tmp_root, batches=[(D(2021, 1, 1), "none")]).count() == 0


def test_marts_as_catalog_tables(spark, tmp_root):
    cat = _catalog(spark)
    rows = [("selic", "02/01/2020", "4.0"), ("ipca", "01/01/2020", "0.2"), ("dolar_venda", "02/01/2020", "4.02"),
            ("dolar_compra", "02/01/2020", "4.00")]
    pipeline.ingest(spark, tmp_root, _fetched(spark, rows), "t1", "2020-01-05", catalog=cat)
    pipeline.bronze_to_silver(spark, tmp_root)
    pipeline.silver_to_gold(spark, tmp_root)
    out = pipeline.marts(spark, tmp_root, database="analytics")
    assert spark.table("analytics.fct_exchange_rate").first().dolar_medio == out["fct_exchange_rate"].first().dolar_medio
    assert set(out) <= {t.name for t in spark.catalog.listTables("analytics")}


def test_failed_ingest_does_not_advance_the_watermark(spark, tmp_root):
    cat = catalog_frame(spark).where(F.col("series_name").isin("selic", "ipca"))
    # ipca has no history and returns nothing: the series fails, so the batch fails
    b1 = _fetched(spark, [("selic", "02/01/2020", "4.0")])
    m1 = pipeline.ingest(spark, tmp_root, b1, "r1", "2020-01-05", catalog=cat)
    assert m1.first().status == "failed"
    assert pipeline.committed_silver_watermarks(spark, tmp_root).count() == 0
    # the re-run sees the same rows as new and commits them
    b2 = _fetched(spark, [("selic", "02/01/2020", "4.0"), ("ipca", "01/01/2020", "0.2")])
    m2 = pipeline.ingest(spark, tmp_root, b2, "r2", "2020-01-06", catalog=cat)
    assert m2.first().status == "committed"
    assert [r.batch_id for r in pipeline.bronze_to_silver(spark, tmp_root).collect()] == ["r2"]
    assert read_silver(spark, silver_path(tmp_root)).count() == 2


def test_applied_list_is_one_table(spark, tmp_root):
    for i in range(5):
        pipeline.record_applied(spark.createDataFrame([(D(2020, 1, 1), f"c{i}")], pipeline.APPLIED_SCHEMA), tmp_root)
    df = pipeline.read_applied(spark, tmp_root)
    assert sorted(r.batch_id for r in df.collect()) == [f"c{i}" for i in range(5)]
    assert len(df.inputFiles()) == 1


def test_snapshot_of_a_lake_root(spark, tmp_root):
    cat = _catalog(spark)
    full = [("selic", "02/01/2020", "4.0"), ("ipca", "01/01/2020", "0.2"), ("dolar_venda", "02/01/2020", "4.02"),
            ("dolar_compra", "02/01/2020", "4.00")]
    pipeline.ingest(spark, tmp_root, _fetched(spark, full), "s1", "2020-01-05", catalog=cat)
    later = full + [("selic", "03/02/2020", "4.5"), ("dolar_venda", "03/02/2020", "4.2"), ("dolar_compra", "03/02/2020", "4.1")]
    pipeline.ingest(spark, tmp_root, _fetched(spark, later), "s2", "2020-02-05", catalog=cat)
    first = sorted((r.series_name, r.data, r.valor) for r in pipeline.snapshot(spark, tmp_root, "2020-01-31").collect())
    assert first == sorted((s, D(int(d[6:]), int(d[3:5]), int(d[:2])), float(v)) for s, d, v in full)
    pipeline.bronze_to_silver(spark, tmp_root)
    snap = sorted((r.series_name, r.data, r.valor) for r in pipeline.snapshot(spark, tmp_root, "2020-02-28").collect())
    silver = sorted((r.series_name, r.data, r.valor) for r in read_silver(spark, silver_path(tmp_root)).collect())
    assert snap == silver and len(snap) == 7


def test_quality_report_of_a_lake_root(spark, tmp_root):
    cat = _catalog(spark)
    rows = [("selic", "02/01/2020", "4.0"), ("ipca", "01/01/2020", "0.2"), ("dolar_venda", "02/01/2020", "4.02"),
            ("dolar_compra", "02/01/2020", "4.00")]
    pipeline.ingest(spark, tmp_root, _fetched(spark, rows), "q1", "2020-01-05", catalog=cat)
    pipeline.bronze_to_silver(spark, tmp_root)
    pipeline.silver_to_gold(spark, tmp_root)
    report = pipeline.quality_report(spark, tmp_root).collect()
    assert len(report) == 9 and all(r.violations == 0 for r in report)
    assert {(r.table, r.check_name) for r in report} >= {("gold", "unique"), ("silver", "not_null"), ("catalog", "accepted_values"), ("bronze", "altered_object")}
    # rows that change after the manifest was written are seen, another order of rows is not
    landed = bronze.read_landed(spark, tmp_root).drop("raw_line")
    rewritten = spark.createDataFrame(sorted(landed.collect(), key=repr, reverse=True), landed.schema)
    bronze.land(rewritten, tmp_root)
    altered = lambda: {r.check_name: r.violations for r in pipeline.quality_report(spark, tmp_root).collect()}["altered_object"]
    assert altered() == 0
    bronze.land(rewritten.where("series_name = 'ipca'").withColumn("valor", F.lit("0.3")), tmp_root)
    assert altered() == 1


def test_cli_steps_in_their_own_processes(spark, tmp_root):
    import subprocess
    import sys
    from pathlib import Path

    cat = _catalog(spark)
    rows = [("selic", "02/01/2020", "4.0"), ("ipca", "01/01/2020", "0.2"), ("dolar_venda", "02/01/2020", "4.02"),
            ("dolar_compra", "02/01/2020", "4.00")]
    pipeline.ingest(spark, tmp_root, _fetched(spark, rows), "c1", "2020-01-05", catalog=cat)
    repo = Path(__file__).resolve().parents[1]
    env = {**__import__("os").environ, "PYTHONPATH": str(repo)}
    more = tmp_root + "-fetched.json"
    every = [(n, "02/02/2020", "9.5") for n in SERIES_NAMES]
    with open(more, "w") as out:
        out.writelines(json.dumps({"series_name": n, "data": d, "valor": v}) + "\n" for n, d, v in every)
    steps = [["bronze-to-silver"], ["silver-to-gold"], ["publish"], ["marts"], ["quality"],
             ["ingest", "--fetched", more, "--batch-id", "c+2", "--ingestion-date", "2020-02-05"], ["stream"],
             ["snapshot", "--as-of", "2020-02-28", "--output", tmp_root + "-snapshot"]]
    for step in steps:
        done = subprocess.run([sys.executable, "-m", "tslake", *step, "--root", tmp_root], cwd=repo, env=env,
                              capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, (step, done.stderr[-2000:])
    assert spark.read.parquet(tmp_root + "-snapshot").count() == 4 + len(SERIES_NAMES)
    assert sorted(r.batch_id for r in pipeline.read_applied(spark, tmp_root).collect()) == ["c1", "c_2"]
    assert versioned.read(spark, tmp_root + "/warehouse/macro_monthly").count() == 1
    assert versioned.read(spark, tmp_root + "/marts/fct_exchange_rate").first().dolar_medio == 4.01


def test_watermark_table_is_kept_and_rebuilt(spark, tmp_root):
    from tslake.operators.state import watermarks

    cat = catalog_frame(spark).where("series_name = 'selic'")
    pipeline.ingest(spark, tmp_root, _fetched(spark, [("selic", "02/01/2020", "4.0")]), "w1", "2020-01-05", catalog=cat)
    pipeline.bronze_to_silver(spark, tmp_root)
    pipeline.ingest(spark, tmp_root, _fetched(spark, [("selic", "06/01/2020", "4.1")]), "w2", "2020-01-07", catalog=cat)
    pipeline.bronze_to_silver(spark, tmp_root)
    table = versioned.read(spark, pipeline.watermarks_path(tmp_root)).collect()
    assert [(r.series_name, r.last_reference_date) for r in table] == [("selic", D(2020, 1, 6))]
    kept = sorted(map(tuple, pipeline.committed_silver_watermarks(spark, tmp_root).collect()))
    # the table equals what a rebuild from Silver would give
    rebuilt = watermarks(read_silver(spark, silver_path(tmp_root)).select("series_name", "data"))
    assert kept == sorted((r.series_name, r.last_reference_date) for r in rebuilt.collect()) == [("selic", D(2020, 1, 6))]


def test_read_landed_reads_exact_pairs(spark, tmp_root):
    """Not the cross product of the days and the ids."""
    rows = [("01/01/2020", f"{d}{b}", "selic", D(2020, 1, d), f"m{b}") for d in (1, 2, 3) for b in (1, 2, 3)]
    bronze.land(spark.createDataFrame(rows, "data string, valor string, series_name string, ingestion_date date, batch_id string"), tmp_root)
    got = bronze.read_landed(spark, tmp_root, batches=[(D(2020, 1, 1), "m1"), (D(2020, 1, 2), "m3"), (D(2020, 1, 9), "m2")])
    assert sorted(r.valor for r in got.collect()) == ["11", "23"]


def test_ingest_raises_naming_failed_series_after_writing_the_manifest(spark, tmp_root):
    cat = catalog_frame(spark).where(F.col("series_name").isin("selic", "ipca", "dolar_venda"))
    with pytest.raises(RuntimeError, match="dolar_venda, ipca"):
        pipeline.ingest(spark, tmp_root, _fetched(spark, [("selic", "02/01/2020", "4.0")]), "e1", "2020-01-05",
                        catalog=cat, raise_on_failure=True)
    m = bronze.read_manifests(spark, tmp_root).collect()
    assert [(r.batch_id, r.status) for r in m] == [("e1", "failed")] and m[0].series["selic"] == "new_data"


def test_ingest_lands_only_catalogue_series(spark, tmp_root):
    cat = catalog_frame(spark).where("series_name = 'selic'")
    fetched = _fetched(spark, [("selic", "02/01/2020", "4.0"), ("unknown", "02/01/2020", "1.0")])
    pipeline.ingest(spark, tmp_root, fetched, "k1", "2020-01-05", catalog=cat)
    assert [r.series_name for r in bronze.read_landed(spark, tmp_root).collect()] == ["selic"]
