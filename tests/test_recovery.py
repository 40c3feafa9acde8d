"""Late, repeated, failed and interrupted runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tslake.operators.gold import monthly
from tslake.operators.normalize import parse_raw
from tslake.operators.publish import ParquetTarget, materialize, publish
from tslake.operators.upsert import upsert_table
from tslake.plans import pipeline
from tslake.sources import bronze, versioned
from tslake.sources.catalog import catalog_frame
from tslake.sources.schemas import SILVER, SILVER_KEYS, SILVER_ORDER, SILVER_PARTITIONS, SILVER_PARTITIONS_MONTHLY
from tslake.sources.silver import read_silver, silver_path
from tslake.streaming.stream import run_silver_stream

D = dt.date
MANIFEST = "batch_id string, ingestion_date date, series map<string,string>, status string"


def land(spark, root, batch, day, rows, status="committed", listed=None):
    df = spark.createDataFrame(
        [(d, v, s, day, batch) for s, d, v in rows], "data string, valor string, series_name string, ingestion_date date, batch_id string"
    )
    bronze.land(df, root)
    series = listed or {s: ("new_data" if status == "committed" else "failed") for s, _, _ in rows}
    bronze.write_manifests(spark.createDataFrame([(batch, day, series, status)], MANIFEST), root)


def silver_rows(spark, root):
    return sorted((r.series_name, r.data, r.valor, r.batch_id) for r in read_silver(spark, silver_path(root)).collect())


def test_rows_of_a_failed_attempt_stay_out(spark, tmp_root):
    """b1 fails on one day and commits without the row on the next; b0 commits on the first."""
    land(spark, tmp_root, "b1", D(2020, 2, 1), [("selic", "02/01/2020", "9")], status="failed")
    land(spark, tmp_root, "b1", D(2020, 2, 2), [("selic", "03/01/2020", "1")])
    land(spark, tmp_root, "b0", D(2020, 2, 1), [("ipca", "01/01/2020", "2")])
    pipeline.bronze_to_silver(spark, tmp_root)
    want = [("ipca", D(2020, 1, 1), 2.0, "b0"), ("selic", D(2020, 1, 3), 1.0, "b1")]
    assert silver_rows(spark, tmp_root) == want
    assert sorted((r.series_name, r.valor) for r in pipeline.snapshot(spark, tmp_root, "2020-03-01").collect()) == [("ipca", 2.0), ("selic", 1.0)]


def test_history_where_no_batch_is_committed_is_empty(spark, tmp_root):
    """Every batch fails: the views of any day have no rows; the first committed batch is the first state."""
    land(spark, tmp_root, "b1", D(2020, 2, 1), [("selic", "02/01/2020", "9")], status="failed")
    pipeline.bronze_to_silver(spark, tmp_root, history=True)
    assert pipeline.snapshots(spark, tmp_root, ["2020-02-01", "2020-03-01"]).collect() == []
    land(spark, tmp_root, "b2", D(2020, 2, 2), [("selic", "03/01/2020", "1")])
    pipeline.bronze_to_silver(spark, tmp_root, history=True)
    got = pipeline.snapshots(spark, tmp_root, ["2020-02-01", "2020-03-01"]).collect()
    assert [tuple(r) for r in got] == [(D(2020, 3, 1), "selic", D(2020, 1, 3), 1.0, "b2")]


def test_stream_of_failed_batches_leaves_an_empty_silver(spark, tmp_root):
    """Gold follows from nothing on, and the empty table takes any layout."""
    land(spark, tmp_root, "b1", D(2020, 2, 1), [("selic", "02/01/2020", "9")], status="failed")
    run_silver_stream(spark, tmp_root)
    assert silver_rows(spark, tmp_root) == []
    assert pipeline.silver_to_gold(spark, tmp_root)[1].count() == 0
    land(spark, tmp_root, "b2", D(2020, 2, 2), [("selic", "03/01/2020", "1")])
    run_silver_stream(spark, tmp_root, partitions=SILVER_PARTITIONS_MONTHLY)
    assert silver_rows(spark, tmp_root) == [("selic", D(2020, 1, 3), 1.0, "b2")]
    assert [(r.reference_month, r.selic) for r in pipeline.silver_to_gold(spark, tmp_root)[1].collect()] == [(D(2020, 1, 1), 1.0)]


def test_same_id_on_another_day_is_another_batch(spark, tmp_root):
    cat = catalog_frame(spark).where("series_name = 'selic'")
    fetched = lambda rows: spark.createDataFrame(rows, "series_name string, data string, valor string")
    pipeline.ingest(spark, tmp_root, fetched([("selic", "02/01/2020", "1")]), "b1", "2020-02-01", catalog=cat)
    pipeline.ingest(spark, tmp_root, fetched([("selic", "03/01/2020", "2")]), "b1", "2020-02-02", catalog=cat)
    applied = pipeline.bronze_to_silver(spark, tmp_root).collect()
    assert sorted((str(r.ingestion_date), r.batch_id) for r in applied) == [("2020-02-01", "b1"), ("2020-02-02", "b1")]
    assert [r[2] for r in silver_rows(spark, tmp_root)] == [1.0, 2.0]


def test_a_second_attempt_replaces_the_first_ones_rows(spark, tmp_root):
    cat = catalog_frame(spark).where(F.col("series_name").isin("selic", "ipca"))
    fetched = lambda rows: spark.createDataFrame(rows, "series_name string, data string, valor string")
    first = pipeline.ingest(spark, tmp_root, fetched([("selic", "02/01/2020", "1")]), "b1", "2020-02-01", catalog=cat)
    assert first.first().status == "failed"
    rows = [("ipca", "01/01/2020", "2"), ("selic", "03/01/2020", "3")]
    assert pipeline.ingest(spark, tmp_root, fetched(rows), "b1", "2020-02-01", catalog=cat).first().status == "committed"
    pipeline.bronze_to_silver(spark, tmp_root)
    assert [(r[0], r[2]) for r in silver_rows(spark, tmp_root)] == [("ipca", 2.0), ("selic", 3.0)]


@pytest.mark.parametrize("order", ["late", "together", "stream"])
def test_silver_does_not_go_backwards(spark, tmp_path, order):
    root = str(tmp_path / "lake")
    newer, older = ("b2", D(2020, 2, 2), [("selic", "02/01/2020", "2")]), ("b1", D(2020, 2, 1), [("selic", "02/01/2020", "1"), ("selic", "03/01/2020", "7")])
    apply = run_silver_stream if order == "stream" else pipeline.bronze_to_silver
    land(spark, root, *newer)
    if order != "together":
        apply(spark, root)
    land(spark, root, *older)
    apply(spark, root)
    assert silver_rows(spark, root) == [("selic", D(2020, 1, 2), 2.0, "b2"), ("selic", D(2020, 1, 3), 7.0, "b1")]
    assert all(r.ingestion_timestamp is not None for r in read_silver(spark, silver_path(root)).collect())
    snap = pipeline.snapshot(spark, root, "2020-03-01").collect()
    assert sorted((r.data, r.valor) for r in snap) == [(D(2020, 1, 2), 2.0), (D(2020, 1, 3), 7.0)]


def test_stream_and_batch_runs_mix_and_restart(spark, tmp_root):
    land(spark, tmp_root, "b1", D(2020, 2, 1), [("selic", "02/01/2020", "1")])
    pipeline.bronze_to_silver(spark, tmp_root)
    land(spark, tmp_root, "b2", D(2020, 2, 2), [("selic", "03/01/2020", "2")])
    run_silver_stream(spark.newSession(), tmp_root)  # leaves out b1, which the batch run applied
    assert pipeline.bronze_to_silver(spark, tmp_root).isEmpty()
    land(spark, tmp_root, "b3", D(2020, 2, 3), [("selic", "04/01/2020", "3")])
    before = versioned.load(spark, silver_path(tmp_root))
    run_silver_stream(spark.newSession(), tmp_root)  # the checkpoint lies under the root
    assert versioned.load(spark, silver_path(tmp_root)) != before
    assert [r[3] for r in silver_rows(spark, tmp_root)] == ["b1", "b2", "b3"]
    assert pipeline.read_applied(spark, tmp_root).count() == 3


def test_bad_rows_are_kept_whatever_their_series_status(spark, tmp_root):
    rows = [("selic", "xx", "1"), ("ipca", "01/01/2020", "2"), ("ipca", "yy", "3")]
    land(spark, tmp_root, "b1", D(2020, 2, 1), rows, listed={"selic": "no_data", "ipca": "new_data"})
    metrics = {}
    applied = pipeline.bronze_to_silver(spark, tmp_root, metrics)
    assert metrics == {"rows_landed": 3, "rows_quarantined": 2, "rows_null_valor": 0}
    quarantine = lambda: sorted((r.series_name, r.data_text, r.batch_id) for r in spark.read.parquet(pipeline.quarantine_path(tmp_root)).collect())
    assert quarantine() == [("ipca", "yy", "b1"), ("selic", "xx", "b1")]
    # a run that was interrupted before the batch was recorded is repeated
    versioned.replace(applied.limit(0), bronze.applied_path(tmp_root))
    pipeline.bronze_to_silver(spark, tmp_root)
    assert len(quarantine()) == 2 and len(silver_rows(spark, tmp_root)) == 1


def test_committed_series_without_an_object_is_reported(spark, tmp_root):
    land(spark, tmp_root, "b1", D(2020, 2, 1), [("ipca", "01/01/2020", "2")], listed={"selic": "new_data", "ipca": "new_data"})
    metrics = {}
    with pytest.warns(UserWarning, match="selic is committed but has no landed object"):
        pipeline.bronze_to_silver(spark, tmp_root, metrics)
    assert metrics["missing_objects"] == [("2020-02-01", "b1", "selic")]
    pipeline.silver_to_gold(spark, tmp_root)
    report = {(r.table, r.check_name): r.violations for r in pipeline.quality_report(spark, tmp_root).collect()}
    assert report["bronze", "missing_object"] == 1


def silver(spark, rows):
    df = spark.createDataFrame(rows, "series_name string, data date, valor double, ingestion_date date, batch_id string")
    return df.withColumn("ingestion_timestamp", F.current_timestamp()).withColumn("year", F.year("data")).withColumn("month", F.month("data"))


def test_upsert_of_many_partitions(spark, tmp_path):
    rows = [(f"s{s}", D(1980 + y, 1, 1), float(y), D(2020, 1, 1), "b1") for s in range(12) for y in range(40)]
    path = str(tmp_path / "t")
    for factor, batch in ((1.0, "b1"), (2.0, "b2")):
        source = silver(spark, [(s, d, v * factor, i, batch) for s, d, v, i, _ in rows])
        upsert_table(spark, source, path, SILVER_KEYS, SILVER_PARTITIONS, SILVER, order=SILVER_ORDER)
    out = versioned.read_partitioned(spark, path, SILVER)
    assert out.count() == 480 and out.agg(F.sum("valor")).first()[0] == 2 * sum(r[2] for r in rows)


def test_interrupted_writes_leave_the_former_table(spark, tmp_path, monkeypatch):
    def failing(*args, **kwargs):
        raise OSError("interrupted")

    one, two = silver(spark, [("s", D(2020, 1, 1), 1.0, D(2020, 1, 1), "b1")]), silver(spark, [("s", D(2020, 1, 1), 2.0, D(2020, 1, 2), "b2"), ("t", D(2020, 1, 1), 3.0, D(2020, 1, 2), "b2")])
    upsert = lambda df, path: upsert_table(spark, df, path, SILVER_KEYS, SILVER_PARTITIONS, SILVER, order=SILVER_ORDER)
    long = lambda df: df.select("series_name", F.col("data").alias("reference_month"), "valor")
    wide = lambda df: long(df).where("series_name = 's'").drop("series_name")
    cases = {
        "silver": (upsert, lambda p: versioned.read_partitioned(spark, p, SILVER)),
        "gold": (lambda df, p: materialize(long(df), p), lambda p: versioned.read(spark, p)),
        "warehouse": (lambda df, p: publish(spark, wide(df), ParquetTarget(p), mode="upsert"), lambda p: versioned.read(spark, p)),
        "watermarks": (lambda df, p: pipeline.update_watermarks(spark, p, df), lambda p: versioned.read(spark, pipeline.watermarks_path(p))),
        "applied": (lambda df, p: pipeline.record_applied(df, p), lambda p: versioned.read(spark, bronze.applied_path(p))),
    }
    whole = versioned._switch
    for name, (put, get) in cases.items():
        path = str(tmp_path / name)
        monkeypatch.setattr(versioned, "_switch", failing)
        with pytest.raises(OSError):
            put(one, path)
        assert get(path) is None  # what was left is no table
        monkeypatch.setattr(versioned, "_switch", whole)
        put(one, path)
        before = sorted(map(tuple, get(path).collect()))
        monkeypatch.setattr(versioned, "_switch", failing)
        with pytest.raises(OSError):
            put(two, path)
        assert sorted(map(tuple, get(path).collect())) == before and before
        monkeypatch.setattr(versioned, "_switch", whole)
        put(two, path)
        put(two, path)
        assert sorted(map(tuple, get(path).collect())) != before


def test_versions_out_of_use_are_removed_one_switch_later(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    for i in range(4):
        old = versioned.read(spark, path)
        versioned.replace(spark.range(i, i + 3).coalesce(1), path)
        if old is not None:
            assert old.count() == 3  # a reader of the former version can finish
    assert [r.id for r in versioned.read(spark, path).orderBy("id").collect()] == [3, 4, 5]
    assert sum(f.startswith("v=") for f in os.listdir(path)) == 2
    versioned.append(spark.range(1), path)
    assert versioned.read(spark, path).count() == 4


def test_interrupted_gold_keeps_its_history(spark, tmp_root, monkeypatch):
    land(spark, tmp_root, "b1", D(2020, 3, 1), [("selic", "02/01/2020", "1"), ("selic", "03/02/2020", "2")])
    pipeline.bronze_to_silver(spark, tmp_root)
    pipeline.silver_to_gold(spark, tmp_root)
    land(spark, tmp_root, "b2", D(2020, 4, 1), [("selic", "02/03/2020", "3")])
    pipeline.bronze_to_silver(spark, tmp_root)
    whole = versioned._switch
    monkeypatch.setattr(versioned, "_switch", lambda *a: (_ for _ in ()).throw(OSError("interrupted")))
    with pytest.raises(OSError):
        pipeline.silver_to_gold(spark, tmp_root)
    assert pipeline.read_gold(spark, tmp_root)[0].count() == 2
    monkeypatch.setattr(versioned, "_switch", whole)
    assert pipeline.silver_to_gold(spark, tmp_root)[1].count() == 3


def test_means_of_legal_doubles(spark):
    def mean(values):
        obs = spark.createDataFrame([("s", D(2020, 1, 1 + i), v) for i, v in enumerate(values)], "series_name string, data date, valor double")
        return monthly(obs, "daily").first().valor

    assert mean([1e-9, 3e-9]) == 2e-9
    assert mean([1e31, 3e31]) == 2e31
    assert mean([None, 4.0]) == 4.0 and mean([None]) is None
    texts = spark.createDataFrame([("01/01/2020", t) for t in ("NaN", "Infinity", "-inf", "1.5", "", "1,5")], "data string, valor string")
    assert [r.valor for r in parse_raw(texts).collect()] == [None, None, None, 1.5, None, None]
