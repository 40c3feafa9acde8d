"""Physical-plan properties that matter at scale (read from explain output)."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tslake.operators.dedupe import latest_per_key
from tslake.operators.features import Feature, lag_long, wide_features
from tslake.operators.gold import monthly
from tslake.operators.upsert import upsert_table, write_partitioned
from tslake.plans.marts import build_mart
from tslake.sources import tables, versioned
from tslake.sources.catalog import catalog_frame
from tslake.sources.silver import read_silver

from testdata_paths import SF001

D = dt.date


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_views_prune_columns(spark):
    p = plan(tables.obs_orders(spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in p


def test_date_filter_reaches_parquet(spark):
    p = plan(tables.obs_orders(spark, SF001).where(F.col("data") < F.lit("2000-01-01").cast("date")))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in p


def test_catalog_is_broadcast_and_aggregation_is_two_stage(spark):
    long = monthly(tables.macro_observations(spark, SF001).drop("k1", "k2"), catalog_frame(spark))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(long)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in p
    assert "partial_avg" in p  # map-side partial aggregation before the shuffle


@pytest.mark.parametrize("tiebreak", [[], ["k1", "k2", "valor"]])
def test_monthly_neither_sorts_nor_shuffles_observations(spark, tiebreak):
    """Cells are made where the rows are read, by hash aggregations; the
    catalogue, whose size no planner knows here, is joined with the cells."""
    rows = [("hot" if i % 3 == 0 else f"s{i % 9}", D(2020, 1, 1 + i % 28), float(i), i // 40, i % 5) for i in range(3000)]
    obs = spark.createDataFrame(rows, "series_name string, data date, valor double, k1 int, k2 int")
    catalog = spark.createDataFrame([("hot", "monthly")] + [(f"s{i}", "daily") for i in range(9)], "series_name string, frequency string")
    p = plan(monthly(obs, catalog, tiebreak=tiebreak), "simple").split("\n")
    assert not any("SortAggregate" in line for line in p)
    joins = [i for i, line in enumerate(p) if "Join" in line]
    cells = min(i for i, line in enumerate(p) if "HashAggregate(keys=[series_name" in line and "avg" in line)
    assert joins[0] < cells  # the catalogue's join is above the aggregation
    assert all("BroadcastHashJoin" in p[i] and "LeftSemi" in p[i] for i in joins[1:])  # with settled cells


def test_lags_need_no_global_exchange_over_data(spark):
    months = [D(2000 + i // 12, i % 12 + 1, 1) for i in range(30)]
    long = spark.createDataFrame(
        [(s, m, float(i)) for s in "abc" for i, m in enumerate(months)], "series_name string, reference_month date, valor double"
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (lag_long(long, [1, 12]), wide_features(long, [Feature("a_yoy", "pct_change", ("a",), 12)])):
            p = plan(df, "simple")
            # the only single-partition exchange gathers the set of distinct months
            assert p.count("- Exchange SinglePartition") == 1
            assert "Window" not in p and "collect_set(reference_month" in p
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_dedupe_aggregates_partially_before_shuffle(spark):
    p = plan(latest_per_key(tables.obs_orders(spark, SF001), ["series_name", "data"], ["o_orderkey"]))
    assert "partial_max(struct(" in p


def test_dedupe_by_sequence_sorts_nothing(spark):
    from tslake.operators.dedupe import latest_by_sequence

    p = plan(latest_by_sequence(tables.obs_orders(spark, SF001), ["series_name", "data"], "o_orderkey", "valor"))
    assert "SortAggregate" not in p and "Sort " not in p and p.count("HashAggregate") >= 4


def test_watermark_bound_reaches_the_scan(spark):
    from tslake.operators.state import after_watermark, watermarks

    obs = tables.obs_orders(spark, SF001)
    p = plan(after_watermark(obs, watermarks(obs.where("data < date'1997-01-01'")), lookback_days=7))
    assert "GreaterThanOrEqual(o_orderdate" in p.split("PushedFilters: [")[1].split("]")[0] and "BroadcastHashJoin" in p


def test_silver_series_filter_prunes_partitions(spark, tmp_path):
    from tslake.sources.schemas import SILVER, SILVER_KEYS, SILVER_PARTITIONS

    obs = latest_per_key(tables.obs_orders(spark, SF001), ["series_name", "data"], ["o_orderkey"]).select(
        "series_name", "data", "valor", F.lit(None).cast("date").alias("ingestion_date"), F.lit("b").alias("batch_id"),
        F.lit(None).cast("timestamp").alias("ingestion_timestamp"), F.year("data").alias("year"), F.month("data").alias("month"),
    )
    path = str(tmp_path / "silver")
    upsert_table(spark, obs, path, SILVER_KEYS, SILVER_PARTITIONS, SILVER)
    p = plan(read_silver(spark, path, ["1-URGENT"]))
    assert "1-URGENT" in p.split("PartitionFilters: [")[1].split("]")[0]
    keys = versioned.touched_keys(obs.where("data >= date'1998-12-01'").limit(50), ["series_name", "year"])
    p2 = plan(read_silver(spark, path).where(versioned.touched_filter(keys, ["series_name", "year"])))
    assert keys[0].replace(versioned.SEPARATOR, "\x1f") in p2.split("PartitionFilters: [")[1]
    # a filter of any length stays one flat predicate
    many = [f"s{i}\x1f2020" for i in range(5000)]
    assert read_silver(spark, path).where(versioned.touched_filter(many, ["series_name", "year"])).count() == 0


def test_mart_reads_checkpointed_gold_not_sources(spark):
    from tslake.plans.registry import macro_gold_long, materialized

    g = materialized(macro_gold_long(spark, SF001))
    assert "FileScan" not in plan(build_mart(g, "fct_exchange_rate"))


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    import os

    rows = [("hot", 2020, i, float(i)) for i in range(20000)] + [("cold", 2020, i, float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "series_name string, year int, k int, valor double").repartition(8)
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        write_partitioned(df, path, ["series_name", "year"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = [f for f in os.listdir(os.path.join(path, "series_name=hot", "year=2020")) if f.endswith(".parquet")]
    cold = [f for f in os.listdir(os.path.join(path, "series_name=cold", "year=2020")) if f.endswith(".parquet")]
    assert len(hot) > 1 and len(cold) == 1
    assert spark.read.parquet(path).count() == 20050


LOW_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def low_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in LOW_BROADCAST}
    for k, v in LOW_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_watermark_join_does_not_shuffle_observations(spark, low_broadcast):
    """A hot series' rows stay where they are: the counted watermarks are broadcast."""
    from tslake.operators.state import after_watermark, watermarks

    rows = [("hot" if i % 3 == 0 else f"s{i % 40}", D(2020, 1, 1 + i % 28), float(i)) for i in range(30000)]
    obs = spark.createDataFrame(rows, "series_name string, data date, valor double").repartition(8)
    df = after_watermark(obs, watermarks(obs.where("data < date'2020-01-10'").select("series_name", "data")))
    assert df.count() == sum(1 for s, d, _ in rows if d >= D(2020, 1, 10))
    p = plan(df, "simple")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and "hashpartitioning(series_name" not in p


def test_ingest_does_not_shuffle_fetched_rows(spark, low_broadcast, tmp_root, monkeypatch):
    from tslake.plans import pipeline
    from tslake.sources import bronze

    plans, land = [], bronze.land
    monkeypatch.setattr(bronze, "land", lambda raw, root: (plans.append(plan(raw, "simple")), land(raw, root)))
    rows = [("selic" if i % 3 else "unlisted", f"{1 + i % 28:02d}/01/2020", str(i)) for i in range(3000)]
    fetched = spark.createDataFrame(rows, "series_name string, data string, valor string").repartition(4)
    catalog = spark.createDataFrame(catalog_frame(spark).where("series_name = 'selic'").collect(), catalog_frame(spark).schema)
    pipeline.ingest(spark, tmp_root, fetched, "b1", "2020-02-01", catalog=catalog)
    assert bronze.read_landed(spark, tmp_root).count() == 2000
    assert "SortMergeJoin" not in plans[0] and "hashpartitioning(series_name" not in plans[0]


def test_gate_does_not_shuffle_landed_rows(spark, low_broadcast):
    from tslake.operators import gate as gate_ops

    rows = [(f"{i:05d}", "1", D(2020, 1, 1), "hot" if i % 3 == 0 else f"s{i % 40}", "b1" if i % 3 == 0 else f"b{i % 7}") for i in range(30000)]
    landed = spark.createDataFrame(rows, "data string, valor string, ingestion_date date, series_name string, batch_id string").repartition(8)
    entries = spark.createDataFrame(
        [(D(2020, 1, 1), f"b{j}", s, "committed", "new_data") for j in range(7) for s in ["hot"] + [f"s{i}" for i in range(40)]],
        "ingestion_date date, batch_id string, series_name string, batch_status string, series_status string",
    )
    df = gate_ops.gate(landed, entries)
    assert df.count() == 30000
    p = plan(df, "simple")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and "hashpartitioning(series_name" not in p
    # another day's batch of the same id is not vouched for
    assert gate_ops.gate(landed.withColumn("ingestion_date", F.lit(D(2020, 1, 2))), entries).count() == 0


def test_large_sides_are_joined_by_shuffle(spark):
    from tslake.operators.small import small_side

    df = spark.range(20)
    assert "broadcast" in small_side(df)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in small_side(df, limit=10)._jdf.queryExecution().analyzed().toString().lower()
