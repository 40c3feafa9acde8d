"""Change feeds and what follows them: partitions, Gold cells, marts, history."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tslake.operators import cells
from tslake.operators.gold import monthly
from tslake.operators.history import as_of, extend, intervals
from tslake.operators.state import holes, snapshot_as_of
from tslake.operators.upsert import VERSIONS, collapse, replay, upsert_table
from tslake.plans import pipeline
from tslake.plans.marts import MARTS, build_mart
from tslake.sources import versioned
from tslake.sources.catalog import catalog_frame
from tslake.sources.schemas import SILVER, SILVER_KEYS, SILVER_ORDER, SILVER_PARTITIONS
from tslake.sources.silver import read_silver, silver_path, upsert_silver

D = dt.date
ROW = "series_name string, data date, valor double, ingestion_date date, batch_id string"


def silver(spark, rows):
    df = spark.createDataFrame(rows, ROW)
    return df.select("*", F.lit(None).cast("timestamp").alias("ingestion_timestamp"), F.year("data").alias("year"), F.month("data").alias("month"))


def table(spark, path):
    return sorted((r.series_name, r.data, r.valor, r.batch_id) for r in versioned.read_partitioned(spark, path, SILVER).collect())


def upsert(spark, rows, path, **kw):
    return upsert_table(spark, silver(spark, rows), path, SILVER_KEYS, SILVER_PARTITIONS, SILVER, order=SILVER_ORDER, **kw)


def test_replayed_feeds_give_the_table(spark, tmp_path):
    """Random batches, some late: each feed tells exactly what its upsert changed."""
    rng, path = random.Random(4), str(tmp_path / "t")
    want, feeds, first = {}, [], None
    for i, day in enumerate([5, 2, 9, 9, 1, 12]):
        rows = {}
        for _ in range(25):
            key = (rng.choice(["a", "b'%", "c"]), D(rng.choice([2019, 2020]), rng.randint(1, 3), rng.randint(1, 9)))
            rows[key] = (*key, rng.choice([None, 1.0, 2.5, float(i)]), D(2024, 1, day), f"b{day}")
        old = table(spark, path) if i else []
        feed = upsert(spark, list(rows.values()), path, keep_feed=True)
        for key, row in rows.items():
            rank = lambda r: (r[3], r[4], r[2] is not None, r[2] or 0)
            if key not in want or rank(row) > rank(want[key]):
                want[key] = row
        assert table(spark, path) == sorted((r[0], r[1], r[2], r[4]) for r in want.values())
        if i == 0:
            first = versioned.read_partitioned(spark, path, SILVER)
            first = spark.createDataFrame(first.collect(), first.schema)
            continue
        changed = {(r.series_name, r.data): (r.op, r.old, r.new) for r in feed.collect()}
        now = {r[:2]: r for r in table(spark, path)}
        assert set(changed) == {k for k in now if now[k] not in old}
        assert all((op == "insert") == (k not in {r[:2] for r in old}) and (was is None) == (op == "insert") for k, (op, was, _) in changed.items())
        feeds.append(feed)
    for several in (feeds, [collapse(feeds, SILVER_KEYS)]):
        df = first
        for feed in several:
            df = replay(df.select(*SILVER.fieldNames()), feed, SILVER_KEYS)
        assert sorted((r.series_name, r.data, r.valor, r.batch_id) for r in df.collect()) == table(spark, path)
    assert versioned.feeds(spark, path)[1] == 1 and len(versioned.feeds(spark, path)[0]) == 5
    versioned.drop_feeds(spark, path, versioned.feeds(spark, path)[0][:4])
    assert len(versioned.feeds(spark, path)[0]) == 1


def folders(path):
    return {f"{d}"[len(path) + 1 :] for d, _, names in os.walk(path) for n in names if n.endswith(".parquet") and "/f=" not in d}


def test_partitions_are_added_to_rewritten_or_left(spark, tmp_path):
    path = str(tmp_path / "t")
    row = lambda s, y, m, d, v, b: (s, D(y, m, d), v, D(2024, 1, b), f"b{b}")
    live = lambda: versioned.load(spark, path)["partitions"]
    upsert(spark, [row("a", 2020, 1, 1, 1.0, 1), row("a", 2021, 1, 1, 1.0, 1), row("b", 2020, 1, 1, 1.0, 1)], path)
    before = live()
    # a new day in one partition, a correction in another, nothing new in the third
    upsert(spark, [row("a", 2020, 1, 2, 2.0, 2), row("a", 2021, 1, 1, 5.0, 2), row("b", 2020, 1, 1, 1.0, 1)], path)
    after = live()
    assert after["a\x1f2020"][0] == before["a\x1f2020"][0] and len(after["a\x1f2020"]) == 2
    assert after["a\x1f2021"] != before["a\x1f2021"] and len(after["a\x1f2021"]) == 1
    assert after["b\x1f2020"] == before["b\x1f2020"]
    read = versioned.read_partitioned(spark, path, SILVER, keys=["a\x1f2020"])
    assert {f.rsplit("/", 1)[0].rsplit("v=", 1)[1].split("/", 1)[1] for f in read.inputFiles()} == {"series_name=a/year=2020"} and len(read.inputFiles()) == 2
    # what the correction replaced is freed by the next commit, although its version lives on
    old = f"v={before['a' + chr(31) + '2021'][0]}/series_name=a/year=2021"
    assert old in folders(path)
    upsert(spark, [row("a", 2020, 1, 3, 3.0, 3)], path)
    assert old not in folders(path) and f"v={before['b' + chr(31) + '2020'][0]}/series_name=b/year=2020" in folders(path)
    assert table(spark, path) == [("a", D(2020, 1, 1), 1.0, "b1"), ("a", D(2020, 1, 2), 2.0, "b2"), ("a", D(2020, 1, 3), 3.0, "b3"), ("a", D(2021, 1, 1), 5.0, "b2"), ("b", D(2020, 1, 1), 1.0, "b1")]
    for k in range(4, 4 + VERSIONS):
        upsert(spark, [row("a", 2020, 1, k, 1.0, k)], path)
    assert len(live()["a\x1f2020"]) < VERSIONS and len(table(spark, path)) == 5 + VERSIONS


def test_partitions_without_a_key_of_the_source_are_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    row = lambda s, d, v, b: (s, D(2020, 1, d), v, D(2024, 1, b), f"b{b}")
    upsert(spark, [row("a", 5, 1.0, 1), row("b", 5, 1.0, 1)], path)
    read, real = [], versioned.read_partitioned
    monkeypatch.setattr(versioned, "read_partitioned", lambda *a, keys=None: read.append(keys) or real(*a, keys=keys))
    upsert(spark, [row("a", 6, 2.0, 2), row("b", 5, 2.0, 2)], path)  # new in one, a correction in the other
    assert read[0] == ["b\x1f2020"]
    del read[:]
    feed = upsert(spark, [row("a", 9, 2.0, 3), row("b", 1, 2.0, 3), row("b", 3, 2.0, 3)], path)  # all new: nothing is read
    assert read == [] and feed.count() == 3 and feed.where("op = 'insert'").count() == 3
    del read[:]
    upsert(spark, [row("b", 2, 2.0, 4)], path)  # inside the range: read, though the key is new
    assert read == [["b\x1f2020"]]
    monkeypatch.setattr(versioned, "read_partitioned", real)
    assert [(r[0], r[1].day, r[2]) for r in table(spark, path)] == [("a", 5, 1.0), ("a", 6, 2.0), ("a", 9, 2.0), ("b", 1, 2.0), ("b", 2, 2.0), ("b", 3, 2.0), ("b", 5, 2.0)]


def test_second_of_two_writers_is_told(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.replace(spark.range(3), path)
    state = versioned.load(spark, path)
    versioned.replace(spark.range(5), path)
    with pytest.raises(versioned.LostUpdate):
        versioned._switch(spark, path, {"versions": state["versions"]}, state)
    assert versioned.read(spark, path).count() == 5
    upsert(spark, [("a", D(2020, 1, 1), 1.0, D(2024, 1, 1), "b1")], str(tmp_path / "p"))
    before = versioned.load(spark, str(tmp_path / "p"))
    upsert(spark, [("a", D(2020, 1, 2), 1.0, D(2024, 1, 1), "b1")], str(tmp_path / "p"))
    with pytest.raises(versioned.LostUpdate):
        versioned.switch_partitions(spark, str(tmp_path / "p"), "x", ["a\x1f2020"], SILVER_PARTITIONS, before)


def test_appends_are_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        versioned.append(spark.range(i, i + 1), path)
    df = versioned.read(spark, path)
    assert df.count() == 5 and "Union" not in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("wide_range", [False, True])
def test_cells_follow_random_feeds(spark, tmp_path, wide_range):
    """Cells after each feed equal a build from all rows; Silver is read for stale ones only."""
    rng, root = random.Random(7 + wide_range), str(tmp_path / "lake")
    choice = [None, 0.0, 1.25, 3.1, 1e6] + ([1e-9, 4e31, -2e15] if wide_range else [])
    catalog = catalog_frame(spark)
    stale = []
    for i in range(5):
        rows = {}
        for _ in range(30):
            key = (rng.choice(["selic", "ipca", "dolar_venda"]), D(2020, rng.randint(1, 3), rng.randint(1, 12)))
            rows[key] = (*key, rng.choice(choice), D(2024, 1, 1 + i), f"b{i}")
        upsert_silver(spark, silver(spark, list(rows.values())), silver_path(root))
        if i:
            feeds, _ = versioned.feeds(spark, silver_path(root))
            from tslake.sources.silver import read_feeds

            after = cells.apply(versioned.read(spark, pipeline.cells_path(root), cells.STATE), cells.changes(read_feeds(spark, silver_path(root), feeds)), 99)
            stale.append(after.where("stale").count())
        long, wide = pipeline.silver_to_gold(spark, root)
        want = {(r.series_name, r.reference_month): r.valor for r in monthly(read_silver(spark, silver_path(root)).select("series_name", "data", "valor"), catalog).collect()}
        got = {(r.series_name, r.reference_month): r.valor for r in long.collect()}
        assert set(got) == set(want)
        for k, v in want.items():
            assert (got[k] is None) == (v is None) and (v is None or abs(got[k] - v) <= 1e-9 * max(1e-3, abs(v))), (k, got[k], v)
        assert versioned.feeds(spark, silver_path(root))[0] == []
        assert {r.reference_month for r in wide.collect()} == {m for _, m in want}
    assert any(stale) if wide_range else sum(stale) < 20


def test_interrupted_gold_applies_each_feed_once(spark, tmp_root, monkeypatch):
    day = lambda d, v, b: ("selic", D(2020, 1, d), v, D(2024, 1, b), f"b{b}")
    upsert_silver(spark, silver(spark, [day(1, 1.0, 1)]), silver_path(tmp_root))
    pipeline.silver_to_gold(spark, tmp_root)
    upsert_silver(spark, silver(spark, [day(2, 5.0, 2)]), silver_path(tmp_root))
    real = versioned.drop_feeds
    monkeypatch.setattr(versioned, "drop_feeds", lambda *a: (_ for _ in ()).throw(OSError("interrupted")))
    with pytest.raises(OSError):
        pipeline.silver_to_gold(spark, tmp_root)
    monkeypatch.setattr(versioned, "drop_feeds", real)
    for _ in range(2):
        assert [r.valor for r in pipeline.silver_to_gold(spark, tmp_root)[0].collect()] == [3.0]
    # a change that left no feed makes Gold be built anew
    upsert_table(spark, silver(spark, [day(3, 9.0, 3)]), silver_path(tmp_root), SILVER_KEYS, SILVER_PARTITIONS, SILVER, order=SILVER_ORDER)
    assert [r.valor for r in pipeline.silver_to_gold(spark, tmp_root)[0].collect()] == [5.0]


def test_corrected_month_rewrites_a_dozen_rows(spark, tmp_root):
    names = ["selic", "selic_meta", "dolar_venda", "dolar_compra", "ipca", "atividade_economica", "inadimplencia_pf"]
    months = [D(2015 + k // 12, 1 + k % 12, 1) for k in range(48) if k != 20]
    load = lambda rows, b: upsert_silver(spark, silver(spark, [(*r, D(2024, 1, b), f"b{b}") for r in rows]), silver_path(tmp_root))
    load([(n, m, float(10 + i * k % 7 + k)) for i, n in enumerate(names) for k, m in enumerate(months)], 1)
    pipeline.silver_to_gold(spark, tmp_root)
    pipeline.marts(spark, tmp_root)

    def equal_full():
        for name in MARTS:
            long = pipeline.read_gold(spark, tmp_root)[0]
            key = lambda r: r.reference_month
            got = versioned.read(spark, f"{tmp_root}/marts/{name}")
            full = build_mart(long, name)
            assert got.columns == full.columns
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect())) or sorted(got.collect(), key=key) == sorted(full.collect(), key=key)

    def run(rows, b):
        load(rows, b)
        pipeline.silver_to_gold(spark, tmp_root)
        metrics = {}
        pipeline.marts(spark, tmp_root, metrics=metrics)
        equal_full()
        return metrics

    equal_full()
    counts = run([(n, months[5], 99.0) for n in names], 2)
    assert all(0 < c <= 13 for c in counts.values()) and max(counts.values()) <= 5 + 8  # months 5 and those that read it
    assert run([("ipca", months[30], 7.0)], 3) == {n: int(n == "mart_macro_credit_features") for n in MARTS}
    counts = run([("selic", D(2019, 1, 1), 3.0)], 5)  # a month more at the end
    assert set(counts.values()) == {1}
    counts = run([("selic", D(2016, 9, 1), 3.0)], 6)  # the month that was missing moves those after it
    assert all(2 <= c <= 13 for c in counts.values())
    metrics = {}
    pipeline.marts(spark, tmp_root, metrics=metrics)
    assert set(metrics.values()) == {0}


def test_history_of_batches_in_any_order(spark):
    rng = random.Random(5)
    batches = []
    for b in range(7):
        day = D(2024, 1, rng.randint(1, 20))
        batches.append([(rng.choice("ab"), D(2020, 1, rng.randint(1, 4)), rng.choice([None, 1.0, 2.0, 3.0]), day, f"b{b}") for _ in range(6)])
    every = spark.createDataFrame(sum(batches, []), ROW)
    history = None
    for batch in rng.sample(batches, len(batches)) + batches[:2]:  # the last two again
        rows = spark.createDataFrame(batch, ROW)
        new = extend(history, rows)
        kept = [] if history is None else history.join(rows.select("series_name", "data").distinct(), ["series_name", "data"], "left_anti").collect()
        history = spark.createDataFrame(kept + new.collect(), new.schema)
    order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert order(history) == order(intervals(every))
    for day in range(1, 22):
        d = F.lit(D(2024, 1, day))
        want = snapshot_as_of(every, d).select("series_name", "data", "valor", "batch_id")
        assert order(as_of(history, d).select("series_name", "data", "valor", "batch_id")) == order(want)


def test_holes_against_days(spark):
    rng = random.Random(9)
    spans, windows = [], []
    for i in range(40):
        s = D(2020, 1, 1) + dt.timedelta(rng.randint(0, 30))
        e = s + dt.timedelta(rng.randint(0, 60))
        spans.append((f"s{i}", "daily", s, e))
        for _ in range(rng.choice([0, 1, 2, 5])):
            a = D(2020, 1, 1) + dt.timedelta(rng.randint(-10, 100))
            windows.append((f"s{i}", a, a + dt.timedelta(rng.randint(0, 25))))
    windows += windows[:5] + [("other", D(2020, 1, 1), D(2020, 2, 1)), ("s3", D(2020, 5, 2), D(2020, 5, 1))]
    got = holes(spark.createDataFrame(spans, "series_name string, frequency string, start_date date, end_date date"), spark.createDataFrame(windows, "series_name string, window_start date, window_end date")).collect()
    days = lambda a, b: {a + dt.timedelta(k) for k in range((b - a).days + 1)}
    for name, _, s, e in spans:
        open_ = days(s, e)
        for n, a, b in windows:
            if n == name and a <= b:
                open_ -= days(a, b)
        mine = sorted((r.start_date, r.end_date) for r in got if r.series_name == name)
        assert [d for a, b in mine for d in sorted(days(a, b))] == sorted(open_)
        assert all((y[0] - x[1]).days > 1 for x, y in zip(mine, mine[1:]))  # each hole is one span


def test_manifests_from_snapshot_and_tail(spark, tmp_root):
    from tslake.sources import bronze

    schema = "batch_id string, ingestion_date date, series map<string,string>, status string"
    write = lambda *rows: bronze.write_manifests(spark.createDataFrame([(b, D(2024, 1, d), {"a": s}, s) for b, d, s in rows], schema), tmp_root)
    latest = lambda: sorted((r.batch_id, r.ingestion_date, r.status) for r in bronze.latest_manifests(bronze.read_manifests(spark, tmp_root)).collect())
    write(("b1", 1, "failed"))
    write(("b2", 2, "committed"))
    before = latest()
    assert bronze.snapshot_manifests(spark, tmp_root) == 2 and latest() == before and bronze.manifest_tail(spark, tmp_root) == 0
    assert all("manifest_log" in f for f in bronze.read_manifests(spark, tmp_root).inputFiles())
    write(("b1", 1, "committed"))
    write(("b2", 2, "failed"), ("b3", 3, "failed"))
    want = [("b1", D(2024, 1, 1), "committed"), ("b2", D(2024, 1, 2), "committed"), ("b3", D(2024, 1, 3), "failed")]
    assert latest() == want and sum(f.endswith(".json") for f in bronze.read_manifests(spark, tmp_root).inputFiles()) == 2
    assert bronze.snapshot_manifests(spark, tmp_root) == 4 == bronze.snapshot_manifests(spark, tmp_root) and latest() == want
