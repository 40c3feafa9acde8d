"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with a ``noop`` write (full computation, nothing
collected) and run $BENCH_REPEATS times (default 2); the best run is
reported per query, the first-run total alongside. Also reported: marts
built from an existing Gold, and a scaling run with the number of series
multiplied by $BENCH_ENTITY_FACTORS (default "1,10"). Prints ONE JSON line with seconds per query; number of jobs and
shuffle bytes per query come from Spark's event log, written to a fresh
scratch folder (the Spark UI stays off).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402


def session(cpus: str, log_dir: str) -> SparkSession:
    from tslake.session import SESSION_DEFAULTS, apply_defaults

    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tslake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, int(cpus) * 2) if cpus.isdigit() else 16)))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .config("spark.checkpoint.dir", os.path.join(log_dir, "checkpoint"))
    )
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def shuffle_stats(log_dir: str) -> dict[str, dict[str, int]]:
    """Jobs and shuffle bytes written per job group, from the event log."""
    stage_group: dict[int, str] = {}
    jobs: dict[str, int] = defaultdict(int)
    shuffle: dict[str, int] = defaultdict(int)
    for path in glob.glob(os.path.join(log_dir, "*")):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        jobs[group] += 1
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    written = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    if group:
                        shuffle[group] += int(written)
    return {g: {"jobs": jobs[g], "shuffle_bytes": shuffle[g]} for g in jobs}


def scaling_run(spark: SparkSession, sf_dir: str, factors: list[int]) -> dict[str, dict[str, float]]:
    """Multiply the number of series k-fold (each order observed by k
    entities, derived with ``explode`` from the given table) and time the
    chain dedupe -> monthly mean -> lags 1/3/6/12 in long form."""
    from pyspark.sql import functions as F

    from tslake.operators.dedupe import latest_per_key
    from tslake.operators.features import lag_long
    from tslake.operators.gold import monthly
    from tslake.sources import tables

    out = {}
    for k in factors:
        obs = tables.obs_orders(spark, sf_dir)
        entity = F.explode(F.sequence(F.lit(1), F.lit(k))).alias("i")
        rep = obs.select("*", entity).select(
            F.concat("series_name", F.lit("#"), F.col("i").cast("string")).alias("series_name"),
            "data",
            (F.col("valor") + F.col("i")).alias("valor"),
            "o_orderkey",
        )
        silver = latest_per_key(rep, ["series_name", "data"], ["o_orderkey"]).select("series_name", "data", "valor")
        long = monthly(silver, "daily")
        spark.sparkContext.setJobGroup(f"scale_{k}", f"scale_{k}")
        t0 = time.perf_counter()
        lag_long(long, [1, 3, 6, 12]).write.format("noop").mode("overwrite").save()
        out[str(k)] = {"sec": round(time.perf_counter() - t0, 3)}
    return out


def marts_from_gold(spark: SparkSession, sf_dir: str, work: str, repeats: int) -> dict[str, float]:
    """Seconds per mart when Gold (long form) is already built, the setting of
    the reference's per-model timings: Gold is written once, then the cells of
    all marts are computed from the Parquet table in one aggregation
    (``cells``) and each mart is projected from them (best of ``repeats``)."""
    from tslake.operators.features import month_axis
    from tslake.operators.small import small_side
    from tslake.plans.marts import build_marts
    from tslake.plans.registry import macro_gold_long

    path = os.path.join(work, "gold_long")
    macro_gold_long(spark, sf_dir).write.mode("overwrite").parquet(path)
    long = spark.read.parquet(path)
    axis = small_side(month_axis(long))  # one axis for all marts, as pipeline.marts does
    out: dict[str, float] = {}
    for _ in range(repeats):
        t0 = time.perf_counter()
        marts = build_marts(long, axis)
        runs = {"cells": time.perf_counter() - t0}
        for name, mart in marts.items():
            t0 = time.perf_counter()
            mart.write.format("noop").mode("overwrite").save()
            runs[name] = time.perf_counter() - t0
        if not out or sum(runs.values()) < sum(out.values()):
            out = runs
    return {name: round(sec, 3) for name, sec in out.items()}


def main() -> None:
    from tslake.plans.registry import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    log_dir = tempfile.mkdtemp(prefix="tslake-bench-")
    spark = session(cpus, log_dir)
    sc = spark.sparkContext

    # warm-up: JVM, Python workers, file listing
    QUERIES["monthly_avg"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    timings: dict[str, float] = {}
    first_run: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        runs = []
        for r in range(repeats):
            # job statistics are taken from the last run only
            sc.setJobGroup(name if r == repeats - 1 else f"{name}#warm{r}", name)
            t0 = time.perf_counter()
            try:
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            except Exception as exc:  # keep going; report the failure
                errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
                break
        if runs:
            timings[name] = round(min(runs), 3)
            first_run[name] = round(runs[0], 3)
    sc.setJobGroup("marts_from_gold", "marts_from_gold")
    mart_only = marts_from_gold(spark, sf_dir, log_dir, repeats) if not only else None
    # entity scaling (series multiplied k-fold); "" switches it off
    factors = [int(x) for x in os.environ.get("BENCH_ENTITY_FACTORS", "1,10").split(",") if x]
    factors = [] if only and "BENCH_ENTITY_FACTORS" not in os.environ else factors
    scaling = scaling_run(spark, sf_dir, factors) if factors else None
    sc.setJobGroup("done", "done")
    spark.stop()
    stats = shuffle_stats(log_dir)
    total = round(sum(timings.values()), 3)
    out = {
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "repeats": repeats,
        "first_run_total": round(sum(first_run.values()), 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "jobs": {k: v["jobs"] for k, v in stats.items() if k in timings},
        "shuffle_bytes": {k: v["shuffle_bytes"] for k, v in stats.items() if k in timings},
    }
    if mart_only:
        out["marts_from_gold"] = mart_only
    if scaling:
        for k, v in scaling.items():
            v.update(stats.get(f"scale_{k}", {}))
        out["scaling"] = scaling
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
