"""Run one pipeline step: ``python -m tslake <step> --root <lake root> ...``.

Steps can be submitted separately: ``ingest`` (land and commit one batch of
fetched rows), ``adopt`` (take over landed data in the source layout),
``bronze-to-silver``, ``stream`` (the same, from the manifests that have
arrived), ``silver-to-gold``, ``publish``, ``marts``, ``snapshot`` (every
series as of a day, written as Parquet), ``quality`` (exit status 1 on any
violation) and ``sanitize-batch-id``.
"""

from __future__ import annotations

import argparse
import re

from pyspark.sql import SparkSession

from tslake.functions.dates import BATCH_ID_FORBIDDEN
from tslake.operators.publish import JdbcTarget, ParquetTarget
from tslake.plans import pipeline
from tslake.session import apply_cluster_settings, apply_defaults


def _target(args):
    if args.jdbc_url:
        props = {"user": args.jdbc_user or "", "password": args.jdbc_password or ""}
        if args.jdbc_driver:
            props["driver"] = args.jdbc_driver
        return JdbcTarget(args.jdbc_url, args.jdbc_table, props)
    return ParquetTarget(args.target) if args.target else None


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tslake")
    steps = ["ingest", "adopt", "bronze-to-silver", "stream", "silver-to-gold", "publish", "marts", "snapshot", "quality", "sanitize-batch-id"]
    ap.add_argument("step", choices=steps)
    ap.add_argument("--root", help="lake root folder (shared storage)")
    ap.add_argument("--source-root", help="adopt: root of the source-layout landing")
    ap.add_argument("--mode", default="append_new", choices=["append_new", "upsert", "overwrite"])
    ap.add_argument("--target", help="publish: Parquet folder of the warehouse table")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-table", default="gold.macro_monthly")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password")
    ap.add_argument("--jdbc-driver")
    ap.add_argument("--batch-id", help="ingest: the batch's id; sanitize-batch-id: the raw id")
    ap.add_argument("--fetched", help="ingest: JSON lines of series_name, data, valor (text)")
    ap.add_argument("--ingestion-date", help="ingest: the batch's day, yyyy-MM-dd")
    ap.add_argument("--inclusive", action="store_true", help="ingest: admit the watermark's own day again")
    ap.add_argument("--lookback-days", type=int, default=0, help="ingest: days before the watermark to admit again")
    ap.add_argument("--as-of", help="snapshot: the day, yyyy-MM-dd")
    ap.add_argument("--output", help="snapshot: Parquet folder to write")
    ap.add_argument("--database", help="marts: save as catalog tables in this database")
    ap.add_argument("--cluster-settings", action="store_true", help="apply the recommended large-cluster settings")
    args = ap.parse_args(argv)

    if args.step == "sanitize-batch-id":
        print(re.sub(BATCH_ID_FORBIDDEN, "_", args.batch_id or ""))
        return
    spark = SparkSession.builder.appName(f"tslake-{args.step}").getOrCreate()
    apply_defaults(spark)
    if args.cluster_settings:
        apply_cluster_settings(spark)
    if args.step == "ingest":
        fetched = spark.read.schema("series_name string, data string, valor string").json(args.fetched)
        manifest = pipeline.ingest(
            spark, args.root, fetched, re.sub(BATCH_ID_FORBIDDEN, "_", args.batch_id), args.ingestion_date,
            inclusive=args.inclusive, lookback_days=args.lookback_days, raise_on_failure=True,
        )
        print({"committed": [r.batch_id for r in manifest.collect()]})  # one row at most
    elif args.step == "stream":
        from tslake.streaming.stream import run_silver_stream

        run_silver_stream(spark, args.root)
    elif args.step == "snapshot":
        pipeline.snapshot(spark, args.root, args.as_of).write.mode("overwrite").parquet(args.output)
    elif args.step == "adopt":
        pipeline.adopt_reference_landing(spark, args.source_root, args.root)
    elif args.step == "bronze-to-silver":
        metrics: dict = {}
        applied = [f"{r.ingestion_date}/{r.batch_id}" for r in pipeline.bronze_to_silver(spark, args.root, metrics).collect()]
        print({"applied": applied, **metrics})
    elif args.step == "silver-to-gold":
        pipeline.silver_to_gold(spark, args.root)
    elif args.step == "publish":
        pipeline.gold_to_warehouse(spark, args.root, _target(args), mode=args.mode)
    elif args.step == "marts":
        pipeline.marts(spark, args.root, database=args.database)
    elif args.step == "quality":
        report = pipeline.quality_report(spark, args.root).collect()  # one row per check
        for row in report:
            print(row.asDict())
        if any(r.violations for r in report):
            raise SystemExit(1)


if __name__ == "__main__":
    main()
