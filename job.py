"""Daily GMV as a submitted job:  spark-submit job.py --bronze-base ... --gold-base ..."""

from __future__ import annotations

import argparse

from daybook import run_daily_gmv
from daybook.operators.window import DAYS_BACK
from daybook.plans.incremental import BROADCAST_BYTES
from daybook.plans.ingest import ingest_logs
from daybook.plans.run import LITERAL, STATE_COMPLETE
from daybook.session import build_session
from daybook.sinks.files import read_known_arrivals, write_known_arrivals
from daybook.sources.bronze import read_logs
from daybook.streaming.ingest import last_arrivals, read_arrivals


def parameters(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    # Names of the public parameters.
    parser.add_argument("--bronze-base", required=True, help="folder of the logs")
    parser.add_argument("--silver-base", help="folder for snapshots")
    parser.add_argument("--gold-base", required=True, help="parent of daily_gmv")
    parser.add_argument("--start-date", help="first day, YYYY-MM-DD")
    parser.add_argument("--end-date", help="last day, YYYY-MM-DD")
    parser.add_argument(
        "--days-back", type=int, default=DAYS_BACK, help="reach of a window given by its end"
    )
    parser.add_argument("--write-silver", action="store_true", help="store the snapshots too")
    # Parameters of this job alone.
    parser.add_argument("--typed-base", help="take new raw CSV files into typed logs here, first")
    parser.add_argument(
        "--progress-path", help="rebuild what has arrived since the run recorded here, whatever its dates"
    )
    parser.add_argument("--gold-table", help="publish gold as this table of the catalog")
    parser.add_argument("--previous-silver", help="snapshots of the last run, to build on")
    parser.add_argument("--quarantine-base", help="folder for rejected rows")
    parser.add_argument("--metrics-path", help="folder for the figures of every run")
    parser.add_argument(
        "--broadcast-bytes", type=int, default=BROADCAST_BYTES, help="0 for no broadcast of keys"
    )
    parser.add_argument("--mode", choices=[STATE_COMPLETE, LITERAL], default=STATE_COMPLETE)
    parser.add_argument("--bronze-format", choices=["csv", "parquet"], default="csv")
    for layer in ("silver", "gold"):
        parser.add_argument(f"--{layer}-format", choices=["csv", "parquet"], default="parquet")
    p = parser.parse_args(arguments)
    if p.write_silver and not p.silver_base:
        parser.error("--write-silver needs --silver-base")
    if p.progress_path and not p.typed_base:
        parser.error("--progress-path needs --typed-base")
    return p


def main(arguments: list[str] | None = None) -> None:
    p = parameters(arguments)
    spark = build_session("daily-gmv")
    rejected = {
        name: f"{p.quarantine_base}/{name}" if p.quarantine_base else None
        for name in ("bronze", "daily_gmv")
    }
    base, fmt = p.bronze_base, p.bronze_format
    if p.typed_base:
        ingest_logs(spark, base, p.typed_base, rejected["bronze"])
        base, fmt = p.typed_base, "parquet"
    known = newest = None
    if p.progress_path:
        # Taken down before the logs are read: what arrives meanwhile is new to the next run too.
        known, newest = read_known_arrivals(spark, p.progress_path), last_arrivals(spark, base)
    report = run_daily_gmv(
        read_logs(spark, base, fmt) if known is None else read_arrivals(spark, base),
        f"{p.gold_base}/daily_gmv",
        start=p.start_date,
        end=p.end_date,
        days_back=p.days_back,
        mode=p.mode,
        arrivals=known,
        gold_table=p.gold_table,
        silver_path=p.silver_base if p.write_silver else None,
        previous_silver=p.previous_silver,
        silver_format=p.silver_format,
        gold_format=p.gold_format,
        broadcast_bytes=p.broadcast_bytes,
        quarantine_path=rejected["daily_gmv"],
        metrics_path=p.metrics_path,
    )
    if newest is not None:
        write_known_arrivals(spark, p.progress_path, newest)
    print(f"{report.status}: window {report.window}, {report.metrics}")


if __name__ == "__main__":
    main()
