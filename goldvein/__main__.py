"""Command line: ``python -m goldvein <command>``.

  land  --sf DIR --landing DIR         land the four event streams derived from the
                                       shared tables as record envelopes (one batch)
  run   --out DIR --as-of YYYY-MM-DD   one pipeline run: ingest, validate, gate,
        [--landing DIR] [--no-gate]    silver, tests, gold, tests; a failed test
        [--known-failure TEST ...]     stops it unless it is named as known or
        [--no-enforce-tests] [--duplicate-tolerance X] [--max-files-per-trigger N]
  hourly --out DIR --landing DIR       one incremental run at the time it is given: what landed
         --at YYYY-MM-DDTHH:MM         since the last run is merged into the states, gold is read
         [--no-gate]                   from them
         [--duplicate-tolerance X] [--max-files-per-trigger N]
  query NAME --sf DIR [--out DIR]      run one registered query; print its row count or
                                       write it as Parquet
"""

from __future__ import annotations

import argparse
import json
from datetime import date, datetime

from .config import PipelineConfig
from .session import build_session


def main(argv: list[str] | None = None, stop: bool = True) -> None:
    ap = argparse.ArgumentParser(prog="goldvein")
    sub = ap.add_subparsers(dest="cmd", required=True)
    land = sub.add_parser("land")
    land.add_argument("--sf", required=True)
    land.add_argument("--landing", required=True)
    land.add_argument("--shards", type=int, help="number of files; by default as many as the data needs")
    run = sub.add_parser("run")
    run.add_argument("--out", required=True)
    run.add_argument("--landing")
    run.add_argument("--as-of", required=True)
    run.add_argument("--no-gate", action="store_true")
    run.add_argument("--no-enforce-tests", action="store_true")
    run.add_argument("--known-failure", action="append", default=[])
    run.add_argument("--max-files-per-trigger", type=int)
    run.add_argument("--duplicate-tolerance", type=float, default=0.0)
    hourly = sub.add_parser("hourly")
    hourly.add_argument("--out", required=True)
    hourly.add_argument("--landing", required=True)
    hourly.add_argument("--at", required=True)
    hourly.add_argument("--no-gate", action="store_true")
    hourly.add_argument("--max-files-per-trigger", type=int)
    hourly.add_argument("--duplicate-tolerance", type=float, default=0.0)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf", required=True)
    q.add_argument("--out")
    for p in (land, run, hourly, q):
        p.add_argument("--master")
    args = ap.parse_args(argv)
    spark = build_session(args.master)

    if args.cmd == "land":
        from .schemas import STREAMS
        from .sources.driver_tables import load_bronze
        from .sources.landing import to_envelope, write_landing
        frames = load_bronze(spark, args.sf).by_table()
        for stream, (table, schema) in STREAMS.items():
            write_landing(to_envelope(frames[table], schema), f"{args.landing}/{stream}", args.shards)
    elif args.cmd == "run":
        from .plans.pipeline import run_pipeline
        cfg = PipelineConfig(as_of=date.fromisoformat(args.as_of), duplicate_tolerance=args.duplicate_tolerance)
        res = run_pipeline(spark, args.out, cfg, landing_root=args.landing, gate=not args.no_gate,
                           enforce_tests=not args.no_enforce_tests, known_failures=tuple(args.known_failure),
                           max_files_per_trigger=args.max_files_per_trigger)
        print(json.dumps({"paths": res.paths, "ingest": res.ingest_counts, "quality": res.quality,
                          "failed_checks": res.failed_checks}))
    elif args.cmd == "hourly":
        from .plans.incremental import hourly_run
        at = datetime.fromisoformat(args.at)
        cfg = PipelineConfig(as_of=at.date(), run_ts=at, duplicate_tolerance=args.duplicate_tolerance)
        print(json.dumps({"paths": hourly_run(spark, args.out, args.landing, cfg, gate=not args.no_gate,
                                              max_files_per_trigger=args.max_files_per_trigger)}))
    else:
        from .plans.catalog import QUERIES
        df = QUERIES[args.name](spark, args.sf)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            print(json.dumps({"query": args.name, "rows": df.count()}))
    if stop:
        spark.stop()


if __name__ == "__main__":
    main()
