"""Command line: the daily load.

  python -m ledgerwatch run --warehouse PATH --drop-dir PATH --run-ts 'YYYY-MM-DD HH:MM:SS' \
      --source accounts=parquet:PATH --source cards=jdbc:bank.cards --source clients=... \
      [--jdbc-url URL --jdbc-user USER --jdbc-password-file FILE] \
      [--partition cards=card_id:0:1000000000 --num-partitions 200] [--only-new-since]
  python -m ledgerwatch reset --warehouse PATH
  python -m ledgerwatch compact --warehouse PATH [--table fact_transactions ...]

The run time defaults to now (UTC, whole seconds), taken once before any read.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from ledgerwatch.session import get_session


def _sources(spark, specs, args):
    from ledgerwatch.sources.tables import read_table
    out = {}
    for spec in specs or []:
        entity, _, target = spec.partition("=")
        fmt, _, location = target.partition(":")
        jdbc = None
        if fmt == "jdbc":
            jdbc = {"url": args.jdbc_url, "user": args.jdbc_user}
            if args.jdbc_password_file:
                with open(args.jdbc_password_file) as f:
                    jdbc["password"] = f.read().strip()
        out[entity] = read_table(spark, fmt, location, jdbc=jdbc, **_split(args, entity))
    return out


def _split(args, entity: str) -> dict:
    """How a JDBC source is read in parallel: ENTITY=COLUMN:LOW:HIGH, or one predicate per task."""
    out: dict = {}
    for spec in args.partition or []:
        name, _, rest = spec.partition("=")
        if name == entity:
            column, low, high = rest.rsplit(":", 2)
            out = {"partition_column": column, "bounds": (int(low), int(high)), "num_partitions": args.num_partitions}
    own = [p.partition("=")[2] for p in args.predicate or [] if p.partition("=")[0] == entity]
    return {"predicates": own} if own else out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerwatch")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run")
    run.add_argument("--warehouse", required=True)
    run.add_argument("--drop-dir")
    run.add_argument("--run-ts")
    run.add_argument("--source", action="append", help="entity=format:location")
    run.add_argument("--jdbc-url")
    run.add_argument("--jdbc-user")
    run.add_argument("--jdbc-password-file")
    run.add_argument("--partition", action="append", help="entity=column:low:high, a numeric column of a JDBC source")
    run.add_argument("--num-partitions", type=int, default=64)
    run.add_argument("--predicate", action="append", help="entity=condition, one task of a JDBC source each")
    run.add_argument("--only-new-since", action="store_true",
                     help="the same as --report new")
    run.add_argument("--report", choices=("full", "counted", "new"), default="full",
                     help="full: the whole history each run, one row per alert; counted: signed changes of "
                          "counted alerts; new: as counted, and the new alerts one row each")
    run.add_argument("--compat-null-reset", action="store_true",
                     help="an empty fact batch resets its watermark, as the original loader did")
    run.add_argument("--no-archive", action="store_true")
    run.add_argument("--drop-order", choices=["date", "name"], default="date")
    run.add_argument("--revive-unchanged", action="store_true",
                     help="reopen a deleted key that returns unchanged")
    run.add_argument("--compat-untrimmed-keys", action="store_true",
                     help="compare delete keys untrimmed, as the original loader did")
    reset = sub.add_parser("reset")
    reset.add_argument("--warehouse", required=True)
    comp = sub.add_parser("compact")
    comp.add_argument("--warehouse", required=True)
    comp.add_argument("--table", action="append",
                      help="append-only table (default: facts, report and dimension archives)")
    args = ap.parse_args(argv)

    spark = get_session()
    if args.cmd == "reset":
        from ledgerwatch.plans.store import Warehouse
        Warehouse(spark, args.warehouse).reset()
        return
    if args.cmd == "compact":
        from ledgerwatch.plans.pipeline import compact_all
        print(json.dumps(compact_all(spark, args.warehouse, args.table)))
        return
    from ledgerwatch.plans.pipeline import PipelineConfig, run_pipeline
    run_ts = args.run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    cfg = PipelineConfig(warehouse=args.warehouse, drop_dir=args.drop_dir,
                         sources=_sources(spark, args.source, args), archive=not args.no_archive,
                         drop_order=args.drop_order, revive_unchanged=args.revive_unchanged,
                         compat_untrimmed_keys=args.compat_untrimmed_keys,
                         compat_null_reset=args.compat_null_reset, only_new_since=args.only_new_since, report=args.report)
    print(json.dumps(run_pipeline(spark, cfg, run_ts)))


if __name__ == "__main__":
    main()
