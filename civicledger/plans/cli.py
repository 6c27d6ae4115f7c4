"""Command line for a scheduler:

    spark-submit civicledger/plans/cli.py daily     --root R --landing L [--run-date D] [--as-of T]
    spark-submit civicledger/plans/cli.py backfill  --root R --landing L --start D --end D
    spark-submit civicledger/plans/cli.py freshness --root R --landing L [--as-of T]
    spark-submit civicledger/plans/cli.py quarantine --root R --landing L

``--root`` and ``--landing`` name shared storage (HDFS / object store paths);
the checkpoint folder comes from the cluster's ``spark.checkpoint.dir``.
Prints one JSON line with the outcome; a failed audit exits non-zero, a day
without trades exits 0 with status "skipped".
"""

from __future__ import annotations

if __package__ in (None, ""):          # run as a file by spark-submit
    import os as _os
    import sys as _sys
    _sys.path.insert(0, _os.path.dirname(_os.path.dirname(_os.path.dirname(_os.path.abspath(__file__)))))
    __package__ = "civicledger.plans"

import argparse
import json
import sys


def parse(argv):
    ap = argparse.ArgumentParser(prog="civicledger")
    sub = ap.add_subparsers(dest="command", required=True)
    for name in ("daily", "backfill", "freshness", "quarantine"):
        p = sub.add_parser(name)
        p.add_argument("--root", required=True, help="warehouse root on shared storage")
        p.add_argument("--landing", required=True, help="landing root of the three feeds")
        p.add_argument("--layout", choices=("array", "lines", "pages"), default="array")
        p.add_argument("--as-of", default=None, help="run time, 'YYYY-MM-DD HH:MM:SS' (default now, UTC)")
        if name == "daily":
            p.add_argument("--run-date", default=None, help="report date (default yesterday)")
            p.add_argument("--materialize-fact", action="store_true")
            p.add_argument("--snapshot-tickers", action="store_true")
            p.add_argument("--colocate", action="store_true", help="lay trades and prices out in buckets for the fact's join")
            p.add_argument("--severity", choices=("error", "warn"), default="error")
            p.add_argument("--post-tests", choices=("incremental", "full"), default="incremental")
            p.add_argument("--allow-empty-tickers", action="store_true", help="publish an empty ticker mirror")
            p.add_argument("--ticker-retention-days", type=int, default=None)
        p.add_argument("--on-error", choices=("abort", "skip-file"), default="abort",
                       help="skip-file: keep files out in which more than a tenth of the records are bad, load the rest")
        p.add_argument("--any-file-name", action="store_true",
                       help="read every file of a feed's folder, not only those named after the feed")
        if name == "backfill":
            p.add_argument("--start", required=True)
            p.add_argument("--end", required=True)
            p.add_argument("--window-days", type=int, default=None, help="publish and record the range in windows of so many days")
            p.add_argument("--snapshot-tickers", action="store_true")
    return ap.parse_args(argv)


def run(argv, spark=None) -> dict:
    args = parse(argv)
    from ..session import get_session
    from . import daily
    spark = spark or get_session(app=f"civicledger-{args.command}")
    wh = daily.Warehouse(spark, args.root, args.landing, layout=args.layout, name_globs=not args.any_file_name,
                         on_error=args.on_error.replace("-", "_"))
    if args.command == "daily":
        res = daily.run_daily(wh, args.run_date, as_of=args.as_of,
                              materialize_fact=args.materialize_fact,
                              snapshot_ticker_dim=args.snapshot_tickers, severity=args.severity,
                              post_tests=args.post_tests, refuse_empty_tickers=not args.allow_empty_tickers,
                              ticker_retention_days=args.ticker_retention_days, colocate_fact=args.colocate)
        return {"command": "daily", "run_date": res.run_date, "status": res.status,
                "seconds": res.steps.get("seconds", {})}
    if args.command == "backfill":
        out = daily.run_backfill(wh, args.start, args.end, as_of=args.as_of, window_days=args.window_days,
                                 snapshot_ticker_dim=args.snapshot_tickers)
        return {"command": "backfill", "start": args.start, "end": args.end, "result": out}
    if args.command == "quarantine":
        return {"command": "quarantine", "files": [r.asDict() for r in daily.quarantine(wh).collect()]}   # files kept out
    import datetime as dt
    as_of = args.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    rows = [r.asDict() for r in daily.source_freshness(wh, as_of).collect()]   # three rows
    return {"command": "freshness", "tables": rows}


def main(argv=None) -> int:
    from ..operators.quality import AuditFailed
    try:
        out = run(sys.argv[1:] if argv is None else argv)
    except AuditFailed as e:
        print(json.dumps({"status": "audit_failed", "failures": e.failures}, default=str))
        return 2
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
