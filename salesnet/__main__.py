"""Command line: list, run and export the jobs.

    python -m salesnet list
    python -m salesnet run distributor_scorecard --data /path/to/tpch [--show 20]
    python -m salesnet run revenue_at_risk --data DIR --out /tmp/risk --format csv
    python -m salesnet reports --data DIR --out DIR          # R11: the three report series as CSV
    python -m salesnet explain sku_substitution --data DIR   # formatted physical plan

``--data`` is a folder of TPC-H style tables (``<table>.parquet``), or with
``--star`` a folder written by ``write_star``.  ``--master`` defaults to the
launcher's setting (spark-submit) and is only needed for local runs.
"""

from __future__ import annotations

import argparse
import sys


def _session(args):
    from salesnet.session import get_session
    return get_session(args.master, shuffle_partitions=args.shuffle_partitions)


def _star(spark, args):
    from salesnet.sources import load_star, tpch_star
    return load_star(spark, args.data) if args.star else tpch_star(spark, args.data)


def _job(name):
    from salesnet.plans.registry import all_queries
    qs = all_queries()
    if name not in qs:
        raise SystemExit(f"unknown query {name!r}; see `python -m salesnet list`")
    return qs[name]


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="salesnet")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for cmd in ("run", "explain"):
        s = sub.add_parser(cmd)
        s.add_argument("query")
        s.add_argument("--data", required=True)
        s.add_argument("--star", action="store_true", help="--data holds star tables written by write_star")
        if cmd == "run":
            s.add_argument("--out")
            s.add_argument("--format", choices=["csv", "parquet"], default="parquet")
            s.add_argument("--show", type=int, default=20)
    r = sub.add_parser("reports")
    r.add_argument("--data", required=True)
    r.add_argument("--star", action="store_true")
    r.add_argument("--out", required=True)
    args = p.parse_args(argv)

    if args.cmd == "list":
        from salesnet.plans.registry import all_queries
        for name, fn in all_queries().items():
            print(f"{name:32s} {(fn.__doc__ or '').strip().splitlines()[0] if fn.__doc__ else ''}")
        return 0

    spark = _session(args)
    if args.cmd == "reports":
        from salesnet.plans.reports import export_reports
        export_reports(_star(spark, args), args.out)
        return 0

    fn = _job(args.query)
    if args.star:
        from salesnet.plans.registry import use_star
        use_star(spark, args.data, _star(spark, args))
    df = fn(spark, args.data)
    if args.cmd == "explain":
        df.explain("formatted")
        return 0
    if args.out:
        if args.format == "csv":
            from salesnet.sources import export_csv
            export_csv(df, args.out)
        else:
            df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
