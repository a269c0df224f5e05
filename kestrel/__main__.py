"""Command line: ``python -m kestrel <command> --sf DIR [options]``.

``load`` reads the driver tables (or, with ``--csv``, the raw CSV folder) and writes the
warehouse; ``funnel``, ``experiment``, ``sessions`` and ``export`` read a warehouse
(``--warehouse``) or the driver tables; ``query NAME`` runs any registered query. Results
are printed whole, row by row; ``--rows`` asks for a first part, ``--out`` writes a
query's result as Parquet.
"""

from __future__ import annotations

import argparse
import sys

from kestrel.config import DRIVER
from kestrel.session import get_spark


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="kestrel")
    ap.add_argument("command", choices=["load", "funnel", "experiment", "sessions", "export", "query"])
    ap.add_argument("name", nargs="?", help="query name for the 'query' command")
    ap.add_argument("--sf", default="/root/testdata/sf0.01", help="folder with the driver tables")
    ap.add_argument("--csv", help="folder with the five raw CSVs (load)")
    ap.add_argument("--increment", action="store_true", help="load: merge the CSVs that the folder has into the warehouse")
    ap.add_argument("--warehouse", help="read the star tables from this warehouse")
    ap.add_argument("--out", help="warehouse folder (load), mart folder (export), result folder (query)")
    ap.add_argument("--master", default=None)
    ap.add_argument("--rows", type=int, help="print only so many rows of each result")
    return ap


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_spark(args.master)
    try:
        return run(argv, spark)
    finally:
        spark.stop()


def emit(df, rows: int | None = None) -> None:
    """Print a result as tab-separated lines, all of it unless ``rows`` is given."""
    print("\t".join(df.columns))
    for r in (df.limit(rows) if rows is not None else df).toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in r))
    print()


def run(argv: list[str] | None, spark) -> int:
    ap = _parser()
    args = ap.parse_args(argv)

    from kestrel.operators import bootstrap, diagnostics, experiment, funnel, sessions
    from kestrel.plans import pipeline, reports
    from kestrel.session import scratch
    from kestrel.sources import marts

    sf, p = args.sf, DRIVER
    if args.command in ("load", "export") and not args.out:
        ap.error(f"--out is required for {args.command}")
    with scratch(spark):
        if args.command == "load" and args.increment:
            if not args.csv:
                ap.error("--increment takes a folder of raw CSVs (--csv)")
            from kestrel.plans import increment
            version = increment.run(spark, args.csv, args.out, p)
            print(f"version {version.number} of {args.out}")
            return 0
        if args.command == "load":
            for name, path in pipeline.run(spark, args.csv or sf, args.out, p, from_csv=bool(args.csv)).items():
                print(f"{name}: {path}")
            return 0
        if args.command == "query":
            from kestrel.plans.registry import REGISTRY
            if args.name not in REGISTRY:
                ap.error(f"unknown query {args.name!r}; one of: {', '.join(sorted(REGISTRY))}")
            df = REGISTRY[args.name](spark, sf)
            if args.out:
                df.write.parquet(args.out)
            else:
                emit(df, args.rows)
            return 0
        tables = pipeline.read_warehouse_tables(spark, args.warehouse) if args.warehouse else pipeline.raw_tables(spark, sf)
        ev = tables["fct_events"]
        if args.command == "funnel":
            reach = funnel.customer_step_reach(ev, p.steps)
            overall = funnel.overall_funnel(reach, p.steps)
            for df in (overall.orderBy("step_idx"), funnel.bounce_rate(ev), funnel.biggest_drop_off_step(overall),
                       funnel.revenue_per_converted_customer(tables["fct_transactions"]),
                       funnel.funnel_by_channel(reach, tables["dim_customers"], p.steps)):
                emit(df, args.rows)
        elif args.command == "experiment":
            counts = experiment.customer_group_counts(ev)
            totals = experiment.group_totals(counts, p.groups)
            reps = bootstrap.bootstrap_replicates(counts, p.groups, p.n_boot, p.seed)
            for df in (totals.orderBy("arm_idx"), experiment.chi_square_test(totals, p.groups),
                       experiment.pairwise_tests(totals, p.groups, p.alpha).orderBy("pair_idx"),
                       bootstrap.bootstrap_ci(reps, p.groups).orderBy("cmp_idx")):
                emit(df, args.rows)
        elif args.command == "sessions":
            summary = sessions.session_summary(sessions.build_sessions(ev.drop("derived_session_id"), p.gap_minutes))
            for df in (sessions.session_counts(ev, summary), diagnostics.session_describe(summary)):
                emit(df, args.rows)
        else:
            for name, path in marts.write_marts(reports.build_marts(tables, p), args.out).items():
                print(f"{name}: {path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
