"""Scheduled entry points (T4): each run processes what is new and stops.

    python -m orderlake.jobs ingest  --wire W --raw R [--quarantine | --threshold 50 [--max-age 3600]] [--catalog DB]
    python -m orderlake.jobs silver  --raw R --neighborhoods N --silver S [--landing | --gated] [--polygons P]
    python -m orderlake.jobs gold    --silver S --customers C --employees E --gold G [--gated]
    python -m orderlake.jobs reports --gold G --out O [--sums S [--gated]]
    python -m orderlake.jobs init    --db DB --dims customers=C employees=E ...
    python -m orderlake.jobs publish --out O --dims customers=C ... [--versions]

``--quarantine`` lands orders and rejected lines in one folder (read it with ``--landing``);
``--threshold`` makes R the staging folder of the count gate (read it with ``--gated``, as are the layers made from it). The
two forms exclude each other. A gated layer's own folder says what it has taken and from where, and a run takes whole
flushes: ``--state`` and ``--max-files`` are refused with ``--gated``, as is ``--catalog`` with ``--threshold`` (the staging
folder also holds what is not let out). With ``--max-age`` a buffer goes out once it has waited so many seconds. ``reports --sums``
keeps partial sums in S, so that a run reads only new gold; ``publish --versions`` replaces dimensions without a gap. Dimensions are Parquet paths or catalog table names (a bucketed table
keeps its bucketing, so a sort-merge join shuffles only the orders). With ``--catalog`` a job makes its
layer a view of that database (bronze, silver, gold): the folder is the only copy.

A scheduler calls these at its own cadence (30 min for silver and 60 min for gold in the reference) and may
retry them. Each job's checkpoint lies with its output (or below ``--state``) and is bound to its
input; a job that would mix two inputs in one state is refused. Nothing runs at import time.
"""

from __future__ import annotations

import argparse

from .plans.reports import export_reports, export_stored_reports
from .plans.silver import to_silver
from .schemas import GOLD_COLUMNS, SILVER_COLUMNS, SILVER_SCHEMA
from .session import build_session
from .sinks.files import publish_dims
from .sinks.snapshots import publish_snapshots
from .sources.catalog import init_catalog, register_query
from .sources.files import read_parquet
from .sources.stream import orders_stream
from .streaming.incremental import GOLD_PARTITIONS, SILVER_PARTITIONS, bound_checkpoint, gold_layout, run_gold, run_silver
from .streaming.ingest import close_flush, start_gated_ingest, start_ingest, start_ingest_with_quarantine
from .streaming.layers import consume_flushes, consume_layer, register_consumed
from .streaming.reports import consume_reports, run_reports


def _dimension(spark, ref: str):
    """A dimension by catalog name (keeps its bucketing) or by Parquet path."""
    return spark.table(ref) if "/" not in ref else read_parquet(spark, ref)


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="orderlake.jobs")
    jobs = ap.add_subparsers(dest="job", required=True)

    def job(name: str, *needed: str, dims: bool = False, stream: bool = False) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        for opt in needed:
            p.add_argument(f"--{opt}", required=True)
        if dims:
            p.add_argument("--dims", nargs="+", required=True, metavar="NAME=REF")
        if stream:
            p.add_argument("--state")
            p.add_argument("--catalog")
            p.add_argument("--max-files", type=int, help="files a micro-batch takes at most")
        return p

    ingest = job("ingest", "wire", "raw", stream=True)
    ingest.add_argument("--max-age", type=int, help="seconds after which a held buffer goes out all the same")
    form = ingest.add_mutually_exclusive_group()
    form.add_argument("--quarantine", action="store_true", help="land rejected lines next to the orders")
    form.add_argument("--threshold", type=int, help="hold micro-batches until more than this many rows")
    silver = job("silver", "raw", "neighborhoods", "silver", stream=True)
    silver.add_argument("--polygons")
    silver.add_argument("--priority", help="polygon column that says which comes first")
    kind = silver.add_mutually_exclusive_group()
    kind.add_argument("--landing", action="store_true", help="raw is the folder of an ingest with quarantine")
    kind.add_argument("--gated", action="store_true", help="raw is the staging folder of a gated ingest")
    job("gold", "silver", "customers", "employees", "gold", stream=True).add_argument("--gated", action="store_true")
    reports = job("reports", "gold", "out")
    reports.add_argument("--sums", help="folder of partial sums, kept up with new gold only")
    reports.add_argument("--gated", action="store_true", help="gold was made from a gated ingest")
    job("init", "db", dims=True)
    job("publish", "out", dims=True).add_argument("--versions", action="store_true", help="replace by version, without a gap")
    return ap


def _checked(argv: list[str] | None) -> argparse.Namespace:
    """The arguments; an option that the chosen form can't honor is an error."""
    ap = _parser()
    args = ap.parse_args(argv)
    if args.job in ("silver", "gold") and args.gated:
        for option in ("state", "max_files"):
            if getattr(args, option) is not None:
                ap.error(f"--{option.replace('_', '-')} has no meaning with --gated")
    if args.job == "ingest" and args.threshold is not None and args.catalog:
        ap.error("a gated ingest has no view: use --catalog with silver --gated")
    if args.job == "ingest" and args.threshold is None and args.max_age is not None:
        ap.error("--max-age needs --threshold")
    if args.job == "reports" and args.gated and not args.sums:
        ap.error("--gated needs --sums")
    return args


def main(argv: list[str] | None = None) -> None:
    args = _checked(argv)
    spark = build_session(app=f"orderlake-{args.job}")
    once = {"availableNow": True}
    if args.job == "ingest":
        kind = "ingest-q" if args.quarantine else "ingest" if args.threshold is None else "ingest-gated"
        state = bound_checkpoint(spark, kind, args.wire, args.raw, args.state)
        more = {"maxFilesPerTrigger": str(args.max_files)} if args.max_files else {}
        lines = orders_stream(spark, "text", args.wire, **more)
        if args.quarantine:
            query = start_ingest_with_quarantine(lines, args.raw, state, trigger=once)
        elif args.threshold is None:
            query = start_ingest(lines, args.raw, state, trigger=once)
        else:
            query = start_gated_ingest(lines, args.raw, state, threshold=args.threshold, trigger=once, max_age=args.max_age)
        query.awaitTermination()
        if args.max_age is not None:
            close_flush(spark, args.raw, args.max_age)
        if args.catalog:
            where = " WHERE status = 'order'" if args.quarantine else ""
            register_query(spark, f"{args.catalog}.bronze", f"SELECT * FROM parquet.`{args.raw}`{where}")
    elif args.job == "silver":
        neighborhoods = _dimension(spark, args.neighborhoods)
        polygons = _dimension(spark, args.polygons) if args.polygons else None
        if args.gated:
            consume_flushes(spark, args.raw, lambda df: to_silver(df, neighborhoods, polygons=polygons, priority=args.priority),
                            args.silver, SILVER_PARTITIONS)
        else:
            run_silver(spark, args.raw, neighborhoods, args.silver,
                       bound_checkpoint(spark, "silver", args.raw, args.silver, args.state), polygons=polygons,
                       priority=args.priority, max_files=args.max_files, landing=args.landing)
        if args.catalog and args.gated:
            register_consumed(spark, f"{args.catalog}.silver", args.silver, SILVER_COLUMNS)
        elif args.catalog:
            register_query(spark, f"{args.catalog}.silver", f"SELECT * FROM parquet.`{args.silver}`")
    elif args.job == "gold":
        customers, employees = _dimension(spark, args.customers), _dimension(spark, args.employees)
        if args.gated:
            consume_layer(spark, args.silver, SILVER_SCHEMA, lambda df: gold_layout(df, customers, employees), args.gold, GOLD_PARTITIONS)
        else:
            run_gold(spark, args.silver, SILVER_SCHEMA, customers, employees, args.gold,
                     bound_checkpoint(spark, "gold", args.silver, args.gold, args.state), max_files=args.max_files)
        if args.catalog:
            register_query(spark, f"{args.catalog}.gold", f"SELECT {', '.join(GOLD_COLUMNS)} FROM parquet.`{args.gold}`")
    elif args.job == "reports":
        if args.gated:
            consume_reports(spark, args.gold, args.sums)
        elif args.sums:
            run_reports(spark, args.gold, args.sums, bound_checkpoint(spark, "reports", args.gold, args.sums))
        if args.sums:
            export_stored_reports(spark, args.sums, args.out)
        else:
            export_reports(spark.read.parquet(args.gold).select(*GOLD_COLUMNS), args.out)
    else:
        dims = dict(d.split("=", 1) for d in args.dims)
        if args.job == "init":
            init_catalog(spark, args.db, {n: _dimension(spark, ref) for n, ref in dims.items()})
        elif args.versions:
            publish_snapshots(spark, dims, args.out)
        else:
            publish_dims(spark, dims, args.out)


if __name__ == "__main__":
    main()
