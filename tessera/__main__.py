"""Command line: run the whole job, or show the KPI tables of a warehouse.

    python -m tessera run  --ris ris.csv --pacs pacs.csv --epr epr.csv --root /shared/radiology
    python -m tessera run  --ris ris/ --pacs pacs/ --epr epr/ --unseen-files --root /shared/radiology
    python -m tessera run  --tables /root/testdata/sf0.01 --root /shared/radiology
    python -m tessera kpis --root /shared/radiology

``--root`` is a folder of the shared file system (it holds staging, the
warehouse, KPI tables and state). On a cluster, submit with spark-submit and
the cluster's own settings; locally a ``local[*]`` session is created.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _session(master: str | None) -> SparkSession:
    from tessera.session import apply_job_conf, local_session
    if master:
        return local_session(cores=master)
    spark = SparkSession.builder.getOrCreate()
    apply_job_conf(spark)
    return spark


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="extract, validate, transform, load and report once")
    run.add_argument("--tables", help="folder with events.parquet, from which stand-in exports are derived")
    for source in ("ris", "pacs", "epr"):
        run.add_argument(f"--{source}", help=f"{source.upper()} export: a header CSV file or folder")
    run.add_argument("--unseen-files", action="store_true",
                     help="read the RIS and PACS files that no run has loaded, instead of rows after the marks")
    run.add_argument("--root", required=True, help="shared output folder")
    run.add_argument("--run-ts", default=None, help="run time stamp (default: now, UTC)")
    show = sub.add_parser("kpis", help="print the KPI tables of a warehouse")
    show.add_argument("--root", required=True)
    for p in (run, show):
        p.add_argument("--local", default=None, metavar="CORES",
                       help="use a local[CORES] session instead of the submitted one")
    args = ap.parse_args(argv)
    spark = _session(args.local)

    if args.cmd == "run":
        from tessera.plans.batch import run_batch, run_exports
        from tessera.sources import exports, standins
        if args.unseen_files and args.ris and args.pacs and args.epr:
            out = run_exports(spark, args.ris, args.pacs, args.epr, args.root, run_ts=args.run_ts)
            print(json.dumps(out, default=str, indent=1))
            return
        bad = None
        if args.tables:
            ev = standins.read_table(spark, args.tables, "events")
            sources = standins.studies(ev), standins.images(ev), standins.patients(ev)
        elif args.ris and args.pacs and args.epr:
            sources = (exports.read_ris_csv(spark, args.ris), exports.read_pacs_csv(spark, args.pacs),
                       exports.read_epr_csv(spark, args.epr))
            for path in (args.ris, args.pacs, args.epr):
                found = exports.csv_bad_records(spark, path).select("record")
                bad = found if bad is None else bad.unionByName(found)
        else:
            ap.error("give --ris, --pacs and --epr, or --tables")
        out = run_batch(spark, *sources, args.root, run_ts=args.run_ts, bad_records=bad)
        print(json.dumps(out, default=str, indent=1))
    else:
        from tessera.operators.warehouse import Warehouse
        from tessera.plans import kpis
        wh = Warehouse(spark, f"{args.root.rstrip('/')}/warehouse")
        for name, df in kpis.all_kpis(wh.table("fact_radiology"), wh.table("dim_modality"),
                                      wh.table("dim_location")).items():
            print(f"== {name}")
            df.show(truncate=False)


if __name__ == "__main__":
    main()
