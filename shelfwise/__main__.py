"""Command line: run the daily pipeline, the ETL, or one registered query.

    python -m shelfwise pipeline --tables DIR --out DIR [--as-of YYYY-MM-DD] [--star]
    python -m shelfwise daily    --tables DIR --out DIR --batch NAME [--as-of YYYY-MM-DD] [--star]
    python -m shelfwise etl      --tables DIR --out DIR [--as-of YYYY-MM-DD] [--star]
    python -m shelfwise query NAME --tables DIR [--out DIR] [--as-of YYYY-MM-DD] [--star]

``--tables`` holds the driver-style tables (lineitem, part, ...) or, with
``--star``, a star schema (sales, products, categories, stores, inventory).
``daily`` takes the sales of ``--tables`` as one delivery: refused rows, fact, daily
state and reports lie under ``--out``, and the same batch again changes nothing.
The date is today unless given; for a query on the driver-style tables, the
last date of those.  Without ``--out`` a query prints all its rows as CSV.
On a cluster, submit with spark-submit; the session here only fills in
settings the launcher left unset.
"""

from __future__ import annotations

import argparse
import csv
import datetime as dt
import sys

from shelfwise.session import build_session, ensure_checkpoint_dir


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="shelfwise")
    ap.add_argument("command", choices=["pipeline", "daily", "etl", "query"])
    ap.add_argument("name", nargs="?", help="query name (for 'query')")
    ap.add_argument("--tables", required=True)
    ap.add_argument("--out")
    ap.add_argument("--batch", help="name of the delivery (for 'daily')")
    ap.add_argument("--as-of", type=dt.date.fromisoformat)
    ap.add_argument("--star", action="store_true", help="--tables is a star schema")
    ap.add_argument("--master", default="local[*]")
    ap.add_argument("--cluster", action="store_true",
                    help="cluster sizing (CLUSTER_CONF); the master comes from spark-submit")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession
    owned = SparkSession.getActiveSession() is None
    spark = (build_session(None, profile="cluster") if args.cluster
             else build_session(args.master))
    ensure_checkpoint_dir(spark)
    from shelfwise.sources.model import load_model, model_from_tables
    model = model_from_tables(spark, args.tables) if args.star else load_model(spark, args.tables)
    as_of = args.as_of or dt.date.today()

    if args.command == "pipeline":
        from shelfwise.plans.jobs import run_pipeline
        out = run_pipeline(spark, model, as_of, args.out or "reports", run_date=as_of)
        print(out["summary"])
    elif args.command == "daily":
        from shelfwise.plans.jobs import run_daily
        if not args.batch:
            ap.error("daily needs --batch")
        # the driver-style fact has order numbers, no line key
        out = run_daily(spark, model.sales, model, args.out or "store", args.batch, as_of, None if args.star else [])
        print(out["counts"])
    elif args.command == "etl":
        from shelfwise.operators.etl import run_etl
        run_etl(model, as_of, args.out or "data/processed")
    else:
        from shelfwise.plans.catalog import AS_OF, QUERIES
        df = QUERIES[args.name].operator(model, args.as_of or (as_of if args.star else AS_OF))
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            lines = csv.writer(sys.stdout)
            lines.writerow(df.columns)
            lines.writerows(df.toLocalIterator())
    if owned:
        spark.stop()


if __name__ == "__main__":
    main()
