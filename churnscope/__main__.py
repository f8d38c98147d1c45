"""Command line: ``python -m churnscope --input tx.csv --out /shared/out``."""

from __future__ import annotations

import argparse

from churnscope.config import Params


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="churnscope", description=__doc__)
    ap.add_argument("--input", required=True, help="transaction lines (CSV or Parquet)")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet", "orc"])
    ap.add_argument("--encoding", default="ISO-8859-1")
    ap.add_argument("--out", required=True, help="output folder (shared storage)")
    ap.add_argument("--out-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--steps", default="rfm,ts,ch")
    ap.add_argument("--country", default=None, help="optional country scope")
    ap.add_argument("--churn-days", type=int, default=120)
    ap.add_argument("--keep-intermediate", action="store_true",
                    help="keep the tables written to spark.checkpoint.dir")
    a = ap.parse_args(argv)
    from churnscope.plans.pipeline import run
    from churnscope.session import get_spark
    from churnscope.sources import read_transactions
    spark = get_spark()
    tx = read_transactions(spark, a.input, a.format, a.encoding)
    params = Params(churn_days=a.churn_days, country=a.country)
    run(spark, tx, a.out, tuple(a.steps.split(",")), params, a.out_format,
        cleanup=not a.keep_intermediate)


if __name__ == "__main__":
    main()
