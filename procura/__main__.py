"""Run an extract from the command line (spark-submit or ``python -m procura``).

    python -m procura tax --tables s3://lake/procurement --out s3://out/tax \\
        --statuses 1,21,22 --lob-ids 7 --bu-codes 901,902 \\
        --as-of "2030-06-01 00:00:00" [--document-numbers PO-1001,...] [--format csv]

The parameters are the ones the source scripts declare at their top (status
list, line-of-business ids, business-unit codes, the optional document-number
filter) plus the as-of time that replaces the wall clock.  The session comes
from the environment; ``spark.checkpoint.dir`` must name a shared folder on a
cluster (the shared stages are written there).
"""

from __future__ import annotations

import argparse
import datetime as dt

from .config import ExtractConfig, parse_id_list


def _config(args: argparse.Namespace) -> ExtractConfig:
    numbers = tuple(x.strip() for x in args.document_numbers.split(",")) if args.document_numbers else None
    return ExtractConfig(
        document_statuses=parse_id_list(args.statuses),
        lob_ids=parse_id_list(args.lob_ids),
        bu_codes=parse_id_list(args.bu_codes),
        document_numbers=numbers,
        as_of=dt.datetime.fromisoformat(args.as_of),
        precision=args.precision,
        on_zero_divisor=args.on_zero_divisor,
        dedupe_scope=args.dedupe_scope,
    )


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="procura", description=__doc__.split("\n\n")[0])
    ap.add_argument("extract", choices=["tax", "accounting"])
    ap.add_argument("--tables", required=True, help="folder with one sub-folder per base table")
    ap.add_argument("--tables-format", default="parquet")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet", help="output format (parquet, csv, ...)")
    ap.add_argument("--statuses", required=True, help="scope document statuses, comma separated")
    ap.add_argument("--lob-ids", required=True)
    ap.add_argument("--bu-codes", required=True)
    ap.add_argument("--document-numbers", default=None)
    ap.add_argument("--as-of", required=True, help="ISO time that stands for 'now'")
    ap.add_argument("--precision", type=int, default=3)
    ap.add_argument("--on-zero-divisor", choices=["null", "error"], default="null")
    ap.add_argument("--dedupe-scope", action="store_true")
    ap.add_argument("--publish", action="store_true", help="write a new version aside and switch to it (parquet)")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from .plans.extracts import export
    from .plans.publish import publish_extract
    from .session import apply_defaults, ensure_checkpoint_dir
    from .sources.tables import load_tables

    spark = apply_defaults(SparkSession.builder.appName(f"procura-{args.extract}").getOrCreate())
    ensure_checkpoint_dir(spark)
    tables = load_tables(spark, args.tables, args.tables_format)
    if args.publish:
        publish_extract(tables, _config(args), args.out, args.extract)
    else:
        export(tables, _config(args), args.out, kind=args.extract, fmt=args.format)


if __name__ == "__main__":
    main()
