"""Run every question on a catalogue: ``python -m marquee <tsv-dir> [--out DIR]``.

Prints the first rows of each question (the reference's console output) and,
with ``--out``, writes every full result as Parquet (``plans.job.run_all``).
Parameters are the questions' defaults, i.e. the reference's literals.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.job import run_all
from .session import apply_scale_conf
from .sources import load_parquet, load_tsv


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="marquee", description=__doc__.splitlines()[0])
    ap.add_argument("source", help="folder with the seven TSV files (or landed Parquet with --parquet)")
    ap.add_argument("--parquet", action="store_true", help="source is a landed Parquet catalogue")
    ap.add_argument("--quote", default="", help='TSV quote char ("" = none, the default)')
    ap.add_argument("--out", help="write every full result as Parquet under this folder")
    ap.add_argument("--rows", type=int, default=20, help="rows to print per question (0 = none)")
    ap.add_argument("--share", action="store_true", help="write titles joined to ratings once, for the questions that start from them")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("marquee").getOrCreate()
    apply_scale_conf(spark)
    cat = load_parquet(spark, args.source) if args.parquet else load_tsv(spark, args.source, quote=args.quote)
    run_all(cat, args.out, rows=args.rows, share=args.share)


if __name__ == "__main__":
    main()
