"""Command line over the registered queries and the movie-table report.

``python -m dfinsight list | run NAME | explain NAME | profile PATH | analyse PATH | wordcount PATH``

``run`` writes the result as Parquet (``--out``) or shows the first rows; ``profile`` shows the
cleaning report of a movie table (CSV with header, or Parquet), ``analyse`` its Q1-Q5 reports,
``wordcount`` the most frequent words of a text path (falling back to a sample when it is missing). The session comes from
``spark-submit`` / the environment when one is active, else a local one.
"""

from __future__ import annotations

import argparse
import os
import sys


def _rules(specs: list[str] | None):
    from dfinsight.plans import movies
    if not specs:
        return movies.HIGH_RULES
    out = []
    for spec in specs:
        text, score, raters = spec.rsplit(":", 2)
        out.append((text, float(score), int(raters)))
    return tuple(out)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="dfinsight")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for cmd in ("run", "explain"):
        p = sub.add_parser(cmd)
        p.add_argument("name")
        p.add_argument("--sf-dir", default="/root/testdata/sf0.01")
        if cmd == "run":
            p.add_argument("--out", help="write Parquet here instead of showing rows")
            p.add_argument("--rows", type=int, default=20)
    for cmd in ("profile", "analyse", "wordcount"):
        p = sub.add_parser(cmd)
        p.add_argument("path")
        p.add_argument("--rows", type=int, default=20)
        if cmd == "analyse":
            p.add_argument("--rule", action="append", metavar="TEXT:SCORE:RATERS",
                           help="Q5 rule, repeatable (default: the built-in two rules)")
    args = ap.parse_args(argv)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from dfinsight.plans import catalog

    qs, sqls = catalog.queries(), catalog.oracle_sql()
    if args.cmd == "list":
        for name in qs:
            print(f"{name}\t{'oracle' if name in sqls else 'rows-only'}")
        return 0
    from pyspark.sql import SparkSession

    from dfinsight.session import build_session
    spark = SparkSession.getActiveSession() or build_session()
    if args.cmd == "wordcount":
        from dfinsight.operators.words import word_count
        from dfinsight.sources.io import read_lines
        word_count(read_lines(spark, args.path), "value", k=10).show(10, truncate=False)
        return 0
    if args.cmd in ("profile", "analyse"):
        from dfinsight.plans import movies
        from dfinsight.sources.io import read_csv
        raw = spark.read.parquet(args.path) if args.path.endswith(".parquet") else read_csv(spark, args.path)
        if args.cmd == "profile":
            report = movies.profile_report(raw)
            report["audit"] = movies.clean_audit(raw)
        else:
            base = movies.analysis_base(raw)
            report = {"q1_countries": movies.country_report(base), "q2_directors": movies.director_board(base),
                      "q3_decades": movies.decade_trend(base).orderBy("decade"),
                      "q4_top_per_genre": movies.top_per_genre(base).orderBy("genre", "rank_in_genre"),
                      "q5_two_regions": movies.two_region_high(base, _rules(args.rule))}
        for name, frame in report.items():
            print(f"== {name}")
            frame.show(args.rows, truncate=False)
        return 0
    df = qs[args.name](spark, args.sf_dir)
    if args.cmd == "explain":
        df.explain("formatted")
    elif args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
