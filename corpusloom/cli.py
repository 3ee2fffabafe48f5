"""spark-submit front: archives through the whole run, JSON folders to TEI again."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from corpusloom.plans import pipeline
from corpusloom.sources import writers


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Comment archives to clean TEI corpora.")
    parser.add_argument("inputs", nargs="+", help=".zst archives, or folders of JSON documents")
    parser.add_argument("--out", required=True, help="folder that all executors share")
    parser.add_argument("--bots", help="list of authors to leave out, one a line")
    parser.add_argument("--no-group", action="store_true", help="one document per comment")
    parser.add_argument("--dtd", help="a DTD to hold the documents against")
    parser.add_argument("--long-window", action="store_true", help="archives compressed with a long window")
    parser.add_argument("--threads", help="list of threads to take, one a line; all if not given")
    parser.add_argument("--keep", action="store_true", help="refuse folders that hold an earlier run instead of replacing it")
    args = parser.parse_args(argv)
    mode = "errorifexists" if args.keep else "overwrite"
    spark = SparkSession.builder.appName("corpusloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for given in args.inputs:
        name = given.rstrip("/").rsplit("/", 1)[-1]
        if given.endswith((".zst", ".gz", ".ndjson")):
            out = f"{args.out}/{name.split('.')[0].removesuffix('_comments')}_{'nogroup' if args.no_group else 'grouped'}"
            result = pipeline.run_archive(spark, given, out, args.bots, not args.no_group, long_window=args.long_window, dtd=args.dtd, mode=mode, only=args.threads)
            result.counters.show(truncate=False)
            result.reconciled.show(truncate=False)
            result.validation.groupBy("valid").count().show()
        else:
            docs = pipeline.run_json(spark, given, not args.no_group)
            writers.write_files(docs, f"{args.out}/{name}_xml", "tei", mode=mode)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
