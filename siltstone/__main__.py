"""python -m siltstone list | run NAME --tables DIR [--output PATH] [--format parquet|json] | ingest --source DIR --schema DDL --store DIR | verify-archive FILE

Exit codes: 0 done, 2 wrong usage, 3 a check found something.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from siltstone.session import session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="siltstone", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of all reports")
    run = commands.add_parser("run", help="run a report over a folder of tables")
    run.add_argument("name")
    run.add_argument("--tables", required=True)
    run.add_argument("--output")
    run.add_argument("--format", choices=("parquet", "json"), default="parquet")
    ingest = commands.add_parser("ingest", help="ingest all new files of a folder")
    for option in ("--source", "--schema", "--store"):
        ingest.add_argument(option, required=True)
    verify = commands.add_parser("verify-archive", help="check a published archive")
    verify.add_argument("file")
    args = parser.parse_args(argv)

    if args.command == "verify-archive":
        from siltstone.operators.publish import verify_archive

        wrong = verify_archive(Path(args.file).read_bytes())
        print(json.dumps({"problems": wrong}))
        return 3 if wrong else 0
    from siltstone.plans.queries import QUERIES

    if args.command == "list":
        print("\n".join(QUERIES))
        return 0
    if args.command == "run" and args.name not in QUERIES:
        parser.error(f"no report {args.name}")
    spark = session()
    if args.command == "ingest":
        from siltstone.streaming.ingest import ingest_stream

        ingest_stream(spark, args.source, args.schema, args.store).awaitTermination()
        return 0
    rows = QUERIES[args.name](spark, args.tables)
    if args.output:
        rows.write.format(args.format).save(args.output)
    else:
        rows.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
