"""Command line: ``python -m caretiers <bundles> --db ROOT [--lines] [--new] [--quarantine] [--debug]``."""

from __future__ import annotations

import argparse
import datetime

from pyspark.errors import AnalysisException

from caretiers.plans.pipeline import run_pipeline
from caretiers.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="caretiers", description="FHIR bundles to bronze, silver and gold tables.")
    parser.add_argument("input", help="directory of bundle files (*.json)")
    parser.add_argument("--db", required=True, help="directory for the tables")
    parser.add_argument("--lines", action="store_true", help="files hold one bundle per line")
    parser.add_argument("--new", action="store_true", help="add the files that no earlier run with --new has added")
    parser.add_argument("--quarantine", action="store_true", help="keep malformed bundles aside instead of failing")
    parser.add_argument("--debug", action="store_true", help="also store the silver tables")
    parser.add_argument("--as-of", type=datetime.date.fromisoformat, help="date at which ages are taken")
    args = parser.parse_args()
    spark = build_session()
    try:
        run_pipeline(spark, args.input, args.db, lines=args.lines, debug=args.debug, as_of=args.as_of, new=args.new, quarantine=args.quarantine)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise SystemExit(f"input does not exist: {args.input}") from None


if __name__ == "__main__":
    main()
