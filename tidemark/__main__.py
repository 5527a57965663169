"""``python -m tidemark <dataflow> FILE [FILE ...]`` -- run one dataflow, print it."""

from __future__ import annotations

import argparse

from tidemark.plans.textjobs import DATAFLOWS, TWO_INPUTS
from tidemark.session import get_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tidemark", description="Run an event-stream dataflow over text files.")
    ap.add_argument("dataflow", choices=sorted(DATAFLOWS))
    ap.add_argument("paths", nargs="+", help="input files (two for union and height-join, one or two for pass-marks, else any number read one after another)")
    ap.add_argument("--out", help="write the result as parquet here instead of printing it")
    args = ap.parse_args(argv)
    spark = get_session()
    two = args.dataflow in TWO_INPUTS
    if two and len(args.paths) not in TWO_INPUTS[args.dataflow]:
        ap.error(f"{args.dataflow} takes {' or '.join(map(str, TWO_INPUTS[args.dataflow]))} files")
    df = DATAFLOWS[args.dataflow](spark, *(args.paths if two else [args.paths]))
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        # Every row, a partition at a time: the driver never holds more than one.
        print("\t".join(df.columns))
        for row in df.toLocalIterator():
            print("\t".join("" if v is None else str(v) for v in row))
    spark.stop()


if __name__ == "__main__":
    main()
