"""Summarise the physical plan of every event-stream query (for PLANS.md).

    python tools/plans.py [sf_dir] > plans.txt

Per query: the operator chain (root first), the number of exchanges, and the
pushed filters / read schemas of the scans, taken from ``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    for name, fn in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0]
        ops = re.findall(r"([A-Z][A-Za-z]+(?: [A-Za-z]+)*) \(\d+\)", tree)
        ops = [o for o in ops if o not in ("AdaptiveSparkPlan", "ColumnarToRow")]
        print(f"### {name}\n")
        print(f"- operators (root first): {' ← '.join(ops)}")
        print(f"- exchanges: {sum(o.startswith('Exchange') for o in ops)}"
              f" (+{sum(o.startswith('BroadcastExchange') for o in ops)} broadcast)")
        for pf in sorted(set(re.findall(r"PushedFilters: (\[.*\])", text))):
            if pf != "[]":
                print(f"- pushed filters: `{pf}`")
        for rs in sorted(set(re.findall(r"ReadSchema: (struct<.*>)", text))):
            print(f"- read schema: `{rs}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
