"""Print the formatted physical plan of registered queries (after one run, so the
adaptive plan shown is the final one).

usage: python tools/explain.py [sf_dir] key [key ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ticketflow.plans.catalog import QUERIES  # noqa: E402
from ticketflow.session import local_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    root = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = local_session(8)
    for key in args:
        df = QUERIES[key](spark, root)
        df.write.format("noop").mode("overwrite").save()
        print(f"===== {key}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
