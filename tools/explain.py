"""Print ``explain("formatted")`` for registered queries.

    python tools/explain.py [sf_dir] key [key ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine.plans.catalog import queries  # noqa: E402
from vitrine.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session()
    qs = queries()
    for k in args or list(qs):
        print(f"==== {k}")
        qs[k](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
