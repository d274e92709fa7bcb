"""Print the formatted physical plan of catalog queries (for plan review).

usage: python tools/explain_plans.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lacuna import get_session  # noqa: E402
from lacuna.plans import queries  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = get_session()
    qs = queries()
    for name in args:
        print(f"===== {name}")
        qs[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
