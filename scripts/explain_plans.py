"""Print the formatted physical plan of registered queries (plan review: pushdown, pruning,
exchanges, broadcasts).  usage: python scripts/explain_plans.py [sf_dir] name ..."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablelearn.plans.queries import QUERIES  # noqa: E402
from tablelearn.session import get_spark  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    spark = get_spark("local[4]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in args:
        print(f"===== {name}")
        QUERIES[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
