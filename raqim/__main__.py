"""``python -m raqim list`` names the queries, ``python -m raqim run NAME FOLDER`` shows one over a folder of tables."""

from __future__ import annotations

import sys


def main(args: list[str]) -> int:
    from raqim.plans import catalog

    found = catalog.queries()
    if args[:1] == ["list"]:
        print("\n".join(sorted(found)))
        return 0
    if len(args) == 3 and args[0] == "run" and args[1] in found:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("raqim").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        found[args[1]](spark, args[2]).show(20, truncate=80)
        return 0
    print(__doc__)
    return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
