"""Command line: ``python -m callstar <command>``.

  load  SF_DIR BATCH_TS WAREHOUSE   run the daily load for the landing tables derived from SF_DIR
  query NAME SF_DIR [N]     show N rows of a registered query
  list                      list registered queries with their operator ids
"""

from __future__ import annotations

import sys


def main(argv: list[str]) -> int:
    if not argv or argv[0] not in {"load", "query", "list"}:
        print(__doc__)
        return 2
    from callstar.plans import catalog
    if argv[0] == "list":
        for name, e in catalog.REGISTRY.items():
            print(f"{name:32s} {e.ids}")
        return 0
    from callstar.session import build_session
    spark = build_session()
    if argv[0] == "load":
        from callstar.plans import daily_load
        from callstar.plans.lake import Lake
        from callstar.sources.landing import LANDING
        spark.conf.set("callstar.warehouse", argv[3])
        lake = Lake(spark, argv[1])
        daily_load.run(spark, {n: lake.landing(n) for n in LANDING}, argv[2]).show(truncate=False)
        daily_load.layer_status(spark).show(truncate=False)
        return 0
    n = int(argv[3]) if len(argv) > 3 else 20
    catalog.run(argv[1], spark, argv[2]).show(n, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
