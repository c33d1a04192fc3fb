"""Time the daily-load write path (bronze -> silver -> gold -> views).

usage: python tools/bench_load.py [sf_dir] [cpus]
Writes into a fresh warehouse folder under spark.checkpoint.dir and runs
two daily batches. Tables keyed by ever-increasing ids (tickets, ticket
times, costs, surveys) are split by id: day 1 carries the older 90 % of the
ids, day 2 the newest 10 % (every row is loaded exactly once); dimension
feeds are re-sent whole each day. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from callstar.plans import daily_load  # noqa: E402
from callstar.plans.lake import Lake  # noqa: E402
from callstar.session import build_session, checkpoint_root  # noqa: E402
from callstar.sources.landing import LANDING  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    spark = build_session(f"local[{cpus}]", app="callstar-load-bench", shuffle_partitions=max(8, 2 * cpus))
    spark.conf.set("callstar.warehouse", os.path.join(checkpoint_root(spark), f"bench-wh-{uuid.uuid4().hex}"))
    lake = Lake(spark, sf)
    landing = {n: lake.landing(n) for n in LANDING}
    split = {"l_tickets": "id_ticket", "l_ticket_times": "id_ticket", "l_costs": "id_cost", "l_surveys": "id_survey"}
    cut = {n: landing[n].agg(F.expr(f"min({c}) + 0.9 * (max({c}) - min({c}))")).first()[0] for n, c in split.items()}
    days = []
    for older in (True, False):
        day = dict(landing)
        for n, c in split.items():
            day[n] = landing[n].filter(F.col(c) < cut[n] if older else F.col(c) >= cut[n])
        days.append(day)
    out = {}
    for (label, batch), day in zip([("first_batch", "2024-03-01 02:00:00"), ("second_batch", "2024-03-02 02:00:00")],
                                   days):
        landing = day
        t = {}
        t0 = time.perf_counter()
        daily_load.load_bronze(spark, landing, batch)
        t["bronze"] = time.perf_counter() - t0
        t0 = time.perf_counter()
        daily_load.load_silver(spark, {n: df.schema for n, df in landing.items()}, batch)
        t["silver"] = time.perf_counter() - t0
        t0 = time.perf_counter()
        daily_load.load_gold(spark, batch)
        t["gold"] = time.perf_counter() - t0
        t0 = time.perf_counter()
        daily_load.publish(spark)
        t["views"] = time.perf_counter() - t0
        out[label] = {k: round(v, 2) for k, v in t.items()}
    print(json.dumps({"metric": "daily_load_sec", "sf": sf, "cpus": cpus, **out}))


if __name__ == "__main__":
    main()
