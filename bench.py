"""Times the main queries and prints one JSON line.

Each query is planned and run from the given tables into a sink that discards
rows; the bank's own tables are derived from the given ones, which is part of
every time.  ``w2_daily_close`` computes all seven outputs of a close and writes,
reads and deletes its intermediate tables.  The best of ``BENCH_RUNS`` (2) runs
counts.
"""

from __future__ import annotations

import json
import os
import time

from checks.registry import QUERIES, Context
from checks.session import local_session
from duebook.plans.close import daily_close

HEADLINE = (
    "d8_carry_forward",
    "d10_days_past_due",
    "d12_d17_counters",
    "d19_d32_default_detection",
    "d33_d36_probation",
    "d38_d40_contagion",
    "d41_d46_default_attributes",
    "d49_monthly_recovery",
    "d50_default_events",
    "d51_gross_carrying_amount",
    "w5_unwinding",
    "d60_product_register",
    "d63_joint_flags",
    "d64_commit_accounts",
    "w2_daily_close",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session()
    seconds = {}
    for name in HEADLINE:
        query, times = QUERIES[name], []
        for _ in range(runs):
            began = time.perf_counter()
            context = Context(spark, sf_dir)
            if name == "w2_daily_close":
                close = context.close()
                results = daily_close(close).values()
            else:
                results = [query.present(query.run(context))]
            for result in results:
                result.write.format("noop").mode("overwrite").save()
            if name == "w2_daily_close":
                close.clear()
            times.append(time.perf_counter() - began)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "total of the main queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rpartition("sf")[2],
            }
        )
    )


if __name__ == "__main__":
    main()
