"""Time all catalog queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores,
BENCH_QUERIES (comma-separated names) replaces the list. Two queries run once before
the clock.
"""

from __future__ import annotations

import json
import os
import time

from quarryline.plans import catalog
from quarryline.session import local_session


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(catalog.queries())
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    known = catalog.queries()
    # Start the Python workers and compile the common code outside the clock: it happens once per session.
    for name in ("e1_model_embedding", "v8_rerank"):
        known[name](spark, sf).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        known[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "catalog queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
