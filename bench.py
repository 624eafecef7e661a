"""Time the headline queries; prints one JSON line.

Every query is run once to warm up and then ``BENCH_REPEATS`` times; the median
counts. All result rows are produced (``noop`` sink), nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pairwarden.catalog import QUERIES
from pairwarden.session import drop_staged, local_session

HEADLINE = [
    "match_rules",
    "label_pairs",
    "skip_pairs",
    "skip_pairs_by_unit",
    "lookback",
    "mad_threshold",
    "count_matrix",
    "token_counts",
    "similar_pairs",
    "similar_pairs_above",
    "corr_pairs",
    "samekind_pairs",
    "bucket_similarity",
    "tag_score",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats + 1):  # the first run warms up
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
            drop_staged(spark)
        seconds[name] = round(statistics.median(runs[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))


if __name__ == "__main__":
    main()
