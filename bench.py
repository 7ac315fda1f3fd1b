"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the cores. Each query runs once for warm-up at
the smallest scale and is then timed as a whole: reading, building and a full result.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from linkseek.plans.queries import QUERIES  # noqa: E402
from linkseek.session import local_session  # noqa: E402
from linkseek.workspace import delete_all  # noqa: E402

HEADLINE = [
    "link_edges",
    "pagerank_pages",
    "pagerank_entities",
    "term_frequency",
    "postings",
    "word_positions",
    "search_batch",
    "search_topk",
    "search_snippets",
    "document_table",
]


def run(query, spark, folder) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    delete_all()
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    warm = os.path.join(os.path.dirname(folder), "sf0.001")
    if os.path.isdir(warm):
        for name in names:
            run(QUERIES[name], spark, warm)
    times = {name: round(run(QUERIES[name], spark, folder), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
