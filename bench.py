"""Benchmark: wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of cores.
Every query is run once to warm up at the same scale, then timed once; results
are written to the no-op sink, so that all columns of all rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from threadlens.plans.catalog import QUERIES
from threadlens.session import get_session

HEADLINE = (
    "clean_text", "modeling_text", "domain_flags", "user_messages", "exact_duplicates", "merged_units",
    "event_segments", "event_segments_sliced", "hash_embeddings", "embed_documents_cached", "topic_keywords",
    "topic_terms", "topic_centroids", "ranked_examples", "outlier_reassignment", "density_topics", "topic_summary",
    "topic_trends", "growth_scores", "response_parsing", "final_summary", "report_lines",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_session("bench", int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4)))
    timings = {}
    for name in HEADLINE:
        for _ in range(2):
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - begin, 3)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_queries", "value": total, "unit": "sec", "queries": timings, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
