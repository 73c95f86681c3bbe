"""Time the headline queries and print one JSON line.

Every query starts from the parquet tables; nothing is kept between them.  A query
is run to completion through the no-op sink, so all of its rows are computed.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from kindred import build_session
from verification.queries import QUERIES

HEADLINE = [
    "rating_stats", "mae_global", "mae_user", "mae_item", "mae_baseline", "baseline_prediction",
    "cosine_similarity", "jaccard_similarity", "overlap_stats", "top_k_neighbors",
    "mae_cosine", "mae_jaccard", "mae_knn", "knn_sweep", "lowest_k",
    "recommend_baseline", "recommend_popularity", "recommend_knn", "recommend_knn_all",
    "top_k_neighbors_hot", "cosine_prediction_hot",
]


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        run(folder)


def run(folder: str) -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=folder,
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["mae_user"](spark, directory).write.format("noop").mode("overwrite").save()  # warm up
    times = {}
    for name in only.split(",") if only else HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
