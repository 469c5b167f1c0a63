"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of cores. Every query is
run to the end of its result and its rows are written nowhere; a small query on the same
session before the first measurement starts the Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelftalk.queries import QUERIES  # noqa: E402
from shelftalk.session import local_session  # noqa: E402

HEADLINE = (
    "ratings_collapse",
    "popular_items",
    "top_rated",
    "item_pearson",
    "similar_items_all",
    "user_recommendations",
    "all_user_recommendations",
    "tag_documents",
    "term_counts",
    "document_term_counts",
    "similar_titles",
    "similar_titles_all",
    "similar_documents",
    "clean_a",
    "clean_b",
    "dialog_pairs",
    "vocabulary",
    "pairs_in_vocabulary",
    "encode_pairs",
    "batches",
    "subword_encode",
    "page_links",
    "page_links_parsed",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("fold_accents")
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
