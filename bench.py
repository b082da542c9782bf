"""Headline queries, timed. Prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

HEADLINE = [
    "flatten_car_used",
    "normalize_realestate_homes",
    "partitioned_write_prune",
    "dedupe_latest",
    "dedupe_html",
    "html_layouts",
    "clean_text",
    "tokens_no_stopwords",
    "bigrams",
    "ngrams",
    "top_phrases",
    "join_meta_content",
    "dim_keywords",
    "bridge_keywords",
    "ads_with_ids_documents",
    "employer_top_keywords_all",
    "search_hits",
    "search_hits_batch",
]


def main(names: list[str]) -> None:
    from adloom.session import build_session
    from driver_queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus),
        {"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed pass over the smallest scale, so that the times are not those of
    # class loading and code generation.
    small = pathlib.Path(sf_dir).parent / "sf0.001"
    times = {}
    if small.is_dir():
        for name in names or HEADLINE:
            QUERIES[name](spark, str(small)).write.format("noop").mode("overwrite").save()
    for name in names or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": pathlib.Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
