"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local threads, and
BENCH_QUERIES, if set, the queries to run, separated by commas, or "all". Each query runs
once to warm up and once for the clock.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clipwire.checks.registry import registered  # noqa: E402
from clipwire.session import build_session  # noqa: E402

HEADLINE = """
ingest_articles collect_history window_page_cap search_query write_partition_overwrite
keyword_filter translate_enrich translate_enrich_large translation_pending
dedup_latest dedup_max_by count_by_day count_by_source_author count_keyword_days
count_keyword_occurrences word_count top_words zipf_compare
stream_articles stream_stage_merge stream_dedup stream_counts_by_day
harmonize harmonize_large aggregate_all daily_job
""".split()


def chosen(known: dict) -> list[str]:
    asked = os.environ.get("BENCH_QUERIES", "")
    if asked == "all":
        return list(known)
    return [n for n in asked.split(",") if n] or HEADLINE


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    known = registered()
    names = chosen(known)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries, second run",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
