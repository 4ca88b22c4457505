"""The daily job: harmonize, then count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from clipwire.plans.harmonize import run_harmonize
from clipwire.plans.semantic import aggregate_all
from clipwire.schema import COUNT_KEYWORDS, HARMONIZED_TABLE, RELEVANCE_KEYWORDS, SEMANTIC_DIR
from clipwire.sources.tables import DEFAULT_FORMAT, load_table


def daily_job(
    spark: SparkSession,
    raw_path: str,
    memory_path: str,
    out_dir: str,
    keywords: Sequence[str] = RELEVANCE_KEYWORDS,
    count_keywords: Sequence[str] = COUNT_KEYWORDS,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, str]:
    """Write the harmonized table and, from it, the three count tables.

    Gives the table paths by name. Run it from any scheduler, once a day.
    """
    harmonized = f"{out_dir}/{HARMONIZED_TABLE}"
    run_harmonize(spark, raw_path, memory_path, harmonized, keywords, fmt)
    counts = aggregate_all(
        load_table(spark, harmonized, fmt), f"{out_dir}/{SEMANTIC_DIR}", count_keywords, fmt=fmt
    )
    return {HARMONIZED_TABLE: harmonized, **counts}
