"""Quality rows: how many rows each stage of a job takes, rejects and keeps, without an extra pass.

Counts ride along as observed metrics of the job's own pass over its data. A batch job watches its
stages and appends their counts once its action is done; a stream hands the counts of each
micro-batch to a listener (``streaming.quality``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipwire.functions.dates import published_date

QUALITY_SCHEMA = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("measure", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("at", T.TimestampType()),
    ]
)


def article_measures(columns: list[str]) -> dict[str, Column]:
    """What is counted of articles: rows, and those without a valid date, an author or a title."""
    measures = {"rows": F.count(F.lit(1))}
    if "publishedAt" in columns:
        measures["bad_dates"] = F.count_if(published_date().isNull())
    for name in ("author", "title"):
        if name in columns:
            measures[f"without_{name}"] = F.count_if(F.col(name).isNull())
    return measures


class QualityLog:
    """The counts of one run of a batch job.

    Each watched frame has to be part of one action, such as a write, before ``rows`` is asked for. A
    frame that is computed again after a lost executor is counted once, as Spark takes the metrics of
    finished tasks only; one that two actions use is counted by the first.
    """

    def __init__(self, job: str, run: str):
        self.job, self.run = job, run
        self._watched: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, stage: str, **more: Column) -> DataFrame:
        """``df``, whose rows are counted as they pass; ``more`` are further measures by name."""
        seen = Observation(f"{self.job}-{stage}-{len(self._watched)}")
        self._watched.append((stage, seen))
        measures = {**article_measures(df.columns), **more}
        return df.observe(seen, *[c.cast("bigint").alias(n) for n, c in measures.items()])

    def rows(self) -> list[tuple]:
        """The rows of ``QUALITY_SCHEMA``; ``lost`` is what a stage has less than the one before."""
        now, out, before = dt.datetime.now(dt.timezone.utc), [], None
        for stage, seen in self._watched:
            counts = dict(seen.get)
            if before is not None:
                counts["lost"] = before - counts["rows"]
            before = counts["rows"]
            out += [(self.job, self.run, stage, n, v, now) for n, v in counts.items()]
        return out

    def save(self, spark: SparkSession, path: str, fmt: str = "parquet") -> None:
        """Append the rows to the quality table."""
        rows = spark.createDataFrame(self.rows(), QUALITY_SCHEMA).coalesce(1)
        rows.write.format(fmt).mode("append").save(path)
