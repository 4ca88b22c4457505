"""Quality rows of streams: the observed counts of each micro-batch, written by a listener."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from clipwire.operators.quality import QUALITY_SCHEMA, article_measures


def watched(df: DataFrame, stage: str) -> DataFrame:
    """A streaming ``df`` whose rows are counted in each micro-batch, for a ``QualityListener``."""
    measures = article_measures(df.columns)
    return df.observe(stage, *[c.cast("bigint").alias(n) for n, c in measures.items()])


class QualityListener(StreamingQueryListener):
    """Appends the watched counts of every micro-batch of the session's queries to a table.

    Register it by ``spark.streams.addListener``. Rows have the query's name (or id) as ``job`` and the
    number of the micro-batch as ``run``. A batch that runs again after a failure is reported again;
    readers take the last row of a run. Batches without rows are not written.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path, fmt

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        import datetime as dt

        progress = event.progress
        at = dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        job = progress.name or str(progress.id)
        rows = [
            (job, str(progress.batchId), stage, n, v, at)
            for stage, counts in progress.observedMetrics.items()
            for n, v in counts.asDict().items()
            if counts["rows"]
        ]
        if rows:
            frame = self.spark.createDataFrame(rows, QUALITY_SCHEMA).coalesce(1)
            frame.write.format(self.fmt).mode("append").save(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
