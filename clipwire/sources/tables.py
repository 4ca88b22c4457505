"""Table sources and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipwire.schema import PARTITION_COLUMN
from clipwire.sources.files import finish_swap, swap

DEFAULT_FORMAT = "parquet"
#: Parquet tables are packed by zstd, as their texts then take far fewer bytes than by snappy.
_PACKED = {"parquet": {"compression": "zstd"}}


def load_table(
    spark: SparkSession,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    schema: T.StructType | None = None,
    since: dt.date | None = None,
) -> DataFrame:
    """Read a table; ``since`` reads only partitions from that ``from_date`` on."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    df = reader.load(path)
    return df if since is None else df.where(F.col(PARTITION_COLUMN) >= F.lit(since))


def packed(fmt: str) -> dict[str, str]:
    """Options for whoever writes a table."""
    return _PACKED.get(fmt, {})


def _by_partition(df: DataFrame) -> DataFrame:
    # Rebalancing brings a day together into few files; AQE splits a day that is too
    # big for one task and merges days that are small.
    return df.hint("rebalance", F.col(PARTITION_COLUMN))


def write_overwrite(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Replace the whole table. It may be one that ``df`` is made of.

    The new table is written beside the old one and then put into its place, so a crash leaves
    one of them whole; the next call finishes a swap that was begun.
    """
    if fmt == "delta":  # replaces by its own log
        df.write.format(fmt).mode("overwrite").save(path)
        return
    beside = path.rstrip("/")
    finish_swap(df.sparkSession, f"{beside}_swap")
    df.write.format(fmt).options(**packed(fmt)).mode("overwrite").save(f"{beside}_next")
    swap(df.sparkSession, f"{beside}_swap", {f"{beside}_next": beside})


def write_partition_overwrite(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Replace only the ``from_date`` partitions that ``df`` has rows for."""
    (
        _by_partition(df)
        .write.format(fmt)
        .options(**packed(fmt))
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COLUMN)
        .save(path)
    )


def write_partition_append(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Add rows to the table, partitioned by ``from_date``."""
    writer = _by_partition(df).write.format(fmt).options(**packed(fmt))
    writer.mode("append").partitionBy(PARTITION_COLUMN).save(path)


def append_as_dealt(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """``write_partition_append`` of rows that lie even in tasks and go to few days: they stay where they are."""
    df.write.format(fmt).options(**packed(fmt)).mode("append").partitionBy(PARTITION_COLUMN).save(path)


# Quotes inside a field are doubled, as in the exports of other tools.
_CSV = {"header": "true", "quote": '"', "escape": '"'}


def read_csv_export(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Read CSV with a header row.

    Fields may hold line breaks unless ``multiline`` is off. With it on, a file is
    read by one task, so a large export should come as many files.
    """
    reader = spark.read.options(**_CSV).option("multiLine", multiline)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_csv_export(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write CSV that ``read_csv_export`` reads, in files of bounded size."""
    writer = df.write.mode("overwrite").options(**_CSV)
    writer.option("maxRecordsPerFile", rows_per_file).csv(path)
