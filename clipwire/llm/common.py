"""What several operators of this folder share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwire.session import scratch_dir

#: What parts words from each other: ASCII white space only.
WORD_GAP = "\\x20\\x09-\\x0D"
WORD = f"[^{WORD_GAP}]+"


def _workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where it is.

    On a cluster, ship it with ``--py-files``; a folder that is not there does no harm.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder, for a query whose functions are in this package."""
    _workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    It cuts the lineage, and what follows can be computed anew from the files when an
    executor is lost.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: CRC-32 of its id as text, modulo ``folds``; 0 without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def least_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` least distinct values of a column of 64-bit hashes; null is none of them.

    They are thinned before they are sorted, so that no task hands on many, and written to
    the shared folder; nothing goes through the driver. ``df`` is read twice.
    """
    known = df.where(F.col(column).isNotNull()).select(column)
    distinct = known.agg(F.approx_count_distinct(column)).first()[0]
    share = min(1.0, 4.0 * n / max(distinct, 1))
    thin = known.where(F.col(column).cast("double") <= share * 2.0**64 - 2.0**63)
    return stored(thin.distinct().orderBy(column).limit(n), "least-values")


def hash_sample(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` different rows of ``df``, those with the least hash of all their columns.

    The same rows in any order and number of copies give the same sample. It is stored; nothing
    but it comes to the driver when it is collected.
    """
    hashed = df.withColumn("_row_hash", F.xxhash64(*df.columns, *[F.col(c).isNull() for c in df.columns]))
    chosen = F.broadcast(least_values(hashed, "_row_hash", n))
    rows = hashed.join(chosen, "_row_hash", "left_semi").dropDuplicates(["_row_hash"])
    return stored(rows.drop("_row_hash"), "hash-sample")


def joined_apart(
    df: DataFrame, small: DataFrame, on: str, how: str = "inner", hint: str = "merge"
) -> DataFrame:
    """``df`` joined on a column with ``small``, an aggregate that has one row for each value.

    AQE splits a hot value only where both sides of the join come straight from a shuffle. Under
    its old name the column would spare the aggregate its shuffle, so it gets a new one. Neither
    side is a broadcast: both grow with the input, and Spark sizes them by their packed files.
    """
    again = small.withColumn("_again", F.array_max(F.array(on))).drop(on).hint(hint)
    return df.join(again, F.col(on) == F.col("_again"), how).drop("_again")
