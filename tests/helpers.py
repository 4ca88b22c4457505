"""Small article frames for the tests."""

from pyspark.sql import types as T

FLAT = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "source_id source_name author title description content url publishedAt "
            "title_pt description_pt content_pt"
        ).split()
    ]
)


def flat(spark, *rows):
    """Flat articles from dicts; what a dict leaves out is null."""
    return spark.createDataFrame([tuple(r.get(f) for f in FLAT.names) for r in rows], FLAT)


def rows(df, *columns):
    """The rows as sorted tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: [(v is not None, v) for v in r],
    )
