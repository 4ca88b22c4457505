"""Article schemas and the fixed column names, table names and word lists."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of an article as the news API sends it.
SOURCE_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]
)
ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("source", SOURCE_SCHEMA),
        T.StructField("author", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("urlToImage", T.StringType()),
        T.StructField("publishedAt", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

CORRUPT_COLUMN = "_corrupt_record"
# The articles of a payload stay JSON texts, so that a bad one does not spoil the others.
PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("articles", T.ArrayType(T.StringType())),
        T.StructField(CORRUPT_COLUMN, T.StringType()),
    ]
)
# What an ingested article has besides: its other fields as JSON, and its place in the reply.
EXTRA_COLUMN = "extra"
POSITION_COLUMN = "position"
INGESTED_SCHEMA = T.StructType(
    [
        *ARTICLE_SCHEMA.fields,
        T.StructField(EXTRA_COLUMN, T.StringType()),
        T.StructField(POSITION_COLUMN, T.IntegerType()),
    ]
)

RAW_SCHEMA = T.StructType([*INGESTED_SCHEMA.fields, T.StructField("from_date", T.DateType())])

MEMORY_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType(), False),
        T.StructField("text_pt", T.StringType()),
    ]
)

# A translation memory that runs add to: failed texts stand there with their error.
STORE_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("text_pt", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# Text columns, their translated names, and the identity of an article.
TEXT_COLUMNS = ("description", "content", "title")
TRANSLATED_COLUMNS = ("description_pt", "content_pt", "title_pt")
ARTICLE_KEYS = ("author", "title")
PARTITION_COLUMN = "from_date"

# Relevance keywords, and the search terms of the article collection.
RELEVANCE_KEYWORDS = ("Filogenética", "Metagenômica", "genes", "DNA")
COUNT_KEYWORDS = ("filogenética", "metagenômica", "genes", "dna")
SEARCH_TERMS = ("genomics", "personalized medicine research")

# Names of the tables written by the daily job.
HARMONIZED_TABLE = "harmonized"
DAY_TABLE = "year_month_day_aggregation"
SOURCE_AUTHOR_TABLE = "source_author_aggregation"
KEYWORD_TABLE = "keyword_appearance_aggregation"
SEMANTIC_DIR = "semantic"

# Collection limits.
HISTORY_DAYS = 30
MAX_PAGES = 6
PAGE_SIZE = 100
