"""The daily job by what has changed: its cost follows the new articles and translations.

The harmonized table and the counts are views of the raw table and the translation memory. A run looks
which files of the two are new or gone. New articles touch their own key (author and title); a
new translation touches the keys of the articles that have its text, of whatever age; a day that
was replaced touches all its keys. The touched keys, and only they, are made anew: those with a new
translation or a replaced day from all their raw articles, those with new articles alone from these
and the row that they have. Where a key's row differs from the one in the table, the old row's counts are taken away
and the new one's are added, and the day it stands in is written again; other days are not.

Three indexes (``sources.keyindex``) say which raw days hold a key, which keys have a text, and
what a text's translation is, so that none of the three needs a scan of the history.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwire.functions.dates import published_date
from clipwire.operators.articles import flatten_source, keyword_filter
from clipwire.operators.dedup import dedup_latest
from clipwire.operators.translation import translate_enrich
from clipwire.plans.semantic import semantic_counts, split_counts
from clipwire.schema import (
    ARTICLE_KEYS,
    COUNT_KEYWORDS,
    HARMONIZED_TABLE,
    MEMORY_SCHEMA,
    PARTITION_COLUMN,
    RELEVANCE_KEYWORDS,
    SEMANTIC_DIR,
    TEXT_COLUMNS,
)
from clipwire.sources.files import delete_folder, finish_swap, folder_exists, folders, swap
from clipwire.sources.keyindex import DIGEST, KeyIndex, digest, key_digest
from clipwire.sources.tables import DEFAULT_FORMAT, load_table, packed

DAY = "published_day"
_WRITER = "daily"
_FILES = "source string, path string, modificationTime timestamp, length bigint, run bigint, rules string"
_FILE_KEY = ["source", "path", "modificationTime", "length"]


def _listing(spark: SparkSession, **tables: str) -> DataFrame:
    """The data files of tables, without their content."""
    parts = []
    for source, path in tables.items():
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        files = reader.option("pathGlobFilter", "*.parquet").load(path)
        parts.append(files.select(F.lit(source).alias("source"), "path", "modificationTime", "length"))
    return reduce(DataFrame.union, parts)


def _in_days(column: str, days: list) -> Column:
    """Is a day one of ``days``, of which one may be null?"""
    known = F.col(column).isin([d for d in days if d is not None])
    return F.coalesce(known, F.lit(False)) | (F.col(column).isNull() & F.lit(None in days))


def _days(df: DataFrame, column: str) -> list:
    return [r[0] for r in df.select(column).distinct().collect()]  # one value a day


class _Run:
    """One run: its folders, its number, and the three indexes."""

    def __init__(self, spark: SparkSession, raw: str, memory: str, out: str):
        self.spark, self.raw, self.memory, self.out = spark, raw, memory, out
        self.state = f"{out}/state"
        finish_swap(spark, f"{self.state}/journal")
        self.first = not folder_exists(spark, f"{self.state}/files")
        self.seen = spark.createDataFrame([], _FILES) if self.first else spark.read.parquet(f"{self.state}/files")
        self.number = 0 if self.first else self.seen.agg(F.max("run")).first()[0] + 1
        self.articles = KeyIndex(spark, f"{self.state}/articles", f"{PARTITION_COLUMN} date, {DAY} date")
        self.texts = KeyIndex(spark, f"{self.state}/texts", "_key binary")
        self.translations = KeyIndex(spark, f"{self.state}/translations", "text_pt string")

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the run's own folder and read again."""
        path = f"{self.state}/work/{name}"
        df.write.mode("overwrite").options(**packed(DEFAULT_FORMAT)).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, path: str, schema) -> DataFrame:
        """A table, or no rows where it is not there yet."""
        if not folder_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def new_rows(self, files: DataFrame, source: str, path: str, whole: DataFrame) -> DataFrame:
        """The rows of the new files of a table; the first run reads all of it."""
        if self.first:
            return whole
        paths = [r["path"] for r in files.where(F.col("source") == source).select("path").collect()]
        if not paths:
            return whole.where(F.lit(False))
        return self.spark.read.schema(whole.schema).option("basePath", path).parquet(*paths)

    def index(self, articles: DataFrame, translations: DataFrame) -> None:
        """Add what is new to the indexes; a run that is repeated writes the same runs again."""
        keyed = articles.withColumn(DIGEST, key_digest(ARTICLE_KEYS)).withColumn(DAY, published_date())
        self.articles.add(keyed.select(DIGEST, PARTITION_COLUMN, DAY).distinct(), _WRITER, self.number)
        texts = keyed.select(F.col(DIGEST).alias("_key"), F.explode(F.array(*TEXT_COLUMNS)).alias("text"))
        texts = texts.where(F.col("text").isNotNull()).select(digest("text").alias(DIGEST), "_key")
        self.texts.add(texts.distinct(), _WRITER, self.number)
        known = translations.where(F.col("text").isNotNull() & F.col("text_pt").isNotNull())
        known = known.select(digest("text").alias(DIGEST), "text_pt")
        self.translations.add(known, _WRITER, self.number)

    def touched(self, articles: DataFrame, gone: DataFrame) -> DataFrame:
        """The digests of the keys that may have another row now; ``anew`` if not by new articles alone."""
        new = self.translations.read(lambda r: r.first == r.last == self.number)
        anew = F.lit(True).alias("anew")
        by_text = self.texts.lookup(new).select(F.col("_key").alias(DIGEST), anew)
        keys = articles.select(key_digest(ARTICLE_KEYS).alias(DIGEST), F.lit(False).alias("anew")).union(by_text)
        day = F.regexp_extract("path", f"{PARTITION_COLUMN}=([^/]+)", 1).try_cast("date")
        days = _days(gone.where("source = 'raw'").select(day.alias("day")), "day")
        if days:
            replaced = self.articles.read().where(_in_days(PARTITION_COLUMN, days))
            keys = keys.union(replaced.select(DIGEST, anew))
        return self.kept(keys.groupBy(DIGEST).agg(F.max("anew").alias("anew")), "touched")

    def translated(self, raw: DataFrame) -> DataFrame:
        wanted = raw.select(F.explode(F.array(*TEXT_COLUMNS)).alias("text")).where(F.col("text").isNotNull())
        found = self.translations.lookup(wanted.select(digest("text").alias(DIGEST)))
        return translate_enrich(flatten_source(raw), found.select(DIGEST, "text_pt"))


def daily_incremental(
    spark: SparkSession,
    raw_path: str,
    memory_path: str,
    out_dir: str,
    keywords: Sequence[str] = RELEVANCE_KEYWORDS,
    count_keywords: Sequence[str] = COUNT_KEYWORDS,
) -> dict[str, str]:
    """Bring the tables of ``daily_job`` up to date with the raw table and the memory.

    The rows are those of a full rebuild; the harmonized table has its days (``published_day``)
    as folders. The first run builds all. Gives the table paths by name.

    Both tables are Parquet, and ``memory_path`` is one that is added to: where files of it are gone, or
    the keywords are others than before, all is built anew. New tables are written beside the old ones and swapped in one go, with the
    list of files that they cover, so a run that dies is repeated or finished by the next.
    """
    run = _Run(spark, raw_path, memory_path, out_dir)
    files = run.kept(_listing(spark, raw=raw_path, memory=memory_path), "files")
    gone = run.seen.join(files, _FILE_KEY, "left_anti")
    rules = json.dumps([list(keywords), list(count_keywords)])
    other_rules = run.seen.where(F.col("rules") != rules).select(_FILE_KEY)
    if gone.where("source = 'memory'").select(_FILE_KEY).union(other_rules).limit(1).count():
        delete_folder(spark, run.state)
        delete_folder(spark, f"{out_dir}/{HARMONIZED_TABLE}")
        delete_folder(spark, f"{out_dir}/{SEMANTIC_DIR}")
        return daily_incremental(spark, raw_path, memory_path, out_dir, keywords, count_keywords)
    new = files.join(run.seen, _FILE_KEY, "left_anti")
    raw = load_table(spark, raw_path)
    articles = run.new_rows(new, "raw", raw_path, raw)
    memory = load_table(spark, memory_path, schema=MEMORY_SCHEMA)
    run.index(articles, run.new_rows(new, "memory", memory_path, memory))

    key = key_digest(ARTICLE_KEYS).alias(DIGEST)
    if run.first:
        source, touched = raw, None
    else:
        touched = run.touched(articles, gone)
        places = run.articles.lookup(touched).join(touched, DIGEST).groupBy(PARTITION_COLUMN, DAY)
        places = run.kept(places.agg(F.max("anew").alias("anew")), "places")
        anew, added = touched.where("anew"), touched.where("NOT anew")
        of_days = raw.where(_in_days(PARTITION_COLUMN, _days(places.where("anew"), PARTITION_COLUMN)))
        source = of_days.select("*", key).join(anew, DIGEST, "left_semi")
        source = source.unionByName(articles.select("*", key).join(added, DIGEST, "left_semi")).drop(DIGEST)
    found = keyword_filter(run.translated(source), keywords)
    dated = found.withColumn(DAY, published_date())
    columns = dated.columns
    compared = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns]).alias("_row")

    harmonized = f"{out_dir}/{HARMONIZED_TABLE}"
    table = run.table(harmonized, dated.schema)
    if not run.first:
        stood = table.where(_in_days(DAY, _days(places, DAY))).select(*columns, key, compared)
        stood = run.kept(stood.join(touched, DIGEST, "left_semi").select(*columns, DIGEST, "_row"), "stood")
        # No new translation, no replaced day: the row that is there is the latest of all articles before.
        found = found.unionByName(stood.join(added, DIGEST, "left_semi").select(found.columns))
    rows = dedup_latest(found).withColumn(DAY, published_date())
    made = run.kept(rows.select(*columns, key, compared), "made")
    if run.first:
        stood = made.where(F.lit(False))
    if stood.isEmpty():  # new keys only: all rows came
        came, went = made, stood
    else:
        same = stood.select(DIGEST, "_row").intersect(made.select(DIGEST, "_row"))
        came = run.kept(made.join(same, [DIGEST, "_row"], "left_anti").select(made.columns), "came")
        went = run.kept(stood.join(same, [DIGEST, "_row"], "left_anti").select(made.columns), "went")

    days = _days(came.select(DAY).union(went.select(DAY)), DAY)
    stay = table.where(_in_days(DAY, days)).select(*columns, key).join(went, DIGEST, "left_anti").select(columns)
    staged = f"{run.state}/next"
    delete_folder(spark, staged)
    by_day = stay.unionByName(came.select(columns)).hint("rebalance", F.col(DAY))
    by_day.write.options(**packed(DEFAULT_FORMAT)).partitionBy(DAY).parquet(f"{staged}/{HARMONIZED_TABLE}")
    written = folders(spark, f"{staged}/{HARMONIZED_TABLE}")
    moves = {f"{staged}/{HARMONIZED_TABLE}/{name}": f"{harmonized}/{name}" for name in written}
    names = [f"{DAY}={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in days]
    empty = [f"{harmonized}/{name}" for name in names if name not in written]

    paths = {HARMONIZED_TABLE: harmonized}
    plus = split_counts(semantic_counts(came, count_keywords))
    minus = split_counts(semantic_counts(went, count_keywords))
    for name, more in plus.items():
        paths[name] = f"{out_dir}/{SEMANTIC_DIR}/{name}"
        *of, n = more.columns
        total = run.table(paths[name], more.schema).union(more)
        total = total.union(minus[name].select(*of, (-F.col(n)).alias(n)))
        total = total.groupBy(*of).agg(F.sum(n).alias(n)).where(F.col(n) > 0)
        total.write.parquet(f"{staged}/{name}")
        moves[f"{staged}/{name}"] = paths[name]
    marks = {"run": F.lit(run.number).cast("long"), "rules": F.lit(rules)}
    files.withColumns(marks).write.parquet(f"{staged}/files")
    moves[f"{staged}/files"] = f"{run.state}/files"
    swap(spark, f"{run.state}/journal", moves, empty)
    for index in (run.articles, run.texts, run.translations):
        index.merge(_WRITER)
    return paths
