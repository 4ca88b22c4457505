"""Portuguese text columns from a translation memory, and the work list that fills it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwire.schema import STORE_SCHEMA, TEXT_COLUMNS
from clipwire.sources.tables import packed

#: Texts that a task translates at a time.
ASKED = 256


def _known(memory: DataFrame, key: Column) -> DataFrame:
    done = F.col("text_pt").isNotNull()
    if "text" in memory.columns:
        done = done & F.col("text").isNotNull()
    return memory.where(done).select(key.alias("_key"), F.col("text_pt").alias("_pt"))


def _digest(column: Column | str) -> Column:
    return F.unhex(F.sha2(column, 256))


def _memory_key() -> Column:
    return F.coalesce(_digest("text"), F.lit(b""))


def _by_lookup(df: DataFrame, memory: DataFrame, columns: Sequence[str]) -> DataFrame:
    # One entry per text, so that no article is multiplied.
    lookup = _known(memory, F.col("text")).groupBy("_key").agg(F.max("_pt").alias("_pt"))
    for c in columns:
        side = lookup.select(F.col("_key").alias(f"_key_{c}"), F.col("_pt").alias(f"_pt_{c}"))
        df = df.join(F.broadcast(side), F.col(c) == F.col(f"_key_{c}"), "left")
    return df


def _by_digest(
    df: DataFrame, memory: DataFrame, columns: Sequence[str], few: bool
) -> DataFrame:
    digests = [f"_digest_{c}" for c in columns]
    present = [F.coalesce(F.hex(d), F.lit("")) for d in digests]
    # Articles with the same texts share a row key, and so their translations.
    keyed = df.select("*", *[_digest(c).alias(d) for c, d in zip(columns, digests)]).withColumn(
        "_row", F.coalesce(_digest(F.concat_ws("|", *present)), F.lit(b""))
    )
    fields = [
        F.struct(F.lit(i).alias("_field"), F.col(d).alias("_key")) for i, d in enumerate(digests)
    ]
    wanted = (
        keyed.select("_row", F.inline(F.array(*fields))).where(F.col("_key").isNotNull()).distinct()
    )
    key = F.col("_digest") if "_digest" in memory.columns else _memory_key()
    found = _known(memory, key).join(F.broadcast(wanted) if few else wanted, "_key")
    # The grouping also settles texts that the memory holds more than once.
    per_row = found.groupBy("_row").agg(
        *[
            F.max(F.when(F.col("_field") == i, F.col("_pt"))).alias(f"_pt_{c}")
            for i, c in enumerate(columns)
        ]
    )
    # AQE splits a hot key only where both sides of the join come straight from a
    # shuffle. Joined under its old name, the grouped side would skip its shuffle.
    renamed = per_row.withColumn("_same_row", F.concat("_row", F.lit(b""))).drop("_row")
    return keyed.join(renamed, F.col("_row") == F.col("_same_row"), "left")


def translate_enrich(
    df: DataFrame,
    memory: DataFrame,
    columns: Sequence[str] = TEXT_COLUMNS,
    lookup: bool = False,
    few: bool = False,
) -> DataFrame:
    """Add ``<column>_pt`` and ``<column>_translated`` from ``memory(text, text_pt)``.

    A memory may have ``_digest``, the SHA-256 of its texts, in place of ``text``.

    A text without translation stays as it is with the flag false; null stays null.

    Digests of the texts, 32 bytes each, are joined to the memory, and the articles are
    shuffled once to meet their translations, rather than once per column. AQE makes
    a broadcast of what turns out small at run time, and its skew join splits hot texts.
    Callers who know the sizes may ask for a broadcast of the whole memory with
    ``lookup``, so that articles are not shuffled, or of the digests with ``few``.
    """
    if lookup:
        found = _by_lookup(df, memory, columns)
    else:
        found = _by_digest(df, memory, columns, few)
    added = []
    for c in columns:
        added.append(F.coalesce(F.col(f"_pt_{c}"), F.col(c)).alias(f"{c}_pt"))
        added.append(F.col(f"_pt_{c}").isNotNull().alias(f"{c}_translated"))
    return found.select(*df.columns, *added)


def source_texts(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """The distinct texts of all text columns, as ``text``."""
    return _texts(df, columns).distinct()


def _texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = df.select(F.explode(F.array(*columns)).alias("text"))
    return texts.where(F.col("text").isNotNull())


def translation_pending(
    df: DataFrame,
    memory: DataFrame,
    columns: Sequence[str] = TEXT_COLUMNS,
    lookup: bool = False,
) -> DataFrame:
    """Distinct source texts that the memory has no translation for.

    Of the memory only digests are shuffled, and each task merges repeated texts first.
    With ``lookup``, for a memory known to be small, it is broadcast, and only texts not
    in it are shuffled.
    """
    if lookup:
        known = _known(memory, F.col("text")).select("_key").distinct()
        texts = _texts(df, columns)
        return texts.join(
            F.broadcast(known), F.col("text") == F.col("_key"), "left_anti"
        ).distinct()
    known = _known(memory, _memory_key()).select("_key").distinct()
    texts = _texts(df, columns).groupBy(_digest("text").alias("_key")).agg(F.min("text").alias("text"))
    return texts.join(known, "_key", "left_anti").select("text")


def translate_texts(
    texts: DataFrame,
    translate: Callable[[str], str] | Callable[[list[str]], list[str]],
    parallelism: int | None = None,
    batched: bool = False,
) -> DataFrame:
    """Call ``translate`` on each text; gives ``text``, ``text_pt`` and ``error``.

    A failure fills ``error`` and leaves ``text_pt`` null, and so does an answer that is no
    string. ``batched`` calls it on lists of up to ``ASKED`` texts instead, for a list as long; where that fails
    every text of the list has the error. ``parallelism`` spreads slow calls over that
    many tasks.
    """

    def one(text: str) -> tuple[str | None, str | None]:
        try:
            return checked(translate(text))
        except Exception as problem:
            return None, str(problem)

    def checked(answer) -> tuple[str | None, str | None]:
        if isinstance(answer, str):
            return answer, None
        return None, f"the translator gave {type(answer).__name__}, not a string"

    def many(asked: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            answers = list(translate(asked))
            if len(answers) != len(asked):
                raise ValueError(f"{len(answers)} answers for {len(asked)} texts")
        except Exception as problem:
            return [(None, str(problem))] * len(asked)
        return [checked(a) for a in answers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ASKED):  # so that few texts and answers are held at a time
                asked = batch.column(0).slice(at, ASKED).to_pylist()
                answers = many(asked) if batched else [one(t) for t in asked]
                columns = [asked, [a for a, _ in answers], [e for _, e in answers]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in columns], ["text", "text_pt", "error"]
                )

    if parallelism:
        texts = texts.repartition(parallelism, "text")
    return texts.select("text").mapInArrow(run, "text string, text_pt string, error string")


def fill_memory(
    df: DataFrame,
    translate: Callable,
    store: str,
    memory: DataFrame | None = None,
    columns: Sequence[str] = TEXT_COLUMNS,
    fmt: str = "parquet",
    parallelism: int | None = None,
    batched: bool = False,
) -> DataFrame:
    """Translate what neither ``memory`` nor the table at ``store`` has, and append it there.

    Gives all translations known then: ``text``, ``text_pt``. Texts whose translation failed are
    in the store with their ``error`` and are tried again by the next run. A run that is
    repeated after a failure translates only what is still missing.
    """
    spark = df.sparkSession
    # An empty table of the right shape, unless one is there.
    spark.createDataFrame([], STORE_SCHEMA).write.format(fmt).mode("ignore").save(store)

    def known() -> DataFrame:
        stored = spark.read.format(fmt).load(store).select("text", "text_pt")
        return stored if memory is None else memory.select("text", "text_pt").unionByName(stored)

    pending = translation_pending(df, known(), columns)
    done = translate_texts(pending, translate, parallelism, batched)
    done.write.format(fmt).options(**packed(fmt)).mode("append").save(store)
    return known()


def translate_udf(
    df: DataFrame,
    translate: Callable,
    store: str,
    memory: DataFrame | None = None,
    columns: Sequence[str] = TEXT_COLUMNS,
    fmt: str = "parquet",
    parallelism: int | None = None,
    batched: bool = False,
) -> DataFrame:
    """``translate_enrich`` with a caller's function for the texts that are not known yet.

    Each distinct text is translated once. The table at ``store``, in a folder all executors
    share, is a memory that adds up over runs, see ``fill_memory``; neither the join nor
    a lost executor calls the function again.
    """
    known = fill_memory(df, translate, store, memory, columns, fmt, parallelism, batched)
    return translate_enrich(df, known, columns)
