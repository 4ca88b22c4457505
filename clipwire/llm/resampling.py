"""Importance resampling towards a target: documents whose word runs look like those of a target.

Features are the words of a text and its runs of following words, hashed into buckets by CRC-32. A
bucket's gain is the log of how much likelier it is in the target than in the documents. A
document's weight is the mean gain of its features; with Gumbel noise added, the documents of
highest score are a sample without replacement in proportion to exp(weight / 1000).

Texts are cut by Arrow kernels: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and
``dictionary_encode``. Runs are pairs of shifted dictionary indices, so that CRCs are computed for
distinct words and runs of a slice only; gains are taken by index and added up by segment. Texts
are read twice, once to count buckets and once to weigh, and never shuffled.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwire.llm.common import stored

#: What parts words, once letters A to Z are lower case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, RUN, SCALE = 10_000, 2, 1000
#: Documents with fewer words are never drawn, and the share of the others that is, in hundredths.
LEAST_WORDS, PER_CENT = 20, 25
SEED = 7
#: Bytes of text that are cut at once; a longer text is cut alone.
SLICE = 4 << 20


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of an array of texts of about ``most`` bytes, with their first index."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // most
    starts = np.flatnonzero(np.diff(part, prepend=-1)) if len(part) else part
    for start, stop in zip(starts, [*starts[1:], len(part)]):
        # Copied, as text kernels misread a slice of an array.
        yield int(start), texts.take(pa.array(np.arange(start, stop)))


class Features:
    """Words and runs of some texts: the texts they are of, and their distinct values' buckets."""

    def __init__(self, texts: pa.Array, run: int = RUN, buckets: int = BUCKETS):
        texts = texts.cast(pa.large_string())
        lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), GAP)
        owner = np.asarray(pc.list_parent_indices(lists))
        words = pc.list_flatten(lists)
        some = pc.not_equal(words, "")
        words, owner = words.filter(some), owner[np.asarray(some)]
        coded = words.dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        said = [w.encode() for w in coded.dictionary.to_pylist()]
        tail = [b" " + w for w in said]
        self.size = len(texts)
        self.words = np.bincount(owner, minlength=self.size)
        crc = np.fromiter(map(zlib.crc32, said), np.int64, len(said))
        #: For each length of runs: owners, index of the distinct run, bucket of each distinct run.
        self.levels = [(owner, code, crc % buckets)]
        first, known = code, crc.tolist()
        for shift in range(1, run):
            # Runs of one word more: the distinct run's index beside the next word's.
            same = owner[shift:] == owner[: len(owner) - shift]
            pairs = first[: len(same)][same] * max(len(said), 1) + code[shift:][same]
            coded = pa.array(pairs).dictionary_encode()
            distinct = np.asarray(coded.dictionary)
            head, word = np.divmod(distinct, max(len(said), 1))
            known = list(map(zlib.crc32, map(tail.__getitem__, word.tolist()), map(known.__getitem__, head.tolist())))
            index = np.asarray(coded.indices).astype(np.int64)
            self.levels.append((owner[: len(same)][same], index, np.array(known, np.int64) % buckets))
            first = np.zeros(len(same), np.int64)
            first[same] = index

    def counts(self, buckets: int = BUCKETS) -> np.ndarray:
        """Features in each bucket."""
        total = np.zeros(buckets, np.int64)
        for _, index, bucket in self.levels:
            often = np.bincount(index, minlength=len(bucket))
            np.add.at(total, bucket, often)
        return total

    def weigh(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of features of each text, and the sum of their gains."""
        number, total = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        for owner, index, bucket in self.levels:
            if not len(owner):
                continue
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            at = owner[starts]
            total[at] += np.add.reduceat(gains.take(bucket).take(index), starts)
            number[at] += np.diff(starts, append=len(owner))
        return number, total


def bucket_counts(docs: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; each task sends one row for each of its buckets."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                total += Features(texts, run, buckets).counts(buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    got = docs.select(F.col("text").cast("string")).mapInArrow(counted, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in got.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket in thousandths, rounded down, from counts with one added to each."""
    n, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(SCALE * math.log((t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighed(docs: DataFrame, gain: np.ndarray, run: int = RUN) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` for every row of ``docs``, from its whole text.

    ``weight`` is the mean gain of the features, rounded down; 0 if there is none.
    """
    names = ["doc_id", "n_words", "n_features", "weight"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                found = Features(texts, run, len(gain))
                number, total = found.weigh(gain)
                ids = batch.column(0).slice(start, len(texts))
                made = [found.words, number, total // np.maximum(number, 1)]
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, made)], names)

    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    return docs.select(*columns).mapInArrow(of, ", ".join(f"{n} long" for n in names))


def with_noise(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` with ``score``: the weight and Gumbel noise, by a hash of the seed and the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / 2.0**32)))
    return rows.withColumn("score", F.col("weight") + noise)


def ranked(rows: DataFrame, least_words: int = LEAST_WORDS, per_cent: int = PER_CENT) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3... by descending score and then id, null where not drawn.

    Rows are dealt into ranges of that order once and numbered in each range; the few ranges' sizes
    then say where each begins. A hot score is parted by id, a hot id by row, so no
    range holds more than its share.
    """
    rows = stored(
        rows.select("*", (F.col("n_words") >= least_words).alias("fit"), F.monotonically_increasing_id().alias("row")),
        "resample-scores",
    )
    order = [F.desc("fit"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            within = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            yield batch.append_column("within", within)

    names = [c for c in rows.columns if c != "row"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = ranges.select(*names, F.spark_partition_id().alias("range"))
    schema = ", ".join(f"{n} {t}" for n, t in ranges.dtypes)
    placed = stored(ranges.mapInArrow(numbered, schema + ", within long"), "resample-ranks")
    sizes = placed.groupBy("range").agg(F.count("*").alias("rows"), F.count_if("fit").alias("fits")).collect()
    sizes.sort(key=lambda r: r["range"])
    total = sum(r["fits"] for r in sizes)
    begin = accumulate((r["rows"] for r in sizes), initial=0)
    starts = [(r["range"], b) for r, b in zip(sizes, begin)]
    begins = rows.sparkSession.createDataFrame(starts, "range int, begin long")
    rank = F.col("begin") + F.col("within") + 1
    drawn = F.col("fit") & (rank <= total * per_cent // 100)
    return placed.join(F.broadcast(begins), "range").withColumn("rank", F.when(drawn, rank)).select(
        *[c for c in names if c != "fit"], "rank"
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    per_cent: int = PER_CENT,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` for every row of ``docs``.

    ``target`` has a column ``text`` with the texts to look like. Of the documents with at least
    ``least_words`` words, the ``per_cent`` hundredths of highest score have a ``rank``. Runs are of up to
    ``run`` words; counts cover all texts of both tables.

    Null and empty texts have no features, weight 0 and no rank. Equal texts have equal weights.
    Noise goes by id alone, so repeated rows have equal scores and following ranks; null
    ids share one noise, and come last among equal scores. Rows that tie in everything are
    ranked in the order of the input. Without target texts, gains only tell frequent buckets
    from rare ones. Other columns are ignored; no rows give none.
    """
    gain = gains(bucket_counts(docs, run, buckets), bucket_counts(target, run, buckets))
    return ranked(with_noise(weighed(docs, gain, run), seed), least_words, per_cent)
