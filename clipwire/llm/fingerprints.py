"""Consistent weighted sampling: fingerprints whose likeness is the generalised Jaccard similarity.

The terms of a text are its shingles, weighted by how often they occur. For each of ``samples``
numbers k a term draws r and c from Gamma(2, 1) and b from [0, 1), by hashes of the term and
k alone. With t = floor(ln(weight) / r + b) its value is c * exp(-r * (t - b) - r); the term with
the least value and its t are the text's k-th sample. Two texts agree in a sample as
often as the sum of their lesser weights goes into that of their greater ones.

Gamma(2, 1) is the sum of two exponentials, r = -ln(u1) - ln(u2), of which -ln(u1) is
evenly spread part b. So exp(r * b - r) is u2, and a term of weight 1, for which t is 0, has the value
c * u2: one logarithm instead of three, for nearly all terms.

Everything is column expressions. Texts are shuffled once, into ranges between quantiles of the
ids; terms, weights and samples are aggregated within that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipwire.llm.common import WORD_GAP, stored

SAMPLES = 32
SHINGLE = 5
#: Documents of a range of ids, so that their terms fit into memory; beyond so many ranges they spill.
IN_TASK, MOST_TASKS = 2048, 100_000

#: Bits of a sample's identity, and of its value after the binary point; values are under 64.
_ID_BITS, _VALUE_BITS = 20, 36
_ID_MASK = (1 << _ID_BITS) - 1
_DIGITS = _ID_BITS // 4
#: What each t adds to a term's identity.
_T_STEP = 0x9E3779B1


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words (parted by ASCII white space), in order; null has none."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), f"[{WORD_GAP}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _sample(term: Column, weight: Column, k: int) -> Column:
    """A term's value in sample k, above the identity of the term and its t; null for weight 0.

    Values are rounded to 2**-36; of equal ones the lesser identity wins, for any texts alike.
    """
    bits = F.xxhash64(term, F.lit(2 * k))

    def uniform(h: Column, shift: int) -> Column:
        part = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 21) - 1)).cast("double")
        return part * F.lit(2.0**-21) + F.lit(2.0**-22)

    u2 = uniform(bits, 0)
    single = -F.log(uniform(bits, 21) * uniform(bits, 42)) * u2
    u1 = uniform(F.xxhash64(term, F.lit(2 * k + 1)), 0)  # matters only to weights over 1
    r = -F.log(u1 * u2)
    t = F.floor(F.log(weight / u1) / r)
    value = single * F.when(weight == 1, 1.0).when(weight > 1, F.exp(-r * t))
    identity = F.when(weight == 1, term).otherwise(term.bitwiseXOR(t * F.lit(_T_STEP)))
    return F.floor(value * F.lit(2.0**_VALUE_BITS)) * F.lit(1 << _ID_BITS) + identity.bitwiseAND(F.lit(_ID_MASK))


def _as_text(samples: list[Column]) -> Column:
    """Identities of samples as hexadecimal text; a text without terms has a sample of its own."""
    return F.concat(
        *[
            F.coalesce(F.lower(F.lpad(F.hex(s.bitwiseAND(F.lit(_ID_MASK))), _DIGITS, "0")), F.lit("-" * _DIGITS))
            for s in samples
        ]
    )


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of samples in which two fingerprints agree, 0 to 1."""
    part = lambda c, k: F.substring(c, _DIGITS * k + 1, _DIGITS)
    same = [F.when(part(a, k) == part(b, k), 1).otherwise(0) for k in range(samples)]
    return sum(same[1:], same[0]) / F.lit(float(samples))


def fingerprint_pairs(
    rows: DataFrame,
    keys: list[str],
    first: str,
    second: str | None,
    carried: list[str],
    samples: int = SAMPLES,
    shingle: int = SHINGLE,
) -> DataFrame:
    """Fingerprints ``first_fp`` and ``second_fp`` of two texts of each row, or of one text.

    ``keys`` tell rows apart; where ``rows`` are partitioned by some of them, nothing is shuffled.
    ``carried`` are columns of whole numbers that are kept, one at least. Texts of fewer words
    than ``shingle`` have one term, texts without words none; null is such a text.
    """
    h2 = F.array().cast("array<bigint>") if second is None else word_hashes(F.col(second))
    texts = {"first_w": "first_fp"} if second is None else {"first_w": "first_fp", "second_w": "second_fp"}
    hashed = rows.select(*keys, *carried, word_hashes(F.col(first)).alias("h1"), h2.alias("h2"))
    nothing = F.lit(None).cast("long")
    pad = lambda h: F.concat(h, F.array_repeat(nothing, F.greatest(F.lit(0), shingle - F.size(h))))
    count = lambda h: F.when(F.size(h) == 0, 0).otherwise(F.greatest(F.lit(1), F.size(h) - (shingle - 1)))
    padded = hashed.select(
        *keys,
        *carried,
        F.concat(pad(F.col("h1")), pad(F.col("h2"))).alias("h"),
        count(F.col("h1")).alias("n1"),
        count(F.col("h2")).alias("n2"),
        F.greatest(F.size("h1"), F.lit(shingle)).alias("from2"),
    )
    # Spots below 0 carry columns through the aggregation: -1 the first, and so on.
    spots = F.sequence(F.lit(-len(carried)), F.col("n1") + F.col("n2") - 1)
    at = padded.select("*", F.explode(spots).alias("i"))
    in_first = F.col("i") < F.col("n1")
    start = F.when(in_first, F.col("i")).otherwise(F.col("i") - F.col("n1") + F.col("from2"))
    shingled = F.xxhash64(*[F.get("h", start + k) for k in range(shingle)])
    is_term, value = F.col("i") >= 0, F.lit(None).cast("long")
    for k, name in enumerate(carried):
        value = F.when(F.col("i") == -1 - k, F.col(name)).otherwise(value)
    terms = at.select(
        *keys,
        F.when(is_term, shingled).otherwise(F.col("i")).alias("term"),
        F.when(is_term, F.when(in_first, 1).otherwise(0)).otherwise(value).alias("w1"),
        F.when(is_term, F.when(in_first, 0).otherwise(1)).cast("long").alias("w2"),
    )
    weighted = terms.groupBy(*keys, "term").agg(F.sum("w1").alias("w1"), F.sum("w2").alias("w2"))
    weighted = weighted.withColumn("real", F.col("w2").isNotNull())
    weight = lambda w: F.when(F.col("real"), F.col(w))
    weighed = weighted.select(*keys, "term", "real", "w1", weight("w1").alias("first_w"), F.col("w2").alias("second_w"))
    least = [
        F.min(_sample(F.col("term"), F.col(w), k)).alias(f"{w}_{k}")
        for k in range(samples)
        for w in texts
    ]
    kept = [F.max(F.when(~F.col("real") & (F.col("term") == -1 - k), F.col("w1"))).alias(n) for k, n in enumerate(carried)]
    sampled = weighed.groupBy(*keys).agg(*kept, *least)
    return sampled.select(
        *keys,
        *carried,
        *[_as_text([F.col(f"{w}_{k}") for k in range(samples)]).alias(name) for w, name in texts.items()],
    )


def fingerprints(docs: DataFrame, samples: int = SAMPLES, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fingerprint`` for every row of ``docs``; equal texts have equal ones."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    made = fingerprint_pairs(rows, ["row"], "text", None, ["doc_id"], samples, shingle)
    return made.select("doc_id", F.col("first_fp").alias("fingerprint"))


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and ``key``: where a row stands in the order of ids.

    ``key`` is the id (null below all others), a hash of the text, and a hash of the row's place in
    its table, so that rows which repeat one id and text can be parted too.
    """
    place = F.xxhash64(F.monotonically_increasing_id())
    whole = lambda name, c: F.coalesce(c, F.lit(0)).cast("long").alias(name)
    key = F.struct(
        whole("known", F.col("doc_id").isNotNull().cast("long")),
        whole("id", F.col("doc_id")),
        whole("tie", F.xxhash64("text")),
        whole("place", place),
    )
    return docs.select("doc_id", "text", key.alias("key"))


def range_edges(docs: DataFrame) -> DataFrame:
    """``range`` (0, 1, ... by rising ids), its least key ``low`` and its greatest ``high``.

    Ranges are cut at quantiles of the keys, so they hold about equally many rows whatever the
    ids are: ``IN_TASK``, and more where that would be over ``MOST_TASKS`` ranges.
    """
    keys = stored(_keyed(docs).select("key.*"), "range-keys")
    parts = min(-(-keys.count() // IN_TASK), MOST_TASKS)
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts)
    dealt = keys.repartitionByRange(parts, *keys.columns).select(
        F.struct(*keys.columns).alias("key"), F.spark_partition_id().alias("part")
    )
    edges = dealt.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    number = F.row_number().over(W.orderBy("low")) - 1
    return stored(edges.select(number.alias("range"), "low", "high"), "range-edges")


def range_of(key: Column, lows: Column, ranges: int) -> Column:
    """The last of ``ranges`` ascending keys ``lows`` that is not over ``key``, by binary search."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(max(1, ranges.bit_length())))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(lows, at + step) <= key, at + step).otherwise(at)
    )


def range_heads(docs: DataFrame, edges: DataFrame, ranges: int) -> DataFrame:
    """``range`` and ``text``: the text that follows the range's last, after the lowest range the first.

    Ids go down, so it is the top of the range below. A top that many ranges share is looked up once.
    """
    tops = edges.select(
        ((F.col("range") + 1) % ranges).alias("range"),
        *[F.col(f"high.{c}").alias(c) for c in ("known", "id", "tie")],
    )
    rows = docs.select(
        "text",
        F.col("doc_id").isNotNull().cast("long").alias("known"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64("text").alias("tie"),
    )
    # Edges are stored, so Spark knows their size: while small they are broadcast, and texts stay in place.
    there = rows.join(tops.drop("range").distinct(), ["known", "id", "tie"], "left_semi")
    found = stored(there.groupBy("known", "id", "tie").agg(F.min("text").alias("text")), "range-heads")
    return tops.join(found, ["known", "id", "tie"]).select("range", "text")


def in_order(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``range``, ``spot`` (1, 2, ... in a range, ids descending), ``after``, ``guest``.

    ``after`` is the next row's text. Each range gets one row more, the first of the range that
    follows, as its ``guest``, so that its last row has a next one without looking elsewhere. Each
    range is a partition of its own.
    """
    edges = range_edges(docs)
    # The least keys alone come to the driver, MOST_TASKS at most.
    ranges, cuts = edges.agg(F.count("*"), F.to_json(F.array_sort(F.collect_list("low")))).first()
    form = f"array<{edges.schema['low'].dataType.simpleString()}>"
    number = range_of(F.col("key"), F.from_json(F.lit(cuts), form), ranges)
    ranged = _keyed(docs).select("doc_id", "text", number.alias("range"), F.lit(0).alias("guest"))
    heads = range_heads(docs, edges, max(1, ranges))
    guests = heads.select(F.lit(None).cast("long").alias("doc_id"), "text", "range", F.lit(1).alias("guest"))
    down = W.partitionBy("range").orderBy("guest", F.col("doc_id").desc(), F.xxhash64("text").desc())
    return ranged.unionByName(guests).repartitionById(max(1, ranges), F.col("range")).select(
        "*", F.row_number().over(down).alias("spot"), F.lead("text").over(down).alias("after")
    )


def edited_pairs(docs: DataFrame, samples: int = SAMPLES, shingle: int = SHINGLE) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and that of the next document.

    ``doc_id``, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next`` (0 to 1). The next document is that with the next lower id, after the
    last the first; a null id is the lowest, equal ids go by a hash of their text. ``docs`` is read
    more than once and must have its rows in the same places each time, as a table has. In the edited
    text the last ``n_chars / 2`` code points (rounded down) are the first of the next document's.

    A null text is empty. Texts without words are as like as can be to each other, and unlike
    all others. Other columns are ignored; no rows give none.
    """
    rows = in_order(docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")))
    n, half = F.length("text"), F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("after", F.lit(1), half))
    rows = rows.withColumn("edited", F.when(F.col("guest") == 0, edited))
    sha = F.sha2("edited", 256)
    parts = [F.conv(F.substring(sha, 16 * k + 1, 16), 16, -10).cast("long").alias(f"sha{k}") for k in range(4)]
    rows = rows.select(
        "range", "spot", "doc_id", n.cast("long").alias("n_chars"), "guest", *parts, "text", "edited"
    )
    carried = ["doc_id", "n_chars", "guest", *[f"sha{k}" for k in range(4)]]
    made = fingerprint_pairs(rows, ["range", "spot"], "text", "edited", carried, samples, shingle)
    after_fp = F.lead("first_fp").over(W.partitionBy("range").orderBy("spot")).alias("after_fp")
    both = made.select("*", after_fp).where("guest = 0")
    return both.select(
        "doc_id",
        "n_chars",
        F.lower(F.concat(*[F.lpad(F.hex(f"sha{k}"), 16, "0") for k in range(4)])).alias("edited_sha256"),
        F.col("first_fp").alias("fingerprint"),
        F.col("second_fp").alias("edited_fingerprint"),
        likeness(F.col("first_fp"), F.col("second_fp"), samples).alias("near_edited"),
        likeness(F.col("first_fp"), F.col("after_fp"), samples).alias("near_next"),
    )
