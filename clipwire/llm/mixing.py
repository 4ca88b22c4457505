"""Mixing sources to target weights over a tree of domains, languages and sources.

A budget of tokens goes down the tree by weights. What a node cannot use, because all its
leaves together hold too little, goes to its siblings first; only what all of them cannot use
reaches the level above. That is the same as filling each family by weight up to what its
members can hold, from the root down.

A leaf's share is a prefix of its token stream: its documents in a seeded order, once
for each epoch, each epoch with an order of its own. Whole epochs need no order. Of the last,
partial one, tokens are counted in ``BUCKETS`` buckets of the order, so that only
the one bucket in which the share ends is sorted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipwire.llm.common import WORD, stored

LEVELS = ("domain", "lang", "source")
#: Hexadecimal digits of the order that name a bucket: 4,096 of them.
BUCKET_DIGITS = 3


def word_tokens(text: Column) -> Column:
    """Words of a text, parted by ASCII white space; null has none."""
    gaps = r"[\x20\x09-\x0D]+"
    words = F.size(F.split(F.regexp_replace(text, f"^{gaps}|{gaps}$", ""), gaps))
    return F.when(text.rlike(WORD), words).otherwise(0).cast("long")


def domain_of(source: Column, domains: int = 4) -> Column:
    """A domain by the number at the end of a source's name: ``domain0`` and so on."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    return F.concat(F.lit("domain"), (F.coalesce(number.try_cast("int"), F.lit(0)) % domains).cast("string"))


def _weight(name: str, weights: Mapping[str, int] | None) -> Column:
    """The whole-number weight of each value of a column; 1 where none is given."""
    if not weights:
        return F.lit(1).cast("long")
    pairs = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, int(v))])
    return F.coalesce(F.try_element_at(pairs, F.col(name)), F.lit(1)).cast("long")


def _filled(nodes: DataFrame, family: list[str], name: str) -> DataFrame:
    """``nodes`` with ``share``: the family's ``budget`` by ``weight``, no more than ``held`` each.

    Members are taken by held / weight, the first to be full first. A member is full if its part
    of what those before it leave, by its weight among those left, is all it holds. The
    others part the rest by weight in whole tokens: differences of rounded running sums,
    so that nothing is lost.
    """
    rank = (F.col("held") / F.col("weight")).alias("rank")
    all_of = W.partitionBy(*family)
    order = all_of.orderBy("rank", name)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    ranked = nodes.select("*", rank).select(
        "*",
        F.coalesce(F.sum("held").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)).alias("weight_left"),
    )
    full = wide("held") * F.col("weight_left") <= (wide("budget") - wide("before")) * F.col("weight")
    marked = ranked.withColumn("full", full).withColumn("open", F.when(F.col("full"), 0).otherwise(F.col("weight")))
    parted = marked.select(
        "*",
        (F.col("budget") - F.sum(F.when(F.col("full"), F.col("held")).otherwise(0)).over(all_of))
        .cast("decimal(20,0)")
        .alias("left"),
        F.sum("open").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("upto"),
        F.sum("open").over(all_of).alias("total_open"),
    )
    part = F.expr("(left * upto) div total_open - (left * (upto - weight)) div total_open")
    share = F.when(F.col("full"), F.col("held")).otherwise(part)
    return parted.select(*family, name, share.cast("long").alias("share"))


def budgets(
    supply: DataFrame,
    budget: Column,
    weights: Mapping[str, Mapping[str, int]] | None = None,
    epochs: int = 1,
    levels: tuple[str, ...] = LEVELS,
) -> DataFrame:
    """``supply`` (the levels' columns and ``tokens`` of each leaf) with ``share``, its token budget.

    ``weights`` has whole numbers of 1 or more for values of each level, 1 where there is none. No leaf
    gets more than ``epochs`` times its tokens. ``budget`` is a column that may use
    ``total``, the tokens of all leaves.
    """
    weights = weights or {}
    held = supply.select(*levels, "tokens", (F.col("tokens") * epochs).alias("held"))
    above: DataFrame | None = None
    for depth, name in enumerate(levels):
        family = list(levels[:depth])
        nodes = held.groupBy(*family, name).agg(F.sum("held").alias("held"), F.sum("tokens").alias("own"))
        nodes = nodes.withColumn("weight", _weight(name, weights.get(name)))
        if above is None:
            nodes = nodes.withColumn("total", F.sum("own").over(W.partitionBy()))
            nodes = nodes.withColumn("budget", budget.cast("long"))
        else:
            nodes = nodes.join(above.withColumnRenamed("share", "budget"), family)
        above = _filled(nodes, family, name)
    return supply.join(above, list(levels))


def mix(
    docs: DataFrame,
    budget: Column,
    weights: Mapping[str, Mapping[str, int]] | None = None,
    epochs: int = 1,
    seed: int = 1,
    domain: Column | None = None,
    tokens: Column | None = None,
) -> DataFrame:
    """One row for each document and epoch of which the mixture takes tokens.

    ``doc_id``, ``domain``, ``lang``, ``source``, ``tokens`` (all of the document), ``epoch`` (from 0),
    ``taken`` (from the front; less than ``tokens`` where a leaf's share ends). ``budget`` may
    use ``total``, the tokens of all documents. ``domain`` and ``tokens`` are columns of ``docs``; by
    default from the source's number, and words.

    Null languages and sources are values of their own (``none``). Documents without tokens have
    nothing to take and no row. Repeated rows are one document with the tokens of all of
    them, and rows with a null id are such a document in each leaf. Other columns are ignored.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce(domain if domain is not None else domain_of(F.col("source")), F.lit("none")).alias("domain"),
        F.coalesce("lang", F.lit("none")).alias("lang"),
        F.coalesce("source", F.lit("none")).alias("source"),
        (tokens if tokens is not None else word_tokens(F.col("text"))).alias("tokens"),
    )
    rows = rows.where(F.col("tokens") > 0).groupBy("doc_id", *LEVELS).agg(F.sum("tokens").alias("tokens"))
    rows = stored(rows, "mix-tokens")
    supply = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    shares = budgets(supply, budget, weights, epochs).select(
        *LEVELS,
        F.expr("share div tokens").cast("int").alias("whole"),
        F.expr("share % tokens").alias("part"),
    )
    leaves = stored(shares, "mix-shares")
    with_leaf = rows.join(leaves, list(LEVELS))
    repeated = with_leaf.where(F.col("whole") > 0).select(
        "doc_id",
        *LEVELS,
        "tokens",
        F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"),
        F.col("tokens").alias("taken"),
    )
    last = with_leaf.where(F.col("part") > 0).withColumn("epoch", F.col("whole"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), "epoch", F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    last = last.withColumn("key", key).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = last.groupBy(*LEVELS, "part", "bucket").agg(F.sum("tokens").alias("inside"))
    running = W.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    placed = sums.select("*", F.coalesce(F.sum("inside").over(running), F.lit(0)).alias("before"))
    placed = placed.where(F.col("before") < F.col("part")).select(*LEVELS, "bucket", "inside", "before")
    inside = last.join(placed, [*LEVELS, "bucket"])
    whole_bucket = F.col("before") + F.col("inside") <= F.col("part")
    easy = inside.where(whole_bucket).withColumn("taken", F.col("tokens"))
    within = W.partitionBy(*LEVELS).orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    edge = inside.where(~whole_bucket).withColumn(
        "start", F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0))
    )
    edge = edge.withColumn("taken", F.least(F.col("tokens"), F.col("part") - F.col("start")))
    columns = ["doc_id", *LEVELS, "tokens", "epoch", "taken"]
    out = repeated.select(columns).union(easy.select(columns))
    return out.union(edge.where(F.col("taken") > 0).select(columns))
