"""K-d tree shards: documents of like metadata together, all shards of nearly equal bytes.

From the root down, a node is split along the dimension in which its documents lie widest apart,
at the weighted median: the place that leaves each side its part of the bytes. Medians are
found by histograms of at most ``BINS`` bins for each node, summed by the cluster; the bin that holds the
median is split into bins again until its weight no longer matters. Only histograms come
to the driver, never rows; the tree is a column expression over the stored metadata.

Equal texts are a group. A group has the metadata of its first document, so that it falls on one
side of each split, unless it is too heavy: then its rows go their own ways among
documents of equal metadata.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipwire.llm.common import joined_apart, stored

DIMENSIONS = ("log_size", "lang_place", "source_place", "id_place")
BINS = 512
#: Share of a shard's bytes up to which a group stays whole, and within which a cut is exact enough.
WHOLE_GROUP, EXACT = 0.05, 0.0005
#: Rows of a shard that are numbered in one task, on average.
NUMBERED = 50_000


@dataclass
class Split:
    """Left of it are rows under (value, tie) in ``dimension``; ``tie`` may be None: all ties."""

    dimension: str
    value: float
    tie: float | None
    closed: bool  # rows at the cut itself go left
    left: object
    right: object

    def goes_left(self) -> Column:
        x = F.col(self.dimension)
        if self.tie is None:
            return x <= self.value if self.closed else x < self.value
        tie = F.col("tie") <= self.tie if self.closed else F.col("tie") < self.tie
        return (x < self.value) | ((x == self.value) & tie)


@dataclass
class Node:
    """A part of the table that becomes ``count`` shards from ``first`` on."""

    first: int
    count: int
    split: Split | None = None


def node_of(root: Node) -> Column:
    """The first shard of the node that a row has come to."""
    if root.split is None:
        return F.lit(root.first)
    return F.when(root.split.goes_left(), node_of(root.split.left)).otherwise(node_of(root.split.right))


def leaves(root: Node) -> list[Node]:
    if root.split is None:
        return [root]
    return leaves(root.split.left) + leaves(root.split.right)


@dataclass
class _Search:
    """The median of one node as far as it is known: it is in [low, high] of ``by``."""

    node: Node
    dimension: str
    low: float
    high: float
    need: float  # bytes of [low, high] that go left
    value: float | None = None  # once all within are ties: their value; then ``by`` is the tie


def _place(c: Column) -> Column:
    """A value's place in [0, 1) by its hash; null has one as well."""
    return F.shiftrightunsigned(F.xxhash64(c, F.lit(1)), 12) / F.lit(float(1 << 52))


def metadata(docs: DataFrame, shards: int) -> DataFrame:
    """The stored metadata of every row: its size, group, dimensions and tie."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        "lang",
        "source",
        F.monotonically_increasing_id().alias("row"),  # tells repeated rows apart, once stored
    )
    rows = stored(rows, "shard-rows").withColumn("group", F.struct("text_hash", "text_crc32", "size"))
    first = F.min(F.struct("doc_id", "lang", "source")).alias("first")
    groups = rows.groupBy("group").agg(F.sum("size").alias("group_bytes"), first)
    total, low, high = rows.agg(F.sum("size"), F.min("doc_id"), F.max("doc_id")).first()
    span = float((high or 0) - (low or 0)) or 1.0
    limit = (total or 0) / shards * WHOLE_GROUP
    heavy = F.col("group_bytes") > limit
    own = F.xxhash64(F.lit(7), "doc_id", "text_hash", "row")
    return stored(
        joined_apart(rows.drop("lang", "source"), groups, "group").select(
            "doc_id",
            "size",
            "text_crc32",
            "row",
            F.log(F.col("size").cast("double")).alias("log_size"),
            _place(F.col("first.lang")).alias("lang_place"),
            _place(F.col("first.source")).alias("source_place"),
            ((F.coalesce("first.doc_id", F.lit(low or 0)).cast("double") - float(low or 0)) / span).alias("id_place"),
            _place(F.when(heavy, own).otherwise(F.col("text_hash"))).alias("tie"),
        ),
        "shard-metadata",
    )


def _searches(rows: DataFrame, root: Node, widths: dict[str, float]) -> list[_Search]:
    """A search for each node that has to be split; a node without rows is split anywhere."""
    nodes = {n.first: n for n in leaves(root) if n.count > 1}
    ends = [f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))]
    found = rows.select(node_of(root).alias("node"), "size", *DIMENSIONS)
    found = found.groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect()
    out = []
    for r in found:
        if r["node"] in nodes:
            node = nodes[r["node"]]
            wide = {d: (r[f"high_{d}"] - r[f"low_{d}"]) / widths[d] for d in DIMENSIONS}
            d = max(DIMENSIONS, key=lambda d: wide[d])
            need = r["bytes"] * (node.count // 2) / node.count
            out.append(_Search(node, d, r[f"low_{d}"], r[f"high_{d}"], need))
    return out


def _cut(search: _Search, at: float, closed: bool) -> None:
    tie = None if search.value is None else at
    value = at if search.value is None else search.value
    n = search.node
    left = Node(n.first, n.count // 2)
    right = Node(n.first + n.count // 2, n.count - n.count // 2)
    n.split = Split(search.dimension, value, tie, closed, left, right)


def _narrowed(rows: DataFrame, root: Node, searches: list[_Search], exact: float) -> list[_Search]:
    """One histogram for all searches; those that are not done yet, narrowed to a bin."""
    of = {s.node.first: s for s in searches}

    def known(get) -> Column:
        """What ``get`` says of the search that a row's node has, null without one."""
        each = [get(of[k]) if k in of else None for k in range(max(of) + 1)]
        return F.get(F.array(*[F.lit(v).cast("double") for v in each]), F.col("node"))

    placed = rows.select("size", "tie", *DIMENSIONS, node_of(root).alias("node"))
    placed = placed.select(
        "size",
        "tie",
        "node",
        F.get(F.array(*DIMENSIONS), known(lambda s: DIMENSIONS.index(s.dimension)).cast("int")).alias("x"),
        known(lambda s: s.value).alias("value"),
        known(lambda s: s.low).alias("low"),
        known(lambda s: s.high).alias("high"),
    )
    x, low, width = F.col("x"), F.col("low"), F.col("high") - F.col("low")
    placed = placed.withColumn("x", F.when(F.col("value").isNull(), x).when(x == F.col("value"), F.col("tie")))
    bin_ = F.least(F.lit(BINS - 1), F.floor(F.when(width > 0, (x - low) / width * BINS).otherwise(0)))
    counted = placed.groupBy("node", F.when((x >= low) & (x <= F.col("high")), bin_).alias("bin")).agg(
        F.sum("size").alias("bytes"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    bins: dict[int, list] = {}
    for r in sorted(r for r in counted.collect() if r["bin"] is not None):
        bins.setdefault(r["node"], []).append(r)
    rest = []
    for s in searches:
        before, here = 0.0, None
        for here in bins.get(s.node.first, []):
            if before + here["bytes"] >= s.need:
                break
            before += here["bytes"]
        if here is None:  # no rows
            _cut(s, s.low, True)
            continue
        inside = s.need - before
        single = here["low"] == here["high"]
        if here["bytes"] <= exact or (single and s.value is not None):
            whole = inside > here["bytes"] / 2
            _cut(s, here["high"] if whole else here["low"], whole)
        elif single:
            rest.append(_Search(s.node, s.dimension, 0.0, 1.0, inside, here["low"]))
        else:
            rest.append(_Search(s.node, s.dimension, here["low"], here["high"], inside, s.value))
    return rest


def grow(rows: DataFrame, shards: int) -> Node:
    """The tree over stored :func:`metadata`; its leaves are the shards 0 to ``shards - 1``."""
    ends = [f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))]
    whole = rows.agg(F.sum("size").alias("bytes"), *ends).first()
    root = Node(0, shards)
    if whole["bytes"] is None:
        return root
    widths = {d: (whole[f"high_{d}"] - whole[f"low_{d}"]) or 1.0 for d in DIMENSIONS}
    exact = whole["bytes"] / shards * EXACT
    while any(n.count > 1 for n in leaves(root)):
        searches = _searches(rows, root, widths)
        empty = {n.first for n in leaves(root) if n.count > 1} - {s.node.first for s in searches}
        for n in leaves(root):
            if n.first in empty:
                _cut(_Search(n, DIMENSIONS[0], 0.0, 0.0, 0.0), 0.0, True)
        while searches:
            searches = _narrowed(rows, root, searches, exact)
    return root


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, ... within each ``shard``, by a hash of the id and the ``row``.

    A shard is numbered in parts of some ``NUMBERED`` rows, each from where the one before it
    ends. Repeated rows are dealt like others.
    """
    count = rows.count()
    shards = max(rows.agg(F.countDistinct("shard")).first()[0], 1)
    parts = max(1, -(-count // (shards * NUMBERED)))
    parted = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", "row"), F.lit(parts)))
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parted.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    starts = starts.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    order = W.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size", "row")
    placed = parted.withColumn("at", F.row_number().over(order)).join(starts, ["shard", "part"])
    return placed.withColumn("slot", F.col("start") + F.col("at") - 1).drop("part", "at", "start", "row")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` for every row of ``docs``.

    Give the number of shards or the bytes that one should have. ``size`` is the text's UTF-8 bytes
    (null: none) plus 16. Sizes of shards differ by a part in a thousand and the group at each cut: a group
    (equal texts) is whole up to a twentieth of a shard, beyond that it is cut like any rows,
    repeated ones and those without an id included. A row larger than
    a shard is a shard's only one, or nearly. Null languages, sources and ids are
    values like others. Other columns are ignored; no rows give none.
    """
    if shards is None:
        total = docs.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 16)).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    rows = metadata(docs, shards)
    root = grow(rows, shards)
    placed = rows.select("doc_id", "size", "text_crc32", "row", node_of(root).cast("int").alias("shard"))
    return numbered(placed)
