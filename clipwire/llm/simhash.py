"""SimHash fingerprints of documents and an exact search for all that lie close together.

A fingerprint has one bit per hash bit of a document's word shingles, set if it is set in
over half of them. Fingerprints within ``radius`` bits of each other are linked. All such
pairs share a block (below), and blocks are compared exactly, tile by tile, with
exclusive-or and bit counts; tiles whose bit counts differ beyond the radius are skipped.

Blocks of bits: cut into ``radius + 2`` pieces, two fingerprints within the radius agree on
two pieces at least, so every pair of pieces is a block key. No link can be missed.

Blocks of least hashes: a radius that stands for a similarity of 0.8 is too wide for pieces
of bits. There, texts share a block if the least of their shingle hashes agrees under one
of ``MIN_HASHES`` mixings; a pair with a similarity of 0.8 misses all of them once in
15,000 times. Fingerprints are of distinct shingles there and links by bits only candidates:
within what they join, each pair in the radius is linked if the Jaccard similarity of its
shingles is ``similarity`` or more, and by nothing else.

Blocks with more rows than a tile are cut by bit count and hash, and each pair of cuts is a
unit of its own, so no task gets a whole large block. A unit returns a spanning set of
its links, one per row at most, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwire.llm.common import joined_apart, stored
from clipwire.llm.components import connected_components

SEED = 42
TILE = 2048
MIN_HASHES = 6
#: Texts of one group have so many of their shingles in common, and candidates differ in so many bits.
SIMILARITY, RADIUS = 0.8, 74
#: Shingles in a tile whose rows have theirs with them.
SHINGLES = 1 << 21
#: Runs of up to so many rows are compared by shifting, not by tiles.
SHORT = 64

#: Arguments of ``near_duplicates`` up to ``similarity``: by shingles that are alike, and by 64 bits alone.
ALIKE = 5, 4, RADIUS, MIN_HASHES, TILE, SIMILARITY
BY_BITS = 4, 1, 4, 0, TILE, None

_ODD = np.array(
    [(2 * pow(3, 40 + k) + 0x9E3779B97F4A7C15 * (2 * k + 1)) % 2**64 | 1 for k in range(32)], np.uint64
)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words, repeats included.

    A-Z are lowered, words are parted by ASCII white space. Fewer words than ``size`` are one
    shingle; no words (or null) give none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1)[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(ends))


def mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """Another hash of each hash; the same for k = 0."""
    if not k:
        return hashes
    x = (hashes ^ (hashes >> np.uint64(31))) * _ODD[k]
    x = (x ^ (x >> np.uint64(29))) * _ODD[k + 16]
    return x ^ (x >> np.uint64(32))


def simhash(hashes: np.ndarray, words: int = 1) -> bytes:
    """The fingerprint of ``64 * words`` bits, big-endian; zero without shingles."""
    out = []
    for k in range(words):
        set_in = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 15):
            part = mixed(hashes[at : at + (1 << 15)], k).astype(">u8")
            set_in += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int32)
        out.append(np.packbits(set_in * 2 > len(hashes)).tobytes())
    return b"".join(out)


def _digest(distinct: np.ndarray) -> bytes:
    """Eight bytes that stand for a set of shingles."""
    return xxhash.xxh64_digest(distinct.tobytes(), SEED)


def _fingerprints(size: int, words: int, min_hashes: int):
    """A column function: the fingerprint, and the least hashes if asked for.

    With these, shingles count once, a digest of their set follows the fingerprint, and
    ``n`` is their number.
    """
    schema = "fp binary, ones int" + ", n int, mins array<bigint>" * bool(min_hashes)

    @F.pandas_udf(schema)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            fps, ones, sizes, mins = [], [], [], []
            for text in texts:
                h = shingle_hashes(text, size)
                if min_hashes:
                    h = np.unique(h)
                    least = [mixed(h, 8 + k).min() if len(h) else 0 for k in range(min_hashes)]
                    mins.append(np.array(least, np.uint64).astype(np.int64))
                    sizes.append(len(h))
                fp = simhash(h, words)
                ones.append(int.from_bytes(fp).bit_count())
                fps.append(fp + _digest(h) if min_hashes else fp)
            more = {"n": sizes, "mins": mins} if min_hashes else {}
            yield pd.DataFrame({"fp": fps, "ones": ones} | more)

    return of


def _shingle_sets(size: int):
    """A column function: the digest and the distinct shingle hashes, ascending."""

    @F.pandas_udf("digest binary, shingles binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [np.unique(shingle_hashes(text, size)) for text in texts]
            yield pd.DataFrame({"digest": [_digest(h) for h in sets], "shingles": [h.tobytes() for h in sets]})

    return of


def bit_blocks(fps: np.ndarray, radius: int) -> np.ndarray:
    """Keys (rows, pairs of pieces) of 64-bit fingerprints: two pieces and which they are."""
    pieces = radius + 2
    cuts = np.linspace(0, 64, pieces + 1).round().astype(int)
    part = [
        (fps >> np.uint64(64 - b)) & np.uint64((1 << int(b - a)) - 1) for a, b in zip(cuts[:-1], cuts[1:])
    ]
    keys = [
        (np.uint64(n) << np.uint64(56)) | (part[i] << np.uint64(28)) | part[j]
        for n, (i, j) in enumerate(combinations(range(pieces), 2))
    ]
    return np.stack(keys, axis=1).astype(np.int64)


def _keyed(nodes: DataFrame, radius: int, min_hashes: int) -> DataFrame:
    """A row (key, fp, ones) for each block of each fingerprint; ones: its bit count."""
    if min_hashes:
        key = F.posexplode("mins").alias("k", "least")
        return nodes.select("fp", "ones", key).select(F.xxhash64("k", "least").alias("key"), "fp", "ones")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("fp").to_pylist()
            if not raw:
                continue
            keys = bit_blocks(np.frombuffer(b"".join(raw), ">u8").astype(np.uint64), radius)
            rows = pa.array(np.repeat(np.arange(len(raw)), keys.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), batch.column("fp").take(rows), batch.column("ones").take(rows)],
                ["key", "fp", "ones"],
            )

    return nodes.select("fp", "ones").mapInArrow(blocks, "key long, fp binary, ones int")


def _units(keyed: DataFrame, radius: int, tile: int) -> DataFrame:
    """(key, unit, fp): a block is one unit, or one for each near pair of its tiles if large.

    A row counts as one in a tile, or as its ``load`` if there is such a column. Only what stands once
    for a large block is a broadcast, so no more than one row for ``tile`` rows of ``keyed``. Spark
    sizes ``keyed`` as what it was exploded from and would send all of it.
    """
    load = F.sum("load") if "load" in keyed.columns else F.count("*")
    large = keyed.groupBy("key").agg(load.alias("load")).where(F.col("load") > tile).select("key")
    large = F.broadcast(large)
    band = F.floor(F.col("ones") / (radius + 1)).cast("int")
    many = keyed.join(large, "key", "left_semi").withColumn("band", band)
    slices = many.groupBy("key", "band").agg(F.ceil(load / tile).cast("int").alias("slices"))
    tiles = slices.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("band", "slices"))).alias("tiles"))
    own = F.struct("band", F.pmod(F.xxhash64("fp"), F.col("tiles")[F.col("band")]).cast("int").alias("slice"))
    near = F.flatten(
        F.transform(
            F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1),
            lambda q: F.transform(
                F.filter(
                    F.sequence(F.lit(0), F.coalesce(F.try_element_at("tiles", q), F.lit(0))),
                    lambda s: s < F.coalesce(F.try_element_at("tiles", q), F.lit(0)),
                ),
                lambda s: F.struct(q.alias("band"), s.alias("slice")),
            ),
        )
    )
    pairs = many.join(F.broadcast(tiles), "key").select("key", "fp", own.alias("own"), F.explode(near).alias("other"))
    unit = F.to_json(F.struct(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")))
    small = keyed.join(large, "key", "left_anti")
    return small.select("key", F.lit("").alias("unit"), "fp").union(pairs.select("key", unit.alias("unit"), "fp"))


def near_pairs(fp: np.ndarray, run: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions i, j of all rows of one run within ``radius`` bits; ``run`` is ascending."""
    left, right = [], []
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else np.zeros(0, int)
    sizes = np.diff(np.r_[starts, len(run)])
    of = np.repeat(sizes, sizes)
    some = np.flatnonzero((of > 1) & (of <= SHORT))
    fps, runs = fp[some], run[some]
    for lag in range(1, SHORT):
        i = np.flatnonzero(runs[lag:] == runs[:-lag])
        if not len(i):
            break
        i = i[np.bitwise_count(fps[i] ^ fps[i + lag]).sum(1, dtype=np.int32) <= radius]
        left.append(some[i])
        right.append(some[i + lag])
    for start, size in zip(starts[sizes > SHORT], sizes[sizes > SHORT]):
        ones = np.bitwise_count(fp[start : start + size]).sum(1, dtype=np.int32)
        order = np.argsort(ones, kind="stable")
        ones, rows = ones[order], order + start
        step = 256
        for a in range(0, size, step):
            x = fp[rows[a : a + step]]
            for b in range(a, size, step):
                if ones[b] - ones[min(a + step, size) - 1] > radius:
                    break
                y = fp[rows[b : b + step]]
                apart = np.zeros((len(x), len(y)), np.int32)
                for w in range(fp.shape[1]):
                    apart += np.bitwise_count(x[:, None, w] ^ y[None, :, w])
                i, j = np.nonzero(apart <= radius)
                if a == b:
                    i, j = i[i < j], j[i < j]
                left.append(rows[a + i])
                right.append(rows[b + j])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the first row that it is joined to by links i-j, itself included."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, before[i], low)
        np.minimum.at(label, before[j], low)
        label = label[label]
        if np.array_equal(label, before):
            break
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity of two ascending arrays of distinct hashes; 0 if both are empty."""
    both = np.concatenate((a, b))
    both.sort()
    same = np.count_nonzero(both[1:] == both[:-1])
    return same / max(1, len(both) - same)


def similar(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """:func:`spanning` for those of the links i-j whose sets are ``similarity`` alike or more.

    A pair is not looked at once others have joined its rows.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    fit = np.minimum(sizes[i], sizes[j]) >= similarity * np.maximum(sizes[i], sizes[j])
    i, j, label, step = i[fit], j[fit], np.arange(len(sets)), 256
    left, right = [], []
    while len(i):
        for a, b in zip(i[:step].tolist(), j[:step].tolist()):
            if jaccard(sets[a], sets[b]) >= similarity:
                left.append(a)
                right.append(b)
        label = spanning(len(sets), np.array(left, np.int64), np.array(right, np.int64))
        i, j, step = i[step:], j[step:], 2 * step
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def _links(units: DataFrame, radius: int, words: int | None = None, similarity: float | None = None) -> DataFrame:
    """Spanning links (a, b) of each unit; rows come sorted by key and unit.

    The first ``words`` of 64 bits are compared. With ``similarity``, ``shingles`` decide.
    """

    def compared(keys: np.ndarray, unit: list, raw: list, shingles: list) -> pa.RecordBatch:
        fp = np.frombuffer(b"".join(raw), ">u8").astype(np.uint64).reshape(len(raw), -1)[:, :words]
        new = np.r_[False, (keys[1:] != keys[:-1]) | (np.array(unit[1:], object) != np.array(unit[:-1], object))]
        i, j = near_pairs(fp, np.cumsum(new), radius)
        if similarity is None:
            label = spanning(len(raw), i, j)
        else:
            label = similar([np.frombuffer(s, np.uint64) for s in shingles], i, j, similarity)
        moved = np.flatnonzero(label != np.arange(len(raw)))
        a = pa.array([raw[k] for k in moved], pa.binary())
        b = pa.array([raw[k] for k in label[moved]], pa.binary())
        return pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, unit, raw, shingles = np.zeros(0, np.int64), [], [], []
        for batch in batches:
            keys = np.concatenate((keys, batch.column("key").to_numpy(zero_copy_only=False)))
            unit += batch.column("unit").to_pylist()
            raw += batch.column("fp").to_pylist()
            if similarity is not None:
                shingles += batch.column("shingles").to_pylist()
            whole = len(raw)  # the last unit may go on in the next batch
            while whole and keys[whole - 1] == keys[-1] and unit[whole - 1] == unit[-1]:
                whole -= 1
            if whole:
                yield compared(keys[:whole], unit[:whole], raw[:whole], shingles[:whole])
                keys, unit, raw, shingles = keys[whole:], unit[whole:], raw[whole:], shingles[whole:]
        if raw:
            yield compared(keys, unit, raw, shingles)

    dealt = units.repartition("key", "unit").sortWithinPartitions("key", "unit")
    return dealt.mapInArrow(scan, "a binary, b binary")


def _alike(docs: DataFrame, nodes: DataFrame, moved: DataFrame, how: tuple) -> DataFrame:
    """Links between nodes of one candidate component (``moved``) whose shingles are alike."""
    shingle, words, radius, min_hashes, tile, similarity = how
    members = moved.select(F.col("node").alias("member"), "root")
    members = members.union(moved.select(F.col("root").alias("member"), "root").distinct())
    load = F.greatest(F.lit(1.0), F.col("n") * (tile / SHINGLES)).alias("load")
    found = nodes.join(members.hint("merge"), nodes["fp"] == members["member"]).select(
        "fp", "ones", "mins", "text_hash", "root", load
    )
    found = stored(found, "candidates")
    # a component is one block if it fits into a tile, else it has the blocks of its least hashes
    sizes = found.groupBy("root").agg(F.sum("load").alias("size"))
    least = F.transform("mins", lambda m, k: F.xxhash64(k, m))
    blocks = F.when(F.col("size") <= tile, F.array(F.xxhash64("root"))).otherwise(least)
    keyed = joined_apart(found, sizes, "root").select(F.explode(blocks).alias("key"), "fp", "ones", "load")
    units = _units(stored(keyed, "blocks"), radius, tile)
    # texts of candidates only, each once, and none sorted for the joins; equal hashes of other texts find no node below
    wanted = found.select("text_hash").distinct()
    texts = docs.select("text", F.xxhash64("text").alias("text_hash"))
    texts = joined_apart(texts, wanted, "text_hash", hint="shuffle_hash").select("text").distinct()
    hashed = _shingle_sets(shingle)(F.col("text"))
    sets = texts.select(hashed.alias("h")).select("h.*")
    own = units.withColumn("_digest", F.expr(f"substring(fp, {8 * words + 1}, 8)"))
    rows = own.hint("shuffle_hash").join(sets, own["_digest"] == sets["digest"]).select("key", "unit", "fp", "shingles")
    return _links(rows, radius, words, similarity)


def _grouped(docs: DataFrame, kept: list, how: tuple) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` (``kept`` and fp), and for each fp its root and its least doc_id."""
    shingle, words, radius, min_hashes, tile, _ = how
    hashed = _fingerprints(shingle, words, min_hashes)(F.col("text"))
    if min_hashes:
        kept = [*kept, F.xxhash64("text").alias("text_hash")]
    names = docs.select(kept).columns
    prints = stored(docs.select(*kept, hashed.alias("h")).select(*names, "h.*"), "fingerprints")
    firsts = [F.min("doc_id").alias("first"), F.min("ones").alias("ones")]
    if min_hashes:
        firsts += [F.min("mins").alias("mins"), F.min("n").alias("n"), F.min("text_hash").alias("text_hash")]
    nodes = stored(prints.groupBy("fp").agg(*firsts), "nodes")
    links = _links(_units(_keyed(nodes, radius, min_hashes), radius, tile), radius, words)
    moved = connected_components(links)
    if min_hashes:
        moved = connected_components(_alike(docs, nodes, moved, how))
    rooted = nodes.join(moved.hint("merge"), nodes["fp"] == moved["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    return prints, rooted


def near_groups(docs: DataFrame, row: Column, how: tuple = ALIKE) -> DataFrame:
    """``doc_id``, ``row`` and ``root`` for every row of ``docs``.

    Rows of one component of :func:`near_duplicates`, with the arguments ``how``, have one ``root``,
    whatever their ids are.
    """
    prints, rooted = _grouped(docs, [F.col("doc_id"), row.alias("row")], how)
    return joined_apart(prints.select("doc_id", "row", "fp"), rooted.select("fp", "root"), "fp").drop("fp")


def joined_groups(one: DataFrame, other: DataFrame) -> DataFrame:
    """``doc_id``, ``row`` and ``root``: rows that share a root in one of two groupings, or in a chain of both.

    The two have the same rows, and each gives rows with equal ``row`` one root. Of these one comes out.
    """
    one = one.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.min("root").alias("a"))
    other = other.groupBy("row").agg(F.min("root").alias("b"))
    both = stored(one.join(other.hint("merge"), "row"), "two-groups")
    least = both.groupBy("b").agg(F.min("a").alias("least"))
    links = joined_apart(both.select("a", "b").distinct(), least, "b").where(F.col("a") != F.col("least"))
    moved = connected_components(links, "a", "least").withColumnRenamed("node", "a")
    return joined_apart(both, moved, "a", "left").select("doc_id", "row", F.coalesce("root", "a").alias("root"))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    words: int = 4,
    radius: int = RADIUS,
    min_hashes: int = MIN_HASHES,
    tile: int = TILE,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (binary), ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links lead to, the row's own included.
    By default texts are linked whose sets of five-word shingles have a Jaccard similarity of
    0.8 or more; 256 bits with a radius of 74 find the candidates. Texts at 0.8 differ in 39
    bits on average, give or take 6, and in 48 where they have only four or five shingles.
    ``min_hashes=0`` links by the radius alone and uses blocks of bits instead, exact for any
    texts, for 64 bits and a small radius.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Equal
    texts, and repeated rows, have one component. A null ``doc_id`` is never a
    component's id unless the component has no other. Other columns are ignored. An empty
    table gives no rows.
    """
    how = shingle, words, radius, min_hashes, tile, similarity
    prints, rooted = _grouped(docs, [F.col("doc_id")], how)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = joined_apart(rooted, least, "root").select("fp", "component_id")
    fingerprint = F.expr(f"substring(fp, 1, {8 * words})").alias("fingerprint")
    return joined_apart(prints.select("doc_id", "fp"), named, "fp").select("doc_id", fingerprint, "component_id")
