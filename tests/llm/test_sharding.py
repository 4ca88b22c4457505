import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clipwire.llm import sharding
from clipwire.llm.queries import llm_queries


def checked(rows, texts):
    """Sizes, sums and gapless slots; the bytes of each shard."""
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return size


def test_query(spark, monkeypatch):
    monkeypatch.setattr(sharding, "NUMBERED", 7)
    sf = "/root/testdata/sf0.01"
    df = llm_queries()["op9_kd_tree_shards"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = df.collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    size = checked(rows, texts)
    largest = max(r["size"] for r in rows)
    mean = sum(size.values()) / 40
    assert sorted(size) == list(range(40))
    assert max(size.values()) < mean + largest and min(size.values()) > mean - largest
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_small_groups_are_whole_and_a_hot_one_is_cut(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id",
        "CASE WHEN id % 3 = 0 THEN repeat('hot ', 20) WHEN id % 50 = 1 THEN concat('copy ', id % 200) "
        "ELSE concat(repeat('text ', int(id % 40)), id) END AS text",
        "if(id % 4 = 0, null, concat('l', id % 4)) AS lang", "if(id % 3 = 0, 'hot', concat('s', id % 9)) AS source",
    )
    rows = sharding.shard(docs, 8).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    size = checked(rows, texts)
    mean = sum(size.values()) / 8
    assert sorted(size) == list(range(8))
    assert max(size.values()) < 1.06 * mean and min(size.values()) > 0.94 * mean
    places = defaultdict(set)
    for r in rows:
        places[texts[r.doc_id]].add(r["shard"])
    assert len(places["hot " * 20]) > 1
    assert sum(len(p) > 1 for t, p in places.items() if t.startswith("copy")) == 0


def test_shards_hold_like_metadata(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat('x', 50) AS text", "'en' AS lang", "concat('s', id % 2) AS source")
    docs = docs.withColumn("text", F.concat("text", F.lpad(F.col("doc_id").cast("string"), 6, "0")))
    rows = sharding.shard(docs, 4).join(docs, "doc_id").groupBy("shard").agg(
        F.countDistinct("source").alias("sources"), (F.max("doc_id") - F.min("doc_id")).alias("span")
    )
    assert all(r.sources == 1 or r.span < 1100 for r in rows.collect())


@pytest.mark.parametrize("shards", [1, 3, 10])
def test_odd_rows(spark, documents, words, shards):
    texts = [None, "", "same", "same", " ".join(words(1, 30_000)), "é😀"]
    df = documents(texts, {"size": "x", "tie": 1, "node": 2, "shard": 3, "slot": 4, "first": 5, "part": 6})
    df = df.union(df.where("doc_id = 2")).union(df.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    rows = sharding.shard(df, shards).collect()
    assert len(rows) == 8 and all(0 <= r["shard"] < shards for r in rows)
    checked(rows, dict(enumerate(texts)) | {None: "é😀"})
    assert sharding.shard(df.limit(0), shards).collect() == []


def test_by_target_bytes(spark, documents):
    rows = sharding.shard(documents(["x" * 84] * 20), target_bytes=500).collect()
    assert Counter(r["shard"] for r in rows) == {0: 5, 1: 5, 2: 5, 3: 5}


def test_repeated_rows_without_an_id_are_spread(spark):
    """A third of all rows is one row; the shards are equal all the same."""
    docs = spark.range(3000).selectExpr(
        "if(id % 3 = 0, null, id) AS doc_id",
        "if(id % 3 = 0, repeat('hot ', 200), concat(repeat('text ', int(id % 300)), id)) AS text",
        "'en' AS lang", "if(id % 3 = 0, 'hot', concat('s', id % 9)) AS source",
    )
    rows = sharding.shard(docs, 40).collect()
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r.slot)
    mean = sum(size.values()) / 40
    assert len(rows) == 3000 and sorted(size) == list(range(40))
    assert max(size.values()) < 1.06 * mean and min(size.values()) > 0.94 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_parts_of_a_shard_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(sharding, "NUMBERED", 50)
    rows = spark.range(4000).selectExpr(
        "CAST(null AS bigint) AS doc_id", "5 AS size", "CAST(1 AS bigint) AS text_crc32", "0 AS shard", "id AS row"
    )
    found = sharding.numbered(rows).collect()
    assert sorted(r.slot for r in found) == list(range(4000))
    plan = sharding.numbered(rows)._jdf.queryExecution().executedPlan().toString()
    assert "part" in plan and "Python" not in plan


def test_tree_is_that_of_plain_recursion(spark):
    """Every split is at the weighted median of the widest dimension, found by sorting the rows."""
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "repeat('x', int(pow(id % 97, 1.5))) AS text", "concat('l', id % 5) AS lang",
        "concat('s', id % 11) AS source",
    )
    shards = 8
    stored_rows = sharding.metadata(docs.withColumn("text", F.concat("text", "doc_id")), shards)
    root = sharding.grow(stored_rows, shards)
    rows = [r.asDict() for r in stored_rows.collect()]
    low = {d: min(r[d] for r in rows) for d in sharding.DIMENSIONS}
    width = {d: (max(r[d] for r in rows) - low[d]) or 1.0 for d in sharding.DIMENSIONS}
    exact = sum(r["size"] for r in rows) / shards * sharding.EXACT

    def check(node, rows):
        if node.count == 1:
            assert node.split is None
            return
        wide = {d: (max(r[d] for r in rows) - min(r[d] for r in rows)) / width[d] for d in sharding.DIMENSIONS}
        d = node.split.dimension
        assert wide[d] == max(wide.values())
        order = sorted(rows, key=lambda r: (r[d], r["tie"]))
        need = sum(r["size"] for r in rows) * (node.count // 2) / node.count
        s = node.split
        place = lambda r: (r[d],) if s.tie is None else (r[d], r["tie"])
        at = (s.value,) if s.tie is None else (s.value, s.tie)
        left = [r for r in order if place(r) < at or (s.closed and place(r) == at)]
        assert left == order[: len(left)]
        bytes_left = sum(r["size"] for r in left)
        slack = exact + max(r["size"] for r in rows)
        assert abs(bytes_left - need) <= slack
        check(s.left, left)
        check(s.right, order[len(left) :])

    check(root, rows)
    assert [n.first for n in sharding.leaves(root)] == list(range(shards))
