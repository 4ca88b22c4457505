import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clipwire.llm import fingerprints as fp
from clipwire.llm.queries import llm_queries

SF = "/root/testdata/sf0.001"


def plain_edits(texts):
    """(n_chars, digest of the edited text, next id) by id, for a dict of texts."""
    ids = sorted(texts, reverse=True)
    out = {}
    for n, d in enumerate(ids):
        after = ids[(n + 1) % len(ids)]
        text, half = texts[d], len(texts[d]) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        out[d] = len(text), hashlib.sha256(edited.encode()).hexdigest(), after, edited
    return out


def jaccard(a, b, size=fp.SHINGLE):
    def terms(text):
        for c in "\t\n\x0b\x0c\r":
            text = text.replace(c, " ")
        w = [x for x in text.split(" ") if x]
        return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()

    x, y = terms(a), terms(b)
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 1.0


def test_query_is_brute_force(spark, monkeypatch):
    """With small ranges, so that the next document is often in another one."""
    monkeypatch.setattr(fp, "IN_TASK", 3)
    got = {r.doc_id: r for r in llm_queries()["op1_weighted_sampling"](spark, SF).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = plain_edits(texts)
    assert {d: (r.n_chars, r.edited_sha256) for d, r in got.items()} == {d: w[:2] for d, w in want.items()}
    prints = {d: r.fingerprint for d, r in got.items()}
    by_text = {}
    for d, p in prints.items():
        assert by_text.setdefault(texts[d], p) == p
    same = lambda a, b: sum(a[5 * k : 5 * k + 5] == b[5 * k : 5 * k + 5] for k in range(fp.SAMPLES)) / fp.SAMPLES
    off = []
    for d, r in got.items():
        assert r.near_next == same(prints[d], prints[want[d][2]])
        assert r.near_edited == same(prints[d], r.edited_fingerprint)
        off.append(r.near_edited - jaccard(texts[d], want[d][3]))
    assert abs(sum(off) / len(off)) < 0.03
    # The standard error of a share of 32 is at most 0.088.
    assert fp.SAMPLES == 32
    assert (sum(x * x for x in off) / len(off)) ** 0.5 < 0.088
    assert max(map(abs, off)) < 5 * 0.088


SKEWS = {
    "an outlying id": "if(id = 17, 4611686018427387904, id)",
    "null ids": "if(id % 3 = 0, null, id)",
    "one id of many texts": "if(id % 3 = 0, 5, id)",
    "one row": "if(id % 3 = 0, 5, id)",
    "clusters": "(id % 4) * 1000000000000 + id",
}


@pytest.mark.parametrize("skew", list(SKEWS))
def test_skewed_ids_are_spread(spark, skew, monkeypatch):
    """No partition holds over twice the mean, and each row's next one is that of the whole order."""
    monkeypatch.setattr(fp, "IN_TASK", 200)
    same = "if(id % 3 = 0, 'hot text', concat('t', id))" if skew == "one row" else "concat('t', id)"
    docs = spark.range(0, 4000, 1, 4).selectExpr(f"{SKEWS[skew]} AS doc_id", f"{same} AS text")
    rows = fp.in_order(docs)
    got = rows.select("*", F.spark_partition_id().alias("task"), F.xxhash64("text").alias("h")).collect()
    own = [r for r in got if r.guest == 0]
    assert len(own) == 4000
    sizes = Counter(r.task for r in own)
    assert len(sizes) >= 20 and max(sizes.values()) <= 2 * 4000 / len(sizes)
    low = -(2**70)
    order = sorted(own, key=lambda r: (low if r.doc_id is None else r.doc_id, r.h), reverse=True)
    want = Counter((r.doc_id, r.text, order[(n + 1) % 4000].text) for n, r in enumerate(order))
    assert Counter((r.doc_id, r.text, r.after) for r in own) == want


def test_collision_rate_is_generalised_jaccard(spark):
    """Texts of repeated one-word terms: weights from 1 to 9."""
    a = " ".join(f"w{k}" for k in range(60) for _ in range(1 + k % 9))
    b = " ".join(f"w{k}" for k in range(20, 90) for _ in range(1 + (k * 5) % 7))
    df = spark.createDataFrame([(0, 0, a, b)], "row long, doc_id long, a string, b string")
    made = fp.fingerprint_pairs(df, ["row"], "a", "b", ["doc_id"], samples=160, shingle=1)
    got = made.select(fp.likeness(F.col("first_fp"), F.col("second_fp"), 160)).first()[0]
    assert got == pytest.approx(jaccard(a, b, 1), abs=0.12)


def test_odd_rows(spark, documents, words):
    long = " ".join(words(1, 20_000))
    texts = [None, "", " \n", "a", "a b c d e", "é😀 x", long, long]
    df = documents(texts, {"range": 1, "spot": 2, "head": "x", "fingerprint": "y", "edited": 0})
    df = df.union(df.where("doc_id = 4")).union(df.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    rows = fp.edited_pairs(df, 8).collect()
    assert len(rows) == 10
    got = {r.doc_id: r for r in rows}
    order = [7, 6, 5, 4, 4, 3, 2, 1, 0, None]
    full = {k: t or "" for k, t in enumerate(texts)} | {None: "a"}
    for n, d in enumerate(order):
        if d == 4 and order[n + 1] == 4:
            continue
        text, after = full[d], full[order[(n + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        of = [r for r in rows if r.doc_id == d]
        assert hashlib.sha256(edited.encode()).hexdigest() in {r.edited_sha256 for r in of}
        assert got[d].n_chars == len(text)
    assert got[6].fingerprint == got[7].fingerprint and got[7].near_next == 1
    assert got[0].fingerprint == got[1].fingerprint == got[2].fingerprint != got[3].fingerprint
    assert got[1].near_next == 1 and got[3].near_next == 0
    assert fp.edited_pairs(df.limit(0), 8).collect() == []
    one = fp.edited_pairs(documents(["a b c d e f g h"]), 8).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert fp.fingerprints(df, 8).where("doc_id = 7").first().fingerprint == got[7].fingerprint


def test_no_python_in_the_plan(spark):
    df = llm_queries()["op1_weighted_sampling"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
