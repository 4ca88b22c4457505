from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from clipwire.llm import mixing
from clipwire.llm.queries import llm_queries
from clipwire.llm.sql import llm_sql


def plain_fill(budget, members):
    """Shares of (weight, held) members, token by token left over as it comes; not rounded."""
    share = [0.0] * len(members)
    open_ = set(range(len(members)))
    left = float(min(budget, sum(h for _, h in members)))
    while open_ and left > 1e-9:
        weight = sum(members[k][0] for k in open_)
        full = {k for k in open_ if members[k][1] - share[k] <= left * members[k][0] / weight + 1e-12}
        if not full:
            for k in open_:
                share[k] += left * members[k][0] / weight
            break
        for k in full:
            left -= members[k][1] - share[k]
            share[k] = float(members[k][1])
        open_ -= full
    return share


def test_budgets_go_to_siblings_before_ancestors(spark):
    supply = [
        ("a", "en", "s1", 1000), ("a", "en", "s2", 10), ("a", "de", "s1", 20),
        ("b", "en", "s1", 50), ("b", "fr", "s1", 5), ("b", "fr", "s9", 700),
    ]
    df = spark.createDataFrame(supply, "domain string, lang string, source string, tokens long")
    weights = {"domain": {"a": 3, "b": 1}, "lang": {"en": 2, "de": 2}, "source": {"s2": 5}}
    for budget, epochs in ((600, 1), (1200, 1), (1785, 1), (9999, 1), (900, 3), (0, 1)):
        got = mixing.budgets(df, F.lit(budget), weights, epochs).collect()
        share = {(r.domain, r.lang, r.source): r.share for r in got}
        held = {(d, l, s): t * epochs for d, l, s, t in supply}
        assert sum(share.values()) == min(budget, sum(held.values()))
        want = {}
        w = lambda level, value: weights[level].get(value, 1)
        domains = sorted({k[0] for k in held})
        top = plain_fill(budget, [(w("domain", d), sum(v for k, v in held.items() if k[0] == d)) for d in domains])
        for d, for_domain in zip(domains, top):
            langs = sorted({k[1] for k in held if k[0] == d})
            mid = plain_fill(for_domain, [(w("lang", x), sum(v for k, v in held.items() if k[:2] == (d, x))) for x in langs])
            for x, for_lang in zip(langs, mid):
                sources = sorted(k[2] for k in held if k[:2] == (d, x))
                for s, v in zip(sources, plain_fill(for_lang, [(w("source", s), held[d, x, s]) for s in sources])):
                    want[d, x, s] = v
        assert all(abs(share[k] - want[k]) <= 2 for k in held), (budget, share, want)


def test_shares_are_filled_exactly(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "repeat('w ', int(id % 17)) AS text", "if(id % 3 = 0, 'en', 'de') AS lang",
        "concat('src', if(id < 1000, 0, id % 5)) AS source", "1 AS n_chars",
    )
    got = mixing.mix(docs, F.expr("total * 3 div 2"), {"domain": {"domain0": 2}}, epochs=2, seed=3).collect()
    total = sum(k % 17 for k in range(3000))
    assert sum(r.taken for r in got) == total * 3 // 2
    leaves = defaultdict(list)
    for r in got:
        assert 0 < r.taken <= r.tokens == r.doc_id % 17
        leaves[r.domain, r.lang, r.source].append(r)
    assert len({(r.doc_id, r.epoch) for r in got}) == len(got)
    for rows in leaves.values():
        assert sum(r.taken < r.tokens for r in rows) <= 1  # only where the share ends
    other = mixing.mix(docs, F.expr("total div 2"), epochs=1, seed=4).collect()
    again = mixing.mix(docs, F.expr("total div 2"), epochs=1, seed=4).collect()
    assert Counter(map(tuple, other)) == Counter(map(tuple, again))
    assert Counter(map(tuple, other)) != Counter(map(tuple, mixing.mix(docs, F.expr("total div 2"), epochs=1, seed=5).collect()))


def test_query_and_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = llm_queries()["op2_hierarchical_budgets"](spark, sf)
    rel = con.sql(llm_sql()["op2_hierarchical_budgets"])
    assert rel.columns == got.columns
    assert Counter(map(tuple, got.collect())) == Counter(rel.fetchall())


def test_odd_rows(spark, documents, words):
    texts = [None, "", " \n", "a", "b c", "\ta  b\n", "b c", " ".join(words(1, 30_000))]
    df = documents(texts, {"tokens": 9, "share": 1, "domain": "x", "key": 0, "bucket": 0, "epoch": "y"})
    df = df.union(df.where("doc_id = 4")).union(df.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    df = df.withColumn("source", F.when(F.col("doc_id") != 5, F.col("source")))
    got = {r.doc_id: r for r in mixing.mix(df, F.expr("total")).collect()}
    assert {d: (r.tokens, r.taken) for d, r in got.items()} == {
        3: (1, 1), 4: (4, 4), 5: (2, 2), 6: (2, 2), 7: (30_000, 30_000), None: (1, 1),
    }
    assert got[5].source == "none" and got[3].lang == "none"
    assert mixing.mix(df, F.lit(0)).collect() == []
    assert mixing.mix(df.limit(0), F.expr("total")).collect() == []


@pytest.mark.parametrize("source,want", [("src13", "domain1"), ("x", "domain0"), (None, "domain0"), ("s99999999999", "domain3")])
def test_domains(spark, source, want):
    df = spark.createDataFrame([(source,)], "source string")
    assert df.select(mixing.domain_of(F.col("source"))).first()[0] == want
